"""Cleans a document table and packs it for training: five stages, each one operator of ``ridepulse.llm``.

``run`` applies the stages in order; every stage's result is written as Parquet to the shared scratch folder and read
back as the documents of the next, so a lost executor never costs more than the stage it was in. All stages but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridepulse.llm import decontaminate, packing, simhash, substrings, toxicity
from ridepulse.llm.common import bounded_batches, stored, table
from ridepulse.llm.queries import tokenizer_path, toxicity_model


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, learnt from the labelled ones among them, does not reject."""
    bounded_batches(spark)
    return toxicity.keep_clean(docs, toxicity_model(spark, docs, sf_dir))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each SimHash group (3-word shingles, 2 bits)."""
    bounded_batches(spark)
    return simhash.deduplicate(docs, shingle=3, radius=2)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words that a repeated 20-word window covers; ``n_chars`` follows the text."""
    bounded_batches(spark)
    cut = substrings.remove_repeats(docs, width=20, keep_untouched=True)
    length = F.when(F.col("n_removed") > 0, F.char_length("text")).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", length.cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words comes from the benchmark."""
    bounded_batches(spark)
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token ids packed into sequences of 1024."""
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json"), size=1024)


STAGES = [
    ("toxicity", reject_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("substring_dedup", cut_repeated_passages),
    ("benchmark_decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

#: SQL has neither the trained model, XXH64 nor the tokenizer; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
