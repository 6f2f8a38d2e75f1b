"""Operators that hand the columns of their input on, with extra columns of the names they use inside or add."""

import pytest
from helpers import awkward, frame
from pyspark.sql import functions as F

from ridepulse.llm import decontaminate, langid, quality, simhash, substrings, toxicity

NAMES = ["text_in", "keep_key", "keep_n", "hit_id", "hit_tie", "hit_runs", "n_hit", "n_words", "hit_items", "hit_spans",
         "longest_match", "row", "body", "group_fp", "fp", "component_id", "removed", "tie", "shard"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = awkward(seed=3, n=12)
    base = frame(spark, rows)
    return base.select("*", *[F.concat(F.lit(f"{n}:"), F.coalesce(F.col("start").cast("string"), F.lit("-"))).alias(n)
                              for n in NAMES])


def check(before, after, added=(), text="text"):
    """Every row that is left holds its own values in all columns but the text and those the operator adds."""
    names = [c for c in before.columns if c not in added and c != text]
    assert [c for c in after.columns if c not in added] == [c for c in before.columns if c not in added]
    have = {repr(tuple(r)) for r in before.select(*names).collect()}
    left = [repr(tuple(r)) for r in after.select(*names).collect()]
    assert left and set(left) <= have


def test_decontaminate_keeps_columns(spark, docs):
    bench = spark.createDataFrame([("a", "w1 w2 w3"), ("a", "w1 w2 w3"), (None, None), ("b", "zz top")],
                                  "item_id string, text string")
    check(docs, decontaminate.decontaminate(docs, bench))


def test_simhash_deduplicate_keeps_columns(docs):
    check(docs, simhash.deduplicate(docs))


def test_remove_repeats_keeps_columns(docs):
    out = substrings.remove_repeats(docs, width=20)
    check(docs, out.select(*docs.columns), added=("n_words", "n_removed", "removed"))


def test_scores_keep_columns(spark, docs):
    labelled = docs.where("doc_id is not null").select("text", (F.col("doc_id") % 2).cast("int").alias("label"))
    model = langid.fit(docs.select("text", F.lit("en").alias("lang")).where("text is not null"))
    check(docs, langid.predict(docs, model).select(*docs.columns), added=("lang_pred", "score", "rejected"))
    rows = labelled.where("text is not null")
    model = toxicity.fit(rows)
    check(docs, toxicity.score(docs, model).select(*docs.columns), added=("score", "predicted"))
    model = quality.fit(rows, quality.document_frequencies(docs.select("text")))
    check(docs, quality.score(docs, model).select(*docs.columns), added=("score", "predicted"))
