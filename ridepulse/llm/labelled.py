"""Bounded samples of labelled documents, for the operators that learn from labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridepulse.llm.common import stored


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, learn: Column | None, limit: int, *,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``text`` and ``label`` (0 or 1) of about ``limit`` labelled documents, at most 1.5 times that, stored.

    The labelled ids are cut down by a hash threshold before they meet the texts, so only a broadcast of bounded size
    joins the scan. Null labels and ids are left out; of contradicting labels for one id the larger counts; repeated
    rows and equal texts count once.
    """
    known = labels.where(learn) if learn is not None else labels
    ids = known.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")) \
        .where("id IS NOT NULL AND label IN (0, 1)").groupBy("id").agg(F.max("label").alias("label"))
    total = ids.count()
    rate = min(1.0, limit / max(1, total))
    few = ids.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / float(1 << 30) < rate).limit(limit * 3 // 2)
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return stored(texts.join(F.broadcast(few), "id").groupBy("text").agg(F.max("label").alias("label")), "labelled")
