"""Language identification by nearest clustered centroids.

A text becomes a normalised TF-IDF vector over hashed character n-grams (1 to 3 letters of the lower-cased text; runs
of anything but letters count as one blank). For every language some centroids are found by spherical k-means on a
bounded sample of its labelled texts; the document frequencies come from all labelled texts. A text gets the language
of the centroid of highest cosine, and is marked as rejected if it lies farther from it than the centroid's own
members do.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridepulse.llm.common import arrow_schema, bounded_batches, free_name

#: Buckets of hashed n-grams.
BUCKETS = 1 << 12
#: The language of a text without letters.
UNKNOWN = "und"
_NOT_LETTERS = re.compile(r"[\W\d_]+")


def letters(text: str | None) -> str:
    """Lower-cased letters of a text, with one blank for everything between them; empty if there is no letter."""
    clean = _NOT_LETTERS.sub(" ", text.lower()) if text else ""
    return f" {clean.strip()} " if clean.strip() else ""


def counts(text: str | None) -> np.ndarray | None:
    """Hashed n-gram counts of the whole text; None if it has no letter."""
    clean = letters(text)
    if not clean:
        return None
    codes = np.frombuffer(clean.encode("utf-32-le"), np.uint32)
    out = np.zeros(BUCKETS, np.int64)
    for i in range(0, len(codes), 1 << 18):  # whole texts, in pieces that overlap by two letters
        part = codes[i:i + (1 << 18) + 2]
        one = part * np.uint32(0x9E3779B1)
        two = (one[:-1] ^ (part[1:] * np.uint32(0x85EBCA77))) * np.uint32(0xC2B2AE3D)
        three = (two[:-1] ^ (part[2:] * np.uint32(0x27D4EB2F))) * np.uint32(0x165667B1)
        edge = 0 if i + (1 << 18) + 2 > len(codes) else None
        keep = slice(None) if edge == 0 else slice(0, 1 << 18)
        for grams in (one, two, three):
            out += np.bincount(grams[keep] >> np.uint32(20), minlength=BUCKETS)
    return out


def vectors(found: list[np.ndarray | None], idf: np.ndarray) -> np.ndarray:
    """Normalised TF-IDF rows (zero for a text without letters)."""
    out = np.zeros((len(found), BUCKETS), np.float32)
    for i, c in enumerate(found):
        if c is not None:
            row = np.log1p(c) * idf
            out[i] = row / np.linalg.norm(row) if row.any() else row
    return out


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 15) -> np.ndarray:
    """At most ``k`` unit centroids. Starts from the rows farthest from those already taken, so it is deterministic."""
    taken = [0]
    near = x @ x[0]
    while len(taken) < min(k, len(x)):
        far = int(near.argmin())
        if near[far] > 0.999999:
            break
        taken.append(far)
        near = np.maximum(near, x @ x[far])
    centres = x[taken]
    for _ in range(rounds):
        member = (x @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, member, x)
        alive = np.linalg.norm(sums, axis=1) > 0
        new = sums[alive] / np.linalg.norm(sums[alive], axis=1, keepdims=True)
        if new.shape == centres.shape and np.allclose(new, centres, atol=1e-6):
            break
        centres = new
    return centres


def fit(train: DataFrame, *, text_col: str = "text", lang_col: str = "lang", per_language: int = 1000,
        centroids: int = 6, quantile: float = 0.995, slack: float = 1.25) -> dict:
    """The model from labelled rows: idf, centroids with their language and radius.

    Document frequencies count all rows of ``train``. The centroids come from at most ``per_language`` rows of each
    language: those whose text hash falls under a threshold set by the language's row count. Rows with a null text or
    language, and texts without letters, are left out. The model holds (languages x ``centroids``) vectors.
    """
    spark = train.sparkSession
    bounded_batches(spark)
    rows = train.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")) \
        .where("lang IS NOT NULL AND text IS NOT NULL")
    df_schema = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("n", T.LongType())])
    df_target = arrow_schema(df_schema)

    def frequencies(batches):
        total, n = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                c = counts(text)
                if c is not None:
                    total += c > 0
                    n += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1), pa.int32()),
                                          pa.array(np.append(total[at], n), pa.int64())], schema=df_target)

    df = {r.bucket: int(r.n) for r in rows.select("text").mapInArrow(frequencies, df_schema)
          .groupBy("bucket").agg(F.sum("n").alias("n")).collect()}  # at most BUCKETS + 1 rows
    n = df.pop(-1, 0)
    seen = np.zeros(BUCKETS)
    seen[list(df)] = list(df.values())
    idf = (np.log((1 + n) / (1 + seen)) + 1).astype(np.float32)
    sizes = rows.groupBy("lang").count()
    hashed = rows.withColumn("h", F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / float(1 << 30))
    sample = (hashed.join(F.broadcast(sizes), "lang").where(F.col("h") < F.lit(1.2 * per_language) / F.col("count"))
              .withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy("h")))
              .where(F.col("k") <= per_language))

    def cluster(pdf: pd.DataFrame) -> pd.DataFrame:
        found = [c for c in map(counts, pdf["text"]) if c is not None]
        if not found:
            return pd.DataFrame({"lang": [], "radius": [], "centre": []})
        x = vectors(found, idf)
        centres = spherical_kmeans(x, centroids)
        cosine = x @ centres.T
        member, near = cosine.argmax(axis=1), cosine.max(axis=1)
        radius = [slack * float(np.quantile(1 - near[member == k], quantile)) if (member == k).any() else 0.0
                  for k in range(len(centres))]
        return pd.DataFrame({"lang": pdf["lang"].iloc[0], "radius": radius, "centre": list(centres.astype(np.float64))})

    got = sorted((r.lang, r.radius, r.centre) for r in sample.groupBy("lang").applyInPandas(
        cluster, "lang string, radius double, centre array<double>").collect())
    centres = np.array([r[2] for r in got], np.float32).reshape(-1, BUCKETS)
    return {"idf": idf, "langs": [r[0] for r in got], "radius": np.array([r[1] for r in got]), "centres": centres}


def predict(docs: DataFrame, model: dict, *, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (cosine to the nearest centroid, 0 to 1) and ``rejected``.

    A null text, a text without letters, and any text under a model without languages get ``und``, score 0 and
    ``rejected``. Equal texts get equal results; ties go to the language that sorts first. Columns of ``docs`` with
    the added names are replaced; rows are neither merged nor dropped.
    """
    bounded_batches(docs.sparkSession)
    added = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
             T.StructField("rejected", T.BooleanType())]
    names = [f.name for f in added]
    own = [f for f in docs.schema.fields if f.name not in names]
    schema = T.StructType([*own, *added])
    target = arrow_schema(schema)
    # Added only here, so that an input column of one of these names can also be the text.
    body_name = free_name(schema.names, "text_in")
    source = docs.select(*[F.col(f"`{f.name}`") for f in own], F.col(f"`{text_col}`").cast("string").alias(body_name))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for batch in batches:
            body = batch.column(body_name).to_pylist()
            lang, score, far = [], [], []
            for i in range(0, len(body), 250):
                found = [counts(t) for t in body[i:i + 250]]
                x = vectors(found, m["idf"])
                cosine = x @ m["centres"].T if len(m["langs"]) else np.zeros((len(found), 0), np.float32)
                for c, row in zip(found, cosine, strict=True):
                    if c is None or not len(row):
                        lang.append(UNKNOWN), score.append(0.0), far.append(True)
                        continue
                    k = int(row.argmax())
                    lang.append(m["langs"][k])
                    score.append(float(min(1.0, max(0.0, row[k]))))
                    far.append(bool(1 - row[k] > m["radius"][k]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(f.name).cast(target.field(f.name).type) for f in own] +
                [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(far, pa.bool_())], schema=target)

    return source.mapInArrow(run, schema)
