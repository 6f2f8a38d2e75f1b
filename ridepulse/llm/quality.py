"""Quality by nearest-neighbour voting in a latent-semantic space.

A text's terms are the shapes of its words (letters by case, digits and other characters, runs collapsed) and terms
that count its repeats: words seen before, words equal to the one before, lines seen before. TF-IDF vectors of a bounded
labelled sample give the latent axes by truncated SVD; the sample's latent vectors with their labels are broadcast, and
every document is compared with all of them exactly, block by block. The nearest ones vote, weighted by similarity.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridepulse.llm.common import arrow_schema, bounded_batches, free_name

TERMS = 1024
#: Lower-case letters and all non-ASCII bytes become a, upper-case A, digits 0; the rest stays.
_SHAPE = bytes(0x61 if 0x61 <= c <= 0x7A or c >= 0x80 else 0x41 if 0x41 <= c <= 0x5A else
               0x30 if 0x30 <= c <= 0x39 else c for c in range(256))
_BUCKETS: dict[bytes, int] = {}


def _bucket(term: bytes) -> int:
    if term not in _BUCKETS:
        if len(_BUCKETS) > 200_000:
            _BUCKETS.clear()
        _BUCKETS[term] = zlib.crc32(term) % TERMS
    return _BUCKETS[term]


def terms(text: bytes) -> dict[int, float]:
    """Weights of the hashed terms of a whole text: the square root of their share of its words."""
    codes = np.frombuffer(text.translate(_SHAPE), np.uint8)
    if not len(codes):
        return {_bucket(b"empty"): 1.0}
    collapsed = codes[np.concatenate(([True], codes[1:] != codes[:-1]))].tobytes()
    words = text.split()
    n = max(1, len(words))
    found: Counter = Counter(collapsed.split())
    # A sentence break is common to all prose; what matters is how the words between look.
    found[b"repeat seen"] = n - len(set(words)) if words else 0
    found[b"repeat next"] = sum(map(bytes.__eq__, words[1:], words[:-1]))
    lines = text.split(b"\n")
    out: dict[int, float] = {}
    for term, count in found.items():
        k = _bucket(term)
        out[k] = out.get(k, 0.0) + count / n
    k = _bucket(b"repeat line")
    out[k] = out.get(k, 0.0) + (len(lines) - len(set(lines))) / len(lines)
    k = _bucket(b"words %d" % min(12, n.bit_length()))
    out[k] = out.get(k, 0.0) + 0.05
    return {k: v ** 0.5 for k, v in out.items() if v > 0}


def matrix(found: list[dict[int, float]], idf: np.ndarray) -> np.ndarray:
    x = np.zeros((len(found), TERMS), np.float32)
    for i, row in enumerate(found):
        x[i, list(row)] = list(row.values())
    x *= idf
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(norm > 0, norm, 1)


def latent(x: np.ndarray, axes: np.ndarray) -> np.ndarray:
    z = x @ axes
    norm = np.linalg.norm(z, axis=1, keepdims=True)
    return z / np.where(norm > 0, norm, 1)


def document_frequencies(docs: DataFrame, text_col: str = "text") -> tuple[np.ndarray, int]:
    """In how many rows each hashed term occurs, over all rows, and how many rows there are."""
    bounded_batches(docs.sparkSession)
    schema = T.StructType([T.StructField("term", T.IntegerType()), T.StructField("n", T.LongType())])
    target = arrow_schema(schema)

    def count(batches):
        seen, n = np.zeros(TERMS, np.int64), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen[list(terms(text or b""))] += 1
                n += 1
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(TERMS + 1), pa.int32()),
                                          pa.array(np.append(seen, n), pa.int64())], schema=target)

    got = docs.select(F.col(text_col).cast("binary")).mapInArrow(count, schema).groupBy("term") \
        .agg(F.sum("n").alias("n")).collect()  # TERMS + 1 rows
    total = np.zeros(TERMS + 1, np.int64)
    for r in got:
        total[r.term] = r.n
    return total[:-1], int(total[-1])


def fit(sample: DataFrame, frequencies: tuple[np.ndarray, int], *, rank: int = 48) -> dict:
    """The model from a bounded labelled sample (``text``, ``label``): idf, latent axes, vectors and labels."""
    schema = T.StructType([T.StructField("label", T.IntegerType()), T.StructField("terms", T.ArrayType(T.IntegerType())),
                           T.StructField("weights", T.ArrayType(T.FloatType()))])
    target = arrow_schema(schema)

    def extract(batches):
        for batch in batches:
            found = [terms(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array([list(f) for f in found], target.field(1).type),
                                              pa.array([list(f.values()) for f in found], target.field(2).type)],
                                             schema=target)

    rows = sample.select(F.col("text").cast("binary"), "label").mapInArrow(extract, schema).collect()
    rows.sort(key=lambda r: (r.label, r.terms, r.weights))
    seen, n = frequencies
    idf = (np.log((1 + n) / (1 + seen)) + 1).astype(np.float32)
    x = matrix([dict(zip(r.terms, r.weights, strict=True)) for r in rows], idf)
    values, axes = np.linalg.eigh((x.T @ x).astype(np.float64))
    axes = axes[:, np.argsort(-values)[:rank]].astype(np.float32)
    return {"idf": idf, "axes": axes, "vectors": latent(x, axes), "labels": np.array([r.label for r in rows], np.float32)}


def vote(z: np.ndarray, model: dict, neighbours: int, sharpness: float) -> np.ndarray:
    """Share of label 1 among the nearest labelled vectors, weighted by similarity."""
    labels = model["labels"]
    if not len(labels):
        return np.full(len(z), 0.5)
    cosine = z @ model["vectors"].T
    k = min(neighbours, len(labels))
    near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
    weight = np.clip(np.take_along_axis(cosine, near, axis=1), 1e-6, 1).astype(np.float64) ** sharpness
    return (weight * labels[near]).sum(axis=1) / weight.sum(axis=1)


def score(docs: DataFrame, model: dict, *, text_col: str = "text", threshold: float = 0.3, neighbours: int = 15,
          sharpness: float = 8.0) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: label 1 likelier) and ``predicted`` (1 from ``threshold`` on).

    Null and empty texts are scored as texts without words; a model without labels gives 0.5 to all. Rows are neither
    merged nor dropped; columns with the added names are replaced.
    """
    bounded_batches(docs.sparkSession)
    added = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    own = [f for f in docs.schema.fields if f.name not in ("score", "predicted")]
    schema = T.StructType([*own, *added])
    target = arrow_schema(schema)
    body_name = free_name(schema.names, "text_in")
    source = docs.select(*[F.col(f"`{f.name}`") for f in own], F.col(f"`{text_col}`").cast("binary").alias(body_name))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for batch in batches:
            body = batch.column(body_name).to_pylist()
            got = [vote(latent(matrix([terms(t or b"") for t in body[i:i + 500]], m["idf"]), m["axes"]), m, neighbours,
                        sharpness) for i in range(0, len(body), 500)]
            values = np.clip(np.concatenate(got) if got else np.zeros(0), 0.0, 1.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(f.name).cast(target.field(f.name).type) for f in own] +
                [pa.array(values, pa.float64()), pa.array((values >= threshold).astype(np.int32))], schema=target)

    return source.mapInArrow(run, schema)
