"""Document fingerprints from prefix polynomial hashes.

A text's prefix sums ``S[i] = sum of code[j] * base^j for j < i`` modulo a Mersenne prime give the hash of any span with
one subtraction and one product, so equal spans are found in constant time and the longest common extension of two
places by binary search. The fingerprint holds the text's length, its hash under two bases and a sketch: the least
mixed hash of all its spans of ``SPAN`` code points in each of ``SLOTS`` slots. The share of equal slots estimates the
share of spans two texts have in common.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridepulse.llm.common import arrow_schema, bounded_batches, shuffle_partitions, split_points

PRIME = (1 << 31) - 1
BASES = (1_000_003, 7_368_787)
SPAN, SLOTS = 12, 128
_P = np.uint64(PRIME)
_EMPTY = np.uint16(0xFFFF)


def _fold(x: np.ndarray) -> np.ndarray:
    """``x`` (below 2^62) modulo the prime."""
    x = (x & _P) + (x >> np.uint64(31))
    x = (x & _P) + (x >> np.uint64(31))
    return np.where(x >= _P, x - _P, x)


class _Powers:
    """Powers of a base and of its inverse, extended as longer texts come."""

    def __init__(self, base: int):
        self.factors = base, pow(base, PRIME - 2, PRIME)
        self.tables = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.tables[0]) < n:
            size = len(self.tables[0])
            self.tables = [np.concatenate([t, _fold(t * np.uint64(pow(f, size, PRIME)))])
                           for t, f in zip(self.tables, self.factors, strict=True)]
        return self.tables[0][:n], self.tables[1][:n]


_POWERS = tuple(_Powers(b) for b in BASES)


class PrefixHash:
    """Prefix hashes of one text under one of the bases."""

    def __init__(self, codes: np.ndarray, which: int = 0):
        n = len(codes)
        power, self.inverse = _POWERS[which].get(n + 1)
        sums = np.cumsum(_fold((codes.astype(np.uint64) + np.uint64(1)) * power[:n]))
        self.sums = np.concatenate((np.zeros(1, np.uint64), _fold(sums)))
        self.n = n

    def span(self, start: int, end: int) -> int:
        """Hash of a span, the same wherever the span lies."""
        return (int(self.sums[end]) - int(self.sums[start])) % PRIME * int(self.inverse[start]) % PRIME

    def spans(self, length: int) -> np.ndarray:
        """Hashes of all spans of a length, in the order of their starts."""
        if self.n < length:
            return np.zeros(0, np.uint64)
        return _fold(_fold(self.sums[length:] + _P - self.sums[:self.n - length + 1])
                     * self.inverse[:self.n - length + 1])


def common_extension(a: tuple[PrefixHash, PrefixHash], i: int, b: tuple[PrefixHash, PrefixHash], j: int) -> int:
    """Length of the longest common extension of place ``i`` of one text and ``j`` of another, by binary search.

    Both arguments hold the prefix hashes under the two bases; spans count as equal if both hashes are.
    """
    low, high = 0, min(a[0].n - i, b[0].n - j)
    while low < high:
        mid = (low + high + 1) // 2
        if all(x.span(i, i + mid) == y.span(j, j + mid) for x, y in zip(a, b, strict=True)):
            low = mid
        else:
            high = mid - 1
    return low


def _mix(x: np.ndarray) -> np.ndarray:
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    return x * np.uint64(0xD6E8FEB86659FD93)


def least_per_slot(mixed: np.ndarray) -> np.ndarray:
    """Least value of every slot (the slot is given by the high bits); the largest number where a slot is empty."""
    out = np.full(SLOTS, np.iinfo(np.uint64).max, np.uint64)
    if not len(mixed):
        return out
    low = mixed << np.uint64(7)
    slot = (mixed >> np.uint64(57)).astype(np.int64)
    if len(mixed) > 64 * SLOTS:  # small values hold every slot's least, unless a slot has none of them
        few = np.flatnonzero(low < np.uint64(int(2.0 ** 64 * 16 * SLOTS / len(mixed))))
        np.minimum.at(out, slot[few], low[few])
        if (out != np.iinfo(np.uint64).max).all():
            return out
    np.minimum.at(out, slot, low)
    return out


class Fingerprint:
    """A text with its hashes and its sketch."""

    def __init__(self, text: str):
        self.text = text
        self.codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        self.hashes = PrefixHash(self.codes, 0), PrefixHash(self.codes, 1)
        self.mixed = _mix(self.hashes[0].spans(SPAN))
        if not len(self.mixed) and len(self.codes):
            self.mixed = _mix(np.array([self.hashes[0].span(0, len(self.codes))], np.uint64))
        self.least = least_per_slot(self.mixed)

    @property
    def slots(self) -> np.ndarray:
        return slots(self.least)

    def __str__(self) -> str:
        return encode(len(self.codes), [h.span(0, h.n) for h in self.hashes], self.slots)


def slots(least: np.ndarray) -> np.ndarray:
    """The least values cut to 16 bits; 0xFFFF stands for an empty slot alone."""
    cut = (least >> np.uint64(48)).astype(np.uint16) ^ (least >> np.uint64(16)).astype(np.uint16)
    return np.where(least == np.iinfo(np.uint64).max, _EMPTY, np.where(cut == _EMPTY, np.uint16(0xFFFE), cut))


def encode(n: int, whole: list[int], sketch: np.ndarray) -> str:
    return f"{n:x}-{whole[0]:08x}{whole[1]:08x}-{sketch.astype('>u2').tobytes().hex()}"


def likeness(a: str, b: str) -> float:
    """Estimated share of common spans of two texts, from their fingerprints alone; 1 for equal fingerprints."""
    if a == b:
        return 1.0
    x, y = (np.frombuffer(bytes.fromhex(f.rsplit("-", 1)[1]), ">u2") for f in (a, b))
    return slot_likeness(x, y)


def slot_likeness(x: np.ndarray, y: np.ndarray) -> float:
    used = int(((x != _EMPTY) | (y != _EMPTY)).sum())
    return float(((x == y) & (x != _EMPTY)).sum()) / used if used else 0.0


def edited(own: Fingerprint, following: Fingerprint) -> tuple[str, str, np.ndarray, int]:
    """The text with its last third replaced by as much of the following one's start: text, fingerprint, slots, LCE.

    Spans inside the kept part come from the text's own prefix hashes; only those that reach the new part are hashed.
    """
    n = len(own.codes)
    keep = n - n // 3
    new = following.codes[:n // 3]
    text = own.text[:keep] + following.text[:len(new)]
    total = keep + len(new)
    codes = np.concatenate([own.codes[:keep], new])
    hashes = PrefixHash(codes, 0), PrefixHash(codes, 1)
    if total < SPAN:
        least = least_per_slot(_mix(np.array([hashes[0].span(0, total)] if total else [], np.uint64)))
    else:
        inside = max(0, keep - SPAN + 1)
        fresh = PrefixHash(codes[inside:], 0).spans(SPAN)
        kept = own.mixed[:inside] if n >= SPAN else own.mixed[:0]
        least = least_per_slot(np.concatenate([kept, _mix(fresh)]))
    sketch = slots(least)
    name = encode(total, [h.span(0, total) for h in hashes], sketch)
    return text, name, sketch, common_extension(own.hashes, 0, hashes, 0)


def fingerprints(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """``docs`` with ``fingerprint``. A null text counts as empty; equal texts have equal fingerprints."""
    bounded_batches(docs.sparkSession)

    @F.pandas_udf(T.StringType())
    def of(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: str(Fingerprint(t or "")))

    return docs.withColumn("fingerprint", of(F.col(f"`{text_col}`").cast("string")))


def with_next_edit(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document's fingerprint beside that of its edit by the next document in descending id.

    Columns: ``doc_id``, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited``,
    ``near_next`` and ``common_prefix`` (longest common extension of text and edit from their starts). After the last
    document comes the first. Null texts are empty; null ids come last; rows of one id follow in the order of a hash
    of their text, then of the text. A single row follows itself. An empty table gives no rows.

    Documents are dealt into id ranges by one shuffle; the first document of every range is also sent to the range
    before whose last document it follows, so that no range waits for another.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"),
                       F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    least = np.iinfo(np.int64).min
    points = split_points(rows, "id", shuffle_partitions(spark))

    @F.pandas_udf(T.IntegerType())
    def shard_of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(points, ids.to_numpy(np.int64), "right").astype(np.int32))

    # Null ids take the least key: they come last in descending order.
    keyed = rows.select("id", F.coalesce("id", F.lit(least)).alias("key")).withColumn("shard", shard_of("key"))
    tops = sorted((r.shard, r.top) for r in keyed.groupBy("shard").agg(F.max("key").alias("top")).collect())
    lent = {top: tops[(k + 1) % len(tops)][0] for k, (_, top) in enumerate(tops)}  # to the range above; last to first

    @F.pandas_udf("array<int>")
    def dealt_to(ids: pd.Series) -> pd.Series:
        own = np.searchsorted(points, ids.to_numpy(np.int64), "right").tolist()
        return pd.Series([[k, lent[i]] if i in lent else [k] for k, i in zip(own, ids.tolist())])

    dealt = (rows.withColumn("key", F.coalesce("id", F.lit(least)))
             .select("id", "text", "key", F.posexplode(dealt_to("key")).alias("lent", "at"))
             .repartitionById(len(points) + 1, "at")
             .sortWithinPartitions("lent", F.desc("key"), F.xxhash64("text"), "text").select("id", "text", "lent"))
    schema = T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("n_chars", T.LongType()),
        T.StructField("edited_sha256", T.StringType()), T.StructField("fingerprint", T.StringType()),
        T.StructField("edited_fingerprint", T.StringType()), T.StructField("near_edited", T.DoubleType()),
        T.StructField("near_next", T.DoubleType()), T.StructField("common_prefix", T.LongType())])
    target = arrow_schema(schema)

    def run(batches):
        previous: tuple[int | None, Fingerprint] | None = None
        done = False
        for batch in batches:
            out = []
            for doc_id, text, borrowed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if done:
                    break
                own = Fingerprint(text)
                if previous is not None:
                    out.append(_row(*previous, own))
                previous, done = (doc_id, own), bool(borrowed)  # the first borrowed row only ends the range
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(target)],
                                             schema=target)

    return dealt.mapInArrow(run, schema)


def _row(doc_id: int | None, own: Fingerprint, following: Fingerprint) -> tuple:
    text, name, sketch, common = edited(own, following)
    mine, theirs = str(own), str(following)
    near = 1.0 if mine == name else slot_likeness(own.slots, sketch)
    return (doc_id, len(own.codes), hashlib.sha256(text.encode("utf-8", "replace")).hexdigest(), mine, name, near,
            1.0 if mine == theirs else slot_likeness(own.slots, following.slots), common)
