"""Exact substring deduplication with an FM-index per shard.

A window is ``width`` consecutive words. Its minimiser is the least hash of its word groups (``group`` words each), a
function of the window's words alone, so equal windows have equal minimisers. Each document is cut into segments: runs
of windows with one minimiser, with the words they cover. The minimiser's hash picks the shard, so every window meets
all its equals in one shard and the work grows with the text, not with shards times text.

A first pass weighs the segments: their bytes are summed on Spark per bin of minimisers (16 bins to ``shard_bytes``). Where a
bin weighs more than a quarter of a shard - a phrase that stands in ever different contexts - its segments are taken
apart into windows, dealt by the hash of the whole window: also a function of its words alone, so equal windows still
meet, but different contexts no longer do. A shard thus holds about ``shard_bytes`` and no minimiser more than a
quarter of that, however often a phrase occurs.

Before anything is shuffled, equal segments of a task are folded into their earliest (what a map-side combine does for
sums): a passage that a third of all documents share reaches its shard once per task. In the shard, segments whose
minimiser occurs nowhere else are dropped, equal ones are folded again, and the words of the rest are indexed: the
Burrows-Wheeler transform in a wavelet tree. Every segment is streamed against the index by backward search; windows
that occur at least twice yield the interval of their occurrences, and the least text position in it tells whether
one of them lies earlier.
"""

from __future__ import annotations

import itertools
import pickle

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridepulse.llm.common import arrow_schema, bounded_batches, free_name, ranges, shuffle_partitions
from ridepulse.llm.fmindex import FMIndex

_NULL_ID = -(1 << 63)  # a null id sorts before every other
HITS = T.StructType([T.StructField("hit_id", T.LongType()), T.StructField("hit_tie", T.LongType()),
                     T.StructField("start", T.IntegerType()), T.StructField("windows", T.IntegerType())])


class _Hashes(dict):
    """64-bit hashes of words, each computed once."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 200_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_HASHES = _Hashes()
#: Compression of the segments: they are the largest part of the shuffle.
LEVEL = 6
#: Text that a task folds before it sends its segments on.
FLUSH_BYTES = 10 << 20


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of every ``width`` consecutive ones."""
    span, out = 1, values
    while span * 2 <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    rest = width - span
    return np.minimum(out[:len(out) - rest], out[rest:]) if rest else out


def group_hashes(hashes: np.ndarray, group: int) -> np.ndarray:
    """Hash of every ``group`` consecutive words."""
    mixed = np.zeros(len(hashes) - group + 1, np.uint64)
    for k in range(group):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + hashes[k:len(hashes) - group + 1 + k]
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ mixed >> np.uint64(32)


def _cuts(words: list[bytes], width: int, group: int):
    """Group hashes, and first window, windows and minimiser of every segment of a document of ``width`` words or more."""
    hashes = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    mixed = group_hashes(hashes, group)
    least = sliding_min(mixed, width - group + 1)
    cut = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
    return mixed, cut, np.diff(np.concatenate((cut, [len(least)]))), least[cut]


def segments(words: list[bytes], width: int, group: int):
    """(first window, windows, minimiser, text of the words) of every segment of a document.

    ``windows`` is twice their number, plus one if the minimiser occurs more than once in the segment: only then can
    one of its windows repeat another.
    """
    if len(words) < width:
        return
    mixed, cut, count, least = _cuts(words, width, group)
    spread = count + width - group
    equal = mixed[ranges(cut, spread)] == np.repeat(least, spread)
    several = np.add.reduceat(equal, np.cumsum(spread) - spread) > 1
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    begin = (ends - np.fromiter(map(len, words), np.int64, len(words)) - 1)[cut]
    stop = ends[cut + count + width - 2] - 1
    texts = map(joined.__getitem__, map(slice, begin.tolist(), stop.tolist()))
    yield from zip(cut.tolist(), (2 * count + several).tolist(), least.tolist(), texts, strict=True)


def _fold(found, first: dict[bytes, tuple], hits: list) -> None:
    """Keep the earliest occurrence of each segment text in ``first``; the windows of all others go to ``hits``.

    ``found`` gives (text, (id, tie, start), windows as ``segments`` gives them, minimiser).
    """
    for text, key, n, least in found:
        have = first.setdefault(text, (key, n, least))
        if have[0] == key:
            continue
        if key < have[0]:
            first[text] = (key, n, least)
            key = have[0]
        hits.append((*key, n >> 1))


def _windows(first: dict, hot: frozenset, bins: int, width: int):
    """Take the segments of hot bins out of ``first``, in parts: each window as a segment of its own, keyed by its hash.

    Yields (windows, folded as in ``first``; hits of the fold); no part holds much more than ``FLUSH_BYTES`` of text.
    """
    found = [text for text, (_, _, least) in first.items() if least % bins in hot] if hot else []
    part, hits, size = {}, [], 0
    for text in found:
        (d, t, start), n, _ = first.pop(text)
        words = text.split()
        for k in range(n >> 1):
            window = b" ".join(words[k:k + width])
            size += len(window)
            _fold([(window, (d, t, start + k), 2, xxhash.xxh64_intdigest(window))], part, hits)
            if size > FLUSH_BYTES:
                yield part, hits
                part, hits, size = {}, [], 0
    if part:
        yield part, hits


def _emit(first: dict, hits: list, shards: int):
    """A row for every shard that the segments fall into; the hits ride along with the first."""
    by: dict[int, list] = {}
    for text, (key, n, least) in first.items():
        by.setdefault(least % shards, []).append((text, key, n, least))
    if hits and not by:
        by[0] = []
    pack = zstandard.ZstdCompressor(level=LEVEL)
    for k, (shard, rows) in enumerate(by.items()):
        columns = {
            "text": b"\n".join(r[0] for r in rows),
            "sizes": np.array([len(r[0]) for r in rows], np.int32),
            "ids": np.array([r[1][0] for r in rows], np.int64), "ties": np.array([r[1][1] for r in rows], np.int64),
            "starts": np.array([r[1][2] for r in rows], np.int32), "n": np.array([r[2] for r in rows], np.int32),
            "least": np.array([r[3] >> 32 for r in rows], np.uint32),  # equal minimisers stay equal
            "hits": np.array(hits if k == 0 else [], np.int64).reshape(-1, 4),
        }
        yield shard, pack.compress(pickle.dumps({c: v if isinstance(v, bytes) else (v.dtype.str, v.shape, v.tobytes())
                                                 for c, v in columns.items()}, protocol=5))


def _load(payload: bytes) -> dict:
    raw = pickle.loads(zstandard.ZstdDecompressor().decompress(payload))
    return {c: v if isinstance(v, bytes) else np.frombuffer(v[2], v[0]).reshape(v[1]) for c, v in raw.items()}


def shard_hits(payloads: list[bytes], width: int) -> list[tuple[int, int, int, int]]:
    """(id, tie, first window, windows) of the windows of one shard that occur earlier."""
    blocks = [_load(p) for p in payloads]
    hits = [tuple(h) for b in blocks for h in b["hits"].tolist()]
    if not any(len(b["n"]) for b in blocks):
        return hits
    every = np.concatenate([b["least"] for b in blocks])
    _, inverse, times = np.unique(every, return_inverse=True, return_counts=True)
    often = times[inverse] > 1
    wanted = often | (np.concatenate([b["n"] for b in blocks]) & 1 == 1)

    def rows():
        base = 0
        for b in blocks:
            n = len(b["n"])
            keep = np.flatnonzero(wanted[base:base + n])
            base += n
            ends = np.cumsum(b["sizes"].astype(np.int64) + 1) - 1
            begin = ends - b["sizes"]
            for i, x, y, d, t, s, w, m in zip(keep.tolist(), *(v[keep].tolist() for v in (
                    begin, ends, b["ids"], b["ties"], b["starts"], b["n"], b["least"])), strict=True):
                yield b["text"][x:y], (d, t, s), w, m

    first: dict[bytes, tuple] = {}
    _fold(rows(), first, hits)
    del blocks
    # What is left of a minimiser that has a single distinct segment has met nothing else.
    left: dict[int, int] = {}
    for _, n, m in first.values():
        left[m] = left.get(m, 0) + 1 + (n & 1)
    rest = sorted((key, n, text) for text, (key, n, m) in first.items() if left[m] > 1)
    if rest:
        hits += _search(rest, width)
    return hits


def _search(rest: list, width: int) -> list[tuple[int, int, int, int]]:
    """Index the segments (in document order) and stream them against the index."""
    numbers: dict[bytes, int] = {}
    pieces, sizes = [], np.zeros(len(rest), np.int64)
    for i, (_, _, text) in enumerate(rest):
        found = text.split()
        sizes[i] = len(found)
        pieces += [numbers.setdefault(w, len(numbers) + 1) for w in found]
        pieces.append(0)
    text = np.array(pieces, np.int64)
    starts = np.cumsum(sizes + 1) - sizes - 1
    index = FMIndex(text, width)
    counts = np.array([n >> 1 for _, n, _ in rest], np.int64)
    at, low, high = index.repeats(text, starts, starts + counts - 1, width)
    if not len(at):
        return []
    # The earliest occurrence of each distinct interval: text positions are in document order.
    lows, where = np.unique(low, return_index=True)
    size = high[where] - lows
    least = np.minimum.reduceat(index.order[ranges(lows, size)], np.cumsum(size) - size)
    at = np.sort(at[least[np.searchsorted(lows, low)] < at])
    piece = np.searchsorted(starts, at, "right") - 1
    begin = np.flatnonzero(np.concatenate(([True], (np.diff(at) != 1) | (np.diff(piece) != 0)))) if len(at) else []
    runs = np.diff(np.concatenate((begin, [len(at)]))) if len(at) else []
    out = []
    for i, n in zip(begin, runs, strict=True):
        (d, t, s), _, _ = rest[piece[i]]
        out.append((d, t, s + int(at[i] - starts[piece[i]]), int(n)))
    return out


def segment_weights(docs: DataFrame, *, width: int, group: int, bins: int) -> DataFrame:
    """``bin`` and ``bytes``: the text of the segments of every bin of minimisers, before any fold."""
    schema = T.StructType([T.StructField("bin", T.LongType()), T.StructField("bytes", T.LongType())])
    target = arrow_schema(schema)

    def weigh(batches):
        def flush():
            number, inverse = np.unique(np.concatenate(least) % np.uint64(bins), return_inverse=True)
            total = np.bincount(inverse, np.concatenate(weight)).astype(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(number.astype(np.int64)), pa.array(total)], schema=target)

        least, weight, size = [], [], 0
        for batch in batches:
            for body in batch.column(0).to_pylist():
                words = (body or b"").split()
                if len(words) < width:
                    continue
                _, _, count, have = _cuts(words, width, group)
                ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
                first = np.cumsum(count) - count
                least.append(have)
                weight.append(ends[first + count + width - 2] - np.where(first > 0, ends[first - 1], 0))
                size += len(body)
                if size > FLUSH_BYTES:
                    yield flush()
                    least, weight, size = [], [], 0
        if least:
            yield flush()
        _HASHES.clear()

    return docs.select("body").mapInArrow(weigh, schema).groupBy("bin").agg(F.sum("bytes").alias("bytes"))


def repeated_windows(docs: DataFrame, *, width: int = 20, group: int = 4, shard_bytes: int = 64 << 20) -> DataFrame:
    """Runs of windows that also start earlier: ``hit_id``, ``hit_tie``, ``start`` and ``windows`` (how many).

    ``docs`` has ``id`` (long), ``tie`` (long) and ``body`` (binary). The bins that come to the driver are those of
    more than ``shard_bytes / 4``: at most about twelve times the text over ``shard_bytes``.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    total = docs.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    # A segment covers about half a window of new words, so the segments hold about three times the text.
    least_shards = int(3 * total) // shard_bytes + 1
    shards = max(shuffle_partitions(spark), least_shards)
    bins = 16 * least_shards  # of a sixteenth of a shard each, unless a minimiser is hot
    heavy = (segment_weights(docs, width=width, group=group, bins=bins).where(F.col("bytes") > shard_bytes // 4)
             .collect())
    hot = frozenset(r["bin"] for r in heavy)
    # A word of a segment stands in at most ``width`` of its windows.
    shards += width * sum(r["bytes"] for r in heavy) // shard_bytes
    blocks = T.StructType([T.StructField("shard", T.LongType()), T.StructField("payload", T.BinaryType())])
    target, hit_target = arrow_schema(blocks), arrow_schema(HITS)

    def cut(batches):
        def flush():
            for part, more in _windows(first, hot, bins, width):
                yield packed(part, more)
            yield packed(first, hits)

        def packed(first, hits):
            rows = list(_emit(first, hits, shards))
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()),
                                               pa.array([r[1] for r in rows], pa.binary())], schema=target)

        first, hits, size = {}, [], 0
        for batch in batches:
            for i, t, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                key = _NULL_ID if i is None else i
                _fold(((text, (key, t, start), n, least)
                       for start, n, least, text in segments((body or b"").split(), width, group)), first, hits)
                size += len(body or b"")
                if size > FLUSH_BYTES:
                    yield from flush()
                    first, hits, size = {}, [], 0
        if first:
            yield from flush()
        _HASHES.clear()  # the worker may serve other operators next

    def search(table: pa.Table) -> pa.Table:
        got = shard_hits(table.column("payload").to_pylist(), width)
        columns = list(zip(*got, strict=True)) or [(), (), (), ()]
        return pa.Table.from_arrays([pa.array(c, hit_target.field(k).type) for k, c in enumerate(columns)],
                                    schema=hit_target)

    return docs.select("id", "tie", "body").mapInArrow(cut, blocks).groupBy("shard").applyInArrow(search, HITS)


def remove_repeats(docs: DataFrame, *, width: int = 20, id_col: str = "doc_id", text_col: str = "text",
                   keep_untouched: bool = False, **options) -> DataFrame:
    """``docs`` with ``text_col`` replaced by its kept words, and ``n_words``, ``n_removed``, ``removed`` (spans).

    Words are runs of anything but the six ASCII blanks. A word goes if a window of ``width`` consecutive words that
    covers it has a word sequence that also starts earlier: in a document with a smaller id, or earlier in the same
    one. Windows are judged on the input. Kept words are joined by one space (with
    ``keep_untouched``, a text that loses nothing keeps its own white space, and a null stays null). Texts of fewer words than a window, empty
    ones and nulls lose nothing (a null text becomes the empty text). A null id sorts before all others. Rows with one
    id and different texts follow the order of a hash of their text; fully repeated rows are one document, so they get
    the same result. An empty table gives no rows. Columns of ``docs`` named like the added ones are replaced.
    """
    added = [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
             T.StructField("removed", T.ArrayType(T.StructType([T.StructField("start", T.LongType()),
                                                                T.StructField("end", T.LongType())])))]
    plain = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"),
                        F.xxhash64(F.col(f"`{text_col}`")).alias("tie"),
                        F.col(f"`{text_col}`").cast("binary").alias("body"))
    hits = (repeated_windows(plain, width=width, **options).groupBy("hit_id", "hit_tie")
            .agg(F.collect_list(F.struct("start", "windows")).alias("hit_runs")))
    names = [f.name for f in added]
    own = [f for f in docs.schema.fields if f.name not in names]
    keys = [free_name(docs.columns, c) for c in ("hit_id", "hit_tie")]
    runs_name = free_name(docs.columns, "hit_runs")
    left = docs.select(*[F.col(f"`{f.name}`") for f in own],
                       F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(_NULL_ID)).alias(keys[0]),
                       F.xxhash64(F.col(f"`{text_col}`")).alias(keys[1]))
    joined = left.join(hits.toDF(*keys, runs_name), keys, "left").drop(*keys)
    schema = T.StructType([*own, *added])
    target = arrow_schema(schema)
    at = target.get_field_index(text_col)

    def apply(batches):
        for batch in batches:
            runs = batch.column(runs_name).to_pylist()
            results = [kept_words(body or b"", r or [], width)
                       for body, r in zip(batch.column(text_col).cast(pa.binary()).to_pylist(), runs, strict=True)]
            columns = [batch.column(f.name).cast(target.field(f.name).type) for f in own]
            if keep_untouched:
                own_text = batch.column(text_col).cast(pa.binary()).to_pylist()
                results = [r if r[2] else (t, *r[1:]) for t, r in zip(own_text, results, strict=True)]
            columns[at] = pa.array([r[0] for r in results], pa.binary()).cast(pa.string()).cast(target.field(at).type)
            columns += [pa.array([r[k] for r in results], target.field(names[k - 1]).type) for k in (1, 2, 3)]
            yield pa.RecordBatch.from_arrays(columns, schema=target)

    return joined.mapInArrow(apply, schema)


def kept_words(body: bytes, runs: list[dict], width: int):
    """(kept text, words, removed words, removed spans) of a document with the given runs of windows."""
    words = body.split()
    spans: list[dict] = []
    for r in sorted(runs, key=lambda r: r["start"]):
        a, b = r["start"], r["start"] + r["windows"] + width - 1
        if spans and a <= spans[-1]["end"]:
            spans[-1]["end"] = max(b, spans[-1]["end"])
        else:
            spans.append({"start": a, "end": b})
    edges = [0, *itertools.chain.from_iterable((s["start"], s["end"]) for s in spans), len(words)]
    kept = [w for k in range(0, len(edges), 2) for w in words[edges[k]:edges[k + 1]]]
    return b" ".join(kept), len(words), len(words) - len(kept), spans
