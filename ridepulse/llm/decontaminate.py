"""Benchmark decontamination with suffix arrays of the training text.

Each Arrow batch of documents is one shard. Its words become codes of the benchmark's vocabulary (0: a word no
benchmark item has), and the shard's suffix array holds, in word order, every position from which a match can
start. Every suffix of every benchmark item is then located in that array by the binary search of its first ``window``
words; the interval found lists all verbatim occurrences. Occurrences that follow each other in a document and in the
same item are one verbatim match, so the longest match of each document is found with its item and place in it.
Documents are whole within a shard, so no text is shuffled: the only data that
moves is the benchmark, in blocks of bounded size.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridepulse.llm.common import arrow_schema, bounded_batches, ranges

#: Lower-cases A-Z and turns every byte that is not of a word into a blank.
_FOLD = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20
              for c in range(256))

ADDED = [
    T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
    T.StructField("hit_items", T.ArrayType(T.StringType())), T.StructField("longest_match", T.LongType()),
    T.StructField("longest_at", T.LongType()), T.StructField("longest_item", T.StringType()),
    T.StructField("longest_item_at", T.LongType()),
    T.StructField("hit_spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()),
                                                         T.StructField("end", T.LongType())]))),
]


def words(text: bytes | None) -> list[bytes]:
    """Words of a UTF-8 text: runs of ASCII letters, digits and non-ASCII bytes, A-Z lower-cased."""
    return text.translate(_FOLD).split() if text else []


#: Places of benchmark windows that are joined to matches at a time.
PART = 1 << 20


@dataclass
class Block:
    """Searchable suffixes of some benchmark items: a vocabulary and the windows as sorted byte strings."""

    vocab: dict[bytes, int]
    low: np.ndarray  # windows as big-endian codes, shorter ones padded with 0x00
    high: np.ndarray  # the same padded with 0xFF: the end of their interval
    length: np.ndarray  # words of each window
    owner_at: np.ndarray  # window -> slice of ``owners``
    owners: np.ndarray  # indexes into ``items``
    item_at: np.ndarray  # window -> slice of ``places``
    places: np.ndarray  # (index into ``items``, number of the item's text, first word of the window in it)
    items: list[str]
    width: int


def benchmark_block(rows: list[tuple[str, bytes | None]], window: int) -> Block:
    """Windows of the items: every ``window`` consecutive words, or the whole of a shorter item."""
    vocab: dict[bytes, int] = {}
    owners: dict[bytes, set[str]] = {}
    places: dict[bytes, list[tuple[str, int, int]]] = {}
    for number, (item, text) in enumerate(sorted(set(rows), key=lambda r: (r[0], r[1] or b""))):
        codes = np.array([vocab.setdefault(w, len(vocab) + 1) for w in words(text)], ">u4")
        if len(codes):
            for i in range(max(1, len(codes) - window + 1)):
                owners.setdefault(codes[i:i + window].tobytes(), set()).add(item)
                places.setdefault(codes[i:i + window].tobytes(), []).append((item, number, i))
    keys, items = sorted(owners), sorted({i for s in owners.values() for i in s})
    number = {x: i for i, x in enumerate(items)}
    size = 4 * window
    return Block(
        vocab, np.array([k.ljust(size, b"\0") for k in keys], f"S{size}"),
        np.array([k.ljust(size, b"\xff") for k in keys], f"S{size}"), np.array([len(k) // 4 for k in keys], np.int64),
        np.cumsum([0] + [len(owners[k]) for k in keys]),
        np.array([number[x] for k in keys for x in sorted(owners[k])], np.int64),
        np.cumsum([0] + [len(places[k]) for k in keys]),
        np.array([(number[x], t, i) for k in keys for x, t, i in places[k]], np.int64).reshape(-1, 3), items, window)


def suffix_array(codes: np.ndarray, least: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions from which at least ``least`` known words follow, in the order of their next ``width`` words.

    Returns the positions and their keys (big-endian codes; what follows an unknown word is blanked).
    """
    n = len(codes)
    stop = np.where(codes == 0, np.arange(n), n)
    run = np.minimum.accumulate(stop[::-1])[::-1] - np.arange(n) if n else stop
    at = np.flatnonzero(run >= max(1, least))
    if not len(at):
        return at, np.zeros(0, f"S{4 * width}")
    padded = np.concatenate([codes, np.zeros(width, codes.dtype)])
    grid = padded[at[:, None] + np.arange(width)]
    grid[np.arange(width) >= run[at][:, None]] = 0
    keys = np.ascontiguousarray(grid.astype(">u4")).view(f"S{4 * width}").ravel()
    order = np.argsort(keys, kind="stable")
    return at[order], keys[order]


def occurrences(block: Block, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, window) of every verbatim occurrence of a benchmark window in the shard."""
    if not len(block.low):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at, keys = suffix_array(codes, int(block.length.min()), block.width)
    first, last = np.searchsorted(keys, block.low, "left"), np.searchsorted(keys, block.high, "right")
    count = np.maximum(last - first, 0)
    return at[ranges(first, count)], np.repeat(np.arange(len(count)), count)


def longest_matches(block: Block, doc: np.ndarray, pos: np.ndarray, win: np.ndarray) -> dict[int, tuple]:
    """Document -> (words, position in the shard, item, word of the item) of its longest verbatim match.

    Of equally long ones the first in the document counts, then the first item and place. Occurrences are taken in parts
    of whole documents, so that a common window of many items does not fill the memory.
    """
    out: dict[int, tuple] = {}
    if not len(win):
        return out
    order = np.lexsort((pos, doc))
    doc, pos, win = doc[order], pos[order], win[order]
    times = np.diff(block.item_at)[win]
    total = np.cumsum(times)
    last = np.flatnonzero(np.concatenate((doc[1:] != doc[:-1], [True])))
    begin = 0
    while begin < len(doc):
        base = total[begin - 1] if begin else 0
        k = max(np.searchsorted(total[last], base + PART, "right") - 1, np.searchsorted(last, begin))
        part = slice(begin, int(last[k]) + 1)
        begin = part.stop
        place = block.places[ranges(block.item_at[win[part]], times[part])]
        d, p, n = (np.repeat(x, times[part]) for x in (doc[part], pos[part], block.length[win[part]]))
        by = np.lexsort((p, p - place[:, 2], place[:, 1]))
        d, p, n, place = d[by], p[by], n[by], place[by]
        # Positions count over the shard, so a document's end breaks every run.
        new = np.concatenate(([True], (np.diff(p) != 1) | (np.diff(place[:, 1]) != 0) | (np.diff(place[:, 2]) != 1)))
        first = np.flatnonzero(new)
        size = np.diff(np.concatenate((first, [len(p)]))) - 1 + n[first]
        best = np.lexsort((place[first, 2], place[first, 0], p[first], -size, d[first]))
        best = best[np.unique(d[first][best], return_index=True)[1]]
        for i, w in zip(first[best].tolist(), size[best].tolist(), strict=True):
            out[int(d[i])] = w, int(p[i]), block.items[place[i, 0]], int(place[i, 2])
    return out


def scan_shard(block: Block, docs: list[bytes | None], before: list[list[tuple[int, int]]] | None = None):
    """Per document: words, hit words, items, hit spans (word offsets), longest verbatim match as (words, first word,
    item, first word in the item) or None.

    ``before`` gives spans found by earlier blocks; the counts cover those too.
    """
    pieces, sizes = [], np.zeros(len(docs), np.int64)
    get = block.vocab.get
    for i, text in enumerate(docs):
        found = words(text)
        sizes[i] = len(found)
        pieces.append(np.fromiter(map(get, found, repeat(0)), np.uint32, len(found)))
        pieces.append(np.zeros(1, np.uint32))  # a document's end matches nothing
    codes = np.concatenate(pieces) if pieces else np.zeros(0, np.uint32)
    starts = np.concatenate(([0], np.cumsum(sizes + 1)))
    pos, win = occurrences(block, codes)
    length = block.length[win] if len(win) else np.zeros(0, np.int64)
    doc = np.searchsorted(starts, pos, "right") - 1
    edges = np.zeros(len(codes) + 1, np.int64)
    np.add.at(edges, pos, 1)
    np.add.at(edges, pos + length, -1)
    for i, spans in enumerate(before or []):
        for a, b in spans:
            edges[starts[i] + a] += 1
            edges[starts[i] + b] -= 1
    hit = np.cumsum(edges)[:-1] > 0
    n_hit = np.zeros(len(docs), np.int64)
    step = np.diff(np.concatenate(([0], hit.astype(np.int8), [0])))
    begin, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)  # a separator is never hit
    owner = np.searchsorted(starts, begin, "right") - 1
    np.add.at(n_hit, owner, end - begin)
    spans: list[list[tuple[int, int]]] = [[] for _ in docs]
    for d, a, b in zip(owner.tolist(), begin.tolist(), end.tolist(), strict=True):
        spans[d].append((a - int(starts[d]), b - int(starts[d])))
    found_items: list[set[str]] = [set() for _ in docs]
    if len(win):
        pairs = np.unique(doc * len(block.length) + win)
        for d, w in zip((pairs // len(block.length)).tolist(), (pairs % len(block.length)).tolist(), strict=True):
            found_items[d].update(block.items[k] for k in block.owners[block.owner_at[w]:block.owner_at[w + 1]])
    longest: list[tuple | None] = [None] * len(docs)
    for d, (n, p, item, at) in longest_matches(block, doc, pos, win).items():
        longest[d] = n, p - int(starts[d]), item, at
    return sizes, n_hit, found_items, spans, longest


def matches(docs: DataFrame, benchmark: DataFrame, *, window: int = 13, text_col: str = "text",
            item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = 8 << 20) -> DataFrame:
    """``docs`` with what of each document occurs in the benchmark.

    Adds ``n_words``, ``n_hit`` (words inside an occurrence of a benchmark window), ``hit_items`` (ids as text,
    sorted), ``longest_match`` and ``longest_at`` (words and first word of the longest passage that stands verbatim in one
    item), ``longest_item`` and ``longest_item_at`` (that item and the first word in it) and ``hit_spans``. A match is of
    ``window`` words or more, or a whole shorter item.
    The benchmark is read in blocks of about ``block_bytes`` of text; each block is one broadcast and one pass
    over the documents in the same stage, so its size has no bound of its own. Null or empty texts have no words
    and no hits; an item without words never matches; repeated item rows count once per id; a null item id is
    reported as ``null``. Rows of ``docs`` are neither merged nor dropped; columns of ``docs`` with the names
    added here are replaced.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("null")).alias("item"),
                             F.col(item_text_col).cast("binary").alias("body")).distinct()
    total = items.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    n_blocks = -(-int(total) // block_bytes) or 1
    names = [f.name for f in ADDED]
    keep = [F.col(f"`{c}`") for c in docs.columns if c not in names]
    out = docs.select(*keep)
    for b in range(n_blocks):
        part = items.where(F.pmod(F.xxhash64("item", "body"), F.lit(n_blocks)) == b)
        block = benchmark_block([(r.item, bytes(r.body) if r.body is not None else None) for r in part.collect()],
                                window)
        out = _scan(out, spark.sparkContext.broadcast(block), text_col)
    return out


def _scan(docs: DataFrame, block, text_col: str) -> DataFrame:
    names = [f.name for f in ADDED]
    schema = T.StructType([f for f in docs.schema.fields if f.name not in names] + ADDED)
    target = arrow_schema(schema)

    def run(batches):
        for batch in batches:
            cols = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            bodies = cols[text_col].cast(pa.binary()).to_pylist()
            again = "hit_spans" in cols
            before = [[(s["start"], s["end"]) for s in x] for x in cols["hit_spans"].to_pylist()] if again else None
            sizes, n_hit, found, spans, best = scan_shard(block.value, bodies, before)
            if again:
                earlier = zip(*(cols[n].to_pylist() for n in ("longest_match", "longest_at", "longest_item",
                                                              "longest_item_at")), strict=True)
                best = [min((x for x in (b, e) if x and x[0]), key=lambda x: (-x[0], *x[1:]), default=None)
                        for b, e in zip(best, earlier, strict=True)]
                for have, more in zip(found, cols["hit_items"].to_pylist(), strict=True):
                    have.update(more)
            added = [sizes, n_hit, [sorted(x) for x in found], [b[0] if b else 0 for b in best],
                     *([b[k] if b else None for b in best] for k in (1, 2, 3)), [[{"start": a, "end": z} for a, z in s] for s in spans]]
            kept = [v.cast(target.field(n).type) for n, v in cols.items() if n not in names]
            yield pa.RecordBatch.from_arrays(
                kept + [pa.array(v, target.field(n).type) for n, v in zip(names, added, strict=True)], schema=target)

    return docs.mapInArrow(run, schema)


def contaminated(share: int = 20):
    """Condition over the columns of ``matches``: at least one hit word and at least 1/``share`` of the words."""
    return (F.col("n_hit") > 0) & (F.lit(share) * F.col("n_hit") >= F.col("n_words"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, share: int = 20, **options) -> DataFrame:
    """``docs`` without the documents of which 1/``share`` or more of the words come from the benchmark.

    Columns are those of ``docs``; see ``matches`` for null, empty and repeated rows (a document without words
    is kept).
    """
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                        F.col(f"`{options.pop('text_col', 'text')}`").alias("body"))  # no name of docs meets one of ours
    found = matches(whole, benchmark, text_col="body", **options)
    return found.where(~contaminated(share)).select(*[F.col("row")[c].alias(c) for c in docs.columns])


