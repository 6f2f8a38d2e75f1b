"""Bounded-space online packing of tokenised documents into fixed-length sequences.

Every partition packs its documents as they come. A document's ids are cut into full windows while they last; the
rest goes to the open window it fits best (the one with the least room that still takes it). At most ``open_windows``
are open at a time. When the rest fits in none, the fullest window is filled up with a cut of it and emitted, and what
remains is placed again. At the end of a partition the open windows are merged by the same cutting, so that each
partition leaves less than one window; the leftovers meet in rounds of bounded fan-in, and the last of them is
written as power-of-two sequences, which need no padding.

The ids are needed once, where they are made: only leftovers (less than one window for each partition) travel.
"""

from __future__ import annotations

import gc
import os
import zlib
from dataclasses import dataclass, field
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridepulse.llm.common import arrow_schema, bounded_batches, ranges, stored

PIECE = [
    T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
    T.StructField("ids_crc32", T.LongType()), T.StructField("doc_tokens", T.LongType()),
    T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()),
    T.StructField("ids", T.BinaryType()),
]
#: Distinct chunks, and distinct pre-tokens, whose ids a worker remembers. A full memory keeps the repeated chunks only.
CACHE = 250_000
#: Fixed values of byte-level BPE: the published split pattern, and the characters that stand for the bytes.
LINE = "\n"
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE_CHARS = {b: chr(b) for b in _PRINTED} | {
    b: chr(256 + i) for i, b in enumerate(x for x in range(256) if x not in _PRINTED)}


class _Codes(dict):
    """Numbers its keys as they are first looked up."""

    def __missing__(self, key):
        code = self[key] = len(self)
        return code


class ChunkTokenizer:
    """Token ids of whole texts, with the ids of the word chunks remembered.

    The split pattern never joins a non-blank with a single blank after it, so a text can be cut before each blank
    between two non-blanks and the chunks tokenised alone: once each, by the tokenizer's own BPE model. A line end
    between two non-blanks is a part of its own, so the text is cut before it too, and its chunk has the line end in
    place of the blank. Texts with more white space beside a blank or line end, and those that hold the string of a
    special token (it becomes that token's id), are tokenised whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core already
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model, self.split = self.tokenizer.model, regex.compile(SPLIT).findall
        self.parts: dict[str, list[int]] = {}
        self._reset()

    def _reset(self):
        self.codes = _Codes()
        self.flat = np.zeros(1 << 16, np.uint32)
        self.at = np.zeros(1, np.int64)  # ids of chunk k are flat[at[k]:at[k + 1]]
        self.odd = np.zeros(0, bool)
        self.uses = np.zeros(0, np.int64)

    def _keep_repeated(self):
        """Forget the chunks seen once; of the others the most used, so that half of the memory is free at least."""
        keep = np.flatnonzero(self.uses > 1)
        if len(keep) > CACHE // 2:
            keep = np.sort(keep[np.argpartition(-self.uses[keep], CACHE // 2)[:CACHE // 2]])
        words = list(self.codes)
        begin, sizes, odd = self.at[keep], self.at[keep + 1] - self.at[keep], self.odd[keep]
        flat = self.flat[ranges(begin, sizes)]
        self._reset()
        self.codes.update((words[k], i) for i, k in enumerate(keep.tolist()))
        self.flat, self.odd, self.uses = flat, odd, np.ones(len(keep), np.int64)
        self.at = np.concatenate([self.at, np.cumsum(sizes)])

    def _ids(self, chunk: str) -> list[int]:
        out: list[int] = []
        for part in self.split(chunk):
            got = self.parts.get(part)
            if got is None:
                if len(self.parts) >= CACHE:
                    self.parts.clear()
                got = self.parts[part] = self._part_ids(part)
            out += got
        return out

    def _word_ids(self, word: str) -> list[int]:
        """A blank with letters after it is one part."""
        if word.isascii():
            return [t.id for t in self.model.tokenize(BYTE_CHARS[0x20] + word)]
        return self._part_ids(f" {word}")

    def _stem_ids(self, word: str) -> list[int]:
        """Ids of a word before its closing mark, which is a part of its own."""
        code = self.codes.get(word)
        if code is not None and code < len(self.odd):
            return self.flat[self.at[code]:self.at[code + 1]].tolist()
        return self._word_ids(word)

    def _part_ids(self, part: str) -> list[int]:
        return [t.id for t in self.model.tokenize(part.encode().decode("latin-1").translate(BYTE_CHARS))]

    def _learn(self):
        """Ids of the words first seen since the last call, each with the blank or line end before it."""
        fresh = list(islice(self.codes, len(self.odd), None))
        odd = [not w or w[-1].isspace() or w[w[0] == LINE].isspace() for w in fresh]
        ids = [[] if o else self._word_ids(w) if w.isalpha() else
               self._stem_ids(w[:-1]) + self._ids(w[-1]) if w[-1] in ".,!?;:" and w[:-1].isalpha() else
               self._ids(w if w[0] == LINE else f" {w}") for w, o in zip(fresh, odd, strict=True)]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        end = int(self.at[-1])
        total = end + int(sizes.sum())
        if total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(total, np.uint32)])
        self.flat[end:total] = np.fromiter(chain.from_iterable(ids), np.uint32, total - end)
        self.at = np.concatenate([self.at, end + np.cumsum(sizes)])
        self.odd = np.concatenate([self.odd, np.array(odd, bool)])
        self.uses = np.concatenate([self.uses, np.zeros(len(fresh), np.int64)])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.codes) >= CACHE:
            self._keep_repeated()
        heads, coded = [], []
        for text in texts:
            found = text.replace(LINE, f" {LINE}").split(" ")
            heads.append(found[0])
            coded.append(np.fromiter(map(self.codes.__getitem__, found[1:]), np.int64, len(found) - 1))
        if len(self.codes) > len(self.odd):
            self._learn()
        self.uses += np.bincount(np.concatenate([np.zeros(0, np.int64), *coded]), minlength=len(self.uses))
        out: list[np.ndarray] = []
        for text, head, codes in zip(texts, heads, coded, strict=True):
            if (head[-1:].isspace() or (len(codes) and not head) or self.odd[codes].any()
                    or any(s in text for s in self.special)):
                out.append(np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32))
                continue
            first = np.array(self._ids(head), np.uint32)
            begin = self.at[codes]
            sizes = self.at[codes + 1] - begin
            out.append(np.concatenate([first, self.flat[ranges(begin, sizes)]]))
        return out


_CODERS: dict[str, ChunkTokenizer] = {}


def coder_of(path: str) -> ChunkTokenizer:
    """The worker's tokenizer for a file: what one task has learnt serves the worker's next tasks."""
    if path not in _CODERS:
        _CODERS[path] = ChunkTokenizer(path)
    return _CODERS[path]


@dataclass(eq=False)
class Window:
    pieces: list = field(default_factory=list)  # (document, start, ids)
    used: int = 0


class Packer:
    """Open windows of one partition. ``emit`` is called with the pieces of a full window."""

    def __init__(self, size: int, open_windows: int, emit):
        self.size, self.limit, self.emit = size, open_windows, emit
        self.open: list[Window] = []

    def add(self, doc, ids: np.ndarray, start: int = 0):
        whole = len(ids) // self.size * self.size
        for i in range(0, whole, self.size):
            self.emit([(doc, start + i, ids[i:i + self.size])])
        ids, start = ids[whole:], start + whole
        while len(ids):
            best = max((w for w in self.open if w.used + len(ids) <= self.size), key=lambda w: w.used, default=None)
            if best is None and len(self.open) < self.limit:
                best = Window()
                self.open.append(best)
            if best is None:
                best = max(self.open, key=lambda w: w.used)
            take = min(len(ids), self.size - best.used)
            best.pieces.append((doc, start, ids[:take]))
            best.used += take
            ids, start = ids[take:], start + take
            if best.used == self.size:
                self.emit(best.pieces)
                self.open.remove(best)

    def merge(self) -> list:
        """Merge the open windows, fullest first, by cutting; return the pieces of what is less than a window."""
        rest = sorted(self.open, key=lambda w: -w.used)
        self.open = []
        gathered = Window()
        for w in rest:
            for doc, start, ids in w.pieces:
                while len(ids):
                    take = min(len(ids), self.size - gathered.used)
                    gathered.pieces.append((doc, start, ids[:take]))
                    gathered.used += take
                    ids, start = ids[take:], start + take
                    if gathered.used == self.size:
                        self.emit(gathered.pieces)
                        gathered = Window()
        return gathered.pieces


def powers_of_two(pieces: list) -> list[list]:
    """Sequences of power-of-two lengths, longest first, that hold the pieces (of less than a window) exactly."""
    total = sum(len(p[2]) for p in pieces)
    sizes = [1 << b for b in range(total.bit_length() - 1, -1, -1) if total >> b & 1]
    out: list[list] = []
    queue = list(pieces)[::-1]
    for size in sizes:
        room, sequence = size, []
        while room:
            doc, start, ids = queue.pop()
            take = min(room, len(ids))
            sequence.append((doc, start, ids[:take]))
            room -= take
            if take < len(ids):
                queue.append((doc, start + take, ids[take:]))
        out.append(sequence)
    return out


def pack(docs: DataFrame, tokenizer_path: str, *, size: int = 1024, end_id: int = 0, open_windows: int = 64,
         fan_in: int = 64, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """Pieces of all documents: one row per piece with its document's id, place and sequence.

    ``start`` counts the document's ids before the piece, ``offset`` the ids before it in its sequence,
    ``doc_tokens`` all ids of the document including ``end_id``. ``ids`` holds the piece's ids as little-endian
    unsigned 32-bit numbers (null when ``with_ids`` is off), ``ids_crc32`` their CRC-32. A null or empty text is the
    one id ``end_id``. Rows with a null or a repeated id are documents of their own. Every sequence has ``size`` ids
    but for at most ten at the end, which have the power-of-two lengths that add up to what was left: no sequence
    needs padding. An empty table gives no rows; extra columns are ignored. ``size`` must be a power of two.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    key = T.StructField("doc_id", docs.schema[id_col].dataType)
    left = T.StructField("left", T.BooleanType())
    schema = T.StructType([key, *PIECE, left])
    target = arrow_schema(schema)
    names = target.names

    def columns(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], target.field(i).type)
                                           for i in range(len(names))], schema=target)

    def row(piece, sequence: int, offset: int, is_left: bool):
        doc, start, ids = piece
        raw = np.ascontiguousarray(ids, "<u4").tobytes()
        return (doc[0], start, len(ids), zlib.crc32(raw), doc[1], sequence, offset,
                raw if is_left or with_ids else None, is_left)

    def stage(batches, level: int, read):
        """Pack what ``read`` gives of each batch; only the leftovers keep their ids in any case."""
        from pyspark import TaskContext

        made: list = []
        base = (level << 56) | (TaskContext.get().partitionId() << 32)
        count = 0

        def emit(pieces):
            nonlocal count
            offset = 0
            for p in pieces:
                made.append(row(p, base | count, offset, False))
                offset += len(p[2])
            count += 1

        packer = Packer(size, open_windows, emit)
        for batch in batches:
            for doc, start, ids in read(batch):
                packer.add(doc, ids, start)
                if len(made) >= 5000:
                    yield columns(made)
                    made.clear()
        made.extend(row(p, -1, 0, True) for p in packer.merge())
        yield columns(made)

    def tokenised(batches):
        coder = coder_of(tokenizer_path)
        gc.disable()  # the many small lists of a task hold no cycles; collecting would walk them again and again

        def read(batch):
            texts = ["" if x is None else x for x in batch.column(1).to_pylist()]
            for i in range(0, len(texts), 200):
                for doc_id, ids in zip(batch.column(0)[i:i + 200].to_pylist(), coder.encode(texts[i:i + 200]),
                                       strict=True):
                    ids = np.append(ids, np.uint32(end_id))
                    yield (doc_id, len(ids)), 0, ids

        try:
            yield from stage(batches, 0, read)
        finally:
            gc.enable()

    def again(level: int):
        def run(batches):
            def read(batch):
                c = {n: batch.column(n).to_pylist() for n in ("doc_id", "doc_tokens", "start", "ids")}
                for doc_id, tokens, start, raw in zip(c["doc_id"], c["doc_tokens"], c["start"], c["ids"], strict=True):
                    yield (doc_id, tokens), start, np.frombuffer(raw, "<u4")

            yield from stage(batches, level, read)
        return run

    def finish(batches):
        pieces = []
        for batch in batches:
            c = {n: batch.column(n).to_pylist() for n in ("doc_id", "doc_tokens", "start", "ids")}
            pieces += [((d, t), s, np.frombuffer(raw, "<u4")) for d, t, s, raw in
                       zip(c["doc_id"], c["doc_tokens"], c["start"], c["ids"], strict=True)]
        made = []
        for k, sequence in enumerate(powers_of_two(pieces)):
            offset = 0
            for p in sequence:
                made.append(row(p, (127 << 56) | k, offset, False))
                offset += len(p[2])
        yield columns(made)

    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    result = stored(source.mapInArrow(tokenised, schema).withColumn("task", F.spark_partition_id()), "packed")
    parts, rest = result.where(~F.col("left")), result.where("left")
    tasks = rest.select("task").distinct().count()
    level = 0
    while tasks > 1:  # each round merges the leftovers of up to ``fan_in`` tasks: a tree, not one task
        level += 1
        tasks = -(-tasks // fan_in)
        ordered = rest.drop("task").repartition(tasks, F.pmod(F.col("task"), F.lit(tasks))) \
            .sortWithinPartitions("task", "doc_id", "start")
        merged = stored(ordered.mapInArrow(again(level), schema).withColumn("task", F.spark_partition_id()), "packed")
        parts, rest = parts.unionByName(merged.where(~F.col("left"))), merged.where("left")
        tasks = min(tasks, rest.select("task").distinct().count())
    last = rest.drop("task").coalesce(1).sortWithinPartitions("doc_id", "start").mapInArrow(finish, schema)
    return parts.drop("task").unionByName(last).drop("left")
