"""Periodic runs of words: Lyndon roots from suffix grouping under both word orders, extended by common extensions.

Every run (a maximal stretch with period ``q``) contains a root that is the longest Lyndon word at its start, under the
words' order or under its reverse. ``lyndon_lengths`` finds those longest Lyndon words for all starts by grouping
suffixes from the greatest group down, the first phase of a grouping suffix sorter; the second phase, which would sort
inside the groups, is not needed. Each root is then stretched to both sides by the longest common extension of its two
ends, read from a table of names of equal blocks of 1, 2, 4, ... words, so that the extension is exact.

A document is the unit of work (its words never leave its task); no shuffle takes place. Words that occur too rarely in
the document for any run, and neighbours that stand together too rarely, cut it into stretches first: a run of at least
``least`` periods holds each of its words ``least`` times and each pair of neighbours once less, so no run crosses a cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridepulse.llm.common import arrow_schema

RUN = T.StructType([T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
                    T.StructField("period", T.LongType())])
FOUND = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_words", T.LongType()),
                      T.StructField("runs", T.ArrayType(RUN)), T.StructField("best", RUN),
                      T.StructField("text", T.StringType())])

#: Words of candidate stretches that are looked at together, about.
STRETCH_WORDS = 1 << 18


def lyndon_lengths(symbols: list[int]) -> list[int]:
    """Length of the longest Lyndon word that starts at each position (the text's end is the least symbol).

    Positions start grouped by their symbol. The greatest group not yet done is final: its members' known prefix is
    their longest Lyndon word. Each stretch of members is taken out of the chain of open positions, and the open
    position in front of it takes over all their words; it moves to a new group just above its own, the higher the more
    members it took over. Every position is taken out once and takes over once for each stretch, so the work is linear
    but for the order of the new groups of one step.
    """
    n = len(symbols)
    length = [1] * n
    after, before = list(range(1, n + 1)), list(range(-1, n))
    order = sorted(set(symbols))
    place = {s: g for g, s in enumerate(order)}
    group_of = [place[s] for s in symbols]
    members: list[list[int]] = [[] for _ in order]
    for i, g in enumerate(group_of):
        members[g].append(i)
    below, above = list(range(-1, len(order) - 1)), list(range(1, len(order) + 1))
    top = len(order) - 1
    while top >= 0:
        taken: dict[tuple[int, int], list[int]] = {}
        size = 0
        for i in members[top]:
            if group_of[i] != top:
                continue  # has moved up since
            front = before[i]
            if front >= 0 and group_of[front] == top:
                continue  # not the first of its stretch
            size = length[i]
            count, j = 0, i
            while j < n and group_of[j] == top:
                count += 1
                j = after[j]
            before[j] = front
            if front >= 0:
                after[front] = j
                taken.setdefault((group_of[front], count), []).append(front)
        for old, count in sorted(taken, reverse=True):  # the last put above a group has the smallest count
            new, moved = len(members), taken[old, count]
            members.append(moved)
            over = above[old]
            below.append(old)
            above.append(over)
            above[old] = new
            below[over] = new  # the group under work lies above every open one
            for j in moved:
                group_of[j] = new
                length[j] += count * size
        members[top] = []
        top = below[top]
    return length


class Extensions:
    """Longest common extensions in a text of integers, by names of its blocks of 1, 2, 4, ... symbols."""

    def __init__(self, symbols: np.ndarray):
        self.names = [np.unique(symbols, return_inverse=True)[1].astype(np.int64)]
        while len(last := self.names[-1]) > (half := 1 << (len(self.names) - 1)):
            pair = last[:-half] * (int(last.max()) + 1) + last[half:]
            distinct, named = np.unique(pair, return_inverse=True)
            if len(distinct) == len(pair):
                break  # no two blocks of this size are equal
            self.names.append(named.astype(np.int64))

    def right(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many symbols from ``a`` on equal those from ``b`` on."""
        start, a, b = a, a.copy(), b.copy()
        for k in range(len(self.names) - 1, -1, -1):
            names, step = self.names[k], 1 << k
            ok = (a < len(names)) & (b < len(names))
            ok[ok] = names[a[ok]] == names[b[ok]]
            a[ok] += step
            b[ok] += step
        return a - start

    def left(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many symbols up to ``a``, itself included, equal those up to ``b``."""
        start, a, b = a, a.copy(), b.copy()
        for k in range(len(self.names) - 1, -1, -1):
            names, step = self.names[k], 1 << k
            ok = (a >= step - 1) & (b >= step - 1)
            ok[ok] = names[a[ok] - step + 1] == names[b[ok] - step + 1]
            a[ok] -= step
            b[ok] -= step
        return start - a


def _stretches(ids: np.ndarray, least: int, shortest: int) -> list[tuple[int, int]]:
    """Stretches (start, end) outside which no run can lie: of words and neighbours that occur often enough."""
    n = len(ids)
    if n < shortest:
        return []
    often = np.bincount(ids)[ids] >= least
    if np.count_nonzero(often) < shortest:
        return []
    joined = np.zeros(n - 1, bool)
    at = np.flatnonzero(often[:-1] & often[1:])
    if len(at):
        pairs = ids[at].astype(np.int64) * (int(ids.max()) + 1) + ids[at + 1]
        _, named, counts = np.unique(pairs, return_inverse=True, return_counts=True)
        joined[at] = counts[named] >= least - 1
    edges = np.diff(np.concatenate(([0], joined.astype(np.int8), [0])))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1) + 1
    return [(int(s), int(e)) for s, e in zip(starts, ends) if e - s >= shortest]


def find_runs(texts: list[np.ndarray], *, least: int = 4, shortest: int = 6) -> list[list[tuple[int, int, int]]]:
    """The runs (start, length, period) of each integer text, by start and then period.

    A run has at least ``least`` periods (2 or more) and ``shortest`` words, and is maximal.
    """
    if least < 2:
        raise ValueError("a run has two periods at least")
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    work: list[tuple[int, int, np.ndarray]] = []
    waiting = 0

    def settle():
        pieces, begins, starts, periods = [], [], [], []
        at = 0
        for _, _, piece in work:
            begins.append(at)
            values = piece.tolist()
            for order in (values, [-v for v in values]):
                roots = np.array(lyndon_lengths(order), np.int64)
                ok = np.flatnonzero(roots * least <= len(values))
                starts.append(ok + at)
                periods.append(roots[ok])
            # A separator of its own behind each piece keeps extensions inside.
            pieces += [piece.astype(np.int64), np.array([-1 - len(begins)], np.int64)]
            at += len(values) + 1
        start, period = np.concatenate(starts), np.concatenate(periods)
        extensions = Extensions(np.concatenate(pieces))
        right = extensions.right(start, start + period)
        left = extensions.left(start - 1, start + period - 1)
        length = left + period + right
        ok = length >= np.maximum(shortest, least * period)
        runs = np.unique(np.stack([start[ok] - left[ok], length[ok], period[ok]], axis=1), axis=0)
        owner = np.searchsorted(np.array(begins), runs[:, 0], side="right") - 1
        for k, (s, m, p) in zip(owner.tolist(), runs.tolist()):
            text, offset, _ = work[k]
            found[text].append((s - begins[k] + offset, m, p))
        work.clear()

    for k, ids in enumerate(texts):
        for s, e in _stretches(ids, least, shortest):
            work.append((k, s, ids[s:e]))
            waiting += e - s
        if waiting >= STRETCH_WORDS:
            settle()
            waiting = 0
    if work:
        settle()
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in found]


def greatest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest length / period, exactly; ties: smallest start, then period."""
    best = None
    for r in runs:  # by start, then period
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return best


def collapse(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least: int = 4,
             shortest: int = 6) -> DataFrame:
    """Runs of words of every row of ``docs``, and its text without the repetitions.

    Words are maximal stretches of bytes other than blanks. Returns ``doc_id``, ``n_words``, ``runs`` (start, length,
    period; by start, then period), ``best`` (that of greatest length / period) and ``text``: the words that no run
    holds behind its first period, joined by one space. A null text has no words, no runs and an empty text; rows with
    a null or a repeated id are rows like any other. Other columns are not looked at. An empty table gives no rows.
    """
    target = arrow_schema(FOUND)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [(t or b"").split() for t in batch.column(1).to_pylist()]
            ids = []
            for ws in words:
                known: dict[bytes, int] = {}
                ids.append(np.fromiter((known.setdefault(w, len(known)) for w in ws), np.int32, len(ws)))
            runs = find_runs(ids, least=least, shortest=shortest)
            kept = []
            for ws, rs in zip(words, runs):
                if rs:
                    cut = np.zeros(len(ws) + 1, np.int32)
                    for s, m, p in rs:
                        cut[s + p] += 1
                        cut[s + m] -= 1
                    ws = [ws[i] for i in np.flatnonzero(np.cumsum(cut[:-1]) == 0).tolist()]
                kept.append(b" ".join(ws))
            named = [[dict(zip(RUN.names, r)) for r in rs] for rs in runs]
            best = [None if (b := greatest(rs)) is None else dict(zip(RUN.names, b)) for rs in runs]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(w) for w in words], pa.int64()),
                 pa.array(named, target.field("runs").type), pa.array(best, target.field("best").type),
                 pa.array(kept, pa.binary()).cast(pa.string())], schema=target)

    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                         F.col(f"`{text_col}`").cast("binary").alias("t"))
    return source.mapInArrow(run, FOUND)
