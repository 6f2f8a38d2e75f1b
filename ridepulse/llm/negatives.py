"""Hard negatives by threshold joins over blocks of an inverted index with norm bounds.

A threshold join finds, for each anchor, the rows whose inner product with it reaches the anchor's threshold. Rows are
dealt into blocks by the hash of their id and anchors into groups; one task meets one block with one group, so that both
sides of a task are bounded, and each block's answer is bounded too (the first few rows per anchor or window).

In a block the dimensions are ordered by their energy, and a row is indexed only up to the dimension after which its
remaining norm cannot reach the lowest threshold any more. Rows are ordered by how many dimensions they index, so the
posting list of a dimension is a run of rows from the first on. Scores are accumulated list by list, a few dimensions at
a time; pairs whose partial score and remaining norms stay below the threshold are pruned, and what is left is
verified with whole-number arithmetic. Anchors whose places do not fill come again with a lower threshold.

The join of anchors with rows is a stated query set against all rows; its work grows with the product of the two.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridepulse.llm.common import shuffle_partitions, stored

#: Most rows of a block and most anchors of a group; both sides of a task stay within them, about.
BLOCK_ROWS, GROUP_ANCHORS = 50_000, 5_000
#: Dimensions accumulated between two prunings, anchors scored at once, and the share of pairs at which to verify.
CHUNK, AT_ONCE, FEW = 8, 64, 0.02
#: Rows that the first threshold is estimated from, at most (the threshold never decides a result).
SAMPLE_ROWS = 2_000
#: A threshold's next value, and the share of the largest possible score below which it becomes 0.
LOWER, LOWEST = 0.7, 0.15
#: Lower end of a window in the first round, as a share of its positive's score; later the stated one.
FIRST_WINDOW = 95


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Whole-number vectors of an Arrow list column, short ones filled with zeros."""
    lists = column.combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks) if lists.num_chunks else pa.array([], lists.type)
    lengths = np.diff(lists.offsets.to_numpy()) if len(lists) else np.zeros(0, np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lists), width), np.int64)
    if len(lists):
        out[np.repeat(np.arange(len(lists)), lengths), np.concatenate([np.arange(n) for n in lengths])] = flat
    return out


class NormIndex:
    """Rows of a block for threshold joins: indexed dimensions first, by energy, as far as the bound asks for."""

    def __init__(self, rows: np.ndarray, longest_query: float, threshold: float):
        self.whole = rows
        values = rows.astype(np.float64)
        self.order = np.argsort(-(values ** 2).sum(axis=0), kind="stable")
        values = values[:, self.order]
        squares = np.cumsum((values ** 2)[:, ::-1], axis=1)[:, ::-1]
        # rest[r, k]: norm of a row's dimensions from the k-th on, rounded up.
        rest = np.sqrt(np.concatenate([squares, np.zeros((len(rows), 1))], axis=1)) * (1 + 1e-9)
        indexed = (rest[:, :-1] * longest_query >= threshold).sum(axis=1)
        self.rank = np.argsort(-indexed, kind="stable")
        self.values, self.rest, self.indexed = values[self.rank], rest[self.rank], indexed[self.rank]

    def join(self, queries: np.ndarray, thresholds: np.ndarray):
        """Pairs (query, row, score) of a score at or over the query's threshold, in whole numbers."""
        q = queries.astype(np.float64)[:, self.order]
        q_rest = np.sqrt(np.concatenate([np.cumsum((q ** 2)[:, ::-1], axis=1)[:, ::-1], np.zeros((len(q), 1))], axis=1))
        q_rest *= 1 + 1e-9
        slack = 1e-9 * (q_rest[:, :1] * self.rest[:, 0].max(initial=0.0))
        partial = np.zeros((len(q), len(self.values)))
        width = q.shape[1]
        alive = q_rest[:, :1] * self.rest[None, :, 0] + slack >= thresholds[:, None]
        for k in range(0, width, CHUNK):
            listed = int(np.searchsorted(-self.indexed, -k, side="left"))  # rows that index a dimension of the chunk
            if not listed:
                break
            end = min(k + CHUNK, width)
            partial[:, :listed] += q[:, k:end] @ self.values[:listed, k:end].T
            # A row that is not listed any more keeps the rest it had when it left, which the bound covers.
            bound = partial + q_rest[:, end:end + 1] * self.rest[None, :, end]
            if listed < len(self.rest):
                at = np.minimum(-(-self.indexed[listed:] // CHUNK) * CHUNK, width)
                gone = self.rest[np.arange(listed, len(self.rest)), at]
                bound[:, listed:] = partial[:, listed:] + q_rest[:, at] * gone[None, :]
            alive = bound + slack >= thresholds[:, None]
            if np.count_nonzero(alive) <= FEW * alive.size:
                break
        a, r = np.nonzero(alive)
        r = self.rank[r]
        scores = exact_products(queries, self.whole, a, r)
        ok = scores >= thresholds[a]
        return a[ok], r[ok], scores[ok]


def exact_products(one: np.ndarray, two: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows ``a`` of ``one`` with the rows ``b`` of ``two``, in whole numbers."""
    bound = float(np.abs(one).max(initial=0)) * float(np.abs(two).max(initial=0)) * max(1, one.shape[1])
    if bound >= 2.0 ** 53:  # products may leave a long: exact, slow
        return np.array([sum(int(x) * int(y) for x, y in zip(one[i], two[j])) for i, j in zip(a, b)], np.int64)
    out = np.empty(len(a), np.int64)
    for i in range(0, len(a), 1 << 16):
        part = slice(i, i + (1 << 16))
        out[part] = np.einsum("ij,ij->i", one[a[part]], two[b[part]])
    return out


def _block(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, pa.Table]:
    """Ids and labels of a block, one row for each id (the least label, then the least vector)."""
    ids = rows.column("vec_id").to_numpy()
    labels = rows.column("label").to_numpy()
    order = np.lexsort((labels, ids))
    ids, labels = ids[order], labels[order]
    if len(ids) and (ids[1:] == ids[:-1]).any():
        vectors = rows.column("vector").to_pylist()
        order = np.array(sorted(range(len(vectors)), key=lambda i: (rows.column("vec_id")[i].as_py(),
                                                                    rows.column("label")[i].as_py(), vectors[i])))
        ids, labels = rows.column("vec_id").to_numpy()[order], rows.column("label").to_numpy()[order]
        first = np.concatenate(([True], ids[1:] != ids[:-1]))
        ids, labels, order = ids[first], labels[first], order[first]
    return ids, labels, rows.take(pa.array(order))


def _width(*tables: pa.Table) -> int:
    return max([1, *(int(n) for t in tables for n in t.column("size").to_numpy())])


POSITIVE = "anchor_id long, positive_id long, score long"
NEGATIVE = "anchor_id long, window int, negative_id long, score long"


def _positives(most: int):
    """Of one block: each anchor's first ``most`` rows of its label at or over its threshold."""

    def meet(key, rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out = [[], [], []]
        if rows.num_rows and anchors.num_rows:
            width = _width(rows, anchors)
            ids, labels, rows = _block(rows)
            vectors, queries = _matrix(rows.column("vector"), width), _matrix(anchors.column("vector"), width)
            names, wanted = anchors.column("vec_id").to_numpy(), anchors.column("label").to_numpy()
            low = anchors.column("threshold").to_numpy()
            norms = np.sqrt((queries.astype(np.float64) ** 2).sum(axis=1))
            for label in np.unique(wanted).tolist():
                mine, ours = np.flatnonzero(labels == label), np.flatnonzero(wanted == label)
                if not len(mine):
                    continue
                index = NormIndex(vectors[mine], norms[ours].max(), low[ours].min())
                for i in range(0, len(ours), AT_ONCE):
                    part = ours[i:i + AT_ONCE]
                    a, r, score = index.join(queries[part], low[part])
                    a, r = part[a], mine[r]
                    other = ids[r] != names[a]
                    a, r, score = a[other], r[other], score[other]
                    order = np.lexsort((ids[r], -score, a))
                    a, r, score = a[order], r[order], score[order]
                    place = np.arange(len(a)) - np.searchsorted(a, a, side="left")
                    ok = place < most
                    for to, values in zip(out, (names[a[ok]], ids[r[ok]], score[ok])):
                        to.append(values)
        return pa.table({n: pa.array(np.concatenate(v) if v else np.zeros(0, np.int64), pa.int64())
                         for n, v in zip(("anchor_id", "positive_id", "score"), out)})

    return meet


def _negatives(most: int):
    """Of one block: for each anchor and window the first ``most`` rows of another label inside the window."""

    def meet(key, rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int, int]] = []
        if rows.num_rows and anchors.num_rows:
            width = _width(rows, anchors)
            ids, labels, rows = _block(rows)
            vectors, queries = _matrix(rows.column("vector"), width), _matrix(anchors.column("vector"), width)
            names, own = anchors.column("vec_id").to_numpy(), anchors.column("label").to_numpy()
            windows = anchors.column("windows").to_pylist()
            low = np.array([min(w["low"] for w in ws) for ws in windows], np.int64)
            norms = np.sqrt((queries.astype(np.float64) ** 2).sum(axis=1))
            index = NormIndex(vectors, norms.max(), low.min())
            for i in range(0, len(names), AT_ONCE):
                part = np.arange(i, min(i + AT_ONCE, len(names)))
                a, r, score = index.join(queries[part], low[part])
                a = part[a]
                other = labels[r] != own[a]
                a, r, score = a[other], r[other], score[other]
                order = np.lexsort((ids[r], -score, a))
                a, r, score = a[order], r[order], score[order]
                bounds = np.searchsorted(a, np.append(part, part[-1] + 1), side="left")
                for k, begin, end in zip(part.tolist(), bounds[:-1].tolist(), bounds[1:].tolist()):
                    falling = -score[begin:end]
                    for w in windows[k]:
                        first = begin + int(np.searchsorted(falling, -w["high"], side="left"))
                        last = begin + int(np.searchsorted(falling, -w["low"], side="right"))
                        out += [(int(names[k]), w["window"], int(ids[r[x]]), int(score[x]))
                                for x in range(first, min(last, first + most))]
        columns = list(zip(*out)) if out else [()] * 4
        return pa.table({"anchor_id": pa.array(columns[0], pa.int64()), "window": pa.array(columns[1], pa.int32()),
                         "negative_id": pa.array(columns[2], pa.int64()), "score": pa.array(columns[3], pa.int64())})

    return meet


def whole_vectors(rows: DataFrame, *, id_col: str, label_col: str, vector_col: str, scale: float = 256.0) -> DataFrame:
    """``vec_id``, ``label`` and ``vector`` (each component times ``scale``, rounded down) of the rows that take part.

    A row with a null id, label or vector, or with a null or non-finite component, takes no part.
    """
    x = F.col(f"`{vector_col}`").cast("array<double>")
    odd = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return (rows.where(F.col(f"`{id_col}`").isNotNull() & F.col(f"`{label_col}`").isNotNull() & x.isNotNull()
                       & ~F.coalesce(odd, F.lit(True)))
            .select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{label_col}`").cast("long").alias("label"),
                    F.transform(x, lambda c: F.floor(c * scale)).alias("vector")))


def _norm() -> Column:
    return F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def _first_share(rows: DataFrame, total: int, longest: float) -> float:
    """A first threshold, as a share of the largest possible score: below the best score in a bounded sample."""
    cut = int(min(1.0, SAMPLE_ROWS / max(1, total)) * (1 << 20)) + 1
    got = rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)) < cut).limit(2 * SAMPLE_ROWS).collect()
    width = max([1, *(len(r.vector) for r in got)])
    x = np.zeros((len(got), width))
    for k, r in enumerate(got):
        x[k, :len(r.vector)] = r.vector
    labels = np.array([r.label for r in got])
    norms = np.sqrt((x ** 2).sum(axis=1))
    best = 0.0
    for i in range(0, min(len(x), 256)):
        score = np.where((labels == labels[i]) & (np.arange(len(x)) != i), x @ x[i], 0.0)
        best = max(best, float(score.max(initial=0.0)) / max(norms[i] * longest, 1e-300))
    return LOWER * best


def mine(rows: DataFrame, anchors: Column, *, positives: int = 5, negatives: int = 5, low: int = 80,
         high: int = 100) -> DataFrame:
    """Hard negatives of the rows that ``anchors`` (a condition over ``vec_id`` and ``label``) holds for.

    ``rows`` has ``vec_id``, ``label`` and whole-number ``vector`` (see ``whole_vectors``); a score is the inner product
    with the anchor. An anchor's positives are its first ``positives`` other rows of its label by score, ties by smaller
    id. Of each positive, the first ``negatives`` rows of other labels whose score lies from ``low`` to ``high`` percent
    of the positive's come back as ``anchor_id``, ``positive_id``, ``rank`` (from 1), ``negative_id``,
    ``positive_score`` and ``negative_score``. A positive with a negative score has no such rows, so thresholds end at 0.

    An id stands for one row: of rows that share one, that of least label and vector counts. A shorter vector counts as
    filled up with zeros. Other columns are not looked at; an empty table, and a label of one row, give no rows.
    """
    spark = rows.sparkSession
    rows = stored(rows.select("vec_id", "label", "vector", F.size("vector").alias("size")), "negatives-rows")
    picked = rows.where(anchors).groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("r")) \
        .select("vec_id", "r.label", "r.vector", F.size("r.vector").alias("size"))
    total, longest = rows.agg(F.count(F.lit(1)), F.max(_norm())).first()
    if not total:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, "
                                         "positive_score long, negative_score long")
    count = picked.count()
    blocks = max(shuffle_partitions(spark), -(-total // BLOCK_ROWS))
    groups = max(1, -(-count // GROUP_ANCHORS))
    group = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(groups)).cast("int")
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")) \
        .withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))

    def meet(asked: DataFrame, function, schema: str) -> DataFrame:
        theirs = asked.withColumn("group", group).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        return dealt.groupBy("block", "group").cogroup(theirs.groupBy("block", "group")).applyInArrow(function, schema)

    def best(found: DataFrame, keys: list[str], other: str, most: int) -> DataFrame:
        order = Window.partitionBy(*keys).orderBy(F.desc("score"), other)
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)

    # Positives: lower the threshold until an anchor has all its places, or nothing below is of use.
    asked, share, done = stored(picked, "negatives-anchors"), _first_share(rows, total, longest), []
    waiting = asked
    while True:
        share = share if share >= LOWEST else 0.0
        threshold = F.floor(_norm() * float(longest) * share)
        found = stored(best(meet(waiting.withColumn("threshold", threshold), _positives(positives), POSITIVE),
                            ["anchor_id"], "positive_id", positives), "negatives-positives")
        if share == 0.0:
            done.append(found)
            break
        full = found.groupBy("anchor_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= positives)
        done.append(found.join(full, "anchor_id", "left_semi"))
        waiting = stored(waiting.join(full, waiting["vec_id"] == full["anchor_id"], "left_anti"), "negatives-anchors")
        if waiting.isEmpty():
            break
        share *= LOWER
    pairs = done[0]
    for more in done[1:]:
        pairs = pairs.unionByName(more)
    # Windows: a narrow one below each positive first, the stated one for those that do not fill.
    percent = F.col("score").cast("decimal(38,0)")
    windows = stored(pairs.select("anchor_id", "positive_id", F.col("rank").alias("window"), "score",
                                  F.floor(percent * high / 100).cast("long").alias("high"),
                                  F.ceil(percent * low / 100).cast("long").alias("low"),
                                  F.ceil(percent * max(low, FIRST_WINDOW * high // 100) / 100).cast("long").alias("near"))
                     .where(F.col("low") <= F.col("high")), "negatives-windows")

    def search(wanted: DataFrame, bottom: str) -> DataFrame:
        lists = wanted.groupBy("anchor_id").agg(
            F.collect_list(F.struct("window", F.col(bottom).alias("low"), "high")).alias("windows"))
        sides = asked.join(lists, asked["vec_id"] == lists["anchor_id"]).drop("anchor_id")
        return stored(best(meet(sides, _negatives(negatives), NEGATIVE), ["anchor_id", "window"], "negative_id", negatives),
                      "negatives-found")

    near = search(windows, "near")
    full = near.groupBy("anchor_id", "window").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= negatives)
    rest = stored(windows.join(full, ["anchor_id", "window"], "left_anti"), "negatives-windows")
    found = near.join(full, ["anchor_id", "window"], "left_semi")
    if not rest.isEmpty():
        found = found.unionByName(search(rest, "low"))
    return found.join(windows.select("anchor_id", "window", "positive_id", F.col("score").alias("positive_score")),
                      ["anchor_id", "window"]) \
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", F.col("score").alias("negative_score"))
