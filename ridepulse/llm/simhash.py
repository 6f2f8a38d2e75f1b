"""SimHash near-duplicates by tiled exact comparison.

Fingerprints are reduced to their distinct values first, so any number of equal documents is one entry. A fingerprint
has a profile: the population counts of its blocks (four of 16 bits). Two fingerprints within ``radius`` bits have
profiles whose counts differ by at most ``radius`` in all. Fingerprints are laid out in tiles of one profile and at
most ``tile`` entries; a tile meets only the tiles whose profile lies within the radius, and each such pair is
compared exactly with numpy exclusive-or and bit counts. Within a pair, links are reduced to a spanning forest before
they leave the task, so a large group of near copies yields as many links as it has members, not their square.
The groups are then the connected components of the links, found by repeated label joins on Spark.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridepulse.llm.common import arrow_schema, bounded_batches, free_name, ranges, shuffle_partitions, stored

BLOCKS, BLOCK_BITS = 4, 16


def fingerprint(text: bytes | None, shingle: int = 3, seed: int = 42) -> int:
    """64-bit SimHash: a bit is set if it is set in over half the XXH64 values of the word shingles."""
    found = (text or b"").lower().split()  # bytes: A-Z only, and the six ASCII blanks
    if not found:
        return 0
    joined = b" ".join(found)
    if len(found) <= shingle:
        return xxhash.xxh64_intdigest(joined, seed)
    sizes = np.fromiter(map(len, found), np.int64, len(found)) + 1
    starts = np.cumsum(sizes) - sizes
    ends = (starts + sizes - 1)[shingle - 1:]
    parts = map(joined.__getitem__, map(slice, starts[:len(ends)].tolist(), ends.tolist()))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, parts, itertools.repeat(seed)), np.uint64, len(ends))
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 4096):
        bits = np.unpackbits(hashes[i:i + 4096].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1,
                             bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << int(b) for b in np.flatnonzero(2 * counts > len(hashes)))


def fingerprints(docs: DataFrame, *, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text",
                 row: Column | None = None) -> DataFrame:
    """``doc_id`` and ``fp`` (the fingerprint as a signed long) of every row. Null and empty texts have 0.

    With ``row`` (a long), that column of every row comes along as ``row``.
    """
    bounded_batches(docs.sparkSession)
    names = ["doc_id", "fp"] if row is None else ["doc_id", "fp", "row"]
    schema = T.StructType([T.StructField(n, T.LongType()) for n in names])
    target = arrow_schema(schema)

    def run(batches):
        for batch in batches:
            fps = np.fromiter((fingerprint(t, shingle) for t in batch.column(1).to_pylist()), np.uint64,
                              batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64)), *batch.columns[2:]],
                                             schema=target)

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("t"),
                         *([] if row is None else [row.alias("row")]))
    return source.mapInArrow(run, schema)


def _profile(fp):
    mask = (1 << BLOCK_BITS) - 1
    return [F.bit_count(F.shiftrightunsigned(fp, BLOCK_BITS * b).bitwiseAND(F.lit(mask))) for b in range(BLOCKS)]


def _key(counts: list[int] | list):
    """A profile as one number: the block counts as digits."""
    total = None
    for c in counts:
        total = c if total is None else total * 32 + c
    return total


def profile_steps(radius: int) -> list[tuple[int, ...]]:
    """Differences of two profiles within the radius, one of each opposite pair, and no difference at all."""
    steps = [d for d in itertools.product(range(-radius, radius + 1), repeat=BLOCKS)
             if sum(map(abs, d)) <= radius]
    return [d for d in steps if d >= (0,) * BLOCKS]


def spanning_links(a: np.ndarray, b: np.ndarray, same: bool, radius: int, rows: int = 256):
    """A spanning forest of the pairs of ``a`` and ``b`` within ``radius`` bits, as two arrays of fingerprints."""
    nodes = a if same else np.concatenate([a, b])
    parent = np.arange(len(nodes))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    left, right = [], []
    for i in range(0, len(a), rows):
        far = b[i:] if same else b
        x, y = np.nonzero(np.bitwise_count(a[i:i + rows, None] ^ far[None, :]) <= radius)
        x, y = x + i, y + (i if same else len(a))
        if same:
            x, y = x[x < y], y[x < y]
        # Most pairs of a large group repeat what is known: drop them in bulk before the careful pass.
        while len(x):
            root = parent.copy()
            while (root != root[root]).any():
                root = root[root]
            keep = root[x] != root[y]
            x, y = x[keep], y[keep]
            if not len(x):
                break
            first = np.unique(np.minimum(root[x], root[y]), return_index=True)[1]
            for k in first.tolist():  # at least one link for each root that still has any
                p, q = find(int(x[k])), find(int(y[k]))
                if p != q:
                    parent[max(p, q)] = min(p, q)
                    left.append(int(x[k]))
                    right.append(int(y[k]))
    return nodes[np.array(left, np.int64)], nodes[np.array(right, np.int64)]


def links(distinct: DataFrame, *, radius: int = 2, tile: int = 4096, pairs_per_task: int = 1 << 28) -> DataFrame:
    """Links (``src``, ``dst``) that connect all distinct fingerprints ``fp`` within ``radius`` bits of each other."""
    spark = distinct.sparkSession
    cells = distinct.select("fp", _key(_profile(F.col("fp"))).cast("int").alias("cell"))
    # Tiles: hash-dealt chunks of a cell, sized so that none exceeds ``tile`` by much.
    sizes = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n")) \
        .select("cell", "n", F.ceil(F.col("n") / tile).cast("int").alias("parts"))
    sizes = stored(sizes, "simhash-cells")
    tiles = (cells.join(sizes, "cell")
             .withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
             .groupBy("cell", "part").agg(F.collect_list("fp").alias("fps")))
    tiles = stored(tiles, "simhash-tiles")
    near = F.array(*[F.lit(_key(list(d))).cast("int") for d in profile_steps(radius)])
    ours = sizes.select("cell", F.col("parts").alias("m"), F.explode(near).alias("step")) \
        .withColumn("other", F.col("cell") + F.col("step"))
    theirs = sizes.select(F.col("cell").alias("other"), F.col("parts").alias("o"))
    pairs = (ours.join(theirs, "other")
             .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("m") - 1)))
             .withColumn("other_part", F.explode(F.sequence(F.when(F.col("step") == 0, F.col("part")).otherwise(0),
                                                            F.col("o") - 1))))
    left = tiles.select("cell", "part", F.col("fps").alias("a"))
    right = tiles.select(F.col("cell").alias("other"), F.col("part").alias("other_part"), F.col("fps").alias("b"))
    # One row for a tile with all it meets would grow with the tile's neighbours: pairs stay apart.
    work = (pairs.select("cell", "part", "other", "other_part").join(left, ["cell", "part"])
            .join(right, ["other", "other_part"])
            .select("a", "b", ((F.col("cell") == F.col("other")) & (F.col("part") == F.col("other_part"))).alias("same"))
            .repartition(4 * shuffle_partitions(spark)))
    schema = T.StructType([T.StructField("src", T.LongType()), T.StructField("dst", T.LongType())])
    target = arrow_schema(schema)

    def compare(batches):
        for batch in batches:
            one, two = batch.column(0), batch.column(1)
            for i in range(batch.num_rows):
                a = one[i].values.to_numpy().view(np.uint64)
                b = two[i].values.to_numpy().view(np.uint64)
                src, dst = spanning_links(a, b, batch.column(2)[i].as_py(), radius)
                if len(src):
                    yield pa.RecordBatch.from_arrays([pa.array(src.view(np.int64)), pa.array(dst.view(np.int64))],
                                                     schema=target)

    return work.mapInArrow(compare, schema)


def components(edges: DataFrame, rank: DataFrame) -> DataFrame:
    """``fp`` and ``low`` for every linked fingerprint: the least ``low`` of ``rank`` reachable over ``edges``.

    Alternating large-star and small-star rounds: each links a node's larger (or all) neighbours to its least one,
    until a round changes nothing. Every round is a grouped minimum and one join, kept in the shared folder.
    """
    ends = rank.select("fp", "low")
    linked = (edges.join(ends.select(F.col("fp").alias("src"), F.col("low").alias("u")), "src")
              .join(ends.select(F.col("fp").alias("dst"), F.col("low").alias("v")), "dst"))
    # Ranks are unique (each fingerprint's smallest document), so they stand for the nodes from here on.
    pairs = stored(linked.select(F.least("u", "v").alias("v"), F.greatest("u", "v").alias("u")).distinct(),
                   "simhash-links")

    def digest(df):
        r = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return int(r[0]), r[1]

    before = digest(pairs)
    while before[0]:
        both = pairs.unionByName(pairs.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .where("u <> v").distinct()
        large = large.select("u", "v")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v") \
            .unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        pairs = stored(small, "simhash-links")
        after = digest(pairs)
        if after == before:
            break
        before = after
    return ends.join(pairs.select(F.col("u").alias("low"), F.col("v").alias("root")), "low", "left") \
        .select("fp", F.coalesce("root", "low").alias("low"))


def near_duplicates(docs: DataFrame, *, shingle: int = 3, radius: int = 2, id_col: str = "doc_id",
                    text_col: str = "text", row: Column | None = None) -> DataFrame:
    """``doc_id``, ``fp`` and ``component_id`` (the smallest id reachable over links) of every row of ``docs``.

    ``group_fp`` is unique to the component; with ``row`` (a long), that column of every row comes along.

    Texts without words have fingerprint 0 and are linked like any other. Rows with one id more than once each keep
    their own fingerprint and may lie in different components; rows with a null id get one but do not count as the
    smallest id (a component of null ids alone has a null ``component_id``). An empty table gives no rows.
    """
    fps = stored(fingerprints(docs, shingle=shingle, id_col=id_col, text_col=text_col, row=row), "simhash")
    # A fingerprint's place in the order is its smallest document; the second part makes it unique where ids repeat.
    distinct = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("first"))
                      .select("fp", F.struct(F.col("first").isNull().alias("none"), F.col("first"),
                                             F.col("fp").alias("tie")).alias("low")), "simhash-distinct")
    found = components(links(distinct.select("fp"), radius=radius), distinct)
    return (fps.join(found, "fp")
            .select("doc_id", "fp", F.col("low.first").alias("component_id"), F.col("low.tie").alias("group_fp"),
                    *([] if row is None else ["row"])))


def deduplicate(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: its smallest id; ties go by fingerprint, then by a hash of the
    row's content. Rows with a null id are deduplicated among themselves: one of each group stays by the same order, also
    beside a row with an id. Columns are those of ``docs``.
    """
    # Columns that cannot be hashed (maps) count by their JSON text.
    content = F.xxhash64(*[F.to_json(F.struct(F.col(f"`{f.name}`"))) if "map<" in f.dataType.simpleString()
                           else F.col(f"`{f.name}`") for f in docs.schema.fields])
    key_name, count_name = free_name(docs.columns, "keep_key"), free_name(docs.columns, "keep_n")
    key = F.struct(F.col(f"`{id_col}`").cast("long").alias("id"), content.alias("tie"))
    found = near_duplicates(docs, id_col=id_col, text_col=text_col, row=content, **options)
    # Fully repeated rows share a key; ``n`` counts them.
    rows = found.groupBy("group_fp", "doc_id", "fp", "row").agg(F.count(F.lit(1)).alias("n"))
    keep = stored(rows.groupBy("group_fp", F.col("doc_id").isNull())
                  .agg(F.min(F.struct("doc_id", "fp", "row", "n")).alias("r"))
                  .select(F.struct(F.col("r.doc_id").alias("id"), F.col("r.row").alias("tie")).alias(key_name),
                          F.col("r.n").alias(count_name)), "simhash-keep")

    def of(part):
        own, other = key, F.col(key_name)
        return docs.join(part, own["id"].eqNullSafe(other["id"]) & (own["tie"] == other["tie"]), "left_semi")

    if keep.where(F.col(count_name) > 1).isEmpty():
        return of(keep)
    again = of(keep.where(F.col(count_name) > 1))
    names = again.columns
    again = again.groupBy(key.alias(key_name)).agg(F.first(F.struct(*[F.col(f"`{c}`") for c in names])).alias("r"))
    return of(keep.where(F.col(count_name) == 1)).unionByName(again.select(*[F.col("r")[c].alias(c) for c in names]))
