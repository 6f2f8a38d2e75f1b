"""Keyed table maintenance: latest-per-key, as-of previous, upsert, merge, insert-if-absent, high-water
marks and retention. All are joins, windows or aggregates on the key, so each costs one shuffle on the key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridepulse.operators.silver import ntz_literal


def _order(cols: Sequence) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence, rank_col: str = "_rn") -> DataFrame:
    """The first row of each key under ``order_by`` (e.g. ``[F.col("ts").desc_nulls_first(), "id"]``).

    ``row_number() = 1`` lets Spark insert a partial WindowGroupLimit before the shuffle, so every map task
    ships at most one row per key: a key holding a third of the table does not pile onto one reducer.
    Always pass a full tie-break in ``order_by`` so the result is deterministic.
    """
    w = Window.partitionBy(*keys).orderBy(*_order(order_by))
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) == 1).drop(rank_col)


def previous_before(df: DataFrame, keys: Sequence[str], ts_col: str, cutoff, order_by: Sequence = ()) -> DataFrame:
    """Latest row per key strictly before ``cutoff`` (a datetime/ISO string or a Column).

    The cut-off is a constant, so this is a filter plus latest-per-key, no per-row as-of join.
    """
    cut = cutoff if isinstance(cutoff, Column) else ntz_literal(cutoff)
    return latest_per_key(df.where(F.col(ts_col) < cut), keys,
                          [F.col(ts_col).desc_nulls_first(), *_order(order_by)])


def upsert(current: DataFrame, batch: DataFrame, keys: Sequence[str], order_by: Sequence,
           keep_first: Sequence[str] = ("route_id",), batch_wins: bool = True) -> DataFrame:
    """``INSERT ... ON CONFLICT (keys) DO UPDATE``: one row per key; batch rows replace current rows.

    Within the batch the last row in ``order_by`` wins (feed order). With ``batch_wins=False`` the latest
    row under ``order_by`` wins across stored and batch rows (a replayed or late batch cannot move a key
    back in time; ties go to the batch). Columns in ``keep_first`` keep the value
    of the earliest row (the stored row when there was one), as an upsert that does not update them.
    Columns that only the batch has come last, null in rows it does not touch.
    Both sides are unioned and reduced by one aggregate on the key (``max_by`` / ``min_by`` over the
    sequence): partial aggregation combines map-side, so a key updated millions of times still ships one row
    per map task.
    """
    both = (current.withColumn("_src", F.lit(0))
            .unionByName(batch.withColumn("_src", F.lit(1)), allowMissingColumns=True))
    values = [c for c in both.columns if c not in keys and c != "_src"]
    # Remaining atomic columns complete the order, so rows tied on ``order_by`` still resolve the same way
    # on every run (no dependence on partitioning or task order).
    named = {c for c in order_by if isinstance(c, str)}
    simple = {f.name for f in both.schema.fields if f.dataType.typeName() not in ("map", "array", "struct")}
    rest = [F.col(c) for c in values if c not in named and c in simple]
    seq = (F.struct(F.col("_src"), *_order(order_by), *rest) if batch_wins
           else F.struct(*_order(order_by), F.col("_src"), *rest))
    aggs = [F.max_by(F.struct(*values), seq).alias("_last")]
    # The stored row keeps its columns even against a late batch row with an earlier time.
    stored_first = F.struct(F.col("_src"), *_order(order_by), *rest)
    aggs += [F.min_by(F.col(c), stored_first).alias(f"_first_{c}") for c in keep_first]
    out = both.groupBy(*keys).agg(*aggs)
    cols = [F.col(f"_first_{c}").alias(c) if c in keep_first else F.col("_last")[c].alias(c) for c in values]
    added = [c for c in batch.columns if c not in current.columns]
    return out.select(*[F.col(k) for k in keys], *cols).select(*current.columns, *added)


def merge_by_key(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Incremental merge by unique key (delete + insert): target rows whose key appears in the batch are
    replaced by the batch rows. Not a dedup: duplicate keys inside the batch all survive."""
    kept = target.join(batch.select(*keys).distinct(), list(keys), "left_anti")
    return kept.unionByName(batch, allowMissingColumns=True)


def insert_if_absent(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Append the batch rows whose key is not yet in the target (``key NOT IN (SELECT key FROM target)``).

    Written as a ``left_anti`` join, which plans as a shuffled hash/sort-merge join at any size, rather than
    ``NOT IN``, which plans a null-aware broadcast anti join. Null keys are never inserted.
    """
    fresh = batch.where(F.greatest(*[F.col(k).isNull() for k in keys]) == F.lit(False)) if len(keys) > 1 \
        else batch.where(F.col(keys[0]).isNotNull())
    fresh = fresh.join(target.select(*keys).where(F.col(keys[0]).isNotNull()).distinct(), list(keys), "left_anti")
    return target.unionByName(fresh, allowMissingColumns=True)


def incremental_since(df: DataFrame, ts_col: str, mark, lateness: str = "0 seconds") -> DataFrame:
    """Rows at or after the high-water ``mark`` minus ``lateness``.

    ``mark`` is a datetime / ISO string (a literal, so it prunes partitions and pushes into the scan), a
    Column (e.g. a scalar subquery), or None for "no mark yet" (everything passes). Using ``>=`` and a
    lateness allowance keeps rows equal to or slightly older than the mark; dedup on the surrogate key
    (``merge_by_key``) makes the overlap harmless.
    """
    if mark is None:
        return df
    m = mark if isinstance(mark, Column) else ntz_literal(mark)
    return df.where(F.col(ts_col) >= m - F.expr(f"INTERVAL {lateness}"))


def high_water_mark(target: DataFrame, ts_col: str):
    """The target's latest timestamp as a Python value (one aggregated scalar), or None when empty."""
    row = target.agg(F.max(ts_col).alias("m")).first()
    return None if row is None else row["m"]


def prune_old(df: DataFrame, ts_col: str, as_of, hours: int = 24) -> tuple[DataFrame, DataFrame]:
    """Retention: keep rows with ``ts_col >= as_of - hours``.

    Returns ``(kept, counts)`` where ``counts`` is one row ``(kept, pruned)``; rows with a null time are kept
    (a delete with ``ts < cutoff`` does not match them).
    """
    cutoff = ntz_literal(as_of) - F.expr(f"INTERVAL {int(hours)} HOURS")
    old = F.col(ts_col) < cutoff
    kept = df.where(~old | F.col(ts_col).isNull())
    counts = df.agg(F.count_if(~old | F.col(ts_col).isNull()).cast("long").alias("kept"),
                    F.count_if(old).cast("long").alias("pruned"))
    return kept, counts
