"""Table storage on parquet: create-if-absent reads, appends, partition overwrites and the incremental fact
and hourly-gold refresh.

Refresh rules (they differ from the published incremental models on purpose):
* the fact holds one row per surrogate key, chosen by one rule over stored and new rows, so replayed, late and
  equal-time rows are neither lost nor duplicated and the table does not depend on how rows fall into batches; ``incremental_fact_batch`` selects the rows a scheduled run takes (at or after the
  high-water mark minus a lateness allowance);
* the hourly gold keeps the parts of each hour (a row per delay and per trip); a batch adds the parts of its new rows to
  the touched hours, so an hour delivered in two batches equals a full rebuild without reading the fact again
  (``refresh_hours``). Hours in which a stored row was replaced, and those that a run cut short has left, are built anew
  from the fact;
* the current state is kept in hash buckets of trips, of which a batch rewrites those it touches (``refresh_current``).
What several steps of a job read (the typed batch, its difference to the fact, the merged parts) is checkpointed into the
shared checkpoint folder. New partitions are written beside the table, so a write never replaces the files it reads, and
swapped in by renames, one folder at a time; a swap cut short is undone by the next ``recover``, which every function
here runs first. The renames must be atomic on the file system, and a reader that lists
a folder between its two renames does not see it; there is one writer at a time.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ridepulse.operators.keyed import incremental_since, latest_per_key, prune_old, upsert
from ridepulse.operators.silver import ntz_literal
from ridepulse.plans.gold import (
    HOURLY_COLUMNS, PART_COLUMNS, fact_historical_delays, gold_route_performance_hourly, hour_parts, hourly_from_parts,
    merge_parts,
)
from ridepulse.session import shared_dir

_EPOCH_DATE = _dt.date(1970, 1, 1)


def _fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def table_exists(spark: SparkSession, path: str) -> bool:
    recover(spark, path)
    p, fs = _fs_path(spark, path)
    if not fs.exists(p):
        return False
    return any(not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(p))


def partition_values(spark: SparkSession, path: str, col: str) -> list[str]:
    """The ``col=value`` folder values of a partitioned table, from one directory listing (no data read)."""
    p, fs = _fs_path(spark, path)
    if not fs.exists(p):
        return []
    prefix = f"{col}="
    return sorted(st.getPath().getName()[len(prefix):] for st in fs.listStatus(p)
                  if st.isDirectory() and st.getPath().getName().startswith(prefix))


def _as_date(value: str):
    try:
        return _dt.date.fromisoformat(value)
    except ValueError:          # e.g. the null partition: never expired
        return None


def read_partitions(spark: SparkSession, path: str, col: str, values: Sequence,
                    all_columns: bool = False) -> DataFrame | None:
    """Read only the ``col=value`` partition folders of a table (None when none of them exists).

    ``all_columns`` merges the files' schemas: rewrites need it, or columns added later would be lost.

    Listing just the touched folders keeps a refresh's file listing proportional to the batch, not to a table
    with months of partitions.
    """
    return read_folders(spark, path, [f"{col}={v}" for v in values], all_columns)


def read_folders(spark: SparkSession, path: str, folders: Sequence[str], all_columns: bool = False) -> DataFrame | None:
    """Read only the given partition folders (``a=1/b=2``) of a table (None when none of them exists)."""
    recover(spark, path)
    dirs = []
    for folder in folders:
        d = f"{path.rstrip('/')}/{folder}"
        p, fs = _fs_path(spark, d)
        if fs.exists(p):
            dirs.append(d)
    if not dirs:
        return None
    return spark.read.option("basePath", path).option("mergeSchema", all_columns).parquet(*dirs)


def nested_partition_columns(spark: SparkSession, folder: str) -> list[str]:
    """Partition columns below ``folder`` (``name=value`` sub-folders, followed down the first branch)."""
    cols = []
    p, fs = _fs_path(spark, folder)
    while fs.exists(p):
        subs = [st.getPath() for st in fs.listStatus(p) if st.isDirectory() and "=" in st.getPath().getName()]
        if not subs:
            break
        cols.append(subs[0].getName().split("=", 1)[0])
        p = subs[0]
    return cols


def drop_partitions(spark: SparkSession, path: str, col: str, values: list) -> None:
    """Delete the ``col=value`` folders of a table."""
    for v in values:
        p, fs = _fs_path(spark, f"{path.rstrip('/')}/{col}={v}")
        fs.delete(p, True)


def folder_bytes(spark: SparkSession, folder: str) -> tuple[int, int]:
    """(number of data files, total bytes) under a folder, from the file system listing."""
    p, fs = _fs_path(spark, folder)
    if not fs.exists(p):
        return 0, 0
    files, size = 0, 0
    it = fs.listFiles(p, True)
    while it.hasNext():
        st = it.next()
        name = st.getPath().getName()
        if not name.startswith(("_", ".")):
            files, size = files + 1, size + st.getLen()
    return files, size


def leaf_folders(spark: SparkSession, folder: str) -> int:
    """Number of folders below ``folder`` that hold data files."""
    p, fs = _fs_path(spark, folder)
    found = set()
    it = fs.listFiles(p, True) if fs.exists(p) else None
    while it is not None and it.hasNext():
        file = it.next().getPath()
        if not file.getName().startswith(("_", ".")):
            found.add(file.getParent().toString())
    return len(found)


def compact_partitions(spark: SparkSession, path: str, col: str, values: Sequence,
                       target_file_bytes: int = 256 << 20, sort_by: Sequence[str] = ()) -> dict:
    """Rewrite the given partitions of an append-heavy table into about ``size / target_file_bytes`` files.

    Frequent small appends (one per micro-batch) leave many small files per date; this reads only the named
    folders, deals their rows by range of (partition columns, ``sort_by``) so that each task writes few folders and
    each file a narrow range of ``sort_by``, materializes them in the shared checkpoint folder and replaces the
    partitions. A range cut adds at most one file, so there are never more files than before. Rows are unchanged.
    Returns the file counts before and after.
    """
    before = sum(folder_bytes(spark, f"{path.rstrip('/')}/{col}={v}")[0] for v in values)
    total = sum(folder_bytes(spark, f"{path.rstrip('/')}/{col}={v}")[1] for v in values)
    df = read_partitions(spark, path, col, values, all_columns=True)
    if df is None:
        return {"files_before": 0, "files_after": 0}
    inner = nested_partition_columns(spark, f"{path.rstrip('/')}/{col}={values[0]}")
    folders = sum(leaf_folders(spark, f"{path.rstrip('/')}/{col}={v}") for v in values)
    n = min(max(1, -(-total // int(target_file_bytes))), before - folders + 1)
    keys = [col, *inner, *sort_by]
    compacted = stable(df.repartitionByRange(n, *keys).sortWithinPartitions(*keys))
    overwrite_partitions(compacted, path, [col, *inner])
    after = sum(folder_bytes(spark, f"{path.rstrip('/')}/{col}={v}")[0] for v in values)
    return {"files_before": before, "files_after": after}


def read_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table at ``path``, or an empty frame of ``schema`` when it does not exist yet.

    Columns the table gained later come after those of ``schema``; files without them read as null.
    """
    empty = spark.createDataFrame([], schema)
    if table_exists(spark, path):
        return empty.unionByName(spark.read.option("mergeSchema", "true").parquet(path), allowMissingColumns=True)
    return empty


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def _children(spark: SparkSession, folder: str, prefix: str = "") -> list[str]:
    p, fs = _fs_path(spark, folder)
    if not fs.exists(p):
        return []
    return sorted(n for n in (st.getPath().getName() for st in fs.listStatus(p)) if n.startswith(prefix))


def _leaves(spark: SparkSession, root: str) -> list[str]:
    """Partition folders (``a=1/b=2``) below ``root`` that hold no further partition folders."""
    out, todo = [], [""]
    while todo:
        at = todo.pop()
        subs = [n for n in _children(spark, f"{root}/{at}".rstrip("/")) if "=" in n]
        todo += [f"{at}/{n}".lstrip("/") for n in subs]
        if at and not subs:
            out.append(at)
    return sorted(out)


def _move(spark: SparkSession, source: str, target: str) -> None:
    (a, fs), (b, _) = _fs_path(spark, source), _fs_path(spark, target)
    fs.mkdirs(b.getParent())
    if not fs.rename(a, b):
        raise OSError(f"could not move {source} to {target}")


def recover(spark: SparkSession, path: str) -> None:
    """Undo a swap that was cut short: a table or partition that is missing beside its old copy comes back."""
    path = path.rstrip("/")
    p, fs = _fs_path(spark, path)
    if not fs.exists(p.getParent()):
        return
    if not fs.exists(p):
        old = _children(spark, str(p.getParent()), f"{p.getName()}__old-")
        if old:
            _move(spark, f"{p.getParent()}/{old[-1]}", path)
    for name in _children(spark, str(p.getParent()), f"{p.getName()}__partold-"):
        aside = f"{p.getParent()}/{name}"
        for leaf in _leaves(spark, aside):
            if not fs.exists(_fs_path(spark, f"{path}/{leaf}")[0]):
                _move(spark, f"{aside}/{leaf}", f"{path}/{leaf}")
        fs.delete(_fs_path(spark, aside)[0], True)


def overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace the whole table (full refresh).

    The new table is written beside the old one and swapped in by two renames, so a write that fails half-way leaves
    the old table as it was; a swap cut short between the renames is undone by the next read (``recover``).
    """
    spark, tag = df.sparkSession, uuid.uuid4().hex[:12]
    path = path.rstrip("/")
    recover(spark, path)
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(f"{path}__new-{tag}")
    swap_in(spark, f"{path}__new-{tag}", path)


def swap_in(spark: SparkSession, folder: str, path: str) -> None:
    """Put the finished ``folder`` in the place of the table at ``path`` by two renames (undone by ``recover`` if cut)."""
    p, fs = _fs_path(spark, path)
    new, old = _fs_path(spark, folder)[0], _fs_path(spark, f"{path}__old-{uuid.uuid4().hex[:12]}")[0]
    had = fs.exists(p)
    if had and not fs.rename(p, old):
        raise OSError(f"could not move {path} aside")
    if not fs.rename(new, p):
        recover(spark, path)
        raise OSError(f"could not move the new table to {path}")
    if had:
        fs.delete(old, True)


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str],
                         emptied: Sequence[str] = ()) -> list[str]:
    """Replace the partitions present in ``df``, and drop the folders ``emptied`` unless ``df`` has them again; returns the
    folders written.

    The new partitions are written beside the table; then, folder by folder, the old one is moved aside and the new one
    moved in. A write that fails leaves the table as it was, and a swap cut short loses no partition (see ``recover``).
    """
    spark, tag, path = df.sparkSession, uuid.uuid4().hex[:12], path.rstrip("/")
    recover(spark, path)
    new, aside = f"{path}__partnew-{tag}", f"{path}__partold-{tag}"
    df.write.mode("errorifexists").partitionBy(*partition_by).parquet(new)
    written = _leaves(spark, new)
    _, fs = _fs_path(spark, path)
    for leaf in [*written, *(e for e in emptied if e not in set(written))]:
        if fs.exists(_fs_path(spark, f"{path}/{leaf}")[0]):
            _move(spark, f"{path}/{leaf}", f"{aside}/{leaf}")
        if leaf in set(written):
            _move(spark, f"{new}/{leaf}", f"{path}/{leaf}")
    for done in (aside, new):
        fs.delete(_fs_path(spark, done)[0], True)
    return written


def stable(df: DataFrame) -> DataFrame:
    """Materialize ``df`` in the shared checkpoint folder (reliable checkpoint, lineage cut)."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


class Merged(NamedTuple):
    """What ``merge_fact`` did: all hours of the batch, the rows that the fact gained, the hours with replaced rows."""

    touched: list
    added: DataFrame | None
    replaced: list


def merge_fact(silver_batch: DataFrame, fact_path: str, before=None) -> Merged:
    """Add a silver batch to the fact table (partitioned by ``record_date``).

    One row per ``delay_record_id`` (trip and second): a replayed or overlapping batch adds nothing twice, and late
    rows are accepted whatever the high-water mark. Of several rows with one key the greatest by ``OBSERVATION_RANK``
    stays, stored or new, so the table is the same however the rows fall into batches. The existing keys are looked
    up only in the touched dates and inside the batch's time range (parquet min/max statistics skip the rest). New
    keys are appended; only dates where a new row replaces a stored one are rewritten. The batch is typed and deduplicated
    once, and so is the join with the stored keys: both are kept in the shared checkpoint folder. ``before`` is called
    with the touched hours before anything is written.
    """
    spark = silver_batch.sparkSession
    new = stable(dedup_observations(fact_historical_delays(silver_batch)))
    # The touched hours (at most 24 per day in the batch) with their time range.
    hours = (new.groupBy("record_date", "record_hour")
             .agg(F.min("recorded_at").alias("lo"), F.max("recorded_at").alias("hi")).collect())
    if not hours:
        return Merged([], None, [])
    touched = sorted((r["record_date"], r["record_hour"]) for r in hours)
    if before is not None:
        before(touched)
    dates = sorted({d for d, _ in touched})
    lo, hi = min(r["lo"] for r in hours), max(r["hi"] for r in hours)
    stored = read_partitions(spark, fact_path, "record_date", dates)
    if stored is None:
        append(new, fact_path, ["record_date"])
        return Merged(touched, new, [])
    seen = (stored.where(F.col("recorded_at").between(ntz_literal(lo), ntz_literal(hi)))
            .select("delay_record_id", F.struct(*OBSERVATION_RANK).alias("_stored"), F.lit(True).alias("_known")))
    known = F.coalesce("_known", F.lit(False))
    changed = stable(new.join(seen, "delay_record_id", "left")
                     .where(~known | (F.struct(*OBSERVATION_RANK) > F.col("_stored")))
                     .select(*new.columns, known.alias("_known")))
    replaced = sorted((r["record_date"], r["record_hour"]) for r in changed.where("_known")
                      .select("record_date", "record_hour").distinct().collect())
    rewritten = F.col("record_date").isin(sorted({d for d, _ in replaced}))
    append(changed.where(~rewritten).drop("_known"), fact_path, ["record_date"])
    if replaced:
        both = read_partitions(spark, fact_path, "record_date", sorted({d for d, _ in replaced}), all_columns=True) \
            .unionByName(changed.where(rewritten).drop("_known"), allowMissingColumns=True)
        overwrite_partitions(_by_date(dedup_observations(both)), fact_path, ["record_date"])
    return Merged(touched, changed.where(~F.col("_known")).drop("_known"), replaced)


def refresh_fact(silver_batch: DataFrame, fact_path: str) -> list:
    """``merge_fact`` without the hourly tables; returns the touched ``(record_date, record_hour)`` pairs."""
    return merge_fact(silver_batch, fact_path).touched


#: Of several observations with one key the greatest stays (nulls are smallest).
OBSERVATION_RANK = ("delay_seconds", "stop_id", "route_id")


def dedup_observations(fact: DataFrame) -> DataFrame:
    """One fact row per ``delay_record_id`` (same trip and second), deterministically chosen."""
    return latest_per_key(fact, ["delay_record_id"], [F.col(c).desc_nulls_last() for c in OBSERVATION_RANK])


def _hours_filter(touched: list):
    """Rows of the touched (date, hour) pairs, as one flat IN list over an hour number (no deep OR chain)."""
    keys = sorted({(d - _EPOCH_DATE).days * 24 + int(h) for d, h in touched})
    if not keys:
        return F.lit(False)
    # One parsed text: a column per hour would cost a call each. The plain filter on the hour reaches the parquet scan;
    # the pair filter decides.
    return F.expr(f"record_hour IN ({', '.join(map(str, sorted({k % 24 for k in keys})))}) AND "
                  f"unix_date(record_date) * 24 + record_hour IN ({', '.join(map(str, keys))})")


def refresh_hourly(fact_path: str, hourly_path: str, touched: list, spark: SparkSession) -> None:
    """Recompute the hourly gold of the touched ``(record_date, record_hour)`` pairs from the fact and
    rewrite their date partitions (untouched hours of those dates are carried over unchanged).

    The result equals a full rebuild however an hour was split across batches. Only touched fact hours are
    read; the rewritten gold partitions are small (one row per route and hour) and are checkpointed before
    the overwrite, since they are read from the same path.
    """
    if not touched:
        return
    dates = sorted({d for d, _ in touched})
    hit = _hours_filter(touched)
    fact = read_partitions(spark, fact_path, "record_date", dates).where(hit)
    fresh = gold_route_performance_hourly(fact)
    stored = read_partitions(spark, hourly_path, "record_date", dates)
    if stored is not None:
        kept = stored.where(~hit)
        fresh = kept.unionByName(fresh.select(*kept.columns))
    overwrite_partitions(_by_date(fresh), hourly_path, ["record_date"])


def _by_date(df: DataFrame) -> DataFrame:
    """``df`` dealt so that a date's rows are in few files of a good size (adaptive execution splits a large date)."""
    return df.hint("rebalance", F.col("record_date"))


def _pending(spark: SparkSession, parts_path: str) -> tuple[list[str], list]:
    """Notes of runs that were cut short, and the hours they were about to write."""
    p, _ = _fs_path(spark, parts_path.rstrip("/"))
    notes = [f"{p.getParent()}/{n}" for n in _children(spark, str(p.getParent()), f"{p.getName()}__pending-")]
    # A note without its success mark was not finished, so its run had not written anything yet.
    whole = [n for n in notes if "_SUCCESS" in _children(spark, n)]
    hours = [(r["record_date"], r["record_hour"]) for r in spark.read.parquet(*whole).distinct().collect()] if whole else []
    return notes, hours


def refresh_hours(silver_batch: DataFrame, fact_path: str, parts_path: str, hourly_path: str) -> dict:
    """Add a silver batch to the fact, to the stored parts of its hours and to the hourly gold.

    The parts of the new rows are merged with the stored parts of the touched hours, and those hours' statistics are made
    from the sum; the fact is read for its keys only. Hours with replaced rows are built anew from the fact. The touched
    hours are noted beside the parts before the fact is written and the note goes when all is done; a run that finds a
    note builds its hours anew too, so a run cut short anywhere is made good by the next one, whatever its batch. Parts
    are built from the whole fact once, if the table is older than they. Returns the touched and the rebuilt hours.
    """
    spark = silver_batch.sparkSession
    parts_path = parts_path.rstrip("/")
    notes, broken = _pending(spark, parts_path)
    old_fact = table_exists(spark, fact_path) and not table_exists(spark, parts_path)

    def note(touched: list) -> None:
        path = f"{parts_path}__pending-{uuid.uuid4().hex[:12]}"
        spark.createDataFrame(touched, "record_date date, record_hour int").coalesce(1).write.parquet(path)
        notes.append(path)

    merged = merge_fact(silver_batch, fact_path, before=note)
    if old_fact:
        overwrite(_by_date(hour_parts(spark.read.parquet(fact_path))), parts_path, ["record_date"])
    rebuilt = sorted({*broken, *merged.replaced, *(merged.touched if old_fact else ())})
    hours = sorted({*merged.touched, *rebuilt})
    if hours:
        _write_hours(spark, merged, hours, rebuilt, fact_path, parts_path, hourly_path)
    for path in notes:
        p, fs = _fs_path(spark, path)
        fs.delete(p, True)
    return {"touched": merged.touched, "rebuilt": rebuilt}


def _write_hours(spark: SparkSession, merged: Merged, hours: list, rebuilt: list, fact_path: str, parts_path: str,
                 hourly_path: str) -> None:
    dates = sorted({d for d, _ in hours})
    stored = read_partitions(spark, parts_path, "record_date", dates)
    kept = sorted(set(hours) - set(rebuilt))
    parts, carried = [], []
    if stored is not None:
        stored = stored.select(*PART_COLUMNS)
        parts += [stored.where(_hours_filter(kept))] if kept else []
        carried = [stored.where(~_hours_filter(hours))]  # other hours of the dates, whose folders are replaced
    if kept and merged.added is not None:
        parts.append(hour_parts(merged.added.where(_hours_filter(kept))))
    if rebuilt:
        fact = read_partitions(spark, fact_path, "record_date", sorted({d for d, _ in rebuilt}))
        parts += [] if fact is None else [hour_parts(fact.where(_hours_filter(rebuilt)))]
    whole = stable(merge_parts(*parts))
    out = whole.unionByName(carried[0]) if carried else whole
    overwrite_partitions(_by_date(out), parts_path, ["record_date"])
    fresh = hourly_from_parts(whole)
    stored = read_partitions(spark, hourly_path, "record_date", dates)
    if stored is not None:
        fresh = stored.where(~_hours_filter(hours)).select(*HOURLY_COLUMNS).unionByName(fresh)
    overwrite_partitions(_by_date(fresh), hourly_path, ["record_date"])


# --- current state ----------------------------------------------------------------------------------------

UPDATE_SEQUENCE = ("loaded_at", "delay_seconds", "stop_id")


def read_current(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The current state at ``path`` (empty if there is none yet), without the columns it is stored by."""
    return read_or_empty(spark, path, schema).drop("buckets", "bucket")


def refresh_current(batch: DataFrame, path: str, buckets: int | None = None,
                    expire_hours: int | None = None) -> list[int]:
    """Bring the current state (latest update per trip, first route id kept) up to date; returns the rewritten buckets.

    The first write fixes the number of buckets (by default the session's shuffle partitions). Trips are stored by hash bucket and only the buckets of the batch's trips are read and rewritten. A replayed or late
    batch cannot move a trip back in time. With ``expire_hours``, trips whose last update lies that much before the latest
    one of the batch leave the rewritten buckets (``expire_current`` sees to the others).
    """
    spark, path = batch.sparkSession, path.rstrip("/")
    recover(spark, path)
    existing = partition_values(spark, path, "buckets")
    buckets = int(existing[0]) if existing else int(buckets or spark.conf.get("spark.sql.shuffle.partitions"))
    columns = batch.columns
    # One row per trip of the batch, typed and reduced once.
    none = spark.createDataFrame([], batch.schema)
    rows = stable(upsert(none, batch, ["trip_id"], list(UPDATE_SEQUENCE), batch_wins=False)
                  .withColumn("bucket", F.pmod(F.xxhash64("trip_id"), F.lit(buckets)).cast("int")))
    touched = sorted(r["bucket"] for r in rows.select("bucket").distinct().collect())
    if not touched:
        return []
    folders = [f"buckets={buckets}/bucket={b}" for b in touched]
    stored = read_folders(spark, path, folders, all_columns=True)
    current = none if stored is None else stored.drop("buckets", "bucket")
    nxt = upsert(current, rows.select(*columns), ["trip_id"], list(UPDATE_SEQUENCE), batch_wins=False)
    if expire_hours is not None:
        latest = rows.agg(F.max("loaded_at")).first()[0]
        if latest is not None:
            nxt = nxt.where(F.col("loaded_at").isNull()
                            | (F.col("loaded_at") >= ntz_literal(latest - _dt.timedelta(hours=int(expire_hours)))))
    _write_current(nxt, path, buckets, folders)
    return touched


def expire_current(spark: SparkSession, path: str, as_of, hours: int) -> int:
    """Remove trips not updated in the ``hours`` before ``as_of``; buckets without any stay as they are."""
    path = path.rstrip("/")
    if not table_exists(spark, path):
        return 0
    buckets = int(partition_values(spark, path, "buckets")[0])
    old = F.col("loaded_at") < ntz_literal(as_of) - F.make_dt_interval(F.lit(0), F.lit(int(hours)))
    found = spark.read.option("mergeSchema", "true").parquet(path).where(old).groupBy("bucket") \
        .agg(F.count(F.lit(1)).alias("n")).collect()
    folders = [f"buckets={buckets}/bucket={r['bucket']}" for r in found]
    if folders:
        left = read_folders(spark, path, folders, all_columns=True).where(~old | F.col("loaded_at").isNull())
        _write_current(left.drop("buckets", "bucket"), path, buckets, folders)
    return sum(r["n"] for r in found)


def _write_current(rows: DataFrame, path: str, buckets: int, folders: list[str]) -> None:
    bucket = F.pmod(F.xxhash64("trip_id"), F.lit(buckets)).cast("int")
    out = rows.withColumn("buckets", F.lit(buckets)).withColumn("bucket", bucket)
    # Each bucket in one task, so one file; there are no more of them than buckets.
    out = out.repartition(min(buckets, len(folders)), "bucket")
    overwrite_partitions(out, path, ["buckets", "bucket"], emptied=folders)


def fact_high_water_mark(spark: SparkSession, fact_path: str):
    """Latest ``recorded_at`` of the fact, read from its newest date folder only (None for no table)."""
    dates = [v for v in partition_values(spark, fact_path, "record_date") if _as_date(v) is not None]
    if not dates:
        return None
    return read_partitions(spark, fact_path, "record_date", dates[-1:]).agg(F.max("recorded_at")).first()[0]


def incremental_fact_batch(silver: DataFrame, fact_path: str, lateness: str = "1 HOUR") -> DataFrame:
    """The silver rows a scheduled run has to merge: everything at or after the fact's mark - lateness."""
    mark = fact_high_water_mark(silver.sparkSession, fact_path)
    return incremental_since(silver, "loaded_at", mark, lateness)


def prune_table(path: str, ts_col: str, as_of, hours: int = 24, partition_col: str | None = None,
                spark: SparkSession | None = None) -> tuple[int, int]:
    """Retention on disk: rewrite the table without rows older than ``as_of - hours``.

    With ``partition_col`` holding the date of ``ts_col``, the folders are classified from one directory
    listing: dates before the cut-off date are wholly expired and deleted (their rows are only counted), and
    only the cut-off date itself is read and, if it holds expired rows, rewritten. Returns ``(kept, pruned)``:
    rows kept in rewritten partitions and rows removed.
    """
    cutoff_day = (_dt.datetime.fromisoformat(str(as_of)) - _dt.timedelta(hours=int(hours))).date()
    if not partition_col:
        kept, counts = prune_old(spark.read.option("mergeSchema", "true").parquet(path), ts_col, as_of, hours)
        c = counts.first()
        if int(c["pruned"]):
            overwrite(stable(kept), path)
        return int(c["kept"]), int(c["pruned"])
    values = [(v, _as_date(v)) for v in partition_values(spark, path, partition_col)]
    expired = [v for v, d in values if d is not None and d < cutoff_day]
    boundary = [v for v, d in values if d == cutoff_day]
    pruned = read_partitions(spark, path, partition_col, expired).count() if expired else 0
    kept_rows = 0
    edge = read_partitions(spark, path, partition_col, boundary, all_columns=True) if boundary else None
    if edge is not None:
        kept, counts = prune_old(edge, ts_col, as_of, hours)
        c = counts.first()
        if int(c["pruned"]):
            kept_rows, pruned = int(c["kept"]), pruned + int(c["pruned"])
            if kept_rows:
                # keep the table's layout, including partition levels below the date (e.g. a run id)
                inner = nested_partition_columns(spark, f"{path.rstrip('/')}/{partition_col}={boundary[0]}")
                overwrite_partitions(stable(kept), path, [partition_col, *inner])
            else:
                expired += boundary
    drop_partitions(spark, path, partition_col, expired)
    return kept_rows, pruned
