"""Scheduled batch job: one run lands a batch of feed snapshots in bronze and brings silver, the fact and the
gold tables up to date incrementally (the cron + transform flow, re-expressed as Spark writes).

Layout under ``root``: ``bronze/{vehicle_positions,trip_updates}`` (partitioned by ``ingest_date``),
``silver/{vehicle_positions,trip_updates}`` (by ``loaded_date``), ``fact/historical_delays`` and
``gold/route_performance_hourly`` (by ``record_date``), ``gold/hour_parts`` (by ``record_date``, ``record_hour``),
``gold/current_trips`` (by hash bucket of the trip), ``gold/worst_routes_by_period`` and
``gold/network_summary`` (small, rebuilt from the hourly table each run), ``gold/dim_routes`` and
``gold/route_performance`` (rebuilt from all silver updates by ``rebuild_route_tables``), ``marks/feed`` (how far
``refresh_since_mark`` has read), ``window/{updates,positions}`` (what the trip reports need of the last hours, bucketed by
trip; ``rebuild_trip_window``).
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridepulse import schemas
from ridepulse.operators.ingest import flatten_trip_feed, flatten_vehicle_feed
from ridepulse.operators.keyed import incremental_since, latest_per_key
from ridepulse.operators.silver import ntz_literal, silver_trip_updates, silver_vehicle_positions
from ridepulse.plans import gold, reports
from ridepulse.plans.gold import gold_network_summary, gold_worst_routes_by_period
from ridepulse.sources import buckets, tables


@dataclass(frozen=True)
class Warehouse:
    root: str

    def path(self, *parts: str) -> str:
        return os.path.join(self.root, *parts)

    @property
    def bronze_vehicles(self) -> str:
        return self.path("bronze", "vehicle_positions")

    @property
    def bronze_trips(self) -> str:
        return self.path("bronze", "trip_updates")

    @property
    def silver_vehicles(self) -> str:
        return self.path("silver", "vehicle_positions")

    @property
    def silver_trips(self) -> str:
        return self.path("silver", "trip_updates")

    @property
    def fact(self) -> str:
        return self.path("fact", "historical_delays")

    @property
    def hourly(self) -> str:
        return self.path("gold", "route_performance_hourly")

    @property
    def parts(self) -> str:
        return self.path("gold", "hour_parts")

    @property
    def current(self) -> str:
        return self.path("gold", "current_trips")

    @property
    def worst(self) -> str:
        return self.path("gold", "worst_routes_by_period")

    @property
    def network(self) -> str:
        return self.path("gold", "network_summary")

    @property
    def marks(self) -> str:
        return self.path("marks", "feed")

    @property
    def window_updates(self) -> str:
        return self.path("window", "updates")

    @property
    def window_positions(self) -> str:
        return self.path("window", "positions")

    @property
    def routes(self) -> str:
        return self.path("gold", "dim_routes")

    @property
    def performance(self) -> str:
        return self.path("gold", "route_performance")


def _add(rows: DataFrame, path: str, date_col: str, ts_col: str, run_id: str | None,
         cluster_by: tuple[str, ...] = ()) -> DataFrame:
    """Append a batch partitioned by date; with a ``run_id`` the batch lands in its own ``run_id`` folders and
    is written with dynamic partition overwrite, so re-running the same run replaces instead of duplicating.

    ``cluster_by`` sorts each task's output (no shuffle), so parquet row groups cover narrow key ranges and
    point lookups (one trip's history) skip most of them through min/max statistics.

    Returns the batch for the steps that follow, so that none derives it again from the feed: read back from the folders
    just written, which hold nothing else, or without a ``run_id`` from the shared checkpoint folder.
    """
    spark, columns = rows.sparkSession, rows.columns
    if run_id is None:
        rows = tables.stable(rows)
    out = rows.withColumn(date_col, F.to_date(ts_col))
    if cluster_by:
        out = out.sortWithinPartitions(date_col, *cluster_by)
    if run_id is None:
        tables.append(out, path, [date_col])
        return rows
    written = tables.overwrite_partitions(out.withColumn("run_id", F.lit(str(run_id))), path, [date_col, "run_id"])
    stored = tables.read_folders(spark, path, written)
    return spark.createDataFrame([], rows.schema) if stored is None else stored.select(*columns)


def append_bronze(rows: DataFrame, path: str, run_id: str | None = None) -> DataFrame:
    """Bronze is append-only history, partitioned by ingestion date. Returns the batch as it landed."""
    return _add(rows, path, "ingest_date", "ingestion_timestamp", run_id)


def refresh_warehouse(feed_batch: DataFrame, root: str, as_of=None, retention_hours: int | None = None,
                      run_id: str | None = None) -> dict:
    """Run one scheduled refresh for a batch of landed snapshots; returns what was touched.

    Each step reads only what the batch touches: bronze and silver are appended, the fact takes the batch
    with key dedup, the hourly gold adds the batch's parts to the touched hours, the current state rewrites the buckets
    of the batch's trips, and the two small period tables are rebuilt from the hourly gold. With ``retention_hours``
    the bronze tables are pruned, and ended trips leave the current state, relative to ``as_of``.

    Re-running a failed or repeated run is safe: the fact dedups on its key and the gold tables are
    recomputed; passing a ``run_id`` (e.g. the landing folder's name) makes the bronze and silver appends
    idempotent as well.
    """
    spark: SparkSession = feed_batch.sparkSession
    w = Warehouse(root)
    # Each layer is made from the one just landed: the feed is read twice, whatever the number of steps.
    vehicles = append_bronze(flatten_vehicle_feed(feed_batch), w.bronze_vehicles, run_id)
    trips = append_bronze(flatten_trip_feed(feed_batch), w.bronze_trips, run_id)
    _add(silver_vehicle_positions(vehicles), w.silver_vehicles, "loaded_date", "loaded_at", run_id,
         cluster_by=("trip_id", "loaded_at"))
    updates = _add(silver_trip_updates(trips), w.silver_trips, "loaded_date", "loaded_at", run_id,
                   cluster_by=("trip_id", "loaded_at"))
    touched = tables.refresh_hours(updates, w.fact, w.parts, w.hourly)["touched"]
    tables.refresh_current(updates, w.current)
    hourly = spark.read.parquet(w.hourly)
    # Both outputs are small (routes x 35 periods): full rebuilds, written to their own paths.
    tables.overwrite(gold_worst_routes_by_period(hourly), w.worst)
    tables.overwrite(gold_network_summary(hourly), w.network)
    pruned = {}
    if retention_hours is not None and as_of is not None:
        for name, p in (("bronze_vehicle_positions", w.bronze_vehicles), ("bronze_trip_updates", w.bronze_trips)):
            pruned[name] = tables.prune_table(p, "ingestion_timestamp", as_of, retention_hours,
                                              partition_col="ingest_date", spark=spark)
        pruned["current_trips"] = tables.expire_current(spark, w.current, as_of, retention_hours)
    return {"touched_hours": len(touched), "pruned": pruned}


def refresh_since_mark(feed: DataFrame, root: str, lateness: str = "1 HOUR", **options) -> dict:
    """One scheduled refresh that takes from the landed snapshots only what no earlier run of this kind has taken.

    The mark is the greatest snapshot time so far, kept in ``marks/feed`` with the digests of the snapshots no older
    than ``lateness`` before it. A run reads from ``mark - lateness`` on (a literal, pushed into the scan of the
    landing folder), leaves out the snapshots whose digest is kept, refreshes the warehouse with the rest, and writes
    the new mark last. So the same folder again adds nothing, and a snapshot landed late inside the bound is taken once.
    Snapshots older than that, or without a time, are taken by the first run only (give them to ``refresh_warehouse``).
    The kept digests follow the bound, not the history. A run that was cut short leaves the old mark and is repeated in
    full: pass the same ``run_id`` again, or bronze and silver keep what it had appended (fact and gold do not).
    """
    spark = feed.sparkSession
    path = Warehouse(root).marks
    digest = F.sha2(F.to_json(F.struct(*[F.col(c) for c in feed.columns])), 256)
    kept = spark.read.parquet(path) if tables.table_exists(spark, path) else None
    mark = kept.agg(F.max("mark")).first()[0] if kept is not None else None
    new = incremental_since(feed, "obs_ts", mark, lateness)
    if mark is not None:
        # No snapshot after the mark can be among those kept, so only the rows up to it need a digest.
        after = F.col("obs_ts") > ntz_literal(mark)
        known = kept.select(F.col("digest").alias("_digest"))
        again = new.where(~after).withColumn("_digest", digest).join(known, "_digest", "left_anti")
        new = tables.stable(new.where(after).unionByName(again.select(*feed.columns)))  # read by every step of the run
    found = new.agg(F.count(F.lit(1)), F.max("obs_ts")).first()
    if not found[0]:
        return {"snapshots": 0, "touched_hours": 0, "pruned": {}}
    done = refresh_warehouse(new, root, **options)
    top = max((t for t in (mark, found[1]) if t is not None), default=None)
    if top is not None:
        # Of the snapshots inside the new bound, those of this run and those kept before.
        inside = incremental_since(new, "obs_ts", top, lateness).select("obs_ts", digest.alias("digest"))
        if mark is not None:
            inside = inside.unionByName(incremental_since(kept, "obs_ts", top, lateness).select("obs_ts", "digest"))
        tables.overwrite(inside.distinct().select(ntz_literal(top).alias("mark"), "obs_ts", "digest"), path)
    return {"snapshots": found[0], **done}


def observations(silver: DataFrame) -> DataFrame:
    """Stored silver rows without the columns that say how they came, each once: a day delivered again under another run
    id stands in silver twice. Filters on the row's own columns reach the scan."""
    return silver.drop("run_id", "batch_id", "loaded_date").distinct()


def rebuild_route_tables(spark: SparkSession, root: str) -> None:
    """Write the route dimension and the route performance table from all stored silver updates."""
    w = Warehouse(root)
    if tables.table_exists(spark, w.silver_trips):
        updates = observations(spark.read.parquet(w.silver_trips))
        tables.overwrite(gold.dim_routes(updates), w.routes)
        tables.overwrite(gold.gold_route_performance(updates), w.performance)


def window_updates(updates: DataFrame) -> DataFrame:
    """The updates that trip reports can need: of the rows of a trip, route and time, the one that counts.

    Reports take the latest update of a trip, of those of equal time the one with the larger delay, whatever route prefix
    or time they look at, so nothing else of a time can be their answer. Rows without a delay answer nothing. A trip so
    keeps at most one row per route and snapshot time, however often it was delivered.
    """
    rows = updates.where(F.col("delay_seconds").isNotNull()).select(*schemas.WINDOW_UPDATES.names)
    return latest_per_key(rows, ["trip_id", "route_id", "loaded_at"], reports.update_order())


def window_positions(positions: DataFrame) -> DataFrame:
    """The positions that trip reports can need: one per trip, GPS time and time of loading."""
    return latest_per_key(positions.select(*schemas.WINDOW_POSITIONS.names), ["trip_id", "gps_timestamp", "loaded_at"],
                          reports.position_order())


def rebuild_trip_window(spark: SparkSession, root: str, as_of=None, hours: int | None = 24,
                        n_buckets: int | None = None) -> None:
    """Write the last ``hours`` before ``as_of`` (None: the time of the latest update) of stored silver, reduced to what the
    trip reports need and bucketed by trip (``hours=None``: all of it).

    The reports then group by trip and join updates with positions without an exchange. A run reads the date folders of
    the window only. Both tables have the same number of buckets, by default the shuffle partitions, at most 2,048. The
    reduction is dealt by trip, route and time, so a trip with most of the rows is reduced by many tasks.
    """
    w = Warehouse(root)
    n = n_buckets or min(int(spark.conf.get("spark.sql.shuffle.partitions")), 2048)
    stored = {p: spark.read.parquet(p) for p in (w.silver_trips, w.silver_vehicles) if tables.table_exists(spark, p)}
    if hours is not None and as_of is None:
        last = tables.partition_values(spark, w.silver_trips, "loaded_date")
        last = [d for d in last if tables._as_date(d) is not None][-1:]  # only the latest date is read
        as_of = (stored[w.silver_trips].where(F.col("loaded_date") == F.lit(last[0]).cast("date"))
                 .agg(F.max("loaded_at")).first()[0] if last else None)
    for source, target, reduce in ((w.silver_trips, w.window_updates, window_updates),
                                   (w.silver_vehicles, w.window_positions, window_positions)):
        if source in stored:
            rows = stored[source] if as_of is None else reports.recent(stored[source], as_of, hours)
            buckets.write_bucketed(reduce(rows), target, "trip_id", n)


def trip_window(spark: SparkSession, root: str,
                max_bucket_bytes: int = buckets.MAX_BUCKET_BYTES) -> tuple[DataFrame, DataFrame]:
    """Updates and positions of the stored window, for ``reports.delays``, ``delay_trend`` and the like."""
    w = Warehouse(root)
    return (buckets.read_bucketed(spark, w.window_updates, schemas.WINDOW_UPDATES, max_bucket_bytes),
            buckets.read_bucketed(spark, w.window_positions, schemas.WINDOW_POSITIONS, max_bucket_bytes))


def compact_warehouse(spark: SparkSession, root: str, dates: list[str], target_file_bytes: int = 256 << 20) -> dict:
    """Compact the append-heavy tables (bronze, silver, fact) for closed dates, e.g. yesterday's: a
    five-minute cadence leaves hundreds of small files per date folder."""
    w = Warehouse(root)
    out = {}
    for name, path, col, ts in (("bronze_vehicle_positions", w.bronze_vehicles, "ingest_date", "ingestion_timestamp"),
                                ("bronze_trip_updates", w.bronze_trips, "ingest_date", "ingestion_timestamp"),
                                ("silver_vehicle_positions", w.silver_vehicles, "loaded_date", "loaded_at"),
                                ("silver_trip_updates", w.silver_trips, "loaded_date", "loaded_at"),
                                ("fact_historical_delays", w.fact, "record_date", "recorded_at")):
        present = [d for d in dates if d in set(tables.partition_values(spark, path, col))]
        if present:
            out[name] = tables.compact_partitions(spark, path, col, present, target_file_bytes, ("trip_id", ts))
    return out
