"""Structured Streaming: landed feed snapshots -> bronze, observation dedup, hourly windows, and exact
incremental refreshes through ``foreachBatch``.

* ``stream_bronze``: file source of landed snapshots -> flatten -> parquet sink (exactly once through the
  sink's commit log and the checkpoint), ``trigger(availableNow=True)`` in place of a cron schedule.
* ``stream_dedup``: repeated observations dropped with ``dropDuplicatesWithinWatermark`` on the fact key.
* ``stream_hourly``: tumbling one-hour windows per route code with a watermark, append mode; only mergeable
  aggregates (counts, sums, extremes, sample deviation, a sketch of the trips); the exact median and the exact distinct
  trips come from the ``refresh_hours`` tier. ``period_trips`` merges the windows' sketches.
* ``late_splitter``: every row of a stream goes to one table, those behind the watermark in a part of their own, so
  that what windows leave out is kept and counted.
* ``hourly_refresher`` / ``current_state_refresher``: ``foreachBatch`` functions that are idempotent on
  replay (dedup on the surrogate key; per-batch partition overwrite; upsert by latest time).

Event times are TIMESTAMP_NTZ; watermarks need TIMESTAMP, so ``event_time`` maps the wall-clock value to the
instant with the same UTC reading, independent of the session time zone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridepulse import schemas
from ridepulse.functions.columns import (
    cents_to_minutes, day_name, day_of_week, delay_cents, epoch_seconds, from_epoch_seconds, round_ratio,
    time_period,
)
from ridepulse.operators.ingest import flatten_trip_feed, flatten_vehicle_feed
from ridepulse.operators.silver import ntz_literal, silver_trip_updates, silver_vehicle_positions
from ridepulse.plans.gold import fact_historical_delays
from ridepulse.sources import tables


def event_time(ntz_col: str) -> F.Column:
    return F.timestamp_seconds(epoch_seconds(F.col(ntz_col)))


def land_feed(feed: DataFrame, landing: str, n_files: int | None = None) -> None:
    """Write snapshots as time-ordered parquet files, as a collector landing the feed would.

    By default as many as the session has shuffle partitions, which follow the size of the input.
    """
    n_files = n_files or int(feed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    feed.repartitionByRange(n_files, "obs_ts").write.mode("append").parquet(landing)


def read_feed_stream(spark: SparkSession, landing: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schemas.FEED)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return reader.parquet(landing)


def run_available_now(writer, checkpoint: str) -> None:
    """Start a query with ``trigger(availableNow=True)`` (process everything landed, then stop) and wait."""
    q = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def stream_bronze(spark: SparkSession, landing: str, out_dir: str, checkpoint: str,
                  entity: str = "trip_update", max_files_per_trigger: int | None = None,
                  **flatten_options) -> None:
    """Flatten every landed snapshot not yet processed into the bronze table at ``out_dir`` (partitioned by
    ``ingest_date``)."""
    feed = read_feed_stream(spark, landing, max_files_per_trigger)
    rows = (flatten_trip_feed(feed, **flatten_options) if entity == "trip_update"
            else flatten_vehicle_feed(feed, **flatten_options))
    rows = rows.withColumn("ingest_date", F.to_date("ingestion_timestamp"))
    writer = (rows.writeStream.format("parquet").option("path", out_dir).partitionBy("ingest_date")
              .outputMode("append"))
    run_available_now(writer, checkpoint)


def stream_silver(spark: SparkSession, landing: str, out_dir: str, checkpoint: str, entity: str = "trip_update",
                  max_files_per_trigger: int | None = None) -> None:
    """Type every newly landed snapshot into the silver table at ``out_dir`` (partitioned by ``loaded_date``)."""
    feed = read_feed_stream(spark, landing, max_files_per_trigger)
    rows = (silver_trip_updates(flatten_trip_feed(feed)) if entity == "trip_update"
            else silver_vehicle_positions(flatten_vehicle_feed(feed)))
    rows = rows.withColumn("loaded_date", F.to_date("loaded_at"))
    writer = (rows.writeStream.format("parquet").option("path", out_dir).partitionBy("loaded_date")
              .outputMode("append"))
    run_available_now(writer, checkpoint)


def stream_dedup(fact_stream: DataFrame, lateness: str = "2 hours") -> DataFrame:
    """Drop repeated observations (same ``delay_record_id``) arriving within ``lateness`` of each other."""
    return (fact_stream.withColumn("_et", event_time("recorded_at"))
            .withWatermark("_et", lateness)
            .dropDuplicatesWithinWatermark(["delay_record_id"])
            .drop("_et"))


STREAM_HOURLY_COLUMNS = ("route_code", "record_date", "record_hour", "day_of_week", "day_name", "time_period",
                         "total_observations", "unique_trips", "avg_delay_minutes", "max_delay_minutes",
                         "min_delay_minutes", "stddev_delay_minutes", "early_count", "on_time_count", "minor_count", "moderate_count",
                         "severe_count", "critical_count", "on_time_percentage", "last_updated")


#: Size of the trip sketches as a power of two: a relative error of about 1 % and at most 16 KB of state per window;
#: a window of few trips keeps them as a list, so its count is exact.
SKETCH_BITS = 14


def stream_hourly(fact_stream: DataFrame, lateness: str = "2 hours") -> DataFrame:
    """Hourly route statistics over event-time windows; a window is emitted once the watermark passes it.

    ``unique_trips`` is the estimate of ``trip_sketch``, a mergeable sketch of the window's trips (HyperLogLog).
    """
    cents = F.col("_c")
    cat = F.col("delay_category")
    bands = ("early", "on_time", "minor", "moderate", "severe", "critical")
    g = (fact_stream.select("route_code", "delay_category", "recorded_at", "trip_id",
                            delay_cents("delay_seconds").alias("_c"), event_time("recorded_at").alias("_et"))
         .withWatermark("_et", lateness)
         .groupBy(F.window("_et", "1 hour"), "route_code")
         .agg(F.count(F.lit(1)).alias("n"), F.sum(cents).alias("s"), F.max(cents).alias("mx"),
              F.min(cents).alias("mn"), F.stddev_samp(cents).alias("sd"),
              F.hll_sketch_agg("trip_id", F.lit(SKETCH_BITS)).alias("trip_sketch"),
              *[F.count_if(cat == b).alias(f"{b}_count") for b in bands],
              F.count_if(cat.isin("early", "on_time")).alias("ok"),
              F.max("recorded_at").alias("last_updated")))
    start = from_epoch_seconds(F.unix_seconds(F.col("window.start")))
    hour = F.hour(start).cast("int")
    out = g.select(
        "route_code", F.to_date(start).alias("record_date"), hour.alias("record_hour"),
        day_of_week(start).alias("day_of_week"), day_name(start).alias("day_name"),
        time_period(hour).alias("time_period"),
        F.col("n").cast("long").alias("total_observations"),
        F.hll_sketch_estimate("trip_sketch").alias("unique_trips"),
        cents_to_minutes(round_ratio("s", "n")).alias("avg_delay_minutes"),
        cents_to_minutes("mx").alias("max_delay_minutes"),
        cents_to_minutes("mn").alias("min_delay_minutes"),
        F.round((F.coalesce(F.col("sd"), F.lit(0.0)) / F.lit(100.0)).cast("decimal(18,6)"), 2)
        .cast("double").alias("stddev_delay_minutes"),
        *[F.col(f"{b}_count").cast("long").alias(f"{b}_count") for b in bands],
        cents_to_minutes(round_ratio(F.col("ok") * 10000, "n")).alias("on_time_percentage"),
        "last_updated", "trip_sketch")
    return out


def period_trips(windows: DataFrame) -> DataFrame:
    """Distinct trips per route code, weekday and period over streamed windows, from their merged sketches: a trip
    seen in several hours of a period counts once, which adding up the windows' counts would not give."""
    g = windows.groupBy("route_code", "day_of_week", "day_name", "time_period").agg(
        F.count(F.lit(1)).alias("observation_hours"),
        F.sum("total_observations").alias("total_observations"),
        F.hll_union_agg("trip_sketch").alias("trip_sketch"))
    return g.select("route_code", "day_of_week", "day_name", "time_period", "observation_hours", "total_observations",
                    F.hll_sketch_estimate("trip_sketch").alias("unique_trips"), "trip_sketch")


def silver_fact_stream(feed_stream: DataFrame) -> DataFrame:
    return fact_historical_delays(silver_trip_updates(flatten_trip_feed(feed_stream)))


def hourly_refresher(fact_path: str, hourly_path: str, parts_path: str | None = None):
    """``foreachBatch`` function: add a silver batch to the fact, the parts of its hours and the hourly gold."""
    parts = parts_path or f"{hourly_path.rstrip('/')}_parts"

    def refresh(batch: DataFrame, batch_id: int) -> None:
        tables.refresh_hours(batch, fact_path, parts, hourly_path)
    return refresh


def current_state_refresher(history_path: str | None, current_path: str, expire_hours: int | None = None):
    """``foreachBatch`` function: keep the update history (one partition per batch id, overwritten on replay; none
    without a ``history_path``) and the current state (latest update per trip, first route id kept), of which only the
    buckets of the batch's trips are rewritten."""
    def refresh(batch: DataFrame, batch_id: int) -> None:
        if history_path:
            tables.overwrite_partitions(batch.withColumn("batch_id", F.lit(int(batch_id))), history_path,
                                        ["batch_id"])
        tables.refresh_current(batch, current_path, expire_hours=expire_hours)
    return refresh


def run_foreach_batch(stream: DataFrame, fn, checkpoint: str) -> None:
    run_available_now(stream.writeStream.foreachBatch(fn), checkpoint)


def _mark_before(spark: SparkSession, marks: str, batch_id: int):
    """The greatest event time of the batches before ``batch_id``; marks older than the one before are dropped."""
    before = sorted(b for b in (int(v) for v in tables.partition_values(spark, marks, "batch_id")) if b < batch_id)
    if not before:
        return None
    mark = tables.read_partitions(spark, marks, "batch_id", before[-1:]).first()["mark"]
    tables.drop_partitions(spark, marks, "batch_id", before[:-1])
    return mark


def late_splitter(out_path: str, lateness: str = "2 hours", ts_col: str = "recorded_at"):
    """``foreachBatch`` function: write a stream to ``out_path/rows``, the rows behind the watermark under ``late=true``.

    A row is late if it lies before the greatest time of the batches before its own minus ``lateness``: the rule of the
    windows, but of the row's own time, and the row is kept. ``watermark`` is what it missed (null before the second
    batch) and ``age_seconds`` by how much (null for rows in time). Rows without a time cannot be late. Each batch is
    computed once and written under its batch id; its greatest time is read back from what was written and stored as
    one row. A replayed batch meets the same mark and replaces its own folders.
    """
    rows, marks = f"{out_path}/rows", f"{out_path}/marks"

    def split(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        mark = _mark_before(spark, marks, batch_id)
        watermark = (F.lit(None).cast("timestamp_ntz") if mark is None
                     else ntz_literal(mark) - F.expr(f"INTERVAL {lateness}"))
        at = F.col(ts_col)
        late = F.coalesce(at < watermark, F.lit(False))
        out = batch.select("*", watermark.alias("watermark"),
                           F.when(late, F.timestamp_diff("SECOND", at, watermark)).alias("age_seconds"),
                           late.alias("late"), F.lit(int(batch_id)).alias("batch_id"))
        known = [f"late={v}/batch_id={batch_id}" for v in ("false", "true")]
        tables.overwrite_partitions(out, rows, ["late", "batch_id"],
                                    emptied=[k for k in known if tables.table_exists(spark, f"{rows}/{k}")])
        written = tables.read_folders(spark, rows, known)
        top = written.agg(F.max(ts_col)).first()[0] if written is not None else None
        top = max((t for t in (mark, top) if t is not None), default=None)
        if top is not None:
            one = spark.range(1).select(ntz_literal(top).alias("mark"), F.lit(int(batch_id)).alias("batch_id"))
            tables.overwrite_partitions(one, marks, ["batch_id"])
    return split


def split_rows(spark: SparkSession, out_path: str) -> DataFrame:
    """What ``late_splitter`` wrote: all rows, with ``late`` and ``batch_id`` (a filter on either prunes folders)."""
    return spark.read.parquet(f"{out_path}/rows").withColumn("late", F.col("late").cast("boolean"))


def split_counts(rows: DataFrame) -> DataFrame:
    """Rows in time and late rows of each batch, and the greatest and the mean age of the late ones."""
    return rows.groupBy("batch_id").agg(
        F.count_if(~F.col("late")).alias("on_time_rows"), F.count_if("late").alias("late_rows"),
        F.max("age_seconds").alias("max_age_seconds"),
        round_ratio(F.sum("age_seconds"), F.count("age_seconds")).cast("long").alias("avg_age_seconds"))
