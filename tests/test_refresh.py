"""On-disk incremental maintenance: k batches equal one full build; replays are harmless; retention."""

import datetime as dt
import tempfile

from pyspark.sql import functions as F

from ridepulse import schemas
from ridepulse.plans import gold
from ridepulse.sources import tables

D = dt.datetime


def _silver(spark, rows):
    return spark.createDataFrame(rows, schemas.SILVER_TRIP_UPDATES)


def _sorted(df):
    return sorted(tuple(r) for r in df.select(*gold.HOURLY_COLUMNS).collect())


def test_hour_split_across_batches_equals_full_build(spark):
    b1 = [("t1", "R1_0", 60, "S1", D(2024, 1, 2, 8, 5)), ("t2", "R1_0", 700, "S2", D(2024, 1, 2, 8, 10))]
    b2 = [("t3", "R1_0", -30, "S3", D(2024, 1, 2, 8, 50)), ("t1", "R1_0", 90, "S1", D(2024, 1, 2, 9, 1)),
          ("t4", "R2_0", 1500, "S4", D(2024, 1, 3, 23, 59))]
    base = tempfile.mkdtemp(prefix="rp-refresh-")
    fact_path, hourly_path = f"{base}/fact", f"{base}/hourly"
    for batch in (b1, b2, b2):            # the second batch is replayed
        touched = tables.refresh_fact(_silver(spark, batch), fact_path)
        tables.refresh_hourly(fact_path, hourly_path, touched, spark)
    full = gold.gold_route_performance_hourly(gold.fact_historical_delays(_silver(spark, b1 + b2)))
    assert _sorted(spark.read.parquet(hourly_path)) == _sorted(full)
    assert spark.read.parquet(fact_path).count() == 5
    # Aggregating only the new rows and replacing the stored hour (the published incremental rule) would
    # keep 1 observation for 08:00 instead of 3.
    only_new = gold.gold_route_performance_hourly(gold.fact_historical_delays(_silver(spark, b2)))
    assert only_new.where("record_hour = 8").first().total_observations == 1
    assert spark.read.parquet(hourly_path).where("record_hour = 8").first().total_observations == 3


def test_incremental_fact_batch_uses_mark_minus_lateness(spark):
    base = tempfile.mkdtemp(prefix="rp-mark-")
    fact_path = f"{base}/fact"
    s = _silver(spark, [("t1", "R1_0", 1, "S1", D(2024, 1, 2, 10, 0)), ("t2", "R1_0", 2, "S1", D(2024, 1, 2, 9, 30)),
                        ("t3", "R1_0", 3, "S1", D(2024, 1, 2, 8, 0))])
    assert tables.incremental_fact_batch(s, fact_path).count() == 3        # no table yet: everything
    tables.refresh_fact(s.where("trip_id = 't1'"), fact_path)
    assert tables.incremental_fact_batch(s, fact_path, "1 HOUR").count() == 2   # 10:00 and 09:30


def test_prune_table_drops_expired_partitions(spark):
    base = tempfile.mkdtemp(prefix="rp-prune-")
    path = f"{base}/t"
    df = spark.createDataFrame([(D(2024, 1, 7, 12),), (D(2024, 1, 8, 23),), (D(2024, 1, 9, 1),),
                                (D(2024, 1, 9, 12),)], "ts timestamp_ntz").withColumn("d", F.to_date("ts"))
    tables.overwrite(df, path, ["d"])
    kept, pruned = tables.prune_table(path, "ts", "2024-01-10 00:00:00", 24, partition_col="d", spark=spark)
    assert (kept, pruned) == (0, 2)
    left = sorted(r.ts for r in spark.read.parquet(path).collect())
    assert left == [D(2024, 1, 9, 1), D(2024, 1, 9, 12)]


def test_read_or_empty(spark):
    base = tempfile.mkdtemp(prefix="rp-empty-")
    df = tables.read_or_empty(spark, f"{base}/missing", schemas.SILVER_TRIP_UPDATES)
    assert df.count() == 0 and df.columns == [f.name for f in schemas.SILVER_TRIP_UPDATES.fields]


def test_warehouse_runs_equal_full_build_and_prune(spark):
    from compare import SF_SMALL
    from ridepulse.plans import catalog, jobs
    from ridepulse.operators.silver import ntz_literal
    t = catalog.Tables(spark, SF_SMALL)
    root = tempfile.mkdtemp(prefix="rp-wh-")
    f = t.feed
    cut = ntz_literal("2024-01-20 00:00:00")
    jobs.refresh_warehouse(f.where(F.col("obs_ts") < cut), root)
    out = jobs.refresh_warehouse(f.where(F.col("obs_ts") >= cut), root, as_of="2024-01-30 00:00:00",
                                 retention_hours=48)
    w = jobs.Warehouse(root)
    assert _sorted(spark.read.parquet(w.hourly)) == _sorted(t.hourly)
    net = sorted(tuple(r) for r in spark.read.parquet(w.network).collect())
    assert net == sorted(tuple(r) for r in t.network.select(*spark.read.parquet(w.network).columns).collect())
    kept_v, pruned_v = out["pruned"]["bronze_vehicle_positions"]
    assert pruned_v > 0
    left = spark.read.parquet(w.bronze_trips)
    assert left.where(F.col("ingestion_timestamp") < ntz_literal("2024-01-28 00:00:00")).count() == 0


def test_prune_table_rewrites_the_boundary_date(spark):
    base = tempfile.mkdtemp(prefix="rp-prune-edge-")
    path = f"{base}/t"
    df = spark.createDataFrame([(D(2024, 1, 8, 23),), (D(2024, 1, 9, 1),), (D(2024, 1, 9, 12),),
                                (D(2024, 1, 9, 18),)], "ts timestamp_ntz").withColumn("d", F.to_date("ts"))
    tables.overwrite(df, path, ["d"])
    kept, pruned = tables.prune_table(path, "ts", "2024-01-10 00:00:00", 12, partition_col="d", spark=spark)
    assert (kept, pruned) == (2, 2)                 # cut-off 2024-01-09 12:00: the 12:00 row is kept
    left = sorted(r.ts for r in spark.read.parquet(path).collect())
    assert left == [D(2024, 1, 9, 12), D(2024, 1, 9, 18)]
    assert tables.partition_values(spark, path, "d") == ["2024-01-09"]


def test_rerun_with_run_id_is_idempotent(spark):
    from compare import SF_SMALL
    from ridepulse.plans import catalog, jobs
    t = catalog.Tables(spark, SF_SMALL)
    root = tempfile.mkdtemp(prefix="rp-rerun-")
    for _ in range(2):                               # the same run delivered twice (e.g. a retried job)
        jobs.refresh_warehouse(t.feed, root, run_id="2024-01-31T00:00")
    w = jobs.Warehouse(root)
    assert spark.read.parquet(w.bronze_trips).count() == t.bronze_trip_updates.count()
    assert spark.read.parquet(w.silver_trips).count() == t.silver_trip_updates.count()
    assert spark.read.parquet(w.fact).count() == t.fact.count()
    assert _sorted(spark.read.parquet(w.hourly)) == _sorted(t.hourly)


def test_retention_keeps_run_id_layout(spark):
    from compare import SF_SMALL
    from ridepulse.plans import catalog, jobs
    t = catalog.Tables(spark, SF_SMALL)
    root = tempfile.mkdtemp(prefix="rp-runid-prune-")
    out = jobs.refresh_warehouse(t.feed, root, as_of="2024-01-20 06:00:00", retention_hours=24, run_id="r1")
    w = jobs.Warehouse(root)
    left = spark.read.parquet(w.bronze_trips)
    assert out["pruned"]["bronze_trip_updates"][1] > 0
    assert left.where(F.col("ingestion_timestamp") < F.lit("2024-01-19 06:00:00").cast("timestamp_ntz")).count() == 0
    assert left.where(F.col("ingestion_timestamp") >= F.lit("2024-01-19 06:00:00").cast("timestamp_ntz")).count() \
        == t.bronze_trip_updates.where(F.col("ingestion_timestamp") >= F.lit("2024-01-19 06:00:00")
                                       .cast("timestamp_ntz")).count()
    assert set(left.columns) >= {"ingest_date", "run_id"}


def test_compaction_keeps_rows_and_reduces_files(spark):
    base = tempfile.mkdtemp(prefix="rp-compact-")
    path = f"{base}/fact"
    u = _silver(spark, [(f"t{i}", "R1_0", i, "S1", D(2024, 1, 2, i % 24, i % 60)) for i in range(200)])
    for i in range(5):                                     # five small appends to the same date
        tables.refresh_fact(u.where(F.col("delay_seconds") % 5 == i), path)
    rows_before = sorted(map(tuple, spark.read.parquet(path).collect()))
    out = tables.compact_partitions(spark, path, "record_date", ["2024-01-02"])
    assert out["files_after"] == 1 and out["files_before"] > 1
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == rows_before


def test_high_water_mark_reads_newest_date_folder(spark):
    base = tempfile.mkdtemp(prefix="rp-hwm-")
    path = f"{base}/fact"
    assert tables.fact_high_water_mark(spark, path) is None
    tables.refresh_fact(_silver(spark, [("t1", "R1_0", 1, "S1", D(2024, 1, 2, 10, 0)),
                                        ("t2", "R1_0", 1, "S1", D(2024, 1, 3, 9, 0))]), path)
    assert tables.fact_high_water_mark(spark, path) == D(2024, 1, 3, 9, 0)
    assert tables.partition_values(spark, path, "record_date") == ["2024-01-02", "2024-01-03"]
    assert tables.nested_partition_columns(spark, path) == ["record_date"]
