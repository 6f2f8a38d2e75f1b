"""Swapped table writes, as-of bounds and the default delay of a present arrival."""

import datetime as dt
import glob
import random

import pytest
from pyspark.sql import functions as F

from compare import SF_SMALL
from ridepulse import schemas
from ridepulse.operators.ingest import flatten_trip_feed
from ridepulse.plans import catalog, reports
from ridepulse.sources import tables
from ridepulse.streaming import stream


def test_failed_overwrite_keeps_the_table(spark, tmp_path):
    path = f"{tmp_path}/state"
    tables.overwrite(spark.range(36), path)

    @F.udf("long")
    def breaks(x):
        if x == 3:
            raise ValueError("lost")
        return x

    with pytest.raises(Exception, match="lost"):
        tables.overwrite(spark.range(10).select(breaks("id").alias("id")), path)
    assert spark.read.parquet(path).count() == 36
    tables.overwrite(spark.read.parquet(path).where("id < 5"), path)  # may read the table it replaces
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == list(range(5))


def test_a_swap_cut_short_is_undone(spark, tmp_path):
    path = f"{tmp_path}/state"
    tables.overwrite(spark.range(7), path)
    p, fs = tables._fs_path(spark, path)
    fs.rename(p, tables._fs_path(spark, f"{path}__old-abc")[0])
    assert tables.table_exists(spark, path) and spark.read.parquet(path).count() == 7


UPDATES = "trip_id string, route_id string, delay_seconds int, stop_id string, loaded_at timestamp_ntz"


def test_reports_see_nothing_after_as_of(spark):
    rows = [("a", "R1_0", d, "s", t) for d, t in ((10, "2024-01-01 09:00:00"), (200, "2024-01-01 10:00:00"),
                                                   (900, "2024-01-01 12:00:00"))]
    u = spark.createDataFrame([(a, b, c, d) for a, b, c, d, _ in rows], "trip_id string, route_id string, "
                              "delay_seconds int, stop_id string")
    times = F.when(F.col("delay_seconds") == 10, rows[0][4]).when(F.col("delay_seconds") == 200, rows[1][4]) \
        .otherwise(rows[2][4]).cast("timestamp_ntz")
    u = u.withColumn("loaded_at", times)
    at = {t: reports.delay_trend(u, t).first() for t in ("2024-01-01 10:00:00", "2024-01-01 12:00:00")}
    first, second = at.values()
    assert (first.delay_seconds, first.prev_delay_seconds, first.trend) == (200, 10, "worsening")
    assert (second.delay_seconds, second.prev_delay_seconds) == (900, 200)
    assert reports.delay_trend(u, "2024-01-01 08:00:00").count() == 0


@pytest.mark.parametrize("mode", ["drop", "zero"])
def test_present_arrival_without_delay_is_zero(spark, mode):
    feed = spark.createDataFrame([(1,)], "event_id long").selectExpr(
        "event_id", "timestamp_ntz'2024-01-01 00:00:00' AS obs_ts", """array(named_struct(
            'id', '1', 'vehicle', NULL, 'trip_update', named_struct(
                'trip', named_struct('trip_id', 't', 'route_id', 'r'),
                'stop_time_update', array(named_struct(
                    'arrival', named_struct('delay', CAST(NULL AS INT)),
                    'departure', named_struct('delay', 70), 'stop_id', 's'))))) AS entity""")
    assert schemas.FEED is not None
    rows = flatten_trip_feed(feed, missing_delay=mode).collect()
    assert [r.raw_data for r in rows] == ['{"delay":0,"stop_id":"s"}']


SILVER = "trip_id string, route_id string, delay_seconds int, stop_id string, loaded_at timestamp_ntz"


def _at(day, hour, minute=0):
    return dt.datetime(2024, 1, day, hour, minute)


@pytest.mark.parametrize("seed", range(3))
def test_fact_and_state_do_not_depend_on_the_batches(spark, tmp_path, seed):
    """Repeated keys with other values, late rows and changed routes, in one batch and in random batches."""
    pick = random.Random(seed)
    rows = [(f"t{pick.randrange(4)}", f"R{pick.randrange(3)}_0", pick.choice([None, 10, 90, 500]),
             pick.choice([None, "S1", "S2"]), _at(pick.randrange(2, 4), pick.randrange(2))) for _ in range(40)]
    rows += rows[:5]
    cuts = sorted(pick.sample(range(1, len(rows)), 3))
    split = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)])]

    def run(name, batches):
        fact, hourly = f"{tmp_path}/{name}/fact", f"{tmp_path}/{name}/hourly"
        refresh = stream.hourly_refresher(fact, hourly)
        for i, b in enumerate(batches):
            refresh(spark.createDataFrame(b, SILVER), i)
        return [sorted(map(repr, spark.read.parquet(p).collect())) for p in (fact, hourly)]

    assert run("once", [rows]) == run("split", split)


def test_columns_added_later_are_kept(spark, tmp_path):
    first = spark.createDataFrame([("t1", "R1_0", 60, "S1", _at(2, 8)), ("t2", "R1_0", 70, "S1", _at(2, 9))], SILVER)
    second = spark.createDataFrame([("t1", "R1_0", 90, "S1", _at(2, 8), "full"), ("t3", "R1_0", 5, "S1", _at(3, 8), "empty")],
                                   SILVER + ", load string")
    fact, current = f"{tmp_path}/fact", f"{tmp_path}/current"
    state = stream.current_state_refresher(f"{tmp_path}/history", current)
    for i, b in enumerate((first, second)):
        tables.refresh_fact(b, fact)
        state(b, i)
    for path in (fact, current):
        got = spark.read.option("mergeSchema", "true").parquet(path).select("trip_id", "delay_seconds", "load").collect()
        assert sorted(map(tuple, got)) == [("t1", 90, "full"), ("t2", 70, None), ("t3", 5, "empty")]
    state(first, 2)  # a batch without the column leaves it in place
    assert "load" in tables.read_or_empty(spark, current, schemas.SILVER_TRIP_UPDATES).columns
    tables.compact_partitions(spark, fact, "record_date", ["2024-01-02", "2024-01-03"])
    assert "load" in spark.read.option("mergeSchema", "true").parquet(fact).columns


def test_compaction_of_run_folders_adds_no_files_and_sorts(spark, tmp_path):
    path = f"{tmp_path}/silver"
    for run in range(4):
        rows = spark.range(200).selectExpr("concat('t', id % 50) AS trip_id", "date'2024-01-02' AS d",
                                           f"'r{run}' AS run_id", "id AS x").repartition(3)
        tables.append(rows, path, ["d", "run_id"])
    before = sorted(map(repr, spark.read.parquet(path).collect()))
    out = tables.compact_partitions(spark, path, "d", ["2024-01-02"], target_file_bytes=512, sort_by=["trip_id"])
    assert out["files_after"] <= out["files_before"] == 12
    assert sorted(map(repr, spark.read.parquet(path).collect())) == before
    for f in glob.glob(f"{path}/d=2024-01-02/*/*.parquet"):
        trips = [r.trip_id for r in spark.read.parquet(f).collect()]
        assert trips == sorted(trips)


def test_summary_reads_the_updates_once(spark):
    t = catalog.Tables(spark, SF_SMALL)
    plan = reports.delays_summary(t.silver_trip_updates, t.silver_vehicle_positions, catalog.AS_OF, True) \
        ._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2  # updates and positions
