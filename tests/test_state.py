"""Stored state: hour parts, swapped partitions, buckets of the current state, sketches of streamed windows."""

import datetime as dt
import random
import tempfile

import pytest
from compare import SF_SMALL
from pyspark.sql import functions as F

from ridepulse import schemas
from ridepulse.__main__ import main
from ridepulse.plans import catalog, gold, jobs, live, reports
from ridepulse.sources import tables
from ridepulse.streaming import stream

D = dt.datetime


def silver(spark, rows):
    return spark.createDataFrame(rows, schemas.SILVER_TRIP_UPDATES)


def hourly(df):
    return sorted(map(tuple, df.select(*gold.HOURLY_COLUMNS).collect()))


def updates(seed, n, trips=12):
    rng = random.Random(seed)
    return [(f"t{rng.randrange(trips)}", f"R{rng.randrange(2)}_0", rng.randrange(-90, 1500), f"S{rng.randrange(9)}",
             D(2024, 1, rng.randrange(2, 4), rng.randrange(6, 9), rng.randrange(60), rng.randrange(3))) for _ in range(n)]


def fact_of(spark, rows):
    return tables.dedup_observations(gold.fact_historical_delays(silver(spark, rows)))


@pytest.mark.parametrize("seed", [1, 2])
def test_hours_from_merged_parts_equal_a_full_build(spark, seed):
    rows = updates(seed, 160) + [(None, "R1_0", 30, "S1", D(2024, 1, 2, 7, 0)), ("t1", None, 30, "S1", D(2024, 1, 2, 7, 9))]
    cuts = sorted(random.Random(seed).sample(range(len(rows)), 2))
    base = tempfile.mkdtemp(prefix="rp-parts-")
    fact, parts, gold_path = (f"{base}/{n}" for n in ("fact", "parts", "hourly"))
    rebuilt = []
    for batch in (rows[:cuts[0]], rows[cuts[0]:cuts[1]], rows[cuts[1]:], rows[:40]):  # the last one is a replay
        rebuilt.append(tables.refresh_hours(silver(spark, batch), fact, parts, gold_path)["rebuilt"])
    assert rebuilt[0] == [] and rebuilt[-1] == []
    expect = fact_of(spark, rows)
    assert hourly(spark.read.parquet(gold_path)) == hourly(gold.gold_route_performance_hourly(expect))
    merged = gold.merge_parts(gold.hour_parts(expect)).select(*gold.PART_COLUMNS)
    assert sorted(map(repr, spark.read.parquet(parts).select(*gold.PART_COLUMNS).collect())) == \
        sorted(map(repr, merged.collect()))


def test_new_rows_reach_the_hours_without_reading_the_fact(spark, monkeypatch):
    base = tempfile.mkdtemp(prefix="rp-nofact-")
    fact, parts, gold_path = (f"{base}/{n}" for n in ("fact", "parts", "hourly"))
    first, second = [r for r in updates(5, 60, 6)], [(f"n{k}", *r[1:]) for k, r in enumerate(updates(6, 40))]
    tables.refresh_hours(silver(spark, first), fact, parts, gold_path)
    read, plans = tables.read_partitions, []

    def spy(session, path, *args, **kw):
        if path == fact:
            plans.append(path)
        return read(session, path, *args, **kw)

    monkeypatch.setattr(tables, "read_partitions", spy)
    out = tables.refresh_hours(silver(spark, second), fact, parts, gold_path)
    assert out["rebuilt"] == [] and plans == [fact]  # once, for the keys of the batch's time range
    assert hourly(spark.read.parquet(gold_path)) == hourly(gold.gold_route_performance_hourly(
        fact_of(spark, first + second)))


@pytest.mark.parametrize("broken", ["append", "overwrite_partitions"])
def test_a_run_cut_short_is_made_good_by_the_next(spark, monkeypatch, broken):
    base = tempfile.mkdtemp(prefix="rp-cut-")
    fact, parts, gold_path = (f"{base}/{n}" for n in ("fact", "parts", "hourly"))
    rows = updates(7, 120)
    tables.refresh_hours(silver(spark, rows[:40]), fact, parts, gold_path)
    whole = getattr(tables, broken)

    def lost(*args, **kw):
        if broken == "append":  # the rows are in the fact, but nothing that follows happens
            whole(*args, **kw)
        raise RuntimeError("driver lost")

    monkeypatch.setattr(tables, broken, lost)
    with pytest.raises(RuntimeError):
        tables.refresh_hours(silver(spark, rows[40:80]), fact, parts, gold_path)
    monkeypatch.setattr(tables, broken, whole)
    tables.refresh_hours(silver(spark, rows[40:80]), fact, parts, gold_path)  # the batch is delivered again
    out = tables.refresh_hours(silver(spark, rows[80:]), fact, parts, gold_path)
    assert hourly(spark.read.parquet(gold_path)) == hourly(gold.gold_route_performance_hourly(fact_of(spark, rows)))
    assert not tables._children(spark, base, "parts__pending-") and out["touched"]


def test_parts_are_built_for_an_older_fact(spark):
    base = tempfile.mkdtemp(prefix="rp-old-")
    fact, parts, gold_path = (f"{base}/{n}" for n in ("fact", "parts", "hourly"))
    rows = updates(8, 90)
    touched = tables.refresh_fact(silver(spark, rows[:60]), fact)
    tables.refresh_hourly(fact, gold_path, touched, spark)
    tables.refresh_hours(silver(spark, rows[60:]), fact, parts, gold_path)
    assert hourly(spark.read.parquet(gold_path)) == hourly(gold.gold_route_performance_hourly(fact_of(spark, rows)))


def test_a_swap_cut_between_its_renames_loses_no_partition(spark, monkeypatch):
    base = tempfile.mkdtemp(prefix="rp-swap-")
    path = f"{base}/t"
    df = spark.createDataFrame([(d, v) for d in ("a", "b", "c") for v in range(4)], "d string, v int")
    tables.overwrite(df, path, ["d"])
    move, calls = tables._move, []

    def cut(session, source, target):
        calls.append(target)
        if len(calls) == 4:  # a is done, b has been moved aside
            raise RuntimeError("driver lost")
        move(session, source, target)

    monkeypatch.setattr(tables, "_move", cut)
    with pytest.raises(RuntimeError):
        tables.overwrite_partitions(df.where("v < 2"), path, ["d"])
    monkeypatch.setattr(tables, "_move", move)
    assert tables.partition_values(spark, path, "d") == ["a", "c"]
    got = tables.read_partitions(spark, path, "d", ["a", "b", "c"])
    assert sorted((r.d, r.v) for r in got.collect()) == [("a", 0), ("a", 1)] + [(d, v) for d in "bc" for v in range(4)]
    tables.overwrite_partitions(df.where("v < 2 and d <> 'c'"), path, ["d"], emptied=["d=c"])
    assert sorted((r.d, r.v) for r in spark.read.parquet(path).collect()) == [(d, v) for d in "ab" for v in range(2)]
    assert tables._children(spark, base) == [n for n in tables._children(spark, base) if n == "t" or "__partnew-" in n]


# --- current state


def test_one_trip_rewrites_one_bucket(spark):
    path = tempfile.mkdtemp(prefix="rp-current-") + "/current"
    rows = updates(9, 200, trips=60)
    assert len(tables.refresh_current(silver(spark, rows), path, buckets=16)) > 8
    before = {leaf: tables.folder_bytes(spark, f"{path}/{leaf}") for leaf in tables._leaves(spark, path)}
    names = {leaf: tables._children(spark, f"{path}/{leaf}", "part-") for leaf in before}
    late = ("t7", "R9_9", 77, "S1", D(2024, 1, 5))
    assert len(tables.refresh_current(silver(spark, [late]), path)) == 1
    changed = [leaf for leaf in before if tables._children(spark, f"{path}/{leaf}", "part-") != names[leaf]]
    assert len(changed) == 1 and set(tables._leaves(spark, path)) == set(before)
    current = {r.trip_id: r for r in tables.read_current(spark, path, schemas.SILVER_TRIP_UPDATES).collect()}
    latest = {}
    for r in rows:
        latest[r[0]] = max(latest.get(r[0], r), r, key=lambda x: (x[4], x[2], x[3]))
    assert current.keys() == latest.keys()
    assert all((c.delay_seconds, c.loaded_at) == (latest[t][2], latest[t][4]) for t, c in current.items() if t != "t7")
    assert (current["t7"].delay_seconds, current["t7"].loaded_at) == (77, D(2024, 1, 5))
    assert current["t7"].route_id != "R9_9"  # the stored route stays
    assert tables.refresh_current(silver(spark, []), path) == []
    tables.refresh_current(silver(spark, rows[:50]), path)  # late rows move nothing back
    assert {r.trip_id: r.loaded_at for r in tables.read_current(spark, path, schemas.SILVER_TRIP_UPDATES).collect()} \
        == {t: c.loaded_at for t, c in current.items()}


def test_ended_trips_leave_the_current_state(spark):
    path = tempfile.mkdtemp(prefix="rp-expire-") + "/current"
    rows = [(f"t{k}", "R1_0", k, "S1", D(2024, 1, 1 + k % 3, 12)) for k in range(30)] + [("x", "R1_0", 1, "S1", None)]
    tables.refresh_current(silver(spark, rows), path, buckets=4)
    assert tables.expire_current(spark, path, "2024-01-03 12:00:00", 24) == 10
    left = tables.read_current(spark, path, schemas.SILVER_TRIP_UPDATES).collect()
    assert len(left) == 21 and {r.loaded_at for r in left} == {None, D(2024, 1, 2, 12), D(2024, 1, 3, 12)}
    tables.refresh_current(silver(spark, [("t1", "R1_0", 5, "S1", D(2024, 1, 9))]), path, expire_hours=24)
    others = tables.read_current(spark, path, schemas.SILVER_TRIP_UPDATES).count() - 2
    assert 0 < others < 19  # the bucket of t1 has lost its ended trips, the other buckets not yet
    assert tables.expire_current(spark, path, "2024-01-09 00:00:00", 24) == others
    assert {r.trip_id for r in tables.read_current(spark, path, schemas.SILVER_TRIP_UPDATES).collect()} == {"t1", "x"}


# --- sketches, command line


def test_streamed_trip_counts_are_within_three_percent(spark):
    base = tempfile.mkdtemp(prefix="rp-sketch-")
    n = 40_000
    rows = spark.range(n).select(
        F.concat(F.lit("t"), (F.col("id") % 25_000).cast("string")).alias("trip_id"), F.lit("R1_0").alias("route_id"),
        F.lit(60).alias("delay_seconds"), F.lit("S1").alias("stop_id"),
        F.expr("timestampadd(SECOND, CAST(id % 7200 AS INT), TIMESTAMP_NTZ'2024-01-02 07:00:00')").alias("loaded_at"))
    end = rows.limit(1).withColumn("loaded_at", F.lit("2024-01-03 00:00:00").cast("timestamp_ntz"))
    rows.unionByName(end).write.parquet(f"{base}/silver")
    fact = gold.fact_historical_delays(spark.readStream.schema(schemas.SILVER_TRIP_UPDATES).parquet(f"{base}/silver"))
    w = stream.stream_hourly(fact).writeStream.format("parquet").option("path", f"{base}/out").outputMode("append")
    stream.run_available_now(w, f"{base}/ckpt")
    windows = spark.read.parquet(f"{base}/out")
    exact = {r.h: r.n for r in rows.groupBy(F.hour("loaded_at").alias("h"))
             .agg(F.count_distinct("trip_id").alias("n")).collect()}
    got = {r.record_hour: r.unique_trips for r in windows.collect()}
    assert got.keys() == exact.keys() and all(abs(got[h] - exact[h]) <= 0.03 * exact[h] for h in exact)
    period = stream.period_trips(windows).collect()
    assert len(period) == 1 and abs(period[0].unique_trips - 25_000) <= 0.03 * 25_000  # not the sum of the two hours
    assert period[0].total_observations == n and sum(got.values()) > 1.2 * 25_000


def test_reports_at_two_times_see_the_vehicles_of_their_time(spark):
    t = catalog.Tables(spark, SF_SMALL)
    base = tempfile.mkdtemp(prefix="rp-times-")
    stream.land_feed(t.feed, f"{base}/landing", 4)
    main(["refresh", "--landing", f"{base}/landing", "--root", f"{base}/wh"])
    for k, as_of in enumerate(("2024-01-04 00:00:00", "2024-01-20 00:00:00")):
        seen = reports.latest_vehicles(reports.recent(t.silver_vehicle_positions, as_of, None, "gps_timestamp"))
        delays = reports.delays(t.silver_trip_updates, t.silver_vehicle_positions, as_of, limit=None)
        for name, expect in (("vehicles", seen), ("ghost_trips", live.ghost_trips(delays, seen)),
                             ("route_menu", live.route_menu(seen))):
            main(["report", name, "--root", f"{base}/wh", "--as-of", as_of, "--out", f"{base}/{name}{k}"])
            got = spark.read.parquet(f"{base}/{name}{k}").select(*expect.columns)
            assert sorted(map(repr, got.collect())) == sorted(map(repr, expect.collect())), (name, as_of)
    assert spark.read.parquet(f"{base}/vehicles0").agg(F.max("gps_timestamp")).first()[0] <= D(2024, 1, 4)
    main(["report", "current", "--root", f"{base}/wh", "--as-of", as_of, "--out", f"{base}/current"])
    assert spark.read.parquet(f"{base}/current").count() == t.silver_trip_updates.select("trip_id").distinct().count()
    w = jobs.Warehouse(f"{base}/wh")
    assert spark.read.parquet(w.routes).count() == spark.read.parquet(w.routes).distinct().count() > 0
