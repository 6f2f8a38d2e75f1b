"""Marks kept between runs: snapshots taken once by scheduled refreshes, late rows of a stream kept beside those in time."""

import datetime as dt
import tempfile

from ridepulse import schemas
from ridepulse.__main__ import main
from ridepulse.operators import ingest, silver
from ridepulse.plans import gold, jobs
from ridepulse.sources import tables
from ridepulse.streaming import stream

D = dt.datetime


def snapshot(eid, ts, trip="t1", route="R1_0", delay=60):
    vehicle = ((f"v{eid}",), (trip, route), (53.0, -6.0), 1704182400)
    return (eid, ts, [(str(eid), vehicle, ((trip, route), [((delay,), None, "S1")]))])


def feed(spark, rows):
    return spark.createDataFrame(rows, schemas.FEED)


def fact_of(spark, rows):
    return gold.fact_historical_delays(silver.silver_trip_updates(ingest.flatten_trip_feed(feed(spark, rows))))


def stored(spark, root):
    w = jobs.Warehouse(root)
    return {name: spark.read.parquet(getattr(w, name)).count()
            for name in ("bronze_trips", "bronze_vehicles", "silver_trips", "silver_vehicles", "fact")}


def test_refresh_takes_each_snapshot_once(spark):
    base = tempfile.mkdtemp(prefix="rp-mark-")
    landing, root = f"{base}/landing", f"{base}/wh"
    first = [snapshot(1, D(2024, 1, 2, 8, 0)), snapshot(2, D(2024, 1, 2, 9, 30), "t2"), snapshot(3, D(2024, 1, 2, 10, 0), "t3")]
    feed(spark, first).write.parquet(landing)
    main(["refresh", "--landing", landing, "--root", root])
    once = stored(spark, root)
    assert set(once.values()) == {3}
    main(["refresh", "--landing", landing, "--root", root])
    assert stored(spark, root) == once
    # One at the mark, one late inside the bound, one new, one too late.
    more = [snapshot(4, D(2024, 1, 2, 10, 0), "t4"), snapshot(5, D(2024, 1, 2, 9, 0), "t5"),
            snapshot(6, D(2024, 1, 2, 12, 0), "t6"), snapshot(7, D(2024, 1, 2, 8, 59), "t7")]
    feed(spark, more).write.mode("append").parquet(landing)
    for _ in range(2):
        main(["refresh", "--landing", landing, "--root", root])
        assert set(stored(spark, root).values()) == {6}
    assert {r.trip_id for r in spark.read.parquet(jobs.Warehouse(root).fact).collect()} == {"t1", "t2", "t3", "t4", "t5", "t6"}
    marks = spark.read.parquet(jobs.Warehouse(root).marks).collect()
    # Only the bound before the mark is remembered.
    assert {(r.mark, r.obs_ts) for r in marks} == {(D(2024, 1, 2, 12, 0), D(2024, 1, 2, 12, 0))}


def test_mark_reaches_the_scan(spark, monkeypatch):
    base = tempfile.mkdtemp(prefix="rp-mark-")
    landing, root = f"{base}/landing", f"{base}/wh"
    feed(spark, [snapshot(1, D(2024, 1, 2, 8, 0))]).write.parquet(landing)
    landed = spark.read.schema(schemas.FEED).parquet(landing)
    jobs.refresh_since_mark(landed, root)
    plans = []
    stable = tables.stable
    monkeypatch.setattr(tables, "stable", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString())
                        or stable(df))
    assert jobs.refresh_since_mark(landed, root)["snapshots"] == 0
    assert "GreaterThanOrEqual(obs_ts,2024-01-02T07:00" in plans[0]


def test_steps_after_a_landing_read_what_landed(spark, monkeypatch):
    """Fact, gold and current state are made from the silver rows just written, not from the feed once more."""
    root = tempfile.mkdtemp(prefix="rp-mark-")
    took = []
    for step in ("refresh_hours", "refresh_current"):
        monkeypatch.setattr(tables, step, lambda rows, *a, _run=getattr(tables, step), **k: took.append(rows) or _run(rows, *a, **k))
    first = [snapshot(1, D(2024, 1, 2, 8, 0)), snapshot(2, D(2024, 1, 3, 8, 0), "t2")]
    jobs.refresh_warehouse(feed(spark, first), root, run_id="r:1")
    # The same run again with fewer days: what it took before of other days is not its batch.
    jobs.refresh_warehouse(feed(spark, first[:1]), root, run_id="r:1")
    jobs.refresh_warehouse(feed(spark, []), root, run_id="r2")
    silver_trips = jobs.Warehouse(root).silver_trips
    for rows in took[:4]:
        assert rows.inputFiles() and all(silver_trips in f for f in rows.inputFiles())
    assert [{r.trip_id for r in rows.collect()} for rows in took[2:]] == [{"t1"}, {"t1"}, set(), set()]
    assert spark.read.parquet(silver_trips).count() == 2


def test_only_snapshots_up_to_the_mark_get_a_digest(spark, monkeypatch):
    root = tempfile.mkdtemp(prefix="rp-mark-")
    first = [snapshot(1, D(2024, 1, 2, 8, 0)), snapshot(2, D(2024, 1, 2, 9, 0), "t2")]
    more = [snapshot(3, D(2024, 1, 2, 9, 0), "t3"), snapshot(4, D(2024, 1, 2, 9, 30), "t4"), snapshot(5, None, "t5")]
    jobs.refresh_since_mark(feed(spark, first), root, run_id="r0")
    plans, stable = [], tables.stable
    monkeypatch.setattr(tables, "stable", lambda df: plans.append(df._jdf.queryExecution().optimizedPlan().toString())
                        or stable(df))
    # Whole rows twice after the mark stay twice; those up to it are told by their digests.
    assert jobs.refresh_since_mark(feed(spark, first + more + more[1:2]), root, run_id="r1")["snapshots"] == 3
    assert plans[0].lstrip().startswith("Union") and plans[0].count("sha2(") == 1
    trips = spark.read.parquet(jobs.Warehouse(root).silver_trips)
    assert sorted(r.trip_id for r in trips.collect()) == ["t1", "t2", "t3", "t4", "t4"]


def test_empty_landing_and_lost_mark(spark):
    base = tempfile.mkdtemp(prefix="rp-mark-")
    root = f"{base}/wh"
    assert jobs.refresh_since_mark(feed(spark, []), root)["snapshots"] == 0
    rows = feed(spark, [snapshot(1, D(2024, 1, 2, 8, 0))])
    # A run that stops before its mark is written is repeated under its name.
    jobs.refresh_warehouse(rows, root, run_id="r0")
    assert jobs.refresh_since_mark(rows, root, run_id="r0")["snapshots"] == 1
    assert set(stored(spark, root).values()) == {1}


def test_late_rows_are_kept_with_their_age(spark):
    out = tempfile.mkdtemp(prefix="rp-late-")
    split = stream.late_splitter(out, "2 hours")
    batches = [[snapshot(1, D(2024, 1, 2, 8, 0)), snapshot(2, D(2024, 1, 2, 12, 0))],
               [snapshot(3, D(2024, 1, 2, 9, 59, 50), "t3"), snapshot(4, D(2024, 1, 2, 10, 0), "t4"), snapshot(5, D(2024, 1, 2, 11, 0))],
               [],
               [snapshot(6, D(2024, 1, 2, 9, 0), "t6"), snapshot(7, D(2024, 1, 2, 9, 0), "t7"), snapshot(8, D(2024, 1, 2, 20, 0))],
               [snapshot(9, D(2024, 1, 2, 17, 0), "t9")]]
    for batch_id, rows in enumerate(batches):
        split(fact_of(spark, rows), batch_id)
    want = {("t3", 1, 10), ("t6", 3, 3600), ("t7", 3, 3600), ("t9", 4, 3600)}

    def late():
        return {(r.trip_id, r.batch_id, r.age_seconds) for r in stream.split_rows(spark, out).where("late").collect()}

    assert late() == want
    whole = fact_of(spark, [r for rows in batches for r in rows])
    kept = stream.split_rows(spark, out).select(*whole.columns)
    assert kept.count() == whole.count() and kept.exceptAll(whole).count() == 0
    counts = {r.batch_id: (r.on_time_rows, r.late_rows, r.max_age_seconds, r.avg_age_seconds)
              for r in stream.split_counts(stream.split_rows(spark, out)).collect()}
    assert counts == {0: (2, 0, None, None), 1: (2, 1, 10, 10), 3: (1, 2, 3600, 3600), 4: (0, 1, 3600, 3600)}
    # A replayed batch meets the mark of the one before it; only the last marks are kept.
    split(fact_of(spark, batches[4]), 4)
    assert late() == want
    assert len(tables.partition_values(spark, f"{out}/marks", "batch_id")) == 2
