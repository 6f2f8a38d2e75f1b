"""Structured Streaming on hand-landed snapshots: late data (watermark drop vs exact refresh), replay safety."""

import datetime as dt
import tempfile

from ridepulse import schemas
from ridepulse.operators import ingest, silver
from ridepulse.streaming import stream

D = dt.datetime


def snapshot(eid, ts, trip="t1", route="R1_0", delay=60):
    entity = (str(eid), None, ((trip, route), [((delay,), None, "S1")]))
    return (eid, ts, [entity])


def land(spark, rows, landing):
    spark.createDataFrame(rows, schemas.FEED).coalesce(1).write.mode("append").parquet(landing)


def hourly_stream_run(spark, landing, out, ckpt):
    fact = stream.silver_fact_stream(stream.read_feed_stream(spark, landing))
    w = stream.stream_hourly(fact, "2 hours").writeStream.format("parquet").option("path", out).outputMode("append")
    stream.run_available_now(w, ckpt)


def test_late_row_dropped_by_window_kept_by_refresh(spark):
    base = tempfile.mkdtemp(prefix="rp-stream-")
    landing = f"{base}/landing"
    land(spark, [snapshot(1, D(2024, 1, 2, 8, 10)), snapshot(2, D(2024, 1, 2, 9, 10)),
                 snapshot(3, D(2024, 1, 2, 12, 5))], landing)
    hourly_stream_run(spark, landing, f"{base}/windows", f"{base}/ckpt-w")
    first = {(r.record_hour, r.total_observations) for r in spark.read.parquet(f"{base}/windows").collect()}
    assert first == {(8, 1), (9, 1)}        # watermark 10:05 closes 08:00 and 09:00; 12:00 stays open

    land(spark, [snapshot(4, D(2024, 1, 2, 8, 30), trip="t2"),          # older than the watermark: late
                 snapshot(5, D(2024, 1, 2, 16, 0), trip="t3")], landing)
    hourly_stream_run(spark, landing, f"{base}/windows", f"{base}/ckpt-w")
    rows = {(r.record_hour, r.total_observations) for r in spark.read.parquet(f"{base}/windows").collect()}
    assert rows == {(8, 1), (9, 1), (12, 1)}                            # late row dropped, 08:00 not re-emitted

    updates = silver.silver_trip_updates(ingest.flatten_trip_feed(stream.read_feed_stream(spark, landing, 1)))
    refresher = stream.hourly_refresher(f"{base}/fact", f"{base}/hourly")
    stream.run_foreach_batch(updates, refresher, f"{base}/ckpt-r")
    exact = {(r.record_hour, r.total_observations, r.unique_trips) for r in spark.read.parquet(f"{base}/hourly").collect()}
    assert exact == {(8, 2, 2), (9, 1, 1), (12, 1, 1), (16, 1, 1)}      # the refresh tier keeps it


def test_refresher_is_idempotent_on_replay(spark):
    base = tempfile.mkdtemp(prefix="rp-replay-")
    batch = silver.silver_trip_updates(ingest.flatten_trip_feed(
        spark.createDataFrame([snapshot(1, D(2024, 1, 3, 7, 0)), snapshot(2, D(2024, 1, 3, 7, 30), trip="t2")],
                              schemas.FEED)))
    refresh = stream.hourly_refresher(f"{base}/fact", f"{base}/hourly")
    refresh(batch, 0)
    refresh(batch, 0)                                                   # the same micro-batch replayed
    h = spark.read.parquet(f"{base}/hourly").collect()
    assert [(r.total_observations, r.unique_trips) for r in h] == [(2, 2)]
    assert spark.read.parquet(f"{base}/fact").count() == 2

    current = stream.current_state_refresher(f"{base}/history", f"{base}/current")
    current(batch, 7)
    current(batch, 7)
    assert spark.read.parquet(f"{base}/history").count() == 2
    assert spark.read.parquet(f"{base}/current").count() == 2
