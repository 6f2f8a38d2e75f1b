"""Hand-written edge tables: empty inputs, one-row groups, late rows, ties, NaN in reports."""

import datetime as dt
import tempfile

from ridepulse import schemas
from ridepulse.plans import gold, live, reports
from ridepulse.sources import tables

D = dt.datetime
AS_OF = "2024-01-10 00:00:00"


def _updates(spark, rows):
    return spark.createDataFrame(rows, schemas.SILVER_TRIP_UPDATES)


def _positions(spark, rows):
    return spark.createDataFrame(rows, schemas.SILVER_VEHICLE_POSITIONS)


def test_empty_inputs_give_empty_reports(spark):
    u, p = _updates(spark, []), _positions(spark, [])
    hourly = gold.gold_route_performance_hourly(gold.fact_historical_delays(u))
    assert hourly.count() == 0
    assert gold.gold_worst_routes_by_period(hourly).count() == 0
    assert gold.gold_network_summary(hourly).count() == 0
    assert gold.dim_routes(u).count() == 0 and gold.gold_route_performance(u).count() == 0
    d = reports.delays(u, p, AS_OF)
    assert d.count() == 0
    assert reports.delays_summary(u, p, AS_OF).count() == 0
    assert reports.delays_summary(u, p, AS_OF, keep_empty=True).count() == 6
    assert reports.total_trips(reports.delays_summary(u, p, AS_OF)).first().total_trips == 0
    assert [r.n for r in live.trend_counts(d).collect()] == [0, 0, 0, 0]
    assert live.ghost_count(d, reports.latest_vehicles(p)).first().ghost_count == 0


def test_one_row_group_has_zero_stddev_and_exact_median(spark):
    u = _updates(spark, [("t1", "R1_0", 61, "S1", D(2024, 1, 2, 8, 0)),
                         ("t2", "R2_0", 61, "S1", D(2024, 1, 2, 8, 0)), ("t3", "R2_0", 62, "S1", D(2024, 1, 2, 8, 5))])
    h = {r.route_code: r for r in gold.gold_route_performance_hourly(gold.fact_historical_delays(u)).collect()}
    assert h["R1"].stddev_delay_minutes == 0.0 and h["R1"].median_delay_minutes == 1.02
    # 61 s = 1.02 min, 62 s = 1.03 min: the median 1.025 rounds half away from zero
    assert h["R2"].median_delay_minutes == 1.03 and h["R2"].avg_delay_minutes == 1.03
    assert h["R2"].stddev_delay_minutes == 0.01


def test_negative_median_rounds_away_from_zero(spark):
    u = _updates(spark, [("t1", "R1_0", -61, "S1", D(2024, 1, 2, 8, 0)), ("t2", "R1_0", -62, "S1", D(2024, 1, 2, 8, 1))])
    h = gold.gold_route_performance_hourly(gold.fact_historical_delays(u)).first()
    assert h.median_delay_minutes == -1.03 and h.min_delay_minutes == -1.03 and h.max_delay_minutes == -1.02


def test_late_row_older_than_mark_is_added_and_counted(spark):
    base = tempfile.mkdtemp(prefix="rp-late-")
    fact_path, hourly_path = f"{base}/fact", f"{base}/hourly"
    first = _updates(spark, [("t1", "R1_0", 30, "S1", D(2024, 1, 2, 9, 0))])
    late = _updates(spark, [("t2", "R1_0", 400, "S1", D(2024, 1, 2, 7, 15)), ("t1", "R1_0", 30, "S1", D(2024, 1, 2, 9, 0))])
    for b in (first, late):
        tables.refresh_hourly(fact_path, hourly_path, tables.refresh_fact(b, fact_path), spark)
    h = {r.record_hour: r.total_observations for r in spark.read.parquet(hourly_path).collect()}
    assert h == {7: 1, 9: 1}
    assert spark.read.parquet(fact_path).count() == 2


def test_ties_on_rank_keys_are_broken_by_route_code(spark):
    rows = []
    for route in ("R2_0", "R1_0", "R3_0"):
        for hour in (8, 9):
            rows.append((f"t-{route}", route, 300, "S1", D(2024, 1, 2, hour, 0)))
    hourly = gold.gold_route_performance_hourly(gold.fact_historical_delays(_updates(spark, rows)))
    w = {r.route_code: (r.worst_rank, r.best_rank) for r in gold.gold_worst_routes_by_period(hourly).collect()}
    assert w == {"R1": (1, 1), "R2": (2, 2), "R3": (3, 3)}


def test_null_trip_and_route_in_live_matching(spark):
    d = spark.createDataFrame([("a", "a", 1.0, "on_time", "new", None, None, None, None, None, D(2024, 1, 1))],
                              "route_id string, trip_id string, avg_delay_minutes double, delay_category string, "
                              "trend string, trend_change_minutes double, prev_delay_minutes double, last_lat double, "
                              "last_lon double, last_seen timestamp_ntz, loaded_at timestamp_ntz")
    v = spark.createDataFrame([("v1", None, 1.0, 2.0, "a", D(2024, 1, 1)), ("v2", None, 1.0, 2.0, None, None)],
                              "vehicle_id string, trip_id string, latitude double, longitude double, route_id string, "
                              "gps_timestamp timestamp_ntz")
    assert live.live_trips(d, v).count() == 1 and live.ghost_trips(d, v).count() == 0
    b = live.selection_bounds(d, v).first()
    assert (b.n_matches, b.mode, b.center_lat) == (1, "center", 1.0)
    info = {r.vehicle_id: r.matched_by for r in live.vehicle_delay_info(v, d).collect()}
    assert info == {"v1": "route", "v2": "default"}


def test_vehicle_lookup_prefers_trip_then_route_then_worst_of_the_clean_route(spark):
    d = spark.createDataFrame(
        [("t1", 1.0, "on_time", D(2024, 1, 1)), ("R1_0", 2.0, "minor", D(2024, 1, 1)), ("R1_9", -9.0, "early", D(2024, 1, 1)),
         ("R2_a", 3.0, "minor", D(2024, 1, 1)), ("R2_b", -3.0, "early", D(2024, 1, 2)), ("R2_c", -3.0, "early", D(2024, 1, 2)),
         ("R3_a", None, "unknown", D(2024, 1, 1)), (None, 7.0, "moderate", D(2024, 1, 1))],
        "route_id string, avg_delay_minutes double, delay_category string, loaded_at timestamp_ntz") \
        .selectExpr("*", "route_id AS trend", "CAST(NULL AS DOUBLE) AS trend_change_minutes")
    asked = [("v1", "t1", "R1_0"), ("v2", "t9", "R1_0"), ("v3", None, "R1_5"), ("v4", "t9", "R2_x"), ("v5", "R2_a", None),
             ("v6", "t9", "R3_b"), ("v7", None, None), ("v8", "t9", "R8_0"), (None, "t1", None)]
    v = spark.createDataFrame(asked, "vehicle_id string, trip_id string, route_id string").selectExpr(
        "*", "1.0D AS latitude", "2.0D AS longitude", "TIMESTAMP_NTZ'2024-01-01 00:00:00' AS gps_timestamp")
    got = {r.vehicle_id: (r.matched_by, r.trend, r.delay_minutes) for r in live.vehicle_delay_info(v, d).collect()}
    assert got == {"v1": ("trip", "t1", 1.0), "v2": ("route", "R1_0", 2.0), "v3": ("clean_route", "R1_9", -9.0),
                   "v4": ("clean_route", "R2_b", -3.0), "v5": ("trip", "R2_a", 3.0),
                   "v6": ("clean_route", "R3_a", 0.0), "v7": ("clean_route", "stable", 7.0),
                   "v8": ("default", "stable", 0.0), None: ("trip", "t1", 1.0)}
    # A selection that no vehicle of the band has falls back to all of the band.
    assert {r.vehicle_id for r in live.live_dots(v, d, category="Minor", selected="t1").collect()} == {"v2", "v5"}
    assert {r.vehicle_id for r in live.live_dots(v, d, category="on_time", selected="t1").collect()} == {"v1", None}


def test_history_window_on_frames_without_date_column(spark):
    u = _updates(spark, [("t1", "R1_0", 30, "S1", D(2024, 1, 8, 23, 0)), ("t1", "R1_0", 500, "S1", D(2024, 1, 9, 23, 0)),
                         ("t2", "R1_0", 10, "S1", D(2024, 1, 7, 0, 0))])
    full = {r.trip_id: r.delay_seconds for r in reports.delay_trend(u, AS_OF).collect()}
    recent = {r.trip_id: (r.delay_seconds, r.trend) for r in reports.delay_trend(u, AS_OF, history_hours=30).collect()}
    assert full == {"t1": 500, "t2": 10}
    # t2 has no row in the last 30 hours; t1's latest row is also its latest row before the cut-off
    assert recent == {"t1": (500, "stable")}
