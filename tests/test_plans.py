"""Physical plan shape: partial aggregation before shuffles, no nested-loop joins, pushdown into the scan."""

import tempfile

from compare import SF_SMALL
from ridepulse.plans import catalog, live, reports
from ridepulse.operators import keyed


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_trend_is_a_hash_aggregate_over_one_shuffle_of_the_history(spark):
    t = catalog.Tables(spark, SF_SMALL)
    p = plan(reports.delay_trend(t.silver_trip_updates, catalog.AS_OF, with_route=False))
    assert p.count("Exchange hashpartitioning") == 1
    assert "partial_max" in p and "SortAggregate" not in p and "Sort [" not in p
    p = plan(reports.delay_trend(t.silver_trip_updates, catalog.AS_OF))
    # The second exchange carries one row per trip and route.
    assert p.count("Exchange hashpartitioning") == 2 and p.rfind("partial_max") > p.rfind("Exchange hashpartitioning")
    assert "SortAggregate" not in p and p.count("HashAggregate") == 2


def test_hourly_statistics_group_by_route_and_hour_after_their_parts(spark):
    t = catalog.Tables(spark, SF_SMALL)
    p = plan(t.hourly)
    assert p.count("Exchange hashpartitioning") == 2 and p.count("Scan parquet") == 1 and "SortAggregate" not in p
    # The history meets hash aggregates with fixed buffers only; the median's buffers see one row per distinct delay.
    lines = [line for line in p.splitlines() if "HashAggregate(" in line]
    kinds = ["ObjectHashAggregate" in line for line in lines]  # from the result down to the scan
    assert kinds == [True, True, False, False] and all("day_of_week" not in line.split("functions")[0] for line in lines)


def test_latest_per_key_limits_before_the_shuffle(spark):
    t = catalog.Tables(spark, SF_SMALL)
    p = plan(reports.latest_vehicles(t.silver_vehicle_positions))
    first_limit, exchange = p.rfind("WindowGroupLimit"), p.rfind("Exchange hashpartitioning")
    assert p.count("WindowGroupLimit") == 2 and first_limit > exchange   # the lower one runs map-side


def test_upsert_and_hourly_combine_map_side(spark):
    t = catalog.Tables(spark, SF_SMALL)
    up = plan(catalog.QUERIES["upsert_trip_updates"](spark, SF_SMALL))
    assert "partial_max_by" in up and "partial_min_by" in up
    h = plan(t.hourly)
    assert "partial_percentile" in h and "partial_count" in h


def test_no_nested_loop_or_cartesian_joins(spark):
    for name in ("ghost_trips", "live_trips", "selection_bounds", "vehicle_delay_info", "live_dots_selected",
                 "insert_if_absent", "delays_summary", "gps_delay_coverage", "silver_trip_updates_gps"):
        p = plan(catalog.QUERIES[name](spark, SF_SMALL))
        assert "NestedLoop" not in p and "Cartesian" not in p, name
        assert "PythonUDF" not in p and "EvalPython" not in p, name


def test_filters_and_columns_reach_the_parquet_scan(spark):
    t = catalog.Tables(spark, SF_SMALL)
    path = tempfile.mkdtemp(prefix="rp-silver-") + "/silver"
    t.silver_trip_updates.write.parquet(path)
    stored = spark.read.parquet(path)
    p = plan(reports.trip_history(stored, "7_view"))
    assert "PushedFilters: [IsNotNull(trip_id), EqualTo(trip_id,7_view)]" in p
    routes = plan(reports.routes(stored))
    assert "ReadSchema: struct<trip_id:string,route_id:string>" in routes


def test_bounded_dimensions_are_broadcast(spark):
    t = catalog.Tables(spark, SF_SMALL)
    assert "BroadcastHashJoin" in final_plan(live.trend_counts(t.all_delays))          # 4-row label table
    assert "BroadcastHashJoin" in final_plan(catalog.QUERIES["route_descriptions"](spark, SF_SMALL))


def test_merge_without_broadcast_threshold_still_plans_a_hash_join(spark):
    t = catalog.Tables(spark, SF_SMALL)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        p = plan(keyed.merge_by_key(t.fact, t.fact, ["delay_record_id"]))
        assert "SortMergeJoin" in p and "LeftAnti" in p and "Broadcast" not in p
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_history_window_prunes_date_partitions(spark):
    from pyspark.sql import functions as F
    t = catalog.Tables(spark, SF_SMALL)
    path = tempfile.mkdtemp(prefix="rp-silver-dated-") + "/silver"
    t.silver_trip_updates.withColumn("loaded_date", F.to_date("loaded_at")).write.partitionBy("loaded_date") \
        .parquet(path)
    stored = spark.read.parquet(path)
    d = reports.delay_trend(stored, "2024-01-10 00:00:00", history_hours=48)
    p = plan(d)
    assert "PartitionFilters: [isnotnull(loaded_date#" in p and "loaded_date#" in p.split("PartitionFilters")[1]
    expect = reports.delay_trend(t.silver_trip_updates.where(
        F.col("loaded_at") >= F.lit("2024-01-08 00:00:00").cast("timestamp_ntz")), "2024-01-10 00:00:00")
    assert sorted(map(tuple, d.collect())) == sorted(map(tuple, expect.collect()))


def test_trend_and_positions_join_reuses_their_partitioning(spark):
    t = catalog.Tables(spark, SF_SMALL)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        p = plan(reports.delays(t.silver_trip_updates, t.silver_vehicle_positions, catalog.AS_OF, limit=None))
        # one exchange per input (trend aggregate, latest-position window); the join adds none
        assert p.count("Exchange hashpartitioning") == 2 and "SortMergeJoin" in p
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_vehicle_lookup_is_one_pass(spark):
    t = catalog.Tables(spark, SF_SMALL)
    p = plan(live.vehicle_delay_info(t.live_vehicles, t.trends))
    assert p.count("Scan parquet") == 2 and p.count("Exchange hashpartitioning") == 4
    assert "Join" not in p and "SortAggregate" not in p
    # A selection looks at the vehicles once more, not at the delays.
    p = plan(catalog.QUERIES["live_dots_selected"](spark, SF_SMALL))
    assert p.count("Scan parquet") == 3 and p.count("Exchange hashpartitioning") == 5
