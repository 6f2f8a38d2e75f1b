"""The derived tables reproduce the counts documented in FIXTURES.md §3 (sf0.001)."""

from pyspark.sql import functions as F

from compare import SF_SMALL
from ridepulse.plans import catalog, live


def test_documented_counts(spark):
    t = catalog.Tables(spark, SF_SMALL)
    assert t.silver_vehicle_positions.count() == 574
    assert t.silver_trip_updates.count() == 923
    assert t.silver_trip_updates.select("trip_id").distinct().count() == 75
    assert t.silver_vehicle_positions.select("vehicle_id").distinct().count() == 15
    ghosts = t.silver_trip_updates.join(t.silver_vehicle_positions.select("trip_id").distinct(), "trip_id",
                                        "left_anti").select("trip_id").distinct().count()
    assert ghosts == 30
    assert t.silver_trip_updates.groupBy("trip_id", "loaded_at").count().where("count > 1").count() == 0
    bands = {r.delay_category: r["count"] for r in t.fact.groupBy("delay_category").count().collect()}
    assert bands == {"early": 332, "on_time": 272, "minor": 159, "moderate": 93, "severe": 42, "critical": 25}
    trends = {r.trend: r.n for r in live.trend_counts(t.all_delays).collect()}
    assert trends == {"improving": 25, "stable": 19, "worsening": 17, "new": 14}


def test_delays_report_is_capped_and_ordered(spark):
    from ridepulse.plans import reports
    t = catalog.Tables(spark, SF_SMALL)
    d = reports.delays(t.silver_trip_updates, t.silver_vehicle_positions, catalog.AS_OF, limit=10)
    rows = d.collect()
    assert len(rows) == 10
    keys = [(r.loaded_at, r.trip_id) for r in rows]
    assert keys == sorted(keys, key=lambda k: (-k[0].timestamp(), k[1]))
    unknown = reports.delays(t.silver_trip_updates, t.silver_vehicle_positions, catalog.AS_OF, category="bogus")
    assert unknown.count() == 75
    import pytest
    with pytest.raises(ValueError):
        reports.delays(t.silver_trip_updates, t.silver_vehicle_positions, catalog.AS_OF, limit=10001)


def test_ghost_and_live_partition_the_delays(spark):
    t = catalog.Tables(spark, SF_SMALL)
    g = live.ghost_trips(t.all_delays, t.vehicles).select("trip_id")
    lv = live.live_trips(t.all_delays, t.vehicles).select("trip_id")
    assert g.count() + lv.count() == t.all_delays.count()
    assert g.intersect(lv).count() == 0


def test_summary_counts_sum_to_trips(spark):
    from ridepulse.plans import reports
    t = catalog.Tables(spark, SF_SMALL)
    s = reports.delays_summary(t.silver_trip_updates, t.silver_vehicle_positions, catalog.AS_OF)
    assert s.agg(F.sum("count")).first()[0] == 75
    ranks = t.worst.groupBy("day_of_week", "time_period").agg(
        F.count("*").alias("n"), F.max("worst_rank").alias("mw"), F.max("best_rank").alias("mb"),
        F.count_distinct("worst_rank").alias("dw")).collect()
    assert all(r.n == r.mw == r.mb == r.dw for r in ranks)   # ranks are a permutation per partition
