"""Column functions on hand-written edge tables (band and trend edges, every hour, route names, rounding)."""

from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from ridepulse.functions import columns as C


def _one(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr.alias("x")).collect()]


def test_delay_category_edges(spark):
    secs = [-1, 0, 120, 121, 300, 301, 600, 601, 1200, 1201, None]
    got = _one(spark, [(s,) for s in secs], "s int", C.delay_category("s"))
    assert got == ["early", "on_time", "on_time", "minor", "minor", "moderate", "moderate", "severe", "severe",
                   "critical", "critical"]


def test_trend_edges(spark):
    rows = [(100, 100 + 61), (100, 100 + 60), (100, 100), (100, 40), (100, 39), (100, None)]
    got = _one(spark, rows, "cur int, prev int", C.trend("cur", "prev"))
    assert got == ["improving", "stable", "stable", "stable", "worsening", "new"]
    change = _one(spark, rows, "cur int, prev int", C.trend_change_minutes("cur", "prev"))
    assert change == [-1.0, -1.0, 0.0, 1.0, 1.0, None]


def test_time_period_every_hour(spark):
    got = _one(spark, [(h,) for h in range(24)], "h int", C.time_period("h"))
    expect = []
    for h in range(24):
        if 7 <= h <= 9:
            expect.append("morning_rush")
        elif 12 <= h <= 14:
            expect.append("lunch")
        elif 16 <= h <= 19:
            expect.append("evening_rush")
        elif h >= 22 or h <= 5:
            expect.append("night")
        else:
            expect.append("off_peak")
    assert got == expect


def test_clean_route_name(spark):
    names = [None, "", "1 27A c a", "60-39a-b12", "27_1", "X25", "abc-", " x"]
    got = _one(spark, [(n,) for n in names], "r string", C.clean_route_name("r"))
    assert got == ["N/A", "N/A", "27A", "39A", "27", "X25", "", "X"]


def test_route_code(spark):
    got = _one(spark, [("R1_2",), ("R7",), ("",), (None,)], "r string", C.route_code("r"))
    assert got == ["R1", "R7", "", None]


def test_round_ratio_exact_half_away(spark):
    rows = [(n, d) for n in range(-50, 51) for d in (1, 2, 3, 4, 6, 7, 60)]
    got = _one(spark, rows, "n long, d long", C.round_ratio("n", "d"))
    for (n, d), g in zip(rows, got):
        assert g == int((Decimal(n) / Decimal(d)).quantize(Decimal(1), rounding=ROUND_HALF_UP)), (n, d)


def test_minutes_match_decimal_rounding(spark):
    secs = list(range(-400, 401))
    cents = _one(spark, [(s,) for s in secs], "s int", C.delay_cents("s"))
    mins = _one(spark, [(s,) for s in secs], "s int", C.to_minutes("s"))
    for s, c, m in zip(secs, cents, mins):
        exact = (Decimal(s) / Decimal(60)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
        assert c == int(exact * 100)
        assert m == float(exact)


def test_surrogate_key_keeps_null_positions(spark):
    rows = [("a", None), (None, "a"), ("a", "b")]
    got = _one(spark, rows, "x string, y string", C.surrogate_key("x", "y"))
    assert len(set(got)) == 3
    import hashlib
    assert got[2] == hashlib.md5(b"a-b").hexdigest()
    assert got[0] == hashlib.md5(b"a-_dbt_utils_surrogate_key_null_").hexdigest()


def test_epoch_round_trip_is_zone_free(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        df = spark.createDataFrame([(1704164645,)], "s long").select(C.from_epoch_seconds("s").alias("t"))
        row = df.select(F.col("t").cast("string"), C.epoch_seconds("t")).first()
        assert row[0] == "2024-01-02 03:04:05" and row[1] == 1704164645
        frac = spark.sql("select timestamp_ntz'2024-01-02 03:04:05.987' as t").select(C.truncate_to_second("t"))
        assert str(frac.first()[0]) == "2024-01-02 03:04:05"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_numeric_prefix(spark):
    got = _one(spark, [("27A",), ("  -3x",), ("X25",), ("",), (None,)], "r string", C.numeric_prefix("r"))
    assert got == [27, -3, None, None, None]


def test_health_score_and_status(spark):
    rows = [(100.0, 0.0, 0, 10), (0.0, 100.0, 10, 10), (80.0, 5.0, 0, 0), (55.0, 30.0, 1, 100)]
    score = _one(spark, rows, "p double, a double, c long, t long", C.health_score("p", "a", "c", "t"))
    # 0 + 15 + 5; 48 + 27 + 5 (no trips: the critical-rate term is capped); 33 + 15 + 9
    assert score == [100.0, 20.0, 80.0, 57.0]
    status = _one(spark, rows, "p double, a double, c long, t long", C.health_status("p", "a"))
    assert status == ["excellent", "critical", "excellent", "poor"]


def test_performance_tier(spark):
    rows = [(1, 9, 40), (9, 2, 40), (10, 30, 40), (11, 10, 40), (20, 20, 40), (6, 6, 20)]
    got = _one(spark, rows, "w int, b int, n long", C.performance_tier("w", "b", "n"))
    assert got == ["worst_performer", "best_performer", "below_average", "above_average", "average",
                   "average"]


def test_nonfinite_to_null(spark):
    rows = [(float("nan"),), (float("inf"),), (float("-inf"),), (1.5,), (None,)]
    assert _one(spark, rows, "x double", C.nonfinite_to_null("x")) == [None, None, None, 1.5, None]


def test_severity_and_display_order(spark):
    cats = ["critical", "severe", "moderate", "minor", "on_time", "early", "other"]
    assert _one(spark, [(c,) for c in cats], "c string", C.severity_rank("c")) == [0, 1, 2, 3, 4, 5, 6]
    assert _one(spark, [(c,) for c in cats], "c string", C.display_order("c")) == [6, 5, 4, 3, 2, 1, 7]


def test_published_route_descriptions(spark):
    from ridepulse.plans import live
    from ridepulse.sources import dims
    d = dims.route_descriptions(spark)
    assert d.count() == 119
    v = spark.createDataFrame([("1 27A c a",), ("60-39a-b12",), ("X32_1",), ("zz",)], "route_id string")
    out = [r.route_description for r in live.with_route_description(v, d).orderBy("route_id").collect()]
    assert out == ["Blunden Drive - Eden Quay", "Ongar - UCD Belfield", "Leixlip - UCD", ""]


def test_clean_nonfinite_frame(spark):
    df = spark.createDataFrame([("a", float("nan"), 1), ("b", float("inf"), 2), ("c", 2.5, 3)],
                               "k string, x double, n int")
    out = [tuple(r) for r in C.clean_nonfinite(df).orderBy("k").collect()]
    assert out == [("a", None, 1), ("b", None, 2), ("c", 2.5, 3)]


def test_time_period_of_timestamp(spark):
    import datetime as dt
    got = _one(spark, [(dt.datetime(2024, 1, 1, 7, 59),), (dt.datetime(2024, 1, 1, 22, 0),)], "t timestamp_ntz",
               C.time_period_of("t"))
    assert got == ["morning_rush", "night"]


def test_scale_conf_for_100_tb():
    from ridepulse.session import scale_conf
    c = scale_conf(100 << 40, total_cores=8000)
    assert int(c["spark.sql.shuffle.partitions"]) == 409600          # 100 TiB / 256 MiB
    assert int(scale_conf(1 << 30, total_cores=64)["spark.sql.shuffle.partitions"]) == 128   # two waves
