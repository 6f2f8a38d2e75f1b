"""The trend at many times in one pass equals one run per time."""

import datetime as dt
import random

import pytest

from compare import SF_SMALL
from ridepulse.plans import catalog, reports

D = dt.datetime
COLUMNS = "trip_id string, route_id string, delay_seconds int, stop_id string, loaded_at timestamp_ntz"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def one_by_one(updates, start, step, count, lookback, route=None):
    out = []
    for i in range(count):
        as_of = start + dt.timedelta(seconds=step * i)
        got = reports.delay_trend(updates, as_of, lookback, route, with_route=False)
        out += [(as_of, *r) for r in got.collect()]
    return sorted(out, key=repr)


@pytest.mark.parametrize("step,count,lookback,route", [(30, 12, 1, None), (90, 5, 2, "R1"), (600, 3, 0, None), (60, 1, 25, None)])
def test_series_equals_one_run_per_time(spark, step, count, lookback, route):
    rng = random.Random(step)
    start = D(2024, 1, 2, 8, 0)
    times = [None] + [start + dt.timedelta(seconds=15 * rng.randint(-20, 30)) for _ in range(80)] \
        + [start + dt.timedelta(microseconds=d) for d in (-1, 0, 1)]
    data = [(rng.choice(["t1", "t1", "t2", "t3", None]), rng.choice(["R1_0", "R2_0"]),
             rng.choice([None, -90, 0, 30, 400, 900]), "S", t) for t in times]
    updates = spark.createDataFrame(data, COLUMNS).coalesce(3)
    got = rows(reports.delay_trend_series(updates, start.isoformat(" "), step, count, lookback, route))
    assert got == one_by_one(updates, start, step, count, lookback, route)


def test_series_of_nothing_and_bad_series(spark):
    empty = spark.createDataFrame([], COLUMNS)
    assert reports.delay_trend_series(empty, "2024-01-02 08:00:00", 30, 4).collect() == []
    with pytest.raises(ValueError):
        reports.delay_trend_series(empty, "2024-01-02 08:00:00", 0, 4)


def test_series_reads_the_history_once_and_combines_before_the_shuffle(spark):
    t = catalog.Tables(spark, SF_SMALL)
    for count in (2, 500):
        df = reports.delay_trend_series(t.silver_trip_updates, "2024-01-06 00:00:00", 30, count)
        p = df._jdf.queryExecution().executedPlan().toString()
        assert p.count("Scan parquet") == 1 and p.count("Exchange hashpartitioning") == 2
        assert "SortAggregate" not in p and p.count("Sort [") == 1 and p.rfind("partial_max") > p.rfind("Exchange")
