"""Trip window stored in buckets: no exchange by trip, the same reports as over silver, another way for hot buckets."""

import datetime as dt
import random
import tempfile

import pytest

from compare import SF_SMALL
from ridepulse import schemas
from ridepulse.plans import catalog, jobs, reports
from ridepulse.sources import buckets, tables

T0 = dt.datetime(2024, 1, 5)


def exchanges(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange")


def rows(df):
    return sorted(map(repr, df.collect()))


@pytest.fixture(scope="module")
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def random_updates(spark, n=3000, hot=0.34, seed=1):
    rnd = random.Random(seed)
    data = []
    for _ in range(n):
        trip = "hot" if rnd.random() < hot else rnd.choice([None, *(f"t{i}" for i in range(40))])
        data.append((trip, rnd.choice(["R1_0", "R1_1", "R2_0", None]), rnd.choice([None, -30, 0, 60, 400, 900]),
                     rnd.choice(["s1", "s2", None]),
                     rnd.choice([None, *(T0 + dt.timedelta(minutes=10 * i) for i in range(30))])))
    return spark.createDataFrame(data, schemas.WINDOW_UPDATES)


def random_positions(spark, n=2000, seed=2):
    rnd = random.Random(seed)
    data = []
    for _ in range(n):
        at = rnd.choice([None, *(T0 + dt.timedelta(minutes=10 * i) for i in range(30))])
        data.append((rnd.choice(["hot", None, *(f"t{i}" for i in range(40))]), rnd.choice([None, 53.1, 53.2]),
                     rnd.choice([None, -6.1, -6.2]), at, rnd.choice([at, T0])))
    return spark.createDataFrame(data, schemas.WINDOW_POSITIONS)


def stored(spark, df, n=4):
    path = f"{tempfile.mkdtemp(prefix='rp-buckets-')}/t"
    buckets.write_bucketed(df, path, "trip_id", n)
    return path


def test_reports_over_the_window_need_no_exchange_by_trip(spark, no_broadcast):
    u, p = catalog._window(catalog.Tables(spark, SF_SMALL))
    assert exchanges(reports.delays(u, p, catalog.AS_OF, limit=None, lookback_minutes=catalog.LOOKBACK_MINUTES)) == 0
    assert exchanges(reports.delay_trend(u, catalog.AS_OF, with_route=False)) == 0
    assert exchanges(reports.delay_trend(u, catalog.AS_OF)) <= 1   # the route of each trip, from one row per trip and route
    assert exchanges(reports.latest_delay(u)) == 0 and exchanges(reports.latest_positions(p)) == 0
    w = catalog._warehouse(catalog.Tables(spark, SF_SMALL))
    plain = [spark.read.parquet(x) for x in (w.window_updates, w.window_positions)]
    assert exchanges(reports.delays(*plain, catalog.AS_OF, limit=None)) >= 2


def test_reduced_rows_answer_every_report_alike(spark):
    updates, positions = random_updates(spark).cache(), random_positions(spark).cache()
    pu, pp = stored(spark, jobs.window_updates(updates)), stored(spark, jobs.window_positions(positions))
    u = buckets.read_bucketed(spark, pu, schemas.WINDOW_UPDATES)
    p = buckets.read_bucketed(spark, pp, schemas.WINDOW_POSITIONS)
    assert u.count() < updates.count() and p.count() < positions.count()
    for as_of in (T0, T0 + dt.timedelta(minutes=95), T0 + dt.timedelta(hours=9)):
        for route in (None, "R1", "R1_1"):
            assert rows(reports.delays(u, p, as_of, route=route, limit=None)) == \
                rows(reports.delays(updates, positions, as_of, route=route, limit=None))
            assert rows(reports.delay_trend(u, as_of, route=route)) == rows(reports.delay_trend(updates, as_of, route=route))
            assert rows(reports.latest_delay(u, route)) == rows(reports.latest_delay(updates, route))
            assert rows(reports.previous_delay(u, as_of, route=route)) == rows(reports.previous_delay(updates, as_of, route=route))
    assert rows(reports.latest_positions(p)) == rows(reports.latest_positions(positions))
    assert rows(reports.delays_summary(u, p, T0 + dt.timedelta(hours=5))) == \
        rows(reports.delays_summary(updates, positions, T0 + dt.timedelta(hours=5)))


def test_a_bucket_over_the_bound_is_read_by_splits(spark, no_broadcast):
    path = stored(spark, random_updates(spark))
    found = buckets.layout(spark, path)
    assert found.key == "trip_id" and found.buckets == 4 and found.pure and set(found.bytes) <= set(range(4))
    by_bucket = buckets.read_bucketed(spark, path, schemas.WINDOW_UPDATES, max(found.bytes.values()))
    by_split = buckets.read_bucketed(spark, path, schemas.WINDOW_UPDATES, max(found.bytes.values()) - 1)
    assert exchanges(reports.latest_delay(by_bucket)) == 0 and exchanges(reports.latest_delay(by_split)) == 1
    assert rows(by_bucket) == rows(by_split) == rows(random_updates(spark))


def test_a_hot_key_may_be_written_by_several_tasks(spark, no_broadcast):
    conf = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
            "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true"}
    old = {k: spark.conf.get(k) for k in conf}
    src = random_updates(spark, 20000, hot=0.8).repartition(8)
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        path = stored(spark, src, 2)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert len([n for n, _ in buckets._listing(spark, path) if n.startswith("part-")]) > 2
    df = buckets.read_bucketed(spark, path, schemas.WINDOW_UPDATES)
    assert exchanges(reports.latest_delay(df)) == 0
    assert rows(reports.latest_delay(df)) == rows(reports.latest_delay(src))


def test_files_of_no_bucket_and_new_versions(spark, no_broadcast):
    small = random_updates(spark, 50)
    path = stored(spark, small)
    assert buckets.read_bucketed(spark, path, schemas.WINDOW_UPDATES).count() == 50
    buckets.write_bucketed(random_updates(spark, 70, seed=3), path, "trip_id", 2)   # another version, no stale listing
    df = buckets.read_bucketed(spark, path, schemas.WINDOW_UPDATES)
    assert df.count() == 70 and exchanges(reports.latest_delay(df)) == 0
    tables.append(small, path)
    df = buckets.read_bucketed(spark, path, schemas.WINDOW_UPDATES)
    assert df.count() == 120 and exchanges(reports.latest_delay(df)) == 1


def test_a_table_without_rows_or_none_at_all(spark):
    empty = spark.createDataFrame([], schemas.WINDOW_UPDATES)
    path = stored(spark, empty)
    assert buckets.read_bucketed(spark, path, schemas.WINDOW_UPDATES).count() == 0
    assert buckets.read_bucketed(spark, f"{path}-none", schemas.WINDOW_UPDATES).schema == schemas.WINDOW_UPDATES
    buckets.write_bucketed(random_updates(spark, 30), path, "trip_id", 3)
    assert buckets.read_bucketed(spark, path, schemas.WINDOW_UPDATES).count() == 30
    jobs.rebuild_trip_window(spark, tempfile.mkdtemp(prefix="rp-buckets-"))           # nothing stored: nothing written


def test_window_holds_the_last_hours_only(spark):
    w = catalog._warehouse(catalog.Tables(spark, SF_SMALL))
    root = tempfile.mkdtemp(prefix="rp-buckets-")
    for name in ("silver_trips", "silver_vehicles"):
        part = "loaded_date"
        (spark.read.parquet(getattr(w, name)).drop("run_id").write.partitionBy(part)
         .parquet(getattr(jobs.Warehouse(root), name)))
    jobs.rebuild_trip_window(spark, root, catalog.AS_OF, 24)
    u, p = jobs.trip_window(spark, root)
    full = [spark.read.parquet(getattr(jobs.Warehouse(root), n)) for n in ("silver_trips", "silver_vehicles")]
    assert u.count() > 0
    assert rows(reports.delays(u, p, catalog.AS_OF, limit=None)) == \
        rows(reports.delays(*full, catalog.AS_OF, limit=None, history_hours=24))
    jobs.rebuild_trip_window(spark, root)                                             # up to the latest update
    last = full[0].agg({"loaded_at": "max"}).first()[0]
    u, _ = jobs.trip_window(spark, root)
    assert u.agg({"loaded_at": "min"}).first()[0] >= last - dt.timedelta(hours=24)
    assert u.agg({"loaded_at": "max"}).first()[0] == last
