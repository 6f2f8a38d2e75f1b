"""Keyed maintenance operators: ties, upsert, merge, insert-if-absent, marks, retention."""

import datetime as dt

from pyspark.sql import functions as F

from ridepulse.operators import keyed

D = dt.datetime


def test_latest_per_key_tie_break(spark):
    df = spark.createDataFrame([("a", D(2024, 1, 1), 1), ("a", D(2024, 1, 1), 2), ("a", None, 0),
                                ("b", D(2024, 1, 2), 5), ("b", D(2024, 1, 3), 4)], "k string, ts timestamp_ntz, v int")
    out = {r.k: r.v for r in keyed.latest_per_key(df, ["k"], [F.col("ts").desc_nulls_first(), F.col("v").desc()])
           .collect()}
    assert out == {"a": 0, "b": 4}   # a null time sorts first in descending order, as in the published SQL
    nn = {r.k: r.v for r in keyed.latest_per_key(df.where("ts is not null"), ["k"],
                                                  [F.col("ts").desc(), F.col("v").desc()]).collect()}
    assert nn == {"a": 2, "b": 4}


def test_previous_before_is_strict(spark):
    df = spark.createDataFrame([("a", D(2024, 1, 1, 0, 0), 1), ("a", D(2024, 1, 1, 0, 35), 2),
                                ("a", D(2024, 1, 1, 0, 34, 59), 3)], "k string, ts timestamp_ntz, v int")
    out = keyed.previous_before(df, ["k"], "ts", "2024-01-01 00:35:00").collect()
    assert [r.v for r in out] == [3]


def test_upsert_replaces_values_keeps_first_route(spark):
    cur = spark.createDataFrame([("t1", "R1", "old", D(2024, 1, 1)), ("t2", "R2", "keep", D(2024, 1, 1))],
                                "trip_id string, route_id string, raw_data string, ingestion_timestamp timestamp_ntz")
    batch = spark.createDataFrame([("t1", "R9", "new1", D(2024, 1, 2)), ("t1", "R8", "new2", D(2024, 1, 3)),
                                   ("t3", "R3", "x", D(2024, 1, 2))], cur.schema)
    out = {r.trip_id: (r.route_id, r.raw_data, r.ingestion_timestamp)
           for r in keyed.upsert(cur, batch, ["trip_id"], ["ingestion_timestamp"]).collect()}
    assert out == {"t1": ("R1", "new2", D(2024, 1, 3)), "t2": ("R2", "keep", D(2024, 1, 1)),
                   "t3": ("R3", "x", D(2024, 1, 2))}


def test_upsert_batch_wins_even_if_older(spark):
    cur = spark.createDataFrame([("t1", "R1", "stored", D(2024, 1, 5))],
                                "trip_id string, route_id string, raw_data string, ingestion_timestamp timestamp_ntz")
    batch = spark.createDataFrame([("t1", "R1", "late", D(2024, 1, 1))], cur.schema)
    assert keyed.upsert(cur, batch, ["trip_id"], ["ingestion_timestamp"]).first().raw_data == "late"


def test_merge_by_key_replaces_and_does_not_dedup_batch(spark):
    tgt = spark.createDataFrame([("k1", 1), ("k2", 2)], "id string, v int")
    batch = spark.createDataFrame([("k2", 20), ("k2", 21), ("k3", 3)], "id string, v int")
    out = sorted(tuple(r) for r in keyed.merge_by_key(tgt, batch, ["id"]).collect())
    assert out == [("k1", 1), ("k2", 20), ("k2", 21), ("k3", 3)]
    again = sorted(tuple(r) for r in keyed.merge_by_key(keyed.merge_by_key(tgt, batch, ["id"]), batch, ["id"])
                   .collect())
    assert again == out  # idempotent


def test_insert_if_absent_ignores_null_keys(spark):
    tgt = spark.createDataFrame([("a", 1), (None, 9)], "trip_id string, v int")
    batch = spark.createDataFrame([("a", 2), ("b", 3), (None, 4)], "trip_id string, v int")
    out = sorted((r.trip_id or "", r.v) for r in keyed.insert_if_absent(tgt, batch, ["trip_id"]).collect())
    assert out == [("", 9), ("a", 1), ("b", 3)]


def test_incremental_since_lateness(spark):
    df = spark.createDataFrame([(D(2024, 1, 1, 9, 0),), (D(2024, 1, 1, 9, 30),), (D(2024, 1, 1, 10, 0),),
                                (D(2024, 1, 1, 11, 0),)], "ts timestamp_ntz")
    assert keyed.incremental_since(df, "ts", D(2024, 1, 1, 10, 0)).count() == 2   # equal time kept
    assert keyed.incremental_since(df, "ts", D(2024, 1, 1, 10, 0), "30 minutes").count() == 3
    assert keyed.incremental_since(df, "ts", None).count() == 4
    assert keyed.high_water_mark(df.limit(0), "ts") is None


def test_prune_old_counts(spark):
    df = spark.createDataFrame([(D(2024, 1, 8, 23),), (D(2024, 1, 9, 0),), (D(2024, 1, 9, 12),), (None,)],
                               "ts timestamp_ntz")
    kept, counts = keyed.prune_old(df, "ts", "2024-01-10 00:00:00", 24)
    assert kept.count() == 3
    c = counts.first()
    assert (c.kept, c.pruned) == (3, 1)


def test_time_ordered_upsert_keeps_the_stored_route(spark):
    cols = "trip_id string, route_id string, loaded_at string, delay_seconds int"
    stored = spark.createDataFrame([("t", "rA", "03:00", 5)], cols)
    late = spark.createDataFrame([("t", "rC", "02:00", 9), ("u", "rB", "01:00", 1), ("u", "rD", "02:00", 2)], cols)
    out = {r.trip_id: tuple(r) for r in keyed.upsert(stored, late, ["trip_id"], ["loaded_at"], batch_wins=False).collect()}
    assert out == {"t": ("t", "rA", "03:00", 5), "u": ("u", "rB", "02:00", 2)}
