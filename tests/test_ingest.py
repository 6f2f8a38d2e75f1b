"""Feed flattening and silver typing on hand-written snapshots."""

import datetime as dt
import json

from ridepulse import schemas
from ridepulse.operators import ingest, silver

T0 = dt.datetime(2024, 1, 2, 8, 0, 0)


def stop(arr=None, dep=None, sid="S1"):
    return ((arr,) if arr is not None else None, (dep,) if dep is not None else None, sid)


def entity(eid, vehicle=None, stops=None, trip=("t1", "R1_0")):
    tu = (trip, stops) if stops is not None else None
    return (eid, vehicle, tu)


def vehicle(vid="v1", trip=("t1", "R1_0"), pos=(53.3, -6.2), ts=1704182400):
    return ((vid,), trip, pos, ts)


def feed(spark, entities):
    return spark.createDataFrame([(1, T0, entities)], schemas.FEED)


def test_delay_presence_rules(spark):
    f = feed(spark, [
        entity("a", stops=[stop(arr=0, dep=90)], trip=("ta", "R1_0")),      # arrival present with 0 wins
        entity("b", stops=[stop(dep=45)], trip=("tb", "R1_0")),             # departure only
        entity("c", stops=[stop()], trip=("tc", "R1_0")),                   # neither
        entity("d", stops=[], trip=("td", "R1_0")),                         # empty list
        entity("e", stops=[stop(arr=-30), stop(arr=999)], trip=("te", "R1_0")),  # first stop only
        entity("f", vehicle=vehicle()),                                     # no trip update
    ])
    drop = {r.trip_id: json.loads(r.raw_data) for r in ingest.flatten_trip_feed(f).collect()}
    assert drop == {"ta": {"delay": 0, "stop_id": "S1"}, "tb": {"delay": 45, "stop_id": "S1"},
                    "te": {"delay": -30, "stop_id": "S1"}}
    zero = {r.trip_id: json.loads(r.raw_data)["delay"] for r in
            ingest.flatten_trip_feed(f, missing_delay="zero").collect()}
    assert zero == {"ta": 0, "tb": 45, "tc": 0, "te": -30}


def test_vehicle_flatten_options(spark):
    f = feed(spark, [
        entity("e1", vehicle=vehicle("v1")),
        entity("e2", vehicle=vehicle("v2", trip=("", "R2_0"))),
        entity("e3", vehicle=vehicle("v3", pos=None)),
        entity("e4", stops=[stop(arr=1)]),
    ])
    rows = ingest.flatten_vehicle_feed(f).orderBy("vehicle_id").collect()
    assert [r.vehicle_id for r in rows] == ["v1", "v2", "v3"]
    assert json.loads(rows[0].raw_data) == {"lat": 53.3, "lon": -6.2, "timestamp": 1704182400, "route_id": "R1_0"}
    assert "lat" not in json.loads(rows[2].raw_data)
    keyed = ingest.flatten_vehicle_feed(f, vehicle_key="entity.id", require_trip=True).collect()
    assert sorted(r.vehicle_id for r in keyed) == ["e1", "e3"]
    assert all(r.ingestion_timestamp == T0 for r in rows)


def test_silver_json_typing(spark):
    bronze_v = spark.createDataFrame([
        ("v1", "t1", "R1_0", '{"lat": 53.1, "lon": -6.1, "timestamp": 1704182400, "route_id": "R1_0"}', T0),
        ("v2", "t2", "R1_0", '{"lon": -6.1, "timestamp": 1704182400}', T0),
        ("v3", "t3", "R1_0", '{"lat": null, "lon": -6.1}', T0),
        ("v4", "t4", "R1_0", '{"lat": "abc", "lon": -6.1}', T0),
        ("v5", "t5", "R1_0", 'not json', T0),
        ("v6", "t6", "R1_0", '{"lat": "53.5", "lon": "-6.5", "timestamp": "1704182401"}', T0),
    ], schemas.BRONZE_VEHICLE_POSITIONS)
    sv = {r.vehicle_id: r for r in silver.silver_vehicle_positions(bronze_v).collect()}
    assert set(sv) == {"v1", "v6"}
    assert sv["v1"].gps_timestamp == dt.datetime(2024, 1, 2, 8, 0, 0) and sv["v1"].loaded_at == T0
    assert sv["v6"].latitude == 53.5
    gps = {r.vehicle_id: r.loaded_at for r in silver.silver_vehicle_positions(bronze_v, loaded_at="gps").collect()}
    assert gps["v6"] == dt.datetime(2024, 1, 2, 8, 0, 1)

    bronze_t = spark.createDataFrame([
        ("t1", "R1_0", '{"delay": 120, "stop_id": "S1"}', T0),
        ("t2", "R1_0", '{"stop_id": "S1"}', T0),
        ("t3", "R1_0", '{"delay": null}', T0),
        ("t4", "R1_0", '{"delay": "x"}', T0),
        ("t5", "R1_0", '{"delay": "-7", "stop_id": "S2"}', T0),
    ], schemas.BRONZE_TRIP_UPDATES)
    st = {r.trip_id: r.delay_seconds for r in silver.silver_trip_updates(bronze_t).collect()}
    assert st == {"t1": 120, "t5": -7}


def test_silver_gps_loaded_at(spark):
    bronze_t = spark.createDataFrame([("t1", "R1_0", '{"delay": 5}', T0), ("t2", "R1_0", '{"delay": 6}', T0)],
                                     schemas.BRONZE_TRIP_UPDATES)
    bronze_v = spark.createDataFrame([
        ("v1", "t1", "R1_0", '{"lat": 1, "timestamp": 1704182400}', T0),
        ("v1", "t1", "R1_0", '{"timestamp": 1704182460}', T0),
    ], schemas.BRONZE_VEHICLE_POSITIONS)
    out = {r.trip_id: r.loaded_at for r in silver.silver_trip_updates(
        bronze_t, positions=bronze_v, loaded_at="gps", as_of="2024-01-05 00:00:00").collect()}
    assert out == {"t1": dt.datetime(2024, 1, 2, 8, 1, 0), "t2": dt.datetime(2024, 1, 5)}
