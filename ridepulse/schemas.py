"""Declared schemas of the feed and of the bronze / silver tables."""

from __future__ import annotations

from pyspark.sql import types as T

_trip = T.StructType([T.StructField("trip_id", T.StringType()), T.StructField("route_id", T.StringType())])
_delay = T.StructType([T.StructField("delay", T.IntegerType())])

STOP_TIME_UPDATE = T.StructType([
    T.StructField("arrival", _delay),
    T.StructField("departure", _delay),
    T.StructField("stop_id", T.StringType()),
])

VEHICLE = T.StructType([
    T.StructField("vehicle", T.StructType([T.StructField("id", T.StringType())])),
    T.StructField("trip", _trip),
    T.StructField("position", T.StructType([T.StructField("latitude", T.DoubleType()),
                                            T.StructField("longitude", T.DoubleType())])),
    T.StructField("timestamp", T.LongType()),
])

TRIP_UPDATE = T.StructType([
    T.StructField("trip", _trip),
    T.StructField("stop_time_update", T.ArrayType(STOP_TIME_UPDATE)),
])

ENTITY = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("vehicle", VEHICLE),
    T.StructField("trip_update", TRIP_UPDATE),
])

# One landed feed snapshot per row: when it was observed and its repeated entities.
FEED = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("obs_ts", T.TimestampNTZType()),
    T.StructField("entity", T.ArrayType(ENTITY)),
])

BRONZE_VEHICLE_POSITIONS = T.StructType([
    T.StructField("vehicle_id", T.StringType()),
    T.StructField("trip_id", T.StringType()),
    T.StructField("route_id", T.StringType()),
    T.StructField("raw_data", T.StringType()),
    T.StructField("ingestion_timestamp", T.TimestampNTZType()),
])

BRONZE_TRIP_UPDATES = T.StructType([
    T.StructField("trip_id", T.StringType()),
    T.StructField("route_id", T.StringType()),
    T.StructField("raw_data", T.StringType()),
    T.StructField("ingestion_timestamp", T.TimestampNTZType()),
])

# JSON payload fields (read as text with json_tuple, then cast with try_cast, so malformed values become null
# instead of failing the job or nulling the whole record).
VEHICLE_PAYLOAD = T.StructType([
    T.StructField("lat", T.StringType()),
    T.StructField("lon", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("route_id", T.StringType()),
])

TRIP_PAYLOAD = T.StructType([
    T.StructField("delay", T.StringType()),
    T.StructField("stop_id", T.StringType()),
])

SILVER_VEHICLE_POSITIONS = T.StructType([
    T.StructField("vehicle_id", T.StringType()),
    T.StructField("trip_id", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("route_id", T.StringType()),
    T.StructField("gps_timestamp", T.TimestampNTZType()),
    T.StructField("loaded_at", T.TimestampNTZType()),
])

SILVER_TRIP_UPDATES = T.StructType([
    T.StructField("trip_id", T.StringType()),
    T.StructField("route_id", T.StringType()),
    T.StructField("delay_seconds", T.IntegerType()),
    T.StructField("stop_id", T.StringType()),
    T.StructField("loaded_at", T.TimestampNTZType()),
])

# What the trip reports need of the last hours (bucketed by trip).
WINDOW_UPDATES = T.StructType([
    T.StructField("trip_id", T.StringType()),
    T.StructField("route_id", T.StringType()),
    T.StructField("delay_seconds", T.IntegerType()),
    T.StructField("stop_id", T.StringType()),
    T.StructField("loaded_at", T.TimestampNTZType()),
])

WINDOW_POSITIONS = T.StructType([
    T.StructField("trip_id", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("gps_timestamp", T.TimestampNTZType()),
    T.StructField("loaded_at", T.TimestampNTZType()),
])
