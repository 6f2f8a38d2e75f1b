"""Silver typing: JSON payloads parsed once into typed columns.

Payload fields are pulled with ``json_tuple`` (one streaming parse per row, fields returned as text) and cast
with ``try_cast``, so a missing, null or malformed value becomes null instead of failing the job. Measured
about twice as fast as ``from_json`` into a struct on the sf0.1 feed.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridepulse import schemas
from ridepulse.functions.columns import from_epoch_seconds


def ntz_literal(value) -> F.Column:
    """A TIMESTAMP_NTZ literal from a datetime or ISO string (never the wall clock)."""
    if isinstance(value, str):
        value = _dt.datetime.fromisoformat(value)
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def silver_vehicle_positions(bronze: DataFrame, loaded_at: str = "ingestion") -> DataFrame:
    """Typed positions; rows whose latitude is missing or not a number are dropped.

    ``loaded_at="ingestion"`` stamps rows with the bronze ingestion time, ``"gps"`` with the GPS time.
    """
    if loaded_at not in ("ingestion", "gps"):
        raise ValueError("loaded_at must be 'ingestion' or 'gps'")
    fields = [f.name for f in schemas.VEHICLE_PAYLOAD.fields]
    rows = bronze.select("vehicle_id", "trip_id", "ingestion_timestamp",
                         F.json_tuple("raw_data", *fields).alias(*[f"p_{n}" for n in fields]))
    gps = from_epoch_seconds(F.col("p_timestamp").try_cast("long"))
    return (rows.select("vehicle_id", "trip_id",
                        F.col("p_lat").try_cast("double").alias("latitude"),
                        F.col("p_lon").try_cast("double").alias("longitude"),
                        F.col("p_route_id").alias("route_id"),
                        gps.alias("gps_timestamp"),
                        (F.col("ingestion_timestamp") if loaded_at == "ingestion" else gps).alias("loaded_at"))
            .where(F.col("latitude").isNotNull()))


def silver_trip_updates(bronze: DataFrame, positions: DataFrame | None = None, loaded_at: str = "ingestion",
                        as_of=None) -> DataFrame:
    """Typed trip updates; rows whose delay is missing or not an integer are dropped.

    ``loaded_at="ingestion"``: the bronze ingestion time. ``loaded_at="gps"``: the latest GPS time of the trip
    in the bronze ``positions`` (one pre-aggregated row per trip, joined by key), else ``as_of``.
    """
    fields = [f.name for f in schemas.TRIP_PAYLOAD.fields]
    rows = (bronze.select("trip_id", "route_id", "ingestion_timestamp",
                          F.json_tuple("raw_data", *fields).alias(*[f"p_{n}" for n in fields]))
            .select("trip_id", "route_id",
                    F.col("p_delay").try_cast("int").alias("delay_seconds"),
                    F.col("p_stop_id").alias("stop_id"),
                    "ingestion_timestamp")
            .where(F.col("delay_seconds").isNotNull()))
    if loaded_at == "ingestion":
        return rows.withColumnRenamed("ingestion_timestamp", "loaded_at")
    if loaded_at != "gps":
        raise ValueError("loaded_at must be 'ingestion' or 'gps'")
    if positions is None or as_of is None:
        raise ValueError("loaded_at='gps' needs positions and as_of")
    gps = from_epoch_seconds(F.get_json_object("raw_data", "$.timestamp").try_cast("long"))
    last_gps = (positions.select("trip_id", gps.alias("gps_ts"))
                .groupBy("trip_id").agg(F.max("gps_ts").alias("last_gps")))
    return (rows.join(last_gps, "trip_id", "left")
            .select("trip_id", "route_id", "delay_seconds", "stop_id",
                    F.coalesce(F.col("last_gps"), ntz_literal(as_of)).alias("loaded_at")))
