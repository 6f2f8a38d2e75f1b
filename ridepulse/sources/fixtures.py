"""Feed snapshots derived from the ``events`` table (the mapping of FIXTURES.md).

The driver's ``events`` rows stand in for realtime observations: each event is one snapshot holding one
entity, whose vehicle part exists for click/view/purchase events and whose trip-update part always exists.
Everything here is a narrow projection of ``events``, so it scales with that table and needs no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridepulse import schemas
from ridepulse.functions.columns import EPOCH_NTZ

# Fixed values of the fixture mapping (FIXTURES.md §1-2).
VEHICLE_EVENT_TYPES = ("click", "view", "purchase")
NO_POSITION_MOD = 17
EMPTY_STOPS_MOD = 29
DEPARTURE_ONLY_MOD = 5
NO_TIMES_MOD = 23
NO_DELAY_MOD = 31  # the arrival or departure is there but states no delay
STOP_MOD = 97
ROUTE_MOD, PATTERN_MOD = 40, 3


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one of the driver's tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events_base(events: DataFrame) -> DataFrame:
    """Common base: ids, route, the k value and weekday, the observation second and the delay ``d``.

    Written as SQL expressions so that the whole projection is built with a handful of calls.
    """
    return events.selectExpr(
        "event_id", "ts", "event_type",
        "CAST(user_id AS STRING) AS vehicle_id",
        "concat(CAST(user_id AS STRING), '_', event_type) AS trip_id",
        f"concat('R', CAST(user_id % {ROUTE_MOD} AS STRING), '_', CAST(user_id % {PATTERN_MOD} AS STRING)) AS route_id",
        "try_cast(get_json_object(props, '$.k') AS INT) AS k",
        "CAST(dayofweek(ts) - 1 AS INT) AS dow",
        f"timestampadd(SECOND, timestampdiff(SECOND, {EPOCH_NTZ}, ts), {EPOCH_NTZ}) AS obs_ts",
    ).selectExpr("*", "CAST((k * k * (dow + 2)) div 100 - 60 + greatest(k - 89, 0) * 120 AS INT) AS d")


def feed_snapshots(events: DataFrame) -> DataFrame:
    """Nested GTFS-realtime-like snapshots (schema ``schemas.FEED``) built from ``events``.

    Every leaf is built with its declared type, so the nested value needs no cast.
    """
    types = "', '".join(VEHICLE_EVENT_TYPES)
    trip = "named_struct('trip_id', trip_id, 'route_id', route_id)"
    delay = f"named_struct('delay', CASE WHEN event_id % {NO_DELAY_MOD} <> 0 THEN d END)"
    entity = f"""array(named_struct(
        'id', CAST(event_id AS STRING),
        'vehicle', CASE WHEN event_type IN ('{types}') THEN named_struct(
            'vehicle', named_struct('id', vehicle_id),
            'trip', {trip},
            'position', CASE WHEN event_id % {NO_POSITION_MOD} <> 0 THEN named_struct(
                'latitude', 53.2D + (event_id % 400) / 1000.0D,
                'longitude', -6.45D + (event_id % 500) / 1000.0D) END,
            'timestamp', timestampdiff(SECOND, {EPOCH_NTZ}, obs_ts)) END,
        'trip_update', named_struct(
            'trip', {trip},
            'stop_time_update', CASE WHEN event_id % {EMPTY_STOPS_MOD} = 0
                THEN CAST(array() AS array<{schemas.STOP_TIME_UPDATE.simpleString()}>)
                ELSE array(named_struct(
                    'arrival', CASE WHEN event_id % {NO_TIMES_MOD} <> 0 AND event_id % {DEPARTURE_ONLY_MOD} <> 0
                                    THEN {delay} END,
                    'departure', CASE WHEN event_id % {NO_TIMES_MOD} <> 0 THEN {delay} END,
                    'stop_id', concat('S', CAST(event_id % {STOP_MOD} AS STRING)))) END))) AS entity"""
    return events_base(events).selectExpr("event_id", "obs_ts", entity)


def on_published_routes(vehicles: DataFrame, codes: list[str], unknown: int = 11) -> DataFrame:
    """``vehicles`` with the route ids of real routes: vehicle ``v`` runs on the code at place ``v`` modulo the codes and
    ``unknown`` more, the last of which are in no table."""
    n = len(codes)
    at = F.pmod(F.col("vehicle_id").cast("long"), F.lit(n + unknown)).cast("int")
    code = F.coalesce(F.get(F.array(*[F.lit(c) for c in codes]), at), F.concat(F.lit("U"), at.cast("string")))
    return vehicles.withColumn("route_id", F.concat(code, F.lit("_"), F.split_part("route_id", F.lit("_"), F.lit(2))))
