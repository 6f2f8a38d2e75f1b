"""Live-map operators: ghost trips (a delay but no live vehicle), the vehicle delay lookup with fallbacks,
the incident list, the route menu, selection bounds and the two map layers.

``delays`` is the output of ``reports.delays`` (``route_id`` holds the trip id) and ``vehicles`` the output of
``reports.latest_vehicles``. A delay row is *live* when some vehicle has ``route_id`` or ``trip_id`` equal to
it. That OR condition would plan as a nested-loop join; here the two vehicle key columns are unioned into one
distinct key set and matched with a single hash join (semi for live, anti for ghosts).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ridepulse.functions.columns import TREND_LABELS, clean_route_name, numeric_prefix, severity_rank
from ridepulse.operators.keyed import latest_per_key
from ridepulse.sources.dims import trend_labels


def vehicle_keys(vehicles: DataFrame) -> DataFrame:
    """Distinct ids a delay row can match a vehicle by (its route id and its trip id)."""
    keys = F.array_distinct(F.array(F.col("route_id"), F.col("trip_id")))
    return (vehicles.select(F.explode(keys).alias("match_key"))
            .where(F.col("match_key").isNotNull()).distinct())


def live_trips(delays: DataFrame, vehicles: DataFrame) -> DataFrame:
    k = vehicle_keys(vehicles)
    return delays.join(k, delays["route_id"] == k["match_key"], "left_semi")


def ghost_trips(delays: DataFrame, vehicles: DataFrame) -> DataFrame:
    k = vehicle_keys(vehicles)
    return delays.join(k, delays["route_id"] == k["match_key"], "left_anti")


def ghost_count(delays: DataFrame, vehicles: DataFrame) -> DataFrame:
    return ghost_trips(delays, vehicles).agg(F.count(F.lit(1)).cast("long").alias("ghost_count"))


def worst_delay_by_route(delays: DataFrame) -> DataFrame:
    """Per clean route name, the delay row with the largest absolute delay (ties: the newest, then the
    smallest trip id, i.e. the first one in report order)."""
    d = delays.select(clean_route_name("route_id").alias("clean_route"), "route_id", "avg_delay_minutes",
                      "delay_category", "trend", "trend_change_minutes", "loaded_at")
    return latest_per_key(d, ["clean_route"], [F.abs(F.col("avg_delay_minutes")).desc_nulls_last(),
                                                F.col("loaded_at").desc_nulls_first(), F.col("route_id")])


_INFO = ("avg_delay_minutes", "delay_category", "trend", "trend_change_minutes")


_VEHICLE = ("vehicle_id", "trip_id", "route_id", "latitude", "longitude", "gps_timestamp")
_MATCHES = ("trip", "route", "clean_route")


def vehicle_delay_info(vehicles: DataFrame, delays: DataFrame) -> DataFrame:
    """Delay shown for each vehicle: by its trip id, else by its route id used as an id, else the worst
    delay of its clean route name, else (0, on_time, stable, null).

    One pass: each delay row offers itself under its id and under its clean route name, each vehicle asks under its
    three keys, and both meet in one window per key whose first row is the offer that counts; a second window keeps the
    answer of the best key. Two exchanges beside those of the inputs, of one small row per offer and question; the
    windows stream over sorted rows and spill, so a key that many vehicles ask under needs no memory of its size.
    Equal vehicle rows count once (``latest_vehicles`` gives one row per vehicle).
    """
    info = F.struct(*_INFO)
    by_id, by_clean = F.lit("id"), F.lit("clean_route")
    clean = clean_route_name("route_id")
    vehicle = F.struct(*_VEHICLE)
    offer = (F.struct(by_id.alias("kind"), F.col("route_id").alias("key")),
             F.struct(by_clean.alias("kind"), clean.alias("key")))
    asked = [F.struct(kind.alias("kind"), key.alias("key"), F.lit(rank).alias("rank"))
             for rank, (kind, key) in enumerate(((by_id, F.col("trip_id")), (by_id, F.col("route_id")),
                                                 (by_clean, clean)))]
    offers = delays.select(info.alias("info"), F.abs(F.col("avg_delay_minutes")).alias("size"), "loaded_at",
                           F.col("route_id").alias("tie"), F.explode(F.array(*offer)).alias("k")) \
        .select("k.kind", "k.key", F.lit(-1).alias("rank"), "info", "size", "loaded_at", "tie")
    questions = vehicles.select(vehicle.alias("vehicle"), F.explode(F.array(*asked)).alias("k")) \
        .select("k.*", "vehicle")
    rows = offers.unionByName(questions, allowMissingColumns=True).where(F.col("key").isNotNull())
    # Offers stand before questions: the row with the largest absolute delay first, then the newest, then by id.
    per_key = (Window.partitionBy("kind", "key")
               .orderBy(F.col("rank") >= 0, F.col("size").desc_nulls_last(), F.col("loaded_at").desc_nulls_first(), "tie")
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    last = len(asked) - 1  # never null, and kept without an answer
    answers = (rows.select("rank", "vehicle", F.first("info").over(per_key).alias("info"))
               .where((F.col("rank") >= 0) & (F.col("info").isNotNull() | (F.col("rank") == last))))
    best = latest_per_key(answers, ["vehicle"], ["rank"])
    found = F.col("info")
    match = F.when(found.isNotNull(), F.element_at(F.array(*[F.lit(m) for m in _MATCHES]), F.col("rank") + 1))
    return best.select(
        *[F.col("vehicle")[c].alias(c) for c in _VEHICLE],
        clean_route_name(F.col("vehicle")["route_id"]).alias("clean_route"),
        F.coalesce(found["avg_delay_minutes"], F.lit(0.0)).alias("delay_minutes"),
        F.coalesce(found["delay_category"], F.lit("on_time")).alias("delay_category"),
        F.coalesce(found["trend"], F.lit("stable")).alias("trend"),
        found["trend_change_minutes"].alias("trend_change_minutes"),
        F.coalesce(match, F.lit("default")).alias("matched_by"))


def incident_list(delays: DataFrame, vehicles: DataFrame, show_ghosts: bool = False) -> DataFrame:
    """Delay rows from critical to early, larger absolute delay first; ghost trips hidden unless asked."""
    rows = delays if show_ghosts else live_trips(delays, vehicles)
    rows = rows.withColumn("severity_rank", severity_rank("delay_category"))
    return rows.orderBy("severity_rank", F.abs(F.col("avg_delay_minutes")).desc_nulls_last(),
                        F.col("loaded_at").desc_nulls_first(), "trip_id")


def with_route_description(df: DataFrame, descriptions: DataFrame, route_col: str = "route_id",
                           out_col: str = "route_description") -> DataFrame:
    """Description of the clean route name of ``route_col``; empty string when unknown.

    The planner and AQE broadcast the description table only if its bytes are under the session's threshold.
    """
    d = descriptions.select(F.col("route_code").alias("_rc"), F.col("description").alias("_desc"))
    return (df.withColumn("_rc", clean_route_name(route_col))
            .join(d, "_rc", "left")
            .withColumn(out_col, F.coalesce(F.col("_desc"), F.lit("")))
            .drop("_rc", "_desc"))


def route_menu(vehicles: DataFrame, descriptions: DataFrame | None = None) -> DataFrame:
    """Distinct clean route names of the live vehicles, numeric labels first in numeric order, then text."""
    r = vehicles.select(clean_route_name("route_id").alias("route")).distinct() \
        .withColumn("route_num", numeric_prefix("route"))
    if descriptions is not None:
        d = descriptions.select(F.col("route_code").alias("route"), "description")
        r = r.join(d, "route", "left").withColumn("description", F.coalesce("description", F.lit("")))
    # Text labels in case-insensitive order (as a locale comparison would), exact text as the tie-break.
    return r.orderBy(F.col("route_num").asc_nulls_last(), F.lower("route"), "route")


def trend_counts(delays: DataFrame) -> DataFrame:
    """Trips per trend label, all four labels present (zero-filled)."""
    counts = delays.where(F.col("trend").isin(*TREND_LABELS)).groupBy("trend") \
        .agg(F.count(F.lit(1)).cast("long").alias("n"))
    # At most four rows on either side.
    return (F.broadcast(trend_labels(delays.sparkSession)).join(F.broadcast(counts), "trend", "left")
            .select("trend", F.coalesce("n", F.lit(0)).cast("long").alias("n")))


def selection_bounds(delays: DataFrame, vehicles: DataFrame) -> DataFrame:
    """Where the map goes when a delay row is selected: the bounding box of its matching vehicles, the
    single vehicle when there is one, else the row's last known position, else nothing.

    Vehicles are first aggregated per match key (count and extremes), so the join to the delay rows is
    one-to-one whatever the number of vehicles per key.
    """
    keys = F.array_distinct(F.array(F.col("route_id"), F.col("trip_id")))
    per_key = (vehicles.select(F.explode(keys).alias("match_key"), "latitude", "longitude")
               .where(F.col("match_key").isNotNull())
               .groupBy("match_key")
               .agg(F.count(F.lit(1)).alias("n_matches"),
                    F.min("latitude").alias("min_lat"), F.min("longitude").alias("min_lon"),
                    F.max("latitude").alias("max_lat"), F.max("longitude").alias("max_lon")))
    j = delays.select(F.col("route_id").alias("selection"), "last_lat", "last_lon") \
        .join(per_key, F.col("selection") == F.col("match_key"), "left")
    n = F.coalesce(F.col("n_matches"), F.lit(0)).cast("long")
    has_last = F.col("last_lat").isNotNull() & F.col("last_lon").isNotNull()
    mode = (F.when(n > 1, F.lit("bounds")).when(n == 1, F.lit("center"))
            .when(has_last, F.lit("last_known")).otherwise(F.lit("none")))
    return j.select(
        "selection", n.alias("n_matches"), mode.alias("mode"),
        F.when(n == 1, F.col("min_lat")).when((n == 0) & has_last, F.col("last_lat")).alias("center_lat"),
        F.when(n == 1, F.col("min_lon")).when((n == 0) & has_last, F.col("last_lon")).alias("center_lon"),
        F.when(n > 1, F.col("min_lat")).alias("min_lat"), F.when(n > 1, F.col("min_lon")).alias("min_lon"),
        F.when(n > 1, F.col("max_lat")).alias("max_lat"), F.when(n > 1, F.col("max_lon")).alias("max_lon"))


def live_dots(vehicles: DataFrame, delays: DataFrame, route: str | None = None, category: str | None = None,
              selected: str | None = None) -> DataFrame:
    """Vehicles on the live map: by clean route name, by looked-up delay band, then by selection; a selection
    matching none of them falls back to the unselected set (decided by a scalar subquery, not a join).

    Route and selection are the vehicle's own, so they are applied before the lookup; the subquery looks delays up only
    for the selected vehicles, and not at all without a ``category``.
    """
    if route:
        vehicles = vehicles.where(clean_route_name("route_id") == F.lit(route))

    def looked_up(v: DataFrame) -> DataFrame:
        v = vehicle_delay_info(v, delays)
        return v.where(F.col("delay_category") == F.lit(category.lower())) if category else v

    if not selected:
        return looked_up(vehicles)
    hit = (F.col("route_id") == F.lit(selected)) | (F.col("trip_id") == F.lit(selected))
    among = looked_up(vehicles.where(hit)) if category else vehicles.where(hit)
    any_hit = among.agg(F.count(F.lit(1))).scalar()
    return looked_up(vehicles.where(hit | (any_hit == 0)))


def ghost_dots(delays: DataFrame, vehicles: DataFrame, route: str | None = None) -> DataFrame:
    """Ghost trips with a last known position (optionally of one clean route name)."""
    g = ghost_trips(delays, vehicles).where(F.col("last_lat").isNotNull() & F.col("last_lon").isNotNull())
    if route:
        g = g.where(clean_route_name("route_id") == F.lit(route))
    return g

