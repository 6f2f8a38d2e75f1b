"""Report queries over silver and gold tables (one function per question an operator asks).

Latest-per-key reads use ``row_number() = 1`` (partial WindowGroupLimit before the shuffle); the trend pass computes the latest and the previous delay of every trip in one
aggregate, so the updates table is scanned and shuffled once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridepulse.functions.columns import (
    CATEGORIES, EPOCH_NTZ, delay_category, display_order, period_order, route_code, to_minutes, trend,
    trend_change_minutes,
)
from ridepulse.operators.keyed import latest_per_key
from ridepulse.operators.silver import ntz_literal
from ridepulse.sources.dims import delay_bands

MAX_DELAYS_LIMIT = 10000


# Deterministic orders for "latest" (the published queries leave ties open).
def update_order() -> list[Column]:
    return [F.col("loaded_at").desc_nulls_first(), F.col("delay_seconds").desc_nulls_last(),
            F.col("stop_id").desc_nulls_last(), F.col("route_id").desc_nulls_last()]


def position_order() -> list[Column]:
    return [F.col("gps_timestamp").desc_nulls_first(), F.col("latitude").desc_nulls_last(),
            F.col("longitude").desc_nulls_last()]


def vehicle_order() -> list[Column]:
    return [F.col("gps_timestamp").desc_nulls_first(), F.col("trip_id").desc_nulls_last(),
            F.col("latitude").desc_nulls_last(), F.col("longitude").desc_nulls_last()]


#: A delay fits below this factor; the time stands above it.
_DELAY_SPAN = 1 << 32


def _update_number() -> Column:
    """Time and delay of an update as one whole number, so that the latest update has the greatest (nulls are latest).

    A number of fixed size lets the latest value of a key come out of a hash aggregate: no sort of the history, and one
    entry per key and task before the shuffle.
    """
    micros = F.timestamp_diff("MICROSECOND", F.expr(EPOCH_NTZ), F.col("loaded_at"))
    time = F.coalesce(micros, F.lit(1 << 60)).cast("decimal(19,0)")
    return time * F.lit(_DELAY_SPAN).cast("decimal(10,0)") + (F.col("delay_seconds").cast("long") + (_DELAY_SPAN >> 1))


def _delay_of(number: Column) -> Column:
    return (F.pmod(number, F.lit(_DELAY_SPAN).cast("decimal(10,0)")).cast("long") - (_DELAY_SPAN >> 1)).cast("int")


def _route_prefix(df: DataFrame, route: str | None) -> DataFrame:
    # Literal prefix match: '_' and '%' in the argument are characters, not wildcards.
    return df if not route else df.where(F.col("route_id").startswith(F.lit(route)))


def recent(df: DataFrame, as_of, history_hours: int | None, ts_col: str = "loaded_at",
           date_col: str = "loaded_date") -> DataFrame:
    """Rows observed up to ``as_of`` (inclusive), of the last ``history_hours`` before it (None: all before it).

    Rows without a time are kept: they cannot be placed after ``as_of``.

    On stored silver (partitioned by ``loaded_date``) the date filter prunes whole partitions before the
    scan; the time filter is pushed into the parquet reader. This is the retention window of the published
    service (24 h) applied at read time instead of by deleting rows.
    """
    end = ntz_literal(as_of)
    df = df.where(F.col(ts_col).isNull() | (F.col(ts_col) <= end))
    if date_col in df.columns:
        df = df.where(F.col(date_col).isNull() | (F.col(date_col) <= F.to_date(end)))
    if history_hours is None:
        return df
    start = ntz_literal(as_of) - F.make_dt_interval(F.lit(0), F.lit(int(history_hours)))
    out = df.where(F.col(ts_col) >= start)
    if date_col in df.columns:
        out = out.where(F.col(date_col) >= F.to_date(start))
    return out


def _cutoff(as_of, lookback_minutes: int) -> Column:
    return ntz_literal(as_of) - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(int(lookback_minutes)))


# --- latest per key ---------------------------------------------------------------------------------------

def latest_vehicles(positions: DataFrame) -> DataFrame:
    """Latest GPS row of every vehicle."""
    cols = ["vehicle_id", "trip_id", "latitude", "longitude", "route_id", "gps_timestamp"]
    return latest_per_key(positions.select(*cols), ["vehicle_id"], vehicle_order())


def latest_delay(updates: DataFrame, route: str | None = None) -> DataFrame:
    """Latest delay of every trip (optionally only routes starting with ``route``)."""
    src = _route_prefix(updates.where(F.col("delay_seconds").isNotNull()), route)
    return latest_per_key(src.select("trip_id", "route_id", "delay_seconds", "stop_id", "loaded_at"),
                          ["trip_id"], update_order()).drop("stop_id")


def previous_delay(updates: DataFrame, as_of, lookback_minutes: int = 25, route: str | None = None) -> DataFrame:
    """Latest delay of every trip strictly before ``as_of - lookback``."""
    src = _route_prefix(updates.where(F.col("delay_seconds").isNotNull()), route)
    src = src.where(F.col("loaded_at") < _cutoff(as_of, lookback_minutes))
    return (latest_per_key(src.select("trip_id", "route_id", "delay_seconds", "stop_id", "loaded_at"),
                           ["trip_id"], update_order())
            .select("trip_id", F.col("delay_seconds").alias("prev_delay_seconds"),
                    F.col("loaded_at").alias("prev_loaded_at")))


def latest_positions(positions: DataFrame) -> DataFrame:
    """Latest GPS position of every trip."""
    return latest_per_key(positions.select("trip_id", "latitude", "longitude", "gps_timestamp"),
                          ["trip_id"], position_order())


# --- trend ------------------------------------------------------------------------------------------------

def delay_trend(updates: DataFrame, as_of, lookback_minutes: int = 25, route: str | None = None,
                history_hours: int | None = None, with_route: bool = True) -> DataFrame:
    """Latest delay per trip against the latest one before ``as_of - lookback``: band, trend and change.

    One hash aggregate computes both as greatest numbers of time and delay (the previous one over the rows before the
    cut-off): one scan, and one shuffle of one row per trip and task. The latest update's route is found in a second
    step over one row per trip and route; without ``with_route`` that step and the column fall away and the result is
    partitioned by trip. Of updates with equal time the larger delay counts, then the greater route id.
    ``history_hours`` limits the scan to recent rows (see ``recent``); None reads the whole history.
    """
    src = _route_prefix(recent(updates, as_of, history_hours).where(F.col("delay_seconds").isNotNull()), route)
    before = F.col("loaded_at") < _cutoff(as_of, lookback_minutes)
    keys = ["trip_id", "route_id"] if with_route else ["trip_id"]
    g = src.groupBy(*keys).agg(F.max(_update_number()).alias("_cur"),
                               F.max(F.when(before, _update_number())).alias("_prev"),
                               F.max("loaded_at").alias("_at"), F.max(F.col("loaded_at").isNull()).alias("_timeless"))
    if with_route:
        of_trip = Window.partitionBy("trip_id")
        g = (g.withColumn("_prev", F.max("_prev").over(of_trip))
             .withColumn("_rn", F.row_number().over(of_trip.orderBy(F.desc("_cur"), F.col("route_id").desc_nulls_last())))
             .where("_rn = 1"))
    return g.select(*keys, *_trend_columns())


def _trend_columns() -> list[Column]:
    """The trend report's values from ``_cur``, ``_prev`` (numbers of time and delay), ``_at`` and ``_timeless``."""
    cur, prev = _delay_of(F.col("_cur")), _delay_of(F.col("_prev"))
    return [cur.alias("delay_seconds"),
            to_minutes(cur).alias("avg_delay_minutes"),
            delay_category(cur).alias("delay_category"),
            F.when(~F.col("_timeless"), F.col("_at")).alias("loaded_at"),
            prev.alias("prev_delay_seconds"),
            to_minutes(prev).alias("prev_delay_minutes"),
            trend(cur, prev).alias("trend"),
            trend_change_minutes(cur, prev).alias("trend_change_minutes")]


def delay_trend_series(updates: DataFrame, start, step_seconds: int, count: int, lookback_minutes: int = 25,
                       route: str | None = None) -> DataFrame:
    """``delay_trend`` (without route) at ``count`` times from ``start`` on, ``step_seconds`` apart: one row per time and
    trip seen by then, with the time as ``as_of``; equal to one run per time over the whole history.

    The history is read once, whatever the number of times. An update first counts as the latest at one time of the
    series and as the previous one at another: a hash aggregate keeps the greatest number of time and delay per trip and
    such time (combined before its shuffle, so a trip with a third of all rows ships at most ``count`` rows per task).
    Then running maxima over the few entries of each trip, and each entry is written out for the times up to the next.
    """
    step, count = int(step_seconds), int(count)
    if step <= 0 or count <= 0:
        raise ValueError("step_seconds and count must be positive")
    first = ntz_literal(start)
    last = first + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(step * (count - 1)))
    at = F.col("loaded_at")
    src = _route_prefix(updates.where(F.col("delay_seconds").isNotNull() & (at.isNull() | (at <= last))), route)
    micros = step * 1_000_000
    since_start = F.timestamp_diff("MICROSECOND", first, at)
    since_cutoff = since_start + int(lookback_minutes) * 60_000_000
    # The first time not before the update (0 without a time), and the first whose cut-off lies after it (null without).
    latest_from = F.coalesce(F.greatest(F.ceil(since_start / F.lit(micros).cast("decimal(20,0)")).cast("long"), F.lit(0)), F.lit(0))
    previous_from = F.when(at.isNotNull(), F.greatest(
        F.floor(since_cutoff / F.lit(micros).cast("decimal(20,0)")).cast("long") + 1, F.lit(0)))
    number = _update_number()
    latest = F.struct(latest_from.alias("slot"), number.alias("cur"), F.lit(None).cast("decimal(38,0)").alias("prev"),
                      at.alias("at"), at.isNull().alias("timeless"))
    previous = F.struct(previous_from.alias("slot"), F.lit(None).alias("cur"), number.alias("prev"),
                        F.lit(None).alias("at"), F.lit(None).alias("timeless"))
    g = (src.select("trip_id", F.explode(F.array(latest, previous)).alias("e")).select("trip_id", "e.*")
         .where(F.col("slot") < count)
         .groupBy("trip_id", "slot")
         .agg(*[F.max(c).alias(c) for c in ("cur", "prev", "at", "timeless")]))
    of_trip = Window.partitionBy("trip_id").orderBy("slot")
    until = of_trip.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = g.select("trip_id", "slot", *[F.max(c).over(until).alias(f"_{c}") for c in ("cur", "prev", "at", "timeless")],
                   F.lead("slot", 1, count).over(of_trip).alias("next")).where(F.col("_cur").isNotNull())
    slots = F.sequence(F.col("slot"), F.col("next") - 1)
    out = run.select("trip_id", *_trend_columns(), F.explode(slots).alias("slot"))
    as_of = first + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("slot") * step)
    return out.select(as_of.alias("as_of"), *[c for c in out.columns if c != "slot"])


def delays(updates: DataFrame, positions: DataFrame, as_of, category: str | None = None,
           route: str | None = None, limit: int | None = 5000, lookback_minutes: int = 25,
           history_hours: int | None = None) -> DataFrame:
    """Trips with their latest delay, band and trend, and their last position; newest first.

    ``category`` is matched lower-cased; an unknown category filters nothing. ``route`` is a literal route
    prefix. ``limit`` is the report size (at most 10,000); the order is ``loaded_at`` desc, then trip id.
    ``limit=None`` returns every trip unordered (the input of the live-map operators at full scale).
    As in the published report, ``route_id`` carries the trip id; ``trip_id`` is the same value.
    """
    if limit is not None:
        limit = int(limit)
        if limit < 0 or limit > MAX_DELAYS_LIMIT:
            raise ValueError(f"limit must be between 0 and {MAX_DELAYS_LIMIT}")
    t = delay_trend(updates, as_of, lookback_minutes, route, history_hours, with_route=False)
    if category and category.lower() in CATEGORIES:
        t = t.where(F.col("delay_category") == F.lit(category.lower()))
    lp = latest_positions(recent(positions, as_of, history_hours))
    joined = t.join(lp, "trip_id", "left")
    out = joined.select(
        F.col("trip_id").alias("route_id"), "trip_id", "avg_delay_minutes", "delay_category", "trend",
        "trend_change_minutes", "prev_delay_minutes",
        F.col("latitude").alias("last_lat"), F.col("longitude").alias("last_lon"),
        F.col("gps_timestamp").alias("last_seen"), "loaded_at")
    if limit is None:
        return out
    return out.orderBy(F.col("loaded_at").desc_nulls_first(), F.col("trip_id")).limit(limit)


def delays_summary(updates: DataFrame, positions: DataFrame, as_of, keep_empty: bool = False,
                   lookback_minutes: int = 25, history_hours: int | None = None) -> DataFrame:
    """Trips per current band, how many of them have a GPS position, the count in the previous window and
    the change; in band order.

    ``keep_empty=False`` lists only bands present now (bands present only before are dropped, as published);
    ``keep_empty=True`` lists all six bands.
    """
    t = delay_trend(updates, as_of, lookback_minutes, history_hours=history_hours, with_route=False)
    gps = (recent(positions, as_of, history_hours).select("trip_id").where(F.col("trip_id").isNotNull())
           .distinct().withColumn("has_gps", F.lit(1)))
    # Each trip counts once in its band now and once in its band before: one pass over the trend.
    none, one = F.lit(0), F.lit(1)
    now = F.struct("delay_category", one.alias("count"), F.coalesce("has_gps", none).alias("mappable_count"),
                   none.alias("prev_count"))
    before = F.struct(delay_category("prev_delay_seconds").alias("delay_category"), none.alias("count"),
                      none.alias("mappable_count"), one.alias("prev_count"))
    counts = ("count", "mappable_count", "prev_count")
    bands = (t.join(gps, "trip_id", "left")
             .select(F.explode(F.array(now, F.when(F.col("prev_delay_seconds").isNotNull(), before))).alias("b"))
             .where(F.col("b").isNotNull()).select("b.*").groupBy("delay_category")
             .agg(*[F.sum(c).cast("long").alias(c) for c in counts]))
    if keep_empty:
        # At most six rows on either side (one per band).
        names = delay_bands(updates.sparkSession).select(F.col("category").alias("delay_category"))
        bands = F.broadcast(names).join(F.broadcast(bands), "delay_category", "left") \
            .select("delay_category", *[F.coalesce(c, none).cast("long").alias(c) for c in counts])
    else:
        bands = bands.where(F.col("count") > 0)
    out = bands.select("delay_category", *counts, (F.col("count") - F.col("prev_count")).alias("change"))
    return out.orderBy(display_order("delay_category"))


def total_trips(summary: DataFrame) -> DataFrame:
    return summary.agg(F.coalesce(F.sum("count"), F.lit(0)).cast("long").alias("total_trips"))


def routes(updates: DataFrame) -> DataFrame:
    """Route codes with their number of distinct trips."""
    return (updates.groupBy(route_code("route_id").alias("route_code"))
            .agg(F.count_distinct("trip_id").cast("long").alias("trip_count"))
            .orderBy("route_code"))


def trip_history(updates: DataFrame, trip_id: str, limit: int = 20) -> DataFrame:
    """The newest ``limit`` delay records of one trip."""
    return (updates.where(F.col("trip_id") == F.lit(trip_id))
            .select("trip_id", "route_id", "delay_seconds", to_minutes("delay_seconds").alias("delay_minutes"),
                    "loaded_at", "stop_id")
            .orderBy(F.col("loaded_at").desc_nulls_first(), F.col("delay_seconds").desc_nulls_last(),
                     F.col("stop_id").desc_nulls_last())
            .limit(int(limit))
            .drop("stop_id"))


# --- gold reports -----------------------------------------------------------------------------------------

WORST_ROUTE_COLUMNS = ("route_code", "day_name", "time_period", "avg_delay", "avg_on_time_pct",
                       "total_critical_delays", "total_severe_delays", "performance_tier", "worst_rank")


def worst_routes(worst: DataFrame, day: int | None = None, period: str | None = None, limit: int = 20) -> DataFrame:
    """Worst-ranked routes, optionally for one weekday (0 = Sunday) and/or period."""
    df = worst
    if day is not None:
        df = df.where(F.col("day_of_week") == F.lit(int(day)))
    if period:
        df = df.where(F.col("time_period") == F.lit(period))
    return (df.orderBy("worst_rank", "day_of_week", "time_period", "route_code")
            .limit(int(limit))
            .select(*WORST_ROUTE_COLUMNS))


def network_health(summary: DataFrame) -> DataFrame:
    """Network health by weekday, then in fixed period order."""
    return (summary.orderBy("day_of_week", period_order("time_period"))
            .select("day_name", "time_period", "active_routes", "total_trips", "network_avg_delay",
                    "network_on_time_pct", "network_health_score", "network_health_status"))


# --- data checks ------------------------------------------------------------------------------------------

def delay_distribution(bronze_updates: DataFrame) -> DataFrame:
    """Counts of bronze trip updates by delay sign (zero / positive / negative / missing)."""
    raw = F.get_json_object("raw_data", "$.delay")
    d = raw.try_cast("int")
    return bronze_updates.agg(
        F.count(F.lit(1)).cast("long").alias("total_records"),
        F.count_if(d == 0).cast("long").alias("zero_delay"),
        F.count_if(d > 0).cast("long").alias("positive_delay"),
        F.count_if(d < 0).cast("long").alias("negative_delay"),
        F.count_if(raw.isNull()).cast("long").alias("null_delay"))


def gps_delay_coverage(bronze_positions: DataFrame, bronze_updates: DataFrame) -> DataFrame:
    """Distinct trips with a GPS row, how many of them also have a delay row, and the difference.

    Both sides are reduced to distinct trip ids before the join, so there is no fan-out.
    """
    vp = bronze_positions.select(F.col("trip_id").alias("vp_trip")).where(F.col("vp_trip").isNotNull()).distinct()
    tu = bronze_updates.select(F.col("trip_id").alias("tu_trip")).where(F.col("tu_trip").isNotNull()).distinct()
    j = vp.join(tu, vp.vp_trip == tu.tu_trip, "left")
    return j.agg(F.count("vp_trip").cast("long").alias("vehicles_with_gps"),
                 F.count("tu_trip").cast("long").alias("vehicles_with_delay"),
                 (F.count("vp_trip") - F.count("tu_trip")).cast("long").alias("vehicles_without_delay"))
