"""Independent DuckDB SQL for every registered query (the correctness oracle).

The SQL starts from the ``events`` view and follows the fixture mapping directly (FIXTURES.md), without the
nested feed, so it also checks the flattening. Exact rounding uses integer arithmetic:
``rr(n, d) = sign(n) * ((2|n| + d) // (2d))`` is ``round(n / d)`` half away from zero for ``d > 0``.
"""

from __future__ import annotations

import csv
import os
import re

AS_OF = "TIMESTAMP '2024-01-10 00:00:00'"
CUT = f"({AS_OF} - INTERVAL 7200 MINUTE)"
SPLIT = "TIMESTAMP '2024-01-15 00:00:00'"
NULLKEY = "'_dbt_utils_surrogate_key_null_'"


def rr(num: str, den: str) -> str:
    return f"(sign({num}) * ((2 * abs({num}) + ({den})) // (2 * ({den}))))"


def cents(sec: str) -> str:
    return f"(CASE WHEN {sec} >= 0 THEN (5 * {sec} + 1) // 3 ELSE -((5 * (-{sec}) + 1) // 3) END)"


def minutes(sec: str) -> str:
    return f"(CAST({cents(sec)} AS BIGINT) / 100.0)"


def band(sec: str) -> str:
    return (f"(CASE WHEN {sec} < 0 THEN 'early' WHEN {sec} <= 120 THEN 'on_time' WHEN {sec} <= 300 THEN 'minor' "
            f"WHEN {sec} <= 600 THEN 'moderate' WHEN {sec} <= 1200 THEN 'severe' ELSE 'critical' END)")


def clean(r: str) -> str:
    return (f"(CASE WHEN {r} IS NULL OR {r} = '' THEN 'N/A' "
            f"WHEN strpos({r}, ' ') > 0 THEN upper(split_part({r}, ' ', 2)) "
            f"WHEN strpos({r}, '-') > 0 THEN upper(split_part({r}, '-', 2)) "
            f"WHEN strpos({r}, '_') > 0 THEN split_part({r}, '_', 1) ELSE {r} END)")


def skey(*parts: str) -> str:
    return "md5(" + " || '-' || ".join(f"coalesce(CAST({p} AS VARCHAR), {NULLKEY})" for p in parts) + ")"


def latest(src: str, keys: str, order: str, cols: str = "*") -> str:
    return (f"(SELECT {cols} FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn_ "
            f"FROM {src}) WHERE rn_ = 1)")


UPD_ORDER = "loaded_at DESC NULLS FIRST, delay_seconds DESC NULLS LAST, stop_id DESC NULLS LAST, route_id DESC NULLS LAST"
POS_ORDER = "gps_timestamp DESC NULLS FIRST, latitude DESC NULLS LAST, longitude DESC NULLS LAST"
VEH_ORDER = ("gps_timestamp DESC NULLS FIRST, trip_id DESC NULLS LAST, latitude DESC NULLS LAST, "
             "longitude DESC NULLS LAST")
LAT = "(53.2::DOUBLE + (event_id % 400) / 1000.0)"
LON = "(-6.45::DOUBLE + (event_id % 500) / 1000.0)"
VEHICLE_TYPES = "('click', 'view', 'purchase')"

CTES: dict[str, str] = {}
CTES["base"] = """SELECT event_id, ts, event_type,
    CAST(user_id AS VARCHAR) AS vehicle_id,
    CAST(user_id AS VARCHAR) || '_' || event_type AS trip_id,
    'R' || CAST(user_id % 40 AS VARCHAR) || '_' || CAST(user_id % 3 AS VARCHAR) AS route_id,
    CAST(props->>'$.k' AS INTEGER) AS k,
    CAST(dayofweek(ts) AS INTEGER) AS dow,
    date_trunc('second', ts) AS obs_ts
  FROM events"""
CTES["based"] = "SELECT *, CASE WHEN event_id % 31 = 0 THEN 0 ELSE CAST((k * k * (2 + dow)) // 100 - 60 + greatest(k - 89, 0) * 120 AS INTEGER) END AS d\n  FROM base"
CTES["bvp"] = f"""SELECT vehicle_id, trip_id, route_id,
    CASE WHEN event_id % 17 <> 0
      THEN '{{"lat":' || CAST({LAT} AS VARCHAR) || ',"lon":' || CAST({LON} AS VARCHAR) || ','
      ELSE '{{' END
    || '"timestamp":' || CAST(CAST(epoch(obs_ts) AS BIGINT) AS VARCHAR) || ',"route_id":"' || route_id || '"}}' AS raw_data,
    obs_ts AS ingestion_timestamp, event_id
  FROM based WHERE event_type IN {VEHICLE_TYPES}"""
CTES["btu"] = """SELECT trip_id, route_id,
    '{"delay":' || CAST(d AS VARCHAR) || ',"stop_id":"S' || CAST(event_id % 97 AS VARCHAR) || '"}' AS raw_data,
    obs_ts AS ingestion_timestamp
  FROM based WHERE event_id % 23 <> 0 AND event_id % 29 <> 0"""
CTES["btu0"] = """SELECT trip_id, route_id,
    '{"delay":' || CAST(CASE WHEN event_id % 23 = 0 THEN 0 ELSE d END AS VARCHAR)
      || ',"stop_id":"S' || CAST(event_id % 97 AS VARCHAR) || '"}' AS raw_data,
    obs_ts AS ingestion_timestamp
  FROM based WHERE event_id % 29 <> 0"""
CTES["svp"] = f"""SELECT vehicle_id, trip_id, {LAT} AS latitude, {LON} AS longitude, route_id,
    obs_ts AS gps_timestamp, obs_ts AS loaded_at
  FROM based WHERE event_type IN {VEHICLE_TYPES} AND event_id % 17 <> 0"""
CTES["stu"] = """SELECT trip_id, route_id, d AS delay_seconds, 'S' || CAST(event_id % 97 AS VARCHAR) AS stop_id,
    obs_ts AS loaded_at
  FROM based WHERE event_id % 23 <> 0 AND event_id % 29 <> 0"""
CTES["fact"] = f"""SELECT {skey('trip_id', 'loaded_at')} AS delay_record_id,
    trip_id, route_id, split_part(route_id, '_', 1) AS route_code, delay_seconds,
    {minutes('delay_seconds')} AS delay_minutes, {band('delay_seconds')} AS delay_category, stop_id,
    loaded_at AS recorded_at, CAST(loaded_at AS DATE) AS record_date, CAST(hour(loaded_at) AS INTEGER) AS record_hour,
    CAST(dayofweek(loaded_at) AS INTEGER) AS day_of_week, dayname(loaded_at) AS day_name,
    CASE WHEN hour(loaded_at) BETWEEN 7 AND 9 THEN 'morning_rush' WHEN hour(loaded_at) BETWEEN 12 AND 14 THEN 'lunch'
         WHEN hour(loaded_at) BETWEEN 16 AND 19 THEN 'evening_rush'
         WHEN hour(loaded_at) >= 22 OR hour(loaded_at) <= 5 THEN 'night' ELSE 'off_peak' END AS time_period,
    {cents('delay_seconds')} AS c
  FROM stu"""
CTES["hourly"] = f"""SELECT {skey('route_code', 'record_date', 'record_hour')} AS performance_id,
    route_code, record_date, record_hour, day_of_week, day_name, time_period,
    CAST(count(*) AS BIGINT) AS total_observations,
    CAST(count(DISTINCT trip_id) AS BIGINT) AS unique_trips,
    CAST({rr('sum(c)', 'count(*)')} AS BIGINT) AS avg_c,
    CAST({rr('sum(c)', 'count(*)')} AS BIGINT) / 100.0 AS avg_delay_minutes,
    CAST(round(quantile_cont(c, 0.5)) AS BIGINT) / 100.0 AS median_delay_minutes,
    max(c) / 100.0 AS max_delay_minutes,
    min(c) / 100.0 AS min_delay_minutes,
    CAST(round(CAST(coalesce(stddev_samp(c) / 100.0, 0) AS DECIMAL(18,6)), 2) AS DOUBLE) AS stddev_delay_minutes,
    CAST(count(*) FILTER (WHERE delay_category = 'early') AS BIGINT) AS early_count,
    CAST(count(*) FILTER (WHERE delay_category = 'on_time') AS BIGINT) AS on_time_count,
    CAST(count(*) FILTER (WHERE delay_category = 'minor') AS BIGINT) AS minor_count,
    CAST(count(*) FILTER (WHERE delay_category = 'moderate') AS BIGINT) AS moderate_count,
    CAST(count(*) FILTER (WHERE delay_category = 'severe') AS BIGINT) AS severe_count,
    CAST(count(*) FILTER (WHERE delay_category = 'critical') AS BIGINT) AS critical_count,
    CAST({rr("10000 * count(*) FILTER (WHERE delay_category IN ('early', 'on_time'))", 'count(*)')} AS BIGINT) AS pct_c,
    CAST({rr("10000 * count(*) FILTER (WHERE delay_category IN ('early', 'on_time'))", 'count(*)')} AS BIGINT) / 100.0
      AS on_time_percentage,
    max(recorded_at) AS last_updated,
    max(c) AS max_c
  FROM fact GROUP BY route_code, record_date, record_hour, day_of_week, day_name, time_period"""
CTES["rps"] = f"""SELECT route_code, day_of_week, day_name, time_period,
    CAST(count(*) AS BIGINT) AS observation_hours,
    CAST(sum(total_observations) AS BIGINT) AS total_observations,
    CAST(sum(unique_trips) AS BIGINT) AS total_trips,
    CAST({rr('sum(avg_c * total_observations)', 'sum(total_observations)')} AS BIGINT) / 100.0 AS avg_delay,
    CAST({rr('sum(pct_c)', 'count(*)')} AS BIGINT) / 100.0 AS avg_on_time_pct,
    CAST(sum(critical_count) AS BIGINT) AS total_critical_delays,
    CAST(sum(severe_count) AS BIGINT) AS total_severe_delays,
    CAST(sum(moderate_count) AS BIGINT) AS total_moderate_delays,
    max(max_c) / 100.0 AS worst_delay_minutes
  FROM hourly GROUP BY route_code, day_of_week, day_name, time_period HAVING count(*) >= 2"""
CTES["ranked"] = """SELECT *,
    CAST(row_number() OVER (PARTITION BY day_of_week, time_period ORDER BY avg_delay DESC, route_code) AS INTEGER) AS worst_rank,
    CAST(row_number() OVER (PARTITION BY day_of_week, time_period ORDER BY avg_on_time_pct DESC, route_code) AS INTEGER) AS best_rank,
    CAST(count(*) OVER (PARTITION BY day_of_week, time_period) AS BIGINT) AS total_routes_in_period
  FROM rps"""
CTES["worst"] = """SELECT *, CASE WHEN worst_rank <= 5 THEN 'worst_performer' WHEN best_rank <= 5 THEN 'best_performer'
    WHEN worst_rank * 4 <= total_routes_in_period THEN 'below_average'
    WHEN best_rank * 4 <= total_routes_in_period THEN 'above_average' ELSE 'average' END AS performance_tier
  FROM ranked"""
CTES["netp"] = f"""SELECT day_of_week, day_name, time_period,
    CAST(count(DISTINCT route_code) AS BIGINT) AS active_routes,
    CAST(sum(total_observations) AS BIGINT) AS total_observations,
    CAST(sum(unique_trips) AS BIGINT) AS total_trips,
    CAST({rr('sum(avg_c)', 'count(*)')} AS BIGINT) / 100.0 AS network_avg_delay,
    CAST({rr('sum(pct_c)', 'count(*)')} AS BIGINT) / 100.0 AS network_on_time_pct,
    CAST(sum(critical_count) AS BIGINT) AS network_critical_count,
    CAST(sum(severe_count) AS BIGINT) AS network_severe_count,
    max(max_c) / 100.0 AS worst_delay_in_network
  FROM hourly GROUP BY day_of_week, day_name, time_period"""
CTES["network"] = """SELECT *,
    CAST(round(CAST(greatest(0.0::DOUBLE, least(100.0::DOUBLE,
        network_on_time_pct * 0.6::DOUBLE
        + (100.0::DOUBLE - least(network_avg_delay * 2.0::DOUBLE, 50.0::DOUBLE)) * 0.3::DOUBLE
        + (100.0::DOUBLE - least(CAST(network_critical_count AS DOUBLE) / CAST(nullif(total_trips, 0) AS DOUBLE)
                                 * 1000.0::DOUBLE, 50.0::DOUBLE)) * 0.1::DOUBLE)) AS DECIMAL(18,6)), 2) AS DOUBLE)
      AS network_health_score,
    CASE WHEN network_on_time_pct >= 80 AND network_avg_delay <= 5 THEN 'excellent'
         WHEN network_on_time_pct >= 70 AND network_avg_delay <= 10 THEN 'good'
         WHEN network_on_time_pct >= 60 AND network_avg_delay <= 15 THEN 'fair'
         WHEN network_on_time_pct >= 50 THEN 'poor' ELSE 'critical' END AS network_health_status
  FROM netp"""
CTES["lat"] = "SELECT trip_id, route_id, delay_seconds, loaded_at FROM " + latest(
    "(SELECT * FROM stu WHERE delay_seconds IS NOT NULL)", "trip_id", UPD_ORDER) + " AS x"
CTES["prv"] = ("SELECT trip_id, delay_seconds AS prev_delay_seconds, loaded_at AS prev_loaded_at FROM " + latest(
    f"(SELECT * FROM stu WHERE delay_seconds IS NOT NULL AND loaded_at < {CUT})", "trip_id", UPD_ORDER) + " AS x")
# What a report at AS_OF may see.
CTES["stua"] = f"SELECT * FROM stu WHERE loaded_at <= {AS_OF}"
CTES["svpa"] = f"SELECT * FROM svp WHERE loaded_at <= {AS_OF}"
CTES["lata"] = CTES["lat"].replace("FROM stu", "FROM stua")
CTES["lposa"] = ("SELECT trip_id, latitude, longitude, gps_timestamp FROM " + latest("svpa", "trip_id", POS_ORDER)
                 + " AS x")
CTES["trend"] = f"""SELECT l.trip_id, l.route_id, l.delay_seconds, {minutes('l.delay_seconds')} AS avg_delay_minutes,
    {band('l.delay_seconds')} AS delay_category, l.loaded_at, p.prev_delay_seconds,
    {minutes('p.prev_delay_seconds')} AS prev_delay_minutes,
    CASE WHEN p.prev_delay_seconds IS NULL THEN 'new' WHEN l.delay_seconds > p.prev_delay_seconds + 60 THEN 'worsening'
         WHEN l.delay_seconds < p.prev_delay_seconds - 60 THEN 'improving' ELSE 'stable' END AS trend,
    CAST({rr('(l.delay_seconds - p.prev_delay_seconds)', '6')} AS BIGINT) / 10.0 AS trend_change_minutes
  FROM lata l LEFT JOIN prv p ON l.trip_id = p.trip_id"""
CTES["lpos"] = "SELECT trip_id, latitude, longitude, gps_timestamp FROM " + latest("svp", "trip_id", POS_ORDER) + " AS x"
CTES["delays"] = """SELECT t.trip_id AS route_id, t.trip_id, t.avg_delay_minutes, t.delay_category, t.trend,
    t.trend_change_minutes, t.prev_delay_minutes, p.latitude AS last_lat, p.longitude AS last_lon,
    p.gps_timestamp AS last_seen, t.loaded_at
  FROM trend t LEFT JOIN lposa p ON t.trip_id = p.trip_id
  ORDER BY t.loaded_at DESC NULLS FIRST, t.trip_id LIMIT 5000"""
CTES["alld"] = """SELECT t.trip_id AS route_id, t.trip_id, t.avg_delay_minutes, t.delay_category, t.trend,
    t.trend_change_minutes, t.prev_delay_minutes, p.latitude AS last_lat, p.longitude AS last_lon,
    p.gps_timestamp AS last_seen, t.loaded_at
  FROM trend t LEFT JOIN lposa p ON t.trip_id = p.trip_id"""
CTES["veh"] = ("SELECT vehicle_id, trip_id, latitude, longitude, route_id, gps_timestamp FROM "
               + latest("svp", "vehicle_id", VEH_ORDER) + " AS x")
CTES["veha"] = CTES["veh"].replace("FROM svp)", "FROM svpa)")
CTES["vkeys"] = """SELECT DISTINCT k AS match_key FROM (SELECT route_id AS k FROM veha UNION ALL SELECT trip_id FROM veha)
  WHERE k IS NOT NULL"""
CTES["ghosts"] = "SELECT * FROM alld d WHERE NOT EXISTS (SELECT 1 FROM veha v WHERE v.route_id = d.route_id OR v.trip_id = d.route_id)"
CTES["lives"] = "SELECT * FROM alld d WHERE EXISTS (SELECT 1 FROM veha v WHERE v.route_id = d.route_id OR v.trip_id = d.route_id)"
CTES["worstclean"] = (f"SELECT clean_route, route_id, avg_delay_minutes, delay_category, trend, trend_change_minutes, "
                      f"loaded_at FROM " + latest(
                          f"(SELECT {clean('route_id')} AS clean_route, * FROM alld)", "clean_route",
                          "abs(avg_delay_minutes) DESC NULLS LAST, loaded_at DESC NULLS FIRST, route_id") + " AS x")
CTES["vinfo"] = f"""SELECT v.vehicle_id, v.trip_id, v.route_id, v.latitude, v.longitude, v.gps_timestamp,
    {clean('v.route_id')} AS clean_route,
    coalesce(d1.avg_delay_minutes, d2.avg_delay_minutes, w.avg_delay_minutes, 0.0) AS delay_minutes,
    CASE WHEN d1.route_id IS NOT NULL THEN d1.delay_category WHEN d2.route_id IS NOT NULL THEN d2.delay_category
         WHEN w.clean_route IS NOT NULL THEN w.delay_category ELSE 'on_time' END AS delay_category,
    CASE WHEN d1.route_id IS NOT NULL THEN d1.trend WHEN d2.route_id IS NOT NULL THEN d2.trend
         WHEN w.clean_route IS NOT NULL THEN w.trend ELSE 'stable' END AS trend,
    CASE WHEN d1.route_id IS NOT NULL THEN d1.trend_change_minutes WHEN d2.route_id IS NOT NULL THEN d2.trend_change_minutes
         WHEN w.clean_route IS NOT NULL THEN w.trend_change_minutes END AS trend_change_minutes,
    CASE WHEN d1.route_id IS NOT NULL THEN 'trip' WHEN d2.route_id IS NOT NULL THEN 'route'
         WHEN w.clean_route IS NOT NULL THEN 'clean_route' ELSE 'default' END AS matched_by
  FROM veha v LEFT JOIN alld d1 ON d1.route_id = v.trip_id
             LEFT JOIN alld d2 ON d2.route_id = v.route_id
             LEFT JOIN worstclean w ON w.clean_route = {clean('v.route_id')}"""
CTES["rdesc"] = """SELECT 'R' || CAST(i AS VARCHAR) AS route_code,
    'Stop ' || CAST(i AS VARCHAR) || ' - Stop ' || CAST(i + 40 AS VARCHAR) AS description
  FROM range(40) t(i) WHERE i % 7 <> 3"""
CTES["summ"] = """SELECT c.delay_category, c.count, c.mappable_count, coalesce(p.prev_count, 0) AS prev_count,
    c.count - coalesce(p.prev_count, 0) AS change
  FROM (SELECT t.delay_category, CAST(count(*) AS BIGINT) AS count,
               CAST(sum(CASE WHEN g.trip_id IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS mappable_count
        FROM trend t LEFT JOIN (SELECT DISTINCT trip_id FROM svpa) g ON t.trip_id = g.trip_id
        GROUP BY t.delay_category) c
  LEFT JOIN (SELECT delay_category, CAST(count(*) AS BIGINT) AS prev_count FROM
               (SELECT """ + band("prev_delay_seconds") + """ AS delay_category FROM prv) GROUP BY delay_category) p
    ON c.delay_category = p.delay_category"""


def with_ctes(body: str) -> str:
    """Prefix ``body`` with the CTEs it needs (transitively), in definition order."""
    names = list(CTES)
    need: set[str] = set()

    def visit(text: str) -> None:
        for n in names:
            if n not in need and re.search(rf"\b{n}\b", text):
                need.add(n)
                visit(CTES[n])

    visit(body)
    ordered = [n for n in names if n in need]
    if not ordered:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in ordered) + "\n" + body


HOURLY_COLS = ("performance_id, route_code, record_date, record_hour, day_of_week, day_name, time_period, "
               "total_observations, unique_trips, avg_delay_minutes, median_delay_minutes, max_delay_minutes, "
               "min_delay_minutes, stddev_delay_minutes, early_count, on_time_count, minor_count, moderate_count, "
               "severe_count, critical_count, on_time_percentage, last_updated")
FACT_COLS = ("delay_record_id, trip_id, route_id, route_code, delay_seconds, delay_minutes, delay_category, stop_id, "
             "recorded_at, record_date, record_hour, day_of_week, day_name, time_period")
RPS_COLS = ("route_code, day_of_week, day_name, time_period, observation_hours, total_observations, total_trips, "
            "avg_delay, avg_on_time_pct, total_critical_delays, total_severe_delays, total_moderate_delays, "
            "worst_delay_minutes")
DELAY_COLS = ("route_id, trip_id, avg_delay_minutes, delay_category, trend, trend_change_minutes, prev_delay_minutes, "
              "last_lat, last_lon, last_seen, loaded_at")


def _delays_variant(where_src: str = "", where_out: str = "") -> str:
    """The delays report with a route prefix on the sources and/or a category filter on the output."""
    lat = latest(f"(SELECT * FROM stua WHERE delay_seconds IS NOT NULL {where_src})", "trip_id", UPD_ORDER)
    prv = latest(f"(SELECT * FROM stu WHERE delay_seconds IS NOT NULL AND loaded_at < {CUT} {where_src})",
                 "trip_id", UPD_ORDER)
    return f"""SELECT l.trip_id AS route_id, l.trip_id, {minutes('l.delay_seconds')} AS avg_delay_minutes,
    {band('l.delay_seconds')} AS delay_category,
    CASE WHEN p.delay_seconds IS NULL THEN 'new' WHEN l.delay_seconds > p.delay_seconds + 60 THEN 'worsening'
         WHEN l.delay_seconds < p.delay_seconds - 60 THEN 'improving' ELSE 'stable' END AS trend,
    CAST({rr('(l.delay_seconds - p.delay_seconds)', '6')} AS BIGINT) / 10.0 AS trend_change_minutes,
    {minutes('p.delay_seconds')} AS prev_delay_minutes,
    q.latitude AS last_lat, q.longitude AS last_lon, q.gps_timestamp AS last_seen, l.loaded_at
  FROM {lat} l LEFT JOIN {prv} p ON l.trip_id = p.trip_id LEFT JOIN lposa q ON l.trip_id = q.trip_id
  WHERE 1 = 1 {where_out}
  ORDER BY l.loaded_at DESC NULLS FIRST, l.trip_id LIMIT 5000"""


STREAM_HOURLY = """SELECT route_code, record_date, record_hour, day_of_week, day_name, time_period,
        total_observations, unique_trips, avg_delay_minutes, max_delay_minutes, min_delay_minutes,
        stddev_delay_minutes, early_count, on_time_count, minor_count, moderate_count, severe_count, critical_count,
        on_time_percentage, last_updated
      FROM hourly
      WHERE CAST(record_date AS TIMESTAMP) + to_hours(record_hour + 1)
            <= (SELECT max(recorded_at) FROM fact) - INTERVAL 2 HOUR"""

TREND_SERIES = f"""WITH times AS (SELECT TIMESTAMP '2024-01-06' + i * INTERVAL 6 HOUR AS as_of FROM range(0, 17) r(i)),
      cur AS (SELECT as_of, trip_id, delay_seconds, loaded_at FROM times JOIN stu ON loaded_at <= as_of
              WHERE delay_seconds IS NOT NULL
              QUALIFY row_number() OVER (PARTITION BY as_of, trip_id ORDER BY loaded_at DESC, delay_seconds DESC) = 1),
      old AS (SELECT as_of, trip_id, delay_seconds FROM times JOIN stu ON loaded_at < as_of - INTERVAL 5 DAY
              WHERE delay_seconds IS NOT NULL
              QUALIFY row_number() OVER (PARTITION BY as_of, trip_id ORDER BY loaded_at DESC, delay_seconds DESC) = 1)
      SELECT l.as_of, l.trip_id, l.delay_seconds, {minutes('l.delay_seconds')} AS avg_delay_minutes,
        {band('l.delay_seconds')} AS delay_category, l.loaded_at, p.delay_seconds AS prev_delay_seconds,
        {minutes('p.delay_seconds')} AS prev_delay_minutes,
        CASE WHEN p.delay_seconds IS NULL THEN 'new' WHEN l.delay_seconds > p.delay_seconds + 60 THEN 'worsening'
             WHEN l.delay_seconds < p.delay_seconds - 60 THEN 'improving' ELSE 'stable' END AS trend,
        CAST({rr('(l.delay_seconds - p.delay_seconds)', '6')} AS BIGINT) / 10.0 AS trend_change_minutes
      FROM cur l LEFT JOIN old p ON l.as_of = p.as_of AND l.trip_id = p.trip_id"""

#: The last delivery of the split stream sends the days before the fifth again, behind the watermark of the one before.
LATE_ROWS = f"""SELECT {FACT_COLS}, 2 AS batch_id, w.watermark,
        CAST(date_diff('second', recorded_at, w.watermark) AS BIGINT) AS age_seconds
      FROM fact, (SELECT max(recorded_at) - INTERVAL 2 HOUR AS watermark FROM fact
                  WHERE recorded_at < TIMESTAMP '2024-01-21') w
      WHERE recorded_at < TIMESTAMP '2024-01-05'"""
LATE_HOUR = ("recorded_at >= TIMESTAMP '2024-01-10 23:00:00' AND recorded_at < TIMESTAMP '2024-01-11' "
             "AND event_id % 2 = 1")

BODIES: dict[str, str] = {
    "flatten_vehicle_feed": "SELECT vehicle_id, trip_id, route_id, raw_data, ingestion_timestamp FROM bvp",
    "flatten_trip_feed": "SELECT trip_id, route_id, raw_data, ingestion_timestamp FROM btu",
    "flatten_trip_feed_zero": "SELECT trip_id, route_id, raw_data, ingestion_timestamp FROM btu0",
    "flatten_vehicle_feed_entity_key": """SELECT CAST(event_id AS VARCHAR) AS vehicle_id, trip_id, route_id, raw_data,
        ingestion_timestamp FROM bvp WHERE coalesce(trip_id, '') <> ''""",
    "upsert_vehicle_positions": """SELECT vehicle_id, trip_id,
        arg_min(route_id, ingestion_timestamp::VARCHAR || raw_data) AS route_id,
        arg_max(raw_data, ingestion_timestamp::VARCHAR || raw_data) AS raw_data,
        max(ingestion_timestamp) AS ingestion_timestamp
      FROM bvp GROUP BY vehicle_id, trip_id""",
    "upsert_trip_updates": """SELECT trip_id,
        arg_min(route_id, ingestion_timestamp::VARCHAR || raw_data) AS route_id,
        arg_max(raw_data, ingestion_timestamp::VARCHAR || raw_data) AS raw_data,
        max(ingestion_timestamp) AS ingestion_timestamp
      FROM btu GROUP BY trip_id""",
    "prune_old": f"SELECT * FROM btu WHERE ingestion_timestamp >= {AS_OF} - INTERVAL 24 HOUR",
    "prune_counts": f"""SELECT 'bronze_vehicle_positions' AS table_name,
        CAST(count(*) FILTER (WHERE ingestion_timestamp >= {AS_OF} - INTERVAL 24 HOUR) AS BIGINT) AS kept,
        CAST(count(*) FILTER (WHERE ingestion_timestamp < {AS_OF} - INTERVAL 24 HOUR) AS BIGINT) AS pruned FROM bvp
      UNION ALL SELECT 'bronze_trip_updates',
        CAST(count(*) FILTER (WHERE ingestion_timestamp >= {AS_OF} - INTERVAL 24 HOUR) AS BIGINT),
        CAST(count(*) FILTER (WHERE ingestion_timestamp < {AS_OF} - INTERVAL 24 HOUR) AS BIGINT) FROM btu""",
    "clean_nonfinite": f"""SELECT {DELAY_COLS.replace('avg_delay_minutes', 'cleaned AS avg_delay_minutes')}
      FROM (SELECT *, CASE WHEN CAST(round(abs(avg_delay_minutes) * 100) AS BIGINT) % 7 > 2 THEN avg_delay_minutes END AS cleaned
            FROM alld)""",
    "silver_vehicle_positions": "SELECT * FROM svp",
    "silver_trip_updates": "SELECT * FROM stu",
    "silver_vehicle_positions_gps": "SELECT vehicle_id, trip_id, latitude, longitude, route_id, gps_timestamp, gps_timestamp AS loaded_at FROM svp",
    "silver_trip_updates_gps": f"""SELECT s.trip_id, s.route_id, s.delay_seconds, s.stop_id,
        coalesce(g.last_gps, {AS_OF}) AS loaded_at
      FROM stu s LEFT JOIN (SELECT trip_id, max(ingestion_timestamp) AS last_gps FROM bvp GROUP BY trip_id) g
        ON s.trip_id = g.trip_id""",
    "insert_if_absent": f"""SELECT * FROM stu WHERE loaded_at < {SPLIT}
      UNION ALL SELECT * FROM stu WHERE loaded_at >= {SPLIT}
        AND trip_id NOT IN (SELECT trip_id FROM stu WHERE loaded_at < {SPLIT})""",
    "incremental_since": f"""SELECT * FROM stu
      WHERE loaded_at >= (SELECT max(loaded_at) FROM stu WHERE loaded_at < {SPLIT}) - INTERVAL 1 HOUR""",
    "merge_by_key": f"""SELECT {FACT_COLS} FROM fact WHERE recorded_at < {SPLIT}
        AND delay_record_id NOT IN (SELECT delay_record_id FROM fact WHERE recorded_at >= TIMESTAMP '2024-01-14 00:00:00')
      UNION ALL SELECT {FACT_COLS} FROM fact WHERE recorded_at >= TIMESTAMP '2024-01-14 00:00:00'""",
    "fact_historical_delays": f"SELECT {FACT_COLS} FROM fact",
    "gold_route_performance_hourly": f"SELECT {HOURLY_COLS} FROM hourly",
    "route_period_stats": f"SELECT {RPS_COLS} FROM rps",
    "gold_worst_routes_by_period": f"""SELECT {RPS_COLS}, worst_rank, best_rank, total_routes_in_period,
        performance_tier FROM worst""",
    "gold_network_summary": """SELECT day_of_week, day_name, time_period, active_routes, total_observations, total_trips,
        network_avg_delay, network_on_time_pct, network_critical_count, network_severe_count, worst_delay_in_network,
        network_health_score, network_health_status FROM network""",
    "dim_routes": f"""SELECT split_part(route_id, '_', 1) AS route_code, route_id AS route_pattern,
        CAST(count(*) AS BIGINT) AS total_observations, CAST(count(DISTINCT trip_id) AS BIGINT) AS unique_trips,
        min(loaded_at) AS first_seen, max(loaded_at) AS last_seen,
        CAST({rr('100 * sum(delay_seconds)', '60 * count(*)')} AS BIGINT) / 100.0 AS avg_delay_minutes,
        {minutes('max(delay_seconds)')} AS max_delay_minutes,
        {minutes('min(delay_seconds)')} AS min_delay_minutes,
        CAST({rr('10000 * count(*) FILTER (WHERE delay_seconds <= 120)', 'count(*)')} AS BIGINT) / 100.0
          AS on_time_percentage,
        CAST(floor((epoch(max(loaded_at)) - epoch(min(loaded_at))) / 86400) + 1 AS INTEGER) AS days_active
      FROM stu WHERE delay_seconds IS NOT NULL GROUP BY split_part(route_id, '_', 1), route_id""",
    "gold_route_performance": f"""SELECT route_id, CAST(count(DISTINCT trip_id) AS BIGINT) AS active_buses,
        CAST({rr('100 * sum(delay_seconds)', '60 * count(delay_seconds)')} AS BIGINT) / 100.0 AS avg_delay_minutes,
        CAST(max(delay_seconds) // 60 AS BIGINT) AS max_delay_minutes
      FROM stu GROUP BY route_id""",
    "latest_vehicles": "SELECT * FROM veh",
    "latest_delay": "SELECT * FROM lat",
    "latest_delay_route": "SELECT trip_id, route_id, delay_seconds, loaded_at FROM " + latest(
        "(SELECT * FROM stu WHERE delay_seconds IS NOT NULL AND starts_with(route_id, 'R1'))", "trip_id", UPD_ORDER)
        + " AS x",
    "previous_delay": "SELECT * FROM prv",
    "latest_positions": "SELECT * FROM lpos",
    "delay_trend": "SELECT * FROM trend",
    "delay_trend_series": f"SELECT * FROM ({TREND_SERIES})",
    "delays": f"SELECT {DELAY_COLS} FROM delays",
    "delays_limit_100": f"SELECT {DELAY_COLS} FROM alld ORDER BY loaded_at DESC NULLS FIRST, trip_id LIMIT 100",
    "delays_route": _delays_variant(where_src="AND starts_with(route_id, 'R1')"),
    "delays_category": _delays_variant(where_out=f"AND {band('l.delay_seconds')} = 'severe'"),
    "delays_summary": "SELECT * FROM summ",
    "delays_summary_all_bands": """SELECT b.category AS delay_category, coalesce(s.count, 0) AS count,
        coalesce(s.mappable_count, 0) AS mappable_count, coalesce(s.prev_count, p.prev_count, 0) AS prev_count,
        coalesce(s.count, 0) - coalesce(s.prev_count, p.prev_count, 0) AS change
      FROM (VALUES ('early'), ('on_time'), ('minor'), ('moderate'), ('severe'), ('critical')) b(category)
      LEFT JOIN summ s ON s.delay_category = b.category
      LEFT JOIN (SELECT delay_category, CAST(count(*) AS BIGINT) AS prev_count FROM
                 (SELECT """ + band("prev_delay_seconds") + """ AS delay_category FROM prv) GROUP BY delay_category) p
        ON p.delay_category = b.category""",
    "total_trips": "SELECT CAST(coalesce(sum(count), 0) AS BIGINT) AS total_trips FROM summ",
    "routes": """SELECT split_part(route_id, '_', 1) AS route_code, CAST(count(DISTINCT trip_id) AS BIGINT) AS trip_count
      FROM stu GROUP BY 1""",
    "route_names": f"""SELECT route_id, split_part(route_id, '_', 1) AS route_code, {clean('route_id')} AS clean_route
      FROM (SELECT DISTINCT route_id FROM stu)""",
    "trip_history": f"""SELECT trip_id, route_id, delay_seconds, {minutes('delay_seconds')} AS delay_minutes, loaded_at
      FROM stu WHERE trip_id = '7_view'
      ORDER BY loaded_at DESC NULLS FIRST, delay_seconds DESC NULLS LAST, stop_id DESC NULLS LAST LIMIT 20""",
    "worst_routes": """SELECT route_code, day_name, time_period, avg_delay, avg_on_time_pct, total_critical_delays,
        total_severe_delays, performance_tier, worst_rank
      FROM worst ORDER BY worst_rank, day_of_week, time_period, route_code LIMIT 20""",
    "worst_routes_filtered": """SELECT route_code, day_name, time_period, avg_delay, avg_on_time_pct,
        total_critical_delays, total_severe_delays, performance_tier, worst_rank
      FROM worst WHERE day_of_week = 1 AND time_period = 'morning_rush'
      ORDER BY worst_rank, day_of_week, time_period, route_code LIMIT 20""",
    "worst_routes_day": """SELECT route_code, day_name, time_period, avg_delay, avg_on_time_pct,
        total_critical_delays, total_severe_delays, performance_tier, worst_rank
      FROM worst WHERE day_of_week = 0 ORDER BY worst_rank, day_of_week, time_period, route_code LIMIT 10""",
    "network_health": """SELECT day_name, time_period, active_routes, total_trips, network_avg_delay, network_on_time_pct,
        network_health_score, network_health_status FROM network""",
    "delay_distribution": """SELECT CAST(count(*) AS BIGINT) AS total_records,
        CAST(count(*) FILTER (WHERE TRY_CAST(raw_data->>'$.delay' AS INTEGER) = 0) AS BIGINT) AS zero_delay,
        CAST(count(*) FILTER (WHERE TRY_CAST(raw_data->>'$.delay' AS INTEGER) > 0) AS BIGINT) AS positive_delay,
        CAST(count(*) FILTER (WHERE TRY_CAST(raw_data->>'$.delay' AS INTEGER) < 0) AS BIGINT) AS negative_delay,
        CAST(count(*) FILTER (WHERE raw_data->>'$.delay' IS NULL) AS BIGINT) AS null_delay
      FROM btu0""",
    "gps_delay_coverage": """SELECT CAST(count(DISTINCT vp.trip_id) AS BIGINT) AS vehicles_with_gps,
        CAST(count(DISTINCT tu.trip_id) AS BIGINT) AS vehicles_with_delay,
        CAST(count(DISTINCT vp.trip_id) - count(DISTINCT tu.trip_id) AS BIGINT) AS vehicles_without_delay
      FROM bvp vp LEFT JOIN btu tu ON vp.trip_id = tu.trip_id""",
    "ghost_trips": f"SELECT {DELAY_COLS} FROM ghosts",
    "live_trips": f"SELECT {DELAY_COLS} FROM lives",
    "ghost_count": "SELECT CAST(count(*) AS BIGINT) AS ghost_count FROM ghosts",
    "worst_delay_by_route": "SELECT * FROM worstclean",
    "vehicle_delay_info": "SELECT * FROM vinfo",
    "incident_list": f"""SELECT {DELAY_COLS},
        CASE delay_category WHEN 'critical' THEN 0 WHEN 'severe' THEN 1 WHEN 'moderate' THEN 2 WHEN 'minor' THEN 3
             WHEN 'on_time' THEN 4 WHEN 'early' THEN 5 ELSE 6 END AS severity_rank FROM lives""",
    "incident_list_all": f"""SELECT {DELAY_COLS},
        CASE delay_category WHEN 'critical' THEN 0 WHEN 'severe' THEN 1 WHEN 'moderate' THEN 2 WHEN 'minor' THEN 3
             WHEN 'on_time' THEN 4 WHEN 'early' THEN 5 ELSE 6 END AS severity_rank FROM alld""",
    "route_descriptions": f"""SELECT v.*, coalesce(r.description, '') AS route_description
      FROM veh v LEFT JOIN rdesc r ON r.route_code = {clean('v.route_id')}""",
    "route_menu": f"""SELECT m.route, m.route_num, coalesce(r.description, '') AS description FROM
        (SELECT route, CASE WHEN regexp_extract(route, '^\\s*([+-]?\\d+)', 1) <> ''
                            THEN TRY_CAST(regexp_extract(route, '^\\s*([+-]?\\d+)', 1) AS BIGINT) END AS route_num
         FROM (SELECT DISTINCT {clean('route_id')} AS route FROM veh)) m
      LEFT JOIN rdesc r ON r.route_code = m.route""",
    "trend_counts": """SELECT l.trend, CAST(count(d.trip_id) AS BIGINT) AS n
      FROM (VALUES ('worsening'), ('improving'), ('stable'), ('new')) l(trend) LEFT JOIN alld d ON d.trend = l.trend
      GROUP BY l.trend""",
    "selection_bounds": """SELECT d.route_id AS selection, CAST(count(v.vehicle_id) AS BIGINT) AS n_matches,
        CASE WHEN count(v.vehicle_id) > 1 THEN 'bounds' WHEN count(v.vehicle_id) = 1 THEN 'center'
             WHEN any_value(d.last_lat) IS NOT NULL AND any_value(d.last_lon) IS NOT NULL THEN 'last_known'
             ELSE 'none' END AS mode,
        CASE WHEN count(v.vehicle_id) = 1 THEN min(v.latitude)
             WHEN count(v.vehicle_id) = 0 AND any_value(d.last_lon) IS NOT NULL THEN any_value(d.last_lat) END AS center_lat,
        CASE WHEN count(v.vehicle_id) = 1 THEN min(v.longitude)
             WHEN count(v.vehicle_id) = 0 AND any_value(d.last_lat) IS NOT NULL THEN any_value(d.last_lon) END AS center_lon,
        CASE WHEN count(v.vehicle_id) > 1 THEN min(v.latitude) END AS min_lat,
        CASE WHEN count(v.vehicle_id) > 1 THEN min(v.longitude) END AS min_lon,
        CASE WHEN count(v.vehicle_id) > 1 THEN max(v.latitude) END AS max_lat,
        CASE WHEN count(v.vehicle_id) > 1 THEN max(v.longitude) END AS max_lon
      FROM alld d LEFT JOIN veha v ON v.route_id = d.route_id OR v.trip_id = d.route_id
      GROUP BY d.route_id""",
    "live_dots": "SELECT * FROM vinfo WHERE delay_category = 'on_time'",
    "live_dots_selected": """SELECT * FROM vinfo WHERE clean_route = 'R3' AND (
        route_id = '3_click' OR trip_id = '3_click'
        OR NOT EXISTS (SELECT 1 FROM vinfo WHERE clean_route = 'R3' AND (route_id = '3_click' OR trip_id = '3_click')))""",
    "ghost_dots": f"SELECT {DELAY_COLS} FROM ghosts WHERE last_lat IS NOT NULL AND last_lon IS NOT NULL",
    "stream_bronze_trips": "SELECT trip_id, route_id, raw_data, ingestion_timestamp FROM btu",
    "stream_bronze_vehicles": "SELECT vehicle_id, trip_id, route_id, raw_data, ingestion_timestamp FROM bvp",
    "stream_fact_dedup": f"SELECT {FACT_COLS} FROM fact",
    "stream_hourly_windows": STREAM_HOURLY,
    "stream_late_rows": STREAM_HOURLY,
    "stream_late_table": LATE_ROWS,
    "stream_split_counts": f"""SELECT CAST(batch_id AS INTEGER) AS batch_id, CAST(sum(on_time) AS BIGINT) AS on_time_rows,
        CAST(sum(late) AS BIGINT) AS late_rows, max(age) AS max_age_seconds, CAST(round(avg(age)) AS BIGINT) AS avg_age_seconds
      FROM (SELECT CASE WHEN {LATE_HOUR} THEN 1 WHEN recorded_at < TIMESTAMP '2024-01-11' THEN 0
                        WHEN recorded_at < TIMESTAMP '2024-01-21' THEN 1 ELSE 2 END AS batch_id,
              1 AS on_time, 0 AS late, CAST(NULL AS BIGINT) AS age
            FROM (SELECT event_id, obs_ts AS recorded_at FROM based WHERE event_id % 23 <> 0 AND event_id % 29 <> 0)
            UNION ALL SELECT batch_id, 0, 1, age_seconds FROM ({LATE_ROWS})) GROUP BY batch_id""",
    "stream_period_trips": """SELECT route_code, day_of_week, day_name, time_period,
        CAST(count(DISTINCT (record_date, record_hour)) AS BIGINT) AS observation_hours,
        CAST(count(*) AS BIGINT) AS total_observations, CAST(count(DISTINCT trip_id) AS BIGINT) AS unique_trips
      FROM fact
      WHERE CAST(record_date AS TIMESTAMP) + to_hours(record_hour + 1)
            <= (SELECT max(recorded_at) FROM fact) - INTERVAL 2 HOUR
      GROUP BY route_code, day_of_week, day_name, time_period""",
    "refresh_hourly_incremental": f"SELECT {HOURLY_COLS} FROM hourly",
    "refresh_current_state": "SELECT trip_id, route_id, delay_seconds, stop_id, loaded_at FROM " + latest(
        "stu", "trip_id", "loaded_at DESC, delay_seconds DESC, stop_id DESC") + " AS x",
    "stream_delay_trend": "SELECT * FROM trend",
    "warehouse_network_summary": """SELECT day_of_week, day_name, time_period, active_routes, total_observations,
        total_trips, network_avg_delay, network_on_time_pct, network_critical_count, network_severe_count,
        worst_delay_in_network, network_health_score, network_health_status FROM network""",
}


# The stored tables hold what the plans compute, so their reports have the same SQL.
BODIES |= {"warehouse_hourly": BODIES["refresh_hourly_incremental"], "warehouse_current": BODIES["refresh_current_state"],
           "warehouse_dim_routes": BODIES["dim_routes"], "warehouse_route_performance": BODIES["gold_route_performance"],
           "warehouse_since_mark": BODIES["silver_trip_updates"], "warehouse_trip_history": BODIES["trip_history"], "warehouse_delays": BODIES["delays"]}

BODIES |= {"window_delays": BODIES["delays"], "window_delays_summary": BODIES["delays_summary"], "window_delay_trend": BODIES["delay_trend"],
           "window_latest_delay": BODIES["latest_delay"], "window_latest_positions": BODIES["latest_positions"]}


def _published_menu() -> str:
    with open(os.path.join(os.path.dirname(os.path.abspath(__file__)), "sources", "route_descriptions.csv"), encoding="utf-8") as fh:
        rows = [(i, *(v.replace("'", "''") for v in row)) for i, row in enumerate(list(csv.reader(fh))[1:])]
    values = ", ".join(f"({i}, '{code}', '{text}')" for i, code, text in rows)
    number = "regexp_extract(m.route, '^\\s*([+-]?\\d+)', 1)"
    at = f"CAST(v.vehicle_id AS BIGINT) % {len(rows) + 11}"
    return f"""SELECT m.route, CASE WHEN {number} <> '' THEN TRY_CAST({number} AS BIGINT) END AS route_num,
        coalesce(r.description, '') AS description
      FROM (SELECT DISTINCT coalesce(p.code, 'U' || CAST({at} AS VARCHAR)) AS route
            FROM veh v LEFT JOIN (VALUES {values}) p(i, code, text) ON p.i = {at}) m
      LEFT JOIN (SELECT code, text AS description FROM (VALUES {values}) q(i, code, text)) r ON r.code = m.route"""


BODIES["route_menu_published"] = _published_menu()


def oracle_sql() -> dict[str, str]:
    return {name: with_ctes(body) for name, body in BODIES.items()}
