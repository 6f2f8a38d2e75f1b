"""Column functions: the scalar rules of the delay model as built-in Spark expressions.

Every function takes and returns ``Column`` objects (or column names) and compiles into whole-stage codegen;
none is a Python UDF. Event times are ``TIMESTAMP_NTZ`` so that no result depends on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------------------------------------
# Fixed values (must equal the delay model's published rules).
# Delay bands in seconds: early < 0 <= on_time <= 120 < minor <= 300 < moderate <= 600 < severe <= 1200 <
# critical.  Trend: more than 60 s worse -> worsening, more than 60 s better -> improving.
# Time periods by hour: 7-9 morning_rush, 12-14 lunch, 16-19 evening_rush, >= 22 or <= 5 night, else off_peak.
# Null placeholder of the surrogate-key macro: "_dbt_utils_surrogate_key_null_", parts joined with "-".
# ---------------------------------------------------------------------------------------------------------
BAND_EDGES = (("on_time", 120), ("minor", 300), ("moderate", 600), ("severe", 1200))
CATEGORIES = ("early", "on_time", "minor", "moderate", "severe", "critical")
TREND_LABELS = ("worsening", "improving", "stable", "new")
TREND_THRESHOLD_SECONDS = 60
PERIODS = ("morning_rush", "off_peak", "lunch", "evening_rush", "night")
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"
EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# --- exact rounding ---------------------------------------------------------------------------------------

def div(a, b) -> Column:
    """Integral division truncating toward zero (SQL ``div``)."""
    return F.call_function("div", _c(a), _c(b))


def round_ratio(num, den) -> Column:
    """``round(num / den)`` half away from zero, exactly, for integral ``num`` and positive integral ``den``.

    Integer arithmetic only, so averages over billions of rows round exactly where a decimal average rounded
    again to two places could land on a false tie.
    """
    num = _c(num).cast("long")
    den = _c(den).cast("long")
    return F.signum(num).cast("long") * div(F.abs(num) * 2 + den, den * 2)


def delay_cents(seconds) -> Column:
    """Delay in hundredths of a minute, i.e. ``round(seconds / 60, 2) * 100`` as an exact long."""
    return round_ratio(_c(seconds).cast("long") * 100, F.lit(60))


def cents_to_minutes(cents) -> Column:
    """Hundredths to a double; the quotient is the double nearest to the two-place decimal."""
    return _c(cents).cast("double") / F.lit(100.0)


def to_minutes(seconds, scale: int = 2) -> Column:
    """``round(seconds / 60.0, scale)`` in decimal arithmetic, returned as double."""
    return F.round(_c(seconds).cast("decimal(20,0)") / F.lit(60).cast("decimal(2,0)"), scale).cast("double")


# --- bands, trends, periods ------------------------------------------------------------------------------

def delay_category(seconds) -> Column:
    """Band of a delay in seconds. A null delay falls to ``critical`` as in the SQL CASE (callers filter)."""
    s = _c(seconds)
    expr = F.when(s < 0, F.lit("early"))
    for name, upper in BAND_EDGES:
        expr = expr.when(s <= upper, F.lit(name))
    return expr.otherwise(F.lit("critical"))


def severity_rank(category) -> Column:
    """Incident-list order: critical 0 ... early 5, anything else 6."""
    c = _c(category)
    expr = None
    for i, name in enumerate(reversed(CATEGORIES)):
        expr = F.when(c == name, F.lit(i)) if expr is None else expr.when(c == name, F.lit(i))
    return expr.otherwise(F.lit(6))


def display_order(category) -> Column:
    """Summary order: early 1 ... critical 6, anything else 7."""
    c = _c(category)
    expr = None
    for i, name in enumerate(CATEGORIES, start=1):
        expr = F.when(c == name, F.lit(i)) if expr is None else expr.when(c == name, F.lit(i))
    return expr.otherwise(F.lit(7))


def trend(current_seconds, previous_seconds) -> Column:
    cur, prev = _c(current_seconds), _c(previous_seconds)
    return (F.when(prev.isNull(), F.lit("new"))
            .when(cur > prev + TREND_THRESHOLD_SECONDS, F.lit("worsening"))
            .when(cur < prev - TREND_THRESHOLD_SECONDS, F.lit("improving"))
            .otherwise(F.lit("stable")))


def trend_change_minutes(current_seconds, previous_seconds) -> Column:
    """``round((cur - prev) / 60, 1)``; null when there is no previous value."""
    delta = _c(current_seconds).cast("long") - _c(previous_seconds).cast("long")
    return to_minutes(delta, 1)


def time_period(hour) -> Column:
    h = _c(hour)
    return (F.when(h.between(7, 9), F.lit("morning_rush"))
            .when(h.between(12, 14), F.lit("lunch"))
            .when(h.between(16, 19), F.lit("evening_rush"))
            .when((h >= 22) | (h <= 5), F.lit("night"))
            .otherwise(F.lit("off_peak")))


def time_period_of(ts) -> Column:
    """Time period of a timestamp (``time_period`` of its hour)."""
    return time_period(F.hour(_c(ts)))


def period_order(period) -> Column:
    p = _c(period)
    expr = None
    for i, name in enumerate(PERIODS, start=1):
        expr = F.when(p == name, F.lit(i)) if expr is None else expr.when(p == name, F.lit(i))
    return expr


def day_of_week(ts) -> Column:
    """0 = Sunday ... 6 = Saturday."""
    return (F.dayofweek(_c(ts)) - 1).cast("int")


def day_name(ts) -> Column:
    return F.date_format(_c(ts), "EEEE")


# --- routes ----------------------------------------------------------------------------------------------

def route_code(route_id) -> Column:
    """Part before the first ``_`` (whole string when there is none)."""
    return F.split_part(_c(route_id), F.lit("_"), F.lit(1))


def clean_route_name(route_id) -> Column:
    """Dashboard route label: empty -> N/A; has a space -> 2nd word upper-cased; has '-' -> 2nd part
    upper-cased; has '_' -> 1st part; else the id itself."""
    s = _c(route_id).cast("string")
    return (F.when(s.isNull() | (s == ""), F.lit("N/A"))
            .when(s.contains(" "), F.upper(F.split_part(s, F.lit(" "), F.lit(2))))
            .when(s.contains("-"), F.upper(F.split_part(s, F.lit("-"), F.lit(2))))
            .when(s.contains("_"), F.split_part(s, F.lit("_"), F.lit(1)))
            .otherwise(s))


def numeric_prefix(s) -> Column:
    """Leading integer of a label (``parseInt``): optional blanks and sign, then digits; else null."""
    digits = F.regexp_extract(_c(s), r"^\s*([+-]?\d+)", 1)
    return F.when(digits != "", digits.try_cast("long")).otherwise(F.lit(None).cast("long"))


# --- keys and time ---------------------------------------------------------------------------------------

def surrogate_key(*cols) -> Column:
    """md5 over the text of each part joined by '-', nulls replaced by a fixed placeholder.

    ``concat_ws`` would silently drop nulls and let (a, null) collide with (null, a); ``concat`` of
    coalesced parts does not.
    """
    parts = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit("-"))
        parts.append(F.coalesce(_c(c).cast("string"), F.lit(SURROGATE_NULL)))
    return F.md5(F.concat(*parts))


def epoch_seconds(ts) -> Column:
    """Whole seconds since 1970-01-01 of a TIMESTAMP_NTZ (time-zone free)."""
    return F.timestamp_diff("SECOND", F.expr(EPOCH_NTZ), _c(ts))


def from_epoch_seconds(seconds) -> Column:
    """TIMESTAMP_NTZ of epoch seconds (time-zone free, unlike ``timestamp_seconds``)."""
    return F.timestamp_add("SECOND", _c(seconds).cast("long"), F.expr(EPOCH_NTZ))


def truncate_to_second(ts) -> Column:
    return from_epoch_seconds(epoch_seconds(ts))


# --- network health and tiers ----------------------------------------------------------------------------

def health_score(on_time_pct, avg_delay, critical_count, total_trips) -> Column:
    """0-100 score: 60 % on-time share, 30 % average delay (capped at 25 min), 10 % critical rate.

    Evaluated in doubles in the published order of terms, then fixed to six places and rounded to two,
    so both engines agree on ties.
    """
    pct = _c(on_time_pct).cast("double")
    avg = _c(avg_delay).cast("double")
    rate = _c(critical_count).cast("double") / F.nullif(_c(total_trips), F.lit(0)).cast("double") * F.lit(1000.0)
    raw = (pct * F.lit(0.6)
           + (F.lit(100.0) - F.least(avg * F.lit(2.0), F.lit(50.0))) * F.lit(0.3)
           + (F.lit(100.0) - F.least(rate, F.lit(50.0))) * F.lit(0.1))
    clamped = F.greatest(F.lit(0.0), F.least(F.lit(100.0), raw))
    return F.round(clamped.cast("decimal(18,6)"), 2).cast("double")


def health_status(on_time_pct, avg_delay) -> Column:
    pct, avg = _c(on_time_pct), _c(avg_delay)
    return (F.when((pct >= 80) & (avg <= 5), F.lit("excellent"))
            .when((pct >= 70) & (avg <= 10), F.lit("good"))
            .when((pct >= 60) & (avg <= 15), F.lit("fair"))
            .when(pct >= 50, F.lit("poor"))
            .otherwise(F.lit("critical")))


def performance_tier(worst_rank, best_rank, routes_in_period) -> Column:
    """First match wins: worst 5, best 5, worst quarter, best quarter, else average (exact quarter test)."""
    w, b, n = _c(worst_rank).cast("long"), _c(best_rank).cast("long"), _c(routes_in_period).cast("long")
    return (F.when(w <= 5, F.lit("worst_performer"))
            .when(b <= 5, F.lit("best_performer"))
            .when(w * 4 <= n, F.lit("below_average"))
            .when(b * 4 <= n, F.lit("above_average"))
            .otherwise(F.lit("average")))


# --- output hygiene --------------------------------------------------------------------------------------

def nonfinite_to_null(col) -> Column:
    c = _c(col)
    return F.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), F.lit(None)).otherwise(c)


def clean_nonfinite(df):
    """Replace NaN and +/-infinity by null in every float/double column of ``df`` (before writing or
    returning records); other columns pass through."""
    floats = {f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")}
    return df.select(*[nonfinite_to_null(c).alias(c) if c in floats else F.col(c) for c in df.columns])
