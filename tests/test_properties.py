"""Property tests: column rules against plain-Python models of the published rules on random inputs."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st

from ridepulse.functions import columns as C


def clean_model(s):
    if not s:
        return "N/A"
    parts = s.split(" ")
    if len(parts) >= 2:
        return parts[1].upper()
    if "-" in s:
        return s.split("-")[1].upper()
    if "_" in s:
        return s.split("_")[0]
    return s


def band_model(d):
    if d < 0:
        return "early"
    for name, upper in (("on_time", 120), ("minor", 300), ("moderate", 600), ("severe", 1200)):
        if d <= upper:
            return name
    return "critical"


@settings(max_examples=15, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab1 -_X", max_size=8)), min_size=1, max_size=40))
def test_clean_route_name_matches_model(spark, names):
    rows = spark.createDataFrame([(n,) for n in names], "r string").select(C.clean_route_name("r")).collect()
    assert [r[0] for r in rows] == [clean_model(n) for n in names]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(-10**12, 10**12), st.integers(1, 10**6)), min_size=1, max_size=40))
def test_round_ratio_matches_decimal(spark, pairs):
    got = [r[0] for r in spark.createDataFrame(pairs, "n long, d long").select(C.round_ratio("n", "d")).collect()]
    want = [int((Decimal(n) / Decimal(d)).quantize(Decimal(1), rounding=ROUND_HALF_UP)) for n, d in pairs]
    assert got == want


@settings(max_examples=10, deadline=None)
@given(st.lists(st.integers(-5000, 5000), min_size=1, max_size=60))
def test_band_and_minutes_match_model(spark, secs):
    df = spark.createDataFrame([(s,) for s in secs], "s int")
    rows = df.select(C.delay_category("s"), C.to_minutes("s"), C.delay_cents("s")).collect()
    for s, (band, minutes, cents) in zip(secs, rows):
        exact = (Decimal(s) / Decimal(60)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
        assert band == band_model(s) and minutes == float(exact) and cents == int(exact * 100)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 5), st.sampled_from(["R1", "R2"]),
                          st.integers(0, 1)), min_size=1, max_size=25))
def test_upsert_matches_sequential_model(spark, rows):
    """Applying a batch with ``upsert`` equals replaying it row by row into a dict (ON CONFLICT semantics)."""
    import datetime as dt
    from ridepulse.operators.keyed import upsert
    base = dt.datetime(2024, 1, 1)
    cur_rows = [(k, r, f"v{t}", base + dt.timedelta(minutes=t)) for k, t, r, b in rows if b == 0]
    bat_rows = [(k, r, f"w{t}", base + dt.timedelta(minutes=10 + t)) for k, t, r, b in rows if b == 1]
    schema = "trip_id string, route_id string, raw_data string, ingestion_timestamp timestamp_ntz"
    # stored table: one row per key (latest of the current rows, first route kept)
    model = {}
    # full order: (time, payload, route), the route being the implicit tie-break of the operator
    for k, r, v, ts in sorted(cur_rows, key=lambda x: (x[3], x[2], x[1])):
        model[k] = (model[k][0] if k in model else r, v, ts)
    current = upsert(spark.createDataFrame([], schema), spark.createDataFrame(cur_rows, schema), ["trip_id"],
                     ["ingestion_timestamp", "raw_data"])
    for k, r, v, ts in sorted(bat_rows, key=lambda x: (x[3], x[2], x[1])):
        model[k] = (model[k][0] if k in model else r, v, ts)
    got = upsert(current, spark.createDataFrame(bat_rows, schema), ["trip_id"], ["ingestion_timestamp", "raw_data"])
    assert {r.trip_id: (r.route_id, r.raw_data, r.ingestion_timestamp) for r in got.collect()} == model
