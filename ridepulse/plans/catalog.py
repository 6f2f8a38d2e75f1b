"""The registered queries: every operator run end to end on the driver's tables.

``Tables`` derives feed -> bronze -> silver -> fact -> gold lazily from ``events`` of one scale-factor folder,
so each query is a single plan rooted in the parquet scan and its work grows with the table. ``QUERIES`` maps
a query name to ``fn(spark, sf_dir) -> DataFrame``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property, partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridepulse import schemas
from ridepulse.functions.columns import clean_nonfinite, clean_route_name, route_code
from ridepulse.operators import ingest, keyed, silver
from ridepulse.plans import gold, jobs, live, reports
from ridepulse.session import scratch_path
from ridepulse.sources import dims, fixtures, tables
from ridepulse.streaming import stream

# Parameters of the registered queries (fixed, documented; the data spans 2024-01-01 .. 2024-01-30).
AS_OF = "2024-01-10 00:00:00"          # "now" for trends, GPS fallback and retention
LOOKBACK_MINUTES = 5 * 24 * 60  # the events are sparse: within 25 minutes hardly a trip has two of them
SERIES = ("2024-01-06 00:00:00", 6 * 3600, 17)  # start, step in seconds and number of the trend's times; ends at AS_OF
SPLIT = "2024-01-15 00:00:00"          # current/batch boundary for upsert, merge and incremental queries
LATENESS = "1 HOUR"
TRIP = "7_view"                        # trip looked up by the trip-history report
ROUTE_PREFIX = "R1"
CATEGORY = "severe"
DAY, PERIOD = 1, "morning_rush"
LIVE_ROUTE, SELECTED = "R3", "3_click"

_delays = partial(reports.delays, lookback_minutes=LOOKBACK_MINUTES)
_delays_summary = partial(reports.delays_summary, lookback_minutes=LOOKBACK_MINUTES)


class Tables:
    """Lazily derived tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def events(self) -> DataFrame:
        return fixtures.read_table(self.spark, self.sf_dir, "events")

    @cached_property
    def feed(self) -> DataFrame:
        return fixtures.feed_snapshots(self.events)

    @cached_property
    def bronze_vehicle_positions(self) -> DataFrame:
        return ingest.flatten_vehicle_feed(self.feed)

    @cached_property
    def bronze_trip_updates(self) -> DataFrame:
        return ingest.flatten_trip_feed(self.feed)

    @cached_property
    def silver_vehicle_positions(self) -> DataFrame:
        return silver.silver_vehicle_positions(self.bronze_vehicle_positions)

    @cached_property
    def silver_trip_updates(self) -> DataFrame:
        return silver.silver_trip_updates(self.bronze_trip_updates)

    @cached_property
    def fact(self) -> DataFrame:
        return gold.fact_historical_delays(self.silver_trip_updates)

    @cached_property
    def hourly(self) -> DataFrame:
        return gold.gold_route_performance_hourly(self.fact)

    @cached_property
    def worst(self) -> DataFrame:
        return gold.gold_worst_routes_by_period(self.hourly)

    @cached_property
    def network(self) -> DataFrame:
        return gold.gold_network_summary(self.hourly)

    @cached_property
    def vehicles(self) -> DataFrame:
        return reports.latest_vehicles(self.silver_vehicle_positions)

    @cached_property
    def live_vehicles(self) -> DataFrame:
        """Latest GPS row of every vehicle at ``AS_OF``: what the live map shows beside the delays of that time."""
        return reports.latest_vehicles(reports.recent(self.silver_vehicle_positions, AS_OF, None, "gps_timestamp"))

    @cached_property
    def trends(self) -> DataFrame:
        """Every trip's trend row under the names of the delays report, for operators that need no position."""
        t = reports.delay_trend(self.silver_trip_updates, AS_OF, LOOKBACK_MINUTES, with_route=False)
        return t.withColumn("route_id", F.col("trip_id"))

    @cached_property
    def delays(self) -> DataFrame:
        """The delays report (newest 5,000 trips)."""
        return _delays(self.silver_trip_updates, self.silver_vehicle_positions, AS_OF)

    @cached_property
    def all_delays(self) -> DataFrame:
        """Every trip's delay row, uncapped: what the live-map operators work on."""
        return _delays(self.silver_trip_updates, self.silver_vehicle_positions, AS_OF, limit=None)


def _t(fn: Callable[[Tables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Tables(spark, sf_dir))
    run.__doc__ = fn.__doc__
    return run


def _before(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col) < silver.ntz_literal(SPLIT))


def _from(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col) >= silver.ntz_literal(SPLIT))


def _none(df: DataFrame) -> DataFrame:
    """An empty table of the same columns."""
    return df.sparkSession.createDataFrame([], df.schema)


def _upsert_vehicles(t: Tables) -> DataFrame:
    b = t.bronze_vehicle_positions
    order = ["ingestion_timestamp", "raw_data"]
    current = keyed.upsert(_none(b), _before(b, "ingestion_timestamp"), ["vehicle_id", "trip_id"], order)
    return keyed.upsert(current, _from(b, "ingestion_timestamp"), ["vehicle_id", "trip_id"], order)


def _upsert_trips(t: Tables) -> DataFrame:
    b = t.bronze_trip_updates
    order = ["ingestion_timestamp", "raw_data"]
    current = keyed.upsert(_none(b), _before(b, "ingestion_timestamp"), ["trip_id"], order)
    return keyed.upsert(current, _from(b, "ingestion_timestamp"), ["trip_id"], order)


def _incremental_since(t: Tables) -> DataFrame:
    s = t.silver_trip_updates
    mark = _before(s, "loaded_at").agg(F.max("loaded_at")).scalar()
    return keyed.incremental_since(s, "loaded_at", mark, LATENESS)


def _merge_by_key(t: Tables) -> DataFrame:
    f = t.fact
    target = _before(f, "recorded_at")
    # The batch re-delivers the last day before the split (overlap) plus everything after it.
    batch = f.where(F.col("recorded_at") >= silver.ntz_literal("2024-01-14 00:00:00"))
    return keyed.merge_by_key(target, batch, ["delay_record_id"])


def _prune(t: Tables) -> DataFrame:
    kept, _ = keyed.prune_old(t.bronze_trip_updates, "ingestion_timestamp", AS_OF, 24)
    return kept


def _prune_counts(t: Tables) -> DataFrame:
    _, v = keyed.prune_old(t.bronze_vehicle_positions, "ingestion_timestamp", AS_OF, 24)
    _, u = keyed.prune_old(t.bronze_trip_updates, "ingestion_timestamp", AS_OF, 24)
    return (v.select(F.lit("bronze_vehicle_positions").alias("table_name"), "kept", "pruned")
            .unionByName(u.select(F.lit("bronze_trip_updates").alias("table_name"), "kept", "pruned")))


def _silver_gps(t: Tables) -> DataFrame:
    return silver.silver_trip_updates(t.bronze_trip_updates, positions=t.bronze_vehicle_positions,
                                      loaded_at="gps", as_of=AS_OF)


def _clean_nonfinite(t: Tables) -> DataFrame:
    """Every trip's delay row, with NaN and both infinities put in for some of the minutes."""
    kind = F.round(F.abs("avg_delay_minutes") * 100).cast("long") % 7
    dirty = t.all_delays.withColumn("avg_delay_minutes", F.when(kind == 0, float("nan")).when(kind == 1, float("inf"))
                                    .when(kind == 2, float("-inf")).otherwise(F.col("avg_delay_minutes")))
    return clean_nonfinite(dirty)


def _route_names(t: Tables) -> DataFrame:
    r = t.silver_trip_updates.select("route_id").distinct()
    return r.select("route_id", route_code("route_id").alias("route_code"),
                    clean_route_name("route_id").alias("clean_route"))


# --- streaming (each run lands the feed derived from events in a fresh folder of the shared checkpoint dir)

STREAM_LATENESS = "2 hours"


def _landed(t: Tables, name: str) -> tuple[str, str]:
    base = scratch_path(t.spark, name)
    landing = f"{base}/landing"
    stream.land_feed(t.feed, landing)
    return base, landing


def _files_per_trigger(t: Tables, batches: int) -> int:
    """Landed files per micro-batch, so that a run takes about ``batches`` of them."""
    return max(1, int(t.spark.conf.get("spark.sql.shuffle.partitions")) // batches)


def _stream_bronze(t: Tables, entity: str) -> DataFrame:
    base, landing = _landed(t, f"stream-bronze-{entity}")
    stream.stream_bronze(t.spark, landing, f"{base}/bronze", f"{base}/ckpt", entity=entity)
    return t.spark.read.parquet(f"{base}/bronze").drop("ingest_date")


#: The streaming queries deliver the feed in three parts; state and watermark carry over between their runs.
PARTS = ("2024-01-11 00:00:00", "2024-01-21 00:00:00")


def _between(start, end) -> F.Column:
    return ((F.lit(True) if start is None else F.col("obs_ts") >= silver.ntz_literal(start))
            & (F.lit(True) if end is None else F.col("obs_ts") < silver.ntz_literal(end)))


def _stream_parts(t: Tables, name: str, parts: list, transform) -> DataFrame:
    """Land each part and process it in a run of its own over one checkpoint; returns what was written."""
    base = scratch_path(t.spark, name)
    for rows in parts:
        stream.land_feed(t.feed.where(rows), f"{base}/landing", _files_per_trigger(t, len(parts)))
        fact = stream.silver_fact_stream(stream.read_feed_stream(t.spark, f"{base}/landing"))
        writer = transform(fact).writeStream.format("parquet").option("path", f"{base}/out").outputMode("append")
        stream.run_available_now(writer, f"{base}/ckpt")
    return t.spark.read.parquet(f"{base}/out")


def _stream_fact_dedup(t: Tables) -> DataFrame:
    """Every observation twice in one run, the last day of a part again in the next, and old days at the end."""
    parts = [_between(None, PARTS[0]), _between("2024-01-10 00:00:00", PARTS[1]),
             _between(PARTS[1], None) | _between(None, "2024-01-05 00:00:00")]
    return _stream_parts(t, "stream-dedup", parts,
                         lambda fact: stream.stream_dedup(fact.unionByName(fact), STREAM_LATENESS))


#: What a query of this session has already built for a table folder, so that several reports read one warehouse.
_BUILT: dict[tuple, str] = {}


def _built(t: Tables, name: str, build: Callable[[Tables], str]) -> str:
    key = (name, t.sf_dir, t.spark.conf.get("spark.app.id", ""), t.spark.conf.get("spark.sql.shuffle.partitions"))
    if key not in _BUILT or not tables.table_exists(t.spark, _BUILT[key]):  # a scratch folder may have been cleared
        _BUILT[key] = build(t)
    return _BUILT[key]


def _stream_hourly(t: Tables, replay: bool) -> DataFrame:
    """Every second event of a part's last hour comes late, with the next part, inside the allowed lateness;
    ``replay`` also sends old days again at the end, far behind the watermark, which must change nothing."""
    late = _between("2024-01-10 23:00:00", PARTS[0]) & (F.col("event_id") % 2 == 1)
    last = _between(PARTS[1], None)
    parts = [_between(None, PARTS[0]) & ~late, _between(PARTS[0], PARTS[1]) | late,
             last | _between(None, "2024-01-05 00:00:00") if replay else last]
    return _stream_parts(t, "stream-hourly", parts, lambda fact: stream.stream_hourly(fact, STREAM_LATENESS))


def _stream_windows(t: Tables) -> DataFrame:
    """The closed windows of a streamed run, with their sketches."""
    def build(t: Tables) -> str:
        path = scratch_path(t.spark, "stream-windows")
        _stream_hourly(t, replay=False).write.parquet(path)
        return path
    return t.spark.read.parquet(_built(t, "stream-windows", build))


def _late_split(t: Tables) -> DataFrame:
    """Three deliveries split into rows in time and late rows: the second has rows late inside the bound, the third
    sends old days again."""
    def build(t: Tables) -> str:
        base = scratch_path(t.spark, "late-split")
        late = _between("2024-01-10 23:00:00", PARTS[0]) & (F.col("event_id") % 2 == 1)
        for rows in (_between(None, PARTS[0]) & ~late, _between(PARTS[0], PARTS[1]) | late,
                     _between(PARTS[1], None) | _between(None, "2024-01-05 00:00:00")):
            stream.land_feed(t.feed.where(rows), f"{base}/landing", _files_per_trigger(t, 3))
            fact = stream.silver_fact_stream(stream.read_feed_stream(t.spark, f"{base}/landing"))
            stream.run_foreach_batch(fact, stream.late_splitter(f"{base}/split", STREAM_LATENESS), f"{base}/ckpt")
        return f"{base}/split"
    return stream.split_rows(t.spark, _built(t, "late-split", build))


def _since_mark(t: Tables) -> DataFrame:
    """Silver updates after three runs over a growing landing folder, the last of which finds nothing new."""
    root = scratch_path(t.spark, "since-mark")
    for run, landed in enumerate((_before(t.feed, "obs_ts"), t.feed, t.feed)):
        jobs.refresh_since_mark(landed, root, run_id=f"r{run}")
    return t.spark.read.parquet(jobs.Warehouse(root).silver_trips).drop("run_id", "loaded_date")


def _stream_period_trips(t: Tables) -> DataFrame:
    return stream.period_trips(_stream_windows(t)).drop("trip_sketch")


def _refresh_hourly(t: Tables) -> DataFrame:
    base, landing = _landed(t, "refresh-hourly")
    # A second delivery of the first five days overlaps the first files (replay / duplicate delivery).
    stream.land_feed(t.feed.where(F.col("obs_ts") < silver.ntz_literal("2024-01-05 00:00:00")), landing,
                     _files_per_trigger(t, 4))
    updates = silver.silver_trip_updates(ingest.flatten_trip_feed(
        stream.read_feed_stream(t.spark, landing, _files_per_trigger(t, 4))))
    stream.run_foreach_batch(updates, stream.hourly_refresher(f"{base}/fact", f"{base}/hourly"), f"{base}/ckpt")
    return t.spark.read.parquet(f"{base}/hourly").select(*gold.HOURLY_COLUMNS)


def _current_state_run(t: Tables, name: str) -> str:
    base, landing = _landed(t, name)
    updates = silver.silver_trip_updates(ingest.flatten_trip_feed(
        stream.read_feed_stream(t.spark, landing, _files_per_trigger(t, 3))))
    stream.run_foreach_batch(updates, stream.current_state_refresher(f"{base}/history", f"{base}/current"),
                             f"{base}/ckpt")
    return base


def _refresh_current(t: Tables) -> DataFrame:
    base = _current_state_run(t, "refresh-current")
    return tables.read_current(t.spark, f"{base}/current", schemas.SILVER_TRIP_UPDATES)


def _stream_trend(t: Tables) -> DataFrame:
    base = _current_state_run(t, "stream-trend")
    history = t.spark.read.parquet(f"{base}/history").drop("batch_id")
    return reports.delay_trend(history, AS_OF, LOOKBACK_MINUTES)


def _warehouse_runs(t: Tables) -> str:
    """Scheduled runs over the events-derived feed: before the split, a re-delivery of the day before it,
    and everything after it, each under its own run id. Returns the warehouse root."""
    root = scratch_path(t.spark, "warehouse")
    f = t.feed
    jobs.refresh_warehouse(_before(f, "obs_ts"), root, run_id="r1")
    jobs.refresh_warehouse(f.where((F.col("obs_ts") >= silver.ntz_literal("2024-01-14 00:00:00"))
                                   & (F.col("obs_ts") < silver.ntz_literal(SPLIT))), root, run_id="r2")
    jobs.refresh_warehouse(_from(f, "obs_ts"), root, run_id="r3")
    jobs.rebuild_route_tables(t.spark, root)
    return root


def _window(t: Tables) -> tuple[DataFrame, DataFrame]:
    """The trip window of the stored warehouse over its whole history."""
    def build(t: Tables) -> str:
        jobs.rebuild_trip_window(t.spark, _warehouse(t).root, hours=None)
        return _warehouse(t).window_updates
    _built(t, "window", build)
    return jobs.trip_window(t.spark, _warehouse(t).root)


def _warehouse(t: Tables) -> jobs.Warehouse:
    return jobs.Warehouse(_built(t, "warehouse", _warehouse_runs))


def _stored(t: Tables, name: str) -> DataFrame:
    return t.spark.read.parquet(getattr(_warehouse(t), name))


def _warehouse_current(t: Tables) -> DataFrame:
    return tables.read_current(t.spark, _warehouse(t).current, schemas.SILVER_TRIP_UPDATES)


def _published_menu(t: Tables) -> DataFrame:
    """The menu over the published routes: vehicles on routes of the published codes, some of them unknown."""
    published = dims.published_route_descriptions(t.spark)
    return live.route_menu(fixtures.on_published_routes(t.vehicles, dims.published_route_codes()), published)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # sources / bronze
    "flatten_vehicle_feed": _t(lambda t: t.bronze_vehicle_positions),
    "flatten_trip_feed": _t(lambda t: t.bronze_trip_updates),
    "flatten_trip_feed_zero": _t(lambda t: ingest.flatten_trip_feed(t.feed, missing_delay="zero")),
    "flatten_vehicle_feed_entity_key": _t(lambda t: ingest.flatten_vehicle_feed(t.feed, vehicle_key="entity.id",
                                                                                require_trip=True)),
    "upsert_vehicle_positions": _t(_upsert_vehicles),
    "upsert_trip_updates": _t(_upsert_trips),
    "prune_old": _t(_prune),
    "prune_counts": _t(_prune_counts),
    "clean_nonfinite": _t(_clean_nonfinite),
    # silver
    "silver_vehicle_positions": _t(lambda t: t.silver_vehicle_positions),
    "silver_trip_updates": _t(lambda t: t.silver_trip_updates),
    "silver_trip_updates_gps": _t(_silver_gps),
    "silver_vehicle_positions_gps": _t(lambda t: silver.silver_vehicle_positions(t.bronze_vehicle_positions,
                                                                                 loaded_at="gps")),
    "insert_if_absent": _t(lambda t: keyed.insert_if_absent(_before(t.silver_trip_updates, "loaded_at"),
                                                            _from(t.silver_trip_updates, "loaded_at"),
                                                            ["trip_id"])),
    "incremental_since": _t(_incremental_since),
    "merge_by_key": _t(_merge_by_key),
    # fact / gold
    "fact_historical_delays": _t(lambda t: t.fact),
    "gold_route_performance_hourly": _t(lambda t: t.hourly),
    "route_period_stats": _t(lambda t: gold.route_period_stats(t.hourly)),
    "gold_worst_routes_by_period": _t(lambda t: t.worst),
    "gold_network_summary": _t(lambda t: t.network),
    "dim_routes": _t(lambda t: gold.dim_routes(t.silver_trip_updates)),
    "gold_route_performance": _t(lambda t: gold.gold_route_performance(t.silver_trip_updates)),
    # latest-per-key and reports
    "latest_vehicles": _t(lambda t: t.vehicles),
    "latest_delay": _t(lambda t: reports.latest_delay(t.silver_trip_updates)),
    "latest_delay_route": _t(lambda t: reports.latest_delay(t.silver_trip_updates, route=ROUTE_PREFIX)),
    "previous_delay": _t(lambda t: reports.previous_delay(t.silver_trip_updates, AS_OF, LOOKBACK_MINUTES)),
    "latest_positions": _t(lambda t: reports.latest_positions(t.silver_vehicle_positions)),
    "delay_trend": _t(lambda t: reports.delay_trend(t.silver_trip_updates, AS_OF, LOOKBACK_MINUTES)),
    "delay_trend_series": _t(lambda t: reports.delay_trend_series(t.silver_trip_updates, *SERIES, LOOKBACK_MINUTES)),
    "delays": _t(lambda t: t.delays),
    "delays_limit_100": _t(lambda t: _delays(t.silver_trip_updates, t.silver_vehicle_positions, AS_OF,
                                                    limit=100)),
    "delays_route": _t(lambda t: _delays(t.silver_trip_updates, t.silver_vehicle_positions, AS_OF,
                                                route=ROUTE_PREFIX)),
    "delays_category": _t(lambda t: _delays(t.silver_trip_updates, t.silver_vehicle_positions, AS_OF,
                                                   category=CATEGORY.upper())),
    "delays_summary": _t(lambda t: _delays_summary(t.silver_trip_updates, t.silver_vehicle_positions,
                                                          AS_OF)),
    "delays_summary_all_bands": _t(lambda t: _delays_summary(t.silver_trip_updates,
                                                                    t.silver_vehicle_positions, AS_OF,
                                                                    keep_empty=True)),
    "total_trips": _t(lambda t: reports.total_trips(
        _delays_summary(t.silver_trip_updates, t.silver_vehicle_positions, AS_OF))),
    "routes": _t(lambda t: reports.routes(t.silver_trip_updates)),
    "route_names": _t(_route_names),
    "trip_history": _t(lambda t: reports.trip_history(t.silver_trip_updates, TRIP)),
    "worst_routes": _t(lambda t: reports.worst_routes(t.worst)),
    "worst_routes_filtered": _t(lambda t: reports.worst_routes(t.worst, day=DAY, period=PERIOD)),
    "worst_routes_day": _t(lambda t: reports.worst_routes(t.worst, day=0, limit=10)),
    "network_health": _t(lambda t: reports.network_health(t.network)),
    "delay_distribution": _t(lambda t: reports.delay_distribution(
        ingest.flatten_trip_feed(t.feed, missing_delay="zero"))),
    "gps_delay_coverage": _t(lambda t: reports.gps_delay_coverage(t.bronze_vehicle_positions,
                                                                  t.bronze_trip_updates)),
    # live map
    "ghost_trips": _t(lambda t: live.ghost_trips(t.all_delays, t.live_vehicles)),
    "live_trips": _t(lambda t: live.live_trips(t.all_delays, t.live_vehicles)),
    "ghost_count": _t(lambda t: live.ghost_count(t.trends, t.live_vehicles)),
    "worst_delay_by_route": _t(lambda t: live.worst_delay_by_route(t.trends)),
    "vehicle_delay_info": _t(lambda t: live.vehicle_delay_info(t.live_vehicles, t.trends)),
    "incident_list": _t(lambda t: live.incident_list(t.all_delays, t.live_vehicles)),
    "incident_list_all": _t(lambda t: live.incident_list(t.all_delays, t.live_vehicles, show_ghosts=True)),
    "route_descriptions": _t(lambda t: live.with_route_description(
        t.vehicles, dims.fixture_route_descriptions(t.spark))),
    "route_menu_published": _t(_published_menu),
    "route_menu": _t(lambda t: live.route_menu(t.vehicles, dims.fixture_route_descriptions(t.spark))),
    "trend_counts": _t(lambda t: live.trend_counts(t.trends)),
    "selection_bounds": _t(lambda t: live.selection_bounds(t.all_delays, t.live_vehicles)),
    "live_dots": _t(lambda t: live.live_dots(t.live_vehicles, t.trends, category="ON_TIME")),
    "live_dots_selected": _t(lambda t: live.live_dots(t.live_vehicles, t.trends, route=LIVE_ROUTE,
                                                      selected=SELECTED)),
    "ghost_dots": _t(lambda t: live.ghost_dots(t.all_delays, t.live_vehicles)),
    # streaming
    "stream_bronze_trips": _t(lambda t: _stream_bronze(t, "trip_update")),
    "stream_bronze_vehicles": _t(lambda t: _stream_bronze(t, "vehicle")),
    "stream_fact_dedup": _t(_stream_fact_dedup),
    "stream_hourly_windows": _t(lambda t: _stream_windows(t).select(*stream.STREAM_HOURLY_COLUMNS)),
    "stream_late_rows": _t(lambda t: _stream_hourly(t, replay=True).select(*stream.STREAM_HOURLY_COLUMNS)),
    "stream_late_table": _t(lambda t: _late_split(t).where("late").drop("late")),
    "stream_split_counts": _t(lambda t: stream.split_counts(_late_split(t))),
    "stream_period_trips": _t(_stream_period_trips),
    "refresh_hourly_incremental": _t(_refresh_hourly),
    "refresh_current_state": _t(_refresh_current),
    "stream_delay_trend": _t(_stream_trend),
    # scheduled batch refresh on disk
    "warehouse_network_summary": _t(lambda t: _stored(t, "network")),
    "warehouse_since_mark": _t(_since_mark),
    # reports over the stored tables of those runs
    "warehouse_hourly": _t(lambda t: _stored(t, "hourly").select(*gold.HOURLY_COLUMNS)),
    "warehouse_current": _t(_warehouse_current),
    "warehouse_dim_routes": _t(lambda t: _stored(t, "routes")),
    "warehouse_route_performance": _t(lambda t: _stored(t, "performance")),
    "warehouse_trip_history": _t(lambda t: reports.trip_history(jobs.observations(_stored(t, "silver_trips")), TRIP)),
    "window_delays": _t(lambda t: _delays(*_window(t), AS_OF)),
    "window_delays_summary": _t(lambda t: _delays_summary(*_window(t), AS_OF)),
    "window_delay_trend": _t(lambda t: reports.delay_trend(_window(t)[0], AS_OF, LOOKBACK_MINUTES)),
    "window_latest_delay": _t(lambda t: reports.latest_delay(_window(t)[0])),
    "window_latest_positions": _t(lambda t: reports.latest_positions(_window(t)[1])),
    "warehouse_delays": _t(lambda t: _delays(_stored(t, "silver_trips"), _stored(t, "silver_vehicles"), AS_OF)),
}
