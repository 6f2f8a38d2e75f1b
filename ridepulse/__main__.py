"""Command line: run the scheduled refresh or a report against a warehouse on any Spark cluster.

    python -m ridepulse refresh --landing DIR --root DIR [--as-of TS --retention-hours 24]
    python -m ridepulse stream --landing DIR --root DIR --checkpoint DIR
    python -m ridepulse report delays --root DIR --as-of "2024-01-10 00:00:00" --out DIR

``refresh`` processes the landed snapshots after the mark of the run before (a batch job, like one cron tick), or with
``--run-id`` all those of the folder; ``stream`` processes
every snapshot landed since the last run through Structured Streaming with ``availableNow`` and exactly-once
checkpoints; ``report`` writes one report as parquet. Paths may be on any file system the session can reach
(the same module runs under ``spark-submit``).
"""

from __future__ import annotations

import argparse

from ridepulse import schemas
from ridepulse.operators import ingest, silver
from ridepulse.plans import gold, jobs, live, reports
from ridepulse.session import get_session
from ridepulse.sources import dims, tables
from ridepulse.streaming import stream


def _reports(spark, args):
    """Report name -> builder; the options mirror the published endpoints' query parameters."""
    w = jobs.Warehouse(args.root)
    positions = spark.read.parquet(w.silver_vehicles)
    updates = spark.read.parquet(w.silver_trips)
    as_of, hours = args.as_of, args.history_hours
    # The reports on delays read silver, or with --window what the last refresh kept of its last hours, bucketed by trip.
    seen = jobs.trip_window(spark, args.root) if args.window else (updates, positions)
    delays = reports.delays(*seen, as_of, limit=None, history_hours=hours)
    # What the map shows at ``as_of``: no vehicle is seen later than the delays beside it.
    vehicles = reports.latest_vehicles(reports.recent(positions, as_of, hours, "gps_timestamp"))
    descriptions = dims.route_descriptions(spark, args.descriptions)
    return {
        "vehicles": lambda: vehicles,
        "delays": lambda: reports.delays(*seen, as_of, category=args.category, route=args.route,
                                         limit=_or(args.limit, 5000), history_hours=hours),
        "delays_summary": lambda: reports.delays_summary(*seen, as_of, history_hours=hours),
        "routes": lambda: reports.routes(updates),
        "worst_routes": lambda: reports.worst_routes(spark.read.parquet(w.worst), day=args.day, period=args.period,
                                                     limit=_or(args.limit, 20)),
        "network_health": lambda: reports.network_health(spark.read.parquet(w.network)),
        "trip_history": lambda: reports.trip_history(jobs.observations(updates), args.trip, limit=_or(args.limit, 20)),
        "dim_routes": lambda: spark.read.parquet(w.routes),
        "route_performance": lambda: spark.read.parquet(w.performance),
        "ghost_trips": lambda: live.ghost_trips(delays, vehicles),
        "incidents": lambda: live.incident_list(delays, vehicles, show_ghosts=args.show_ghosts),
        "vehicle_delay_info": lambda: live.vehicle_delay_info(vehicles, delays),
        "live_dots": lambda: live.live_dots(vehicles, delays, route=args.route, category=args.category,
                                            selected=args.trip),
        "ghost_dots": lambda: live.ghost_dots(delays, vehicles, route=args.route),
        "selection_bounds": lambda: live.selection_bounds(delays, vehicles),
        "trend_counts": lambda: live.trend_counts(delays),
        "route_menu": lambda: live.route_menu(vehicles, descriptions),
        "vehicles_described": lambda: live.with_route_description(vehicles, descriptions),
        "current": lambda: tables.read_current(spark, w.current, schemas.SILVER_TRIP_UPDATES),
    }


def _or(value, default):
    return default if value is None else value


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="ridepulse")
    sub = ap.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("refresh", help="one scheduled batch refresh over landed snapshot files")
    r.add_argument("--landing", required=True)
    r.add_argument("--root", required=True)
    r.add_argument("--as-of")
    r.add_argument("--retention-hours", type=int)
    r.add_argument("--window-hours", type=int, default=24, help="hours kept by trip for report --window")
    r.add_argument("--run-id", help="take all of the landing folder; a repeated run replaces its bronze/silver rows "
                                    "(without: only snapshots that no earlier run has taken)")
    s = sub.add_parser("stream", help="process newly landed snapshots (availableNow) into bronze and gold")
    s.add_argument("--landing", required=True)
    s.add_argument("--root", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--max-files-per-trigger", type=int)
    s.add_argument("--window-hours", type=int, default=24)
    c = sub.add_parser("compact", help="compact the append-heavy tables for closed dates")
    c.add_argument("--root", required=True)
    c.add_argument("--date", action="append", required=True, help="YYYY-MM-DD (repeatable)")
    p = sub.add_parser("report", help="write one report as parquet")
    p.add_argument("name")
    p.add_argument("--root", required=True)
    p.add_argument("--as-of", required=True)
    p.add_argument("--history-hours", type=int)
    p.add_argument("--window", action="store_true", help="read the stored window of the last refresh")
    p.add_argument("--out", required=True)
    p.add_argument("--category")
    p.add_argument("--route", help="route id prefix (delays) or clean route name (map layers)")
    p.add_argument("--descriptions", help="route description table (default: the published one)")
    p.add_argument("--limit", type=int)
    p.add_argument("--day", type=int, help="weekday, 0 = Sunday (worst_routes)")
    p.add_argument("--period", help="time period (worst_routes)")
    p.add_argument("--trip", help="trip id (trip_history)")
    p.add_argument("--show-ghosts", action="store_true")
    args = ap.parse_args(argv)

    spark = get_session(app_name=f"ridepulse-{args.cmd}")
    if args.cmd == "refresh":
        feed = spark.read.schema(schemas.FEED).parquet(args.landing)
        refresh = jobs.refresh_warehouse if args.run_id else jobs.refresh_since_mark
        print(refresh(feed, args.root, as_of=args.as_of, retention_hours=args.retention_hours, run_id=args.run_id))
        jobs.rebuild_route_tables(spark, args.root)
        jobs.rebuild_trip_window(spark, args.root, args.as_of, args.window_hours)
    elif args.cmd == "compact":
        print(jobs.compact_warehouse(spark, args.root, args.date))
    elif args.cmd == "stream":
        w = jobs.Warehouse(args.root)
        rate = args.max_files_per_trigger
        for name, run, path, entity in (("bronze_trips", stream.stream_bronze, w.bronze_trips, "trip_update"),
                                        ("bronze_vehicles", stream.stream_bronze, w.bronze_vehicles, "vehicle"),
                                        ("silver_trips", stream.stream_silver, w.silver_trips, "trip_update"),
                                        ("silver_vehicles", stream.stream_silver, w.silver_vehicles, "vehicle")):
            run(spark, args.landing, path, f"{args.checkpoint}/{name}", entity=entity, max_files_per_trigger=rate)
        updates = silver.silver_trip_updates(ingest.flatten_trip_feed(
            stream.read_feed_stream(spark, args.landing, rate)))
        stream.run_foreach_batch(updates, stream.hourly_refresher(w.fact, w.hourly, w.parts), f"{args.checkpoint}/gold")
        stream.run_foreach_batch(updates, stream.current_state_refresher(None, w.current), f"{args.checkpoint}/current")
        if not tables.table_exists(spark, w.hourly):
            return
        hourly = spark.read.parquet(w.hourly)
        tables.overwrite(gold.gold_worst_routes_by_period(hourly), w.worst)
        tables.overwrite(gold.gold_network_summary(hourly), w.network)
        jobs.rebuild_route_tables(spark, args.root)
        jobs.rebuild_trip_window(spark, args.root, hours=args.window_hours)
    else:
        table = _reports(spark, args)
        if args.name not in table:
            ap.error(f"unknown report {args.name!r}; one of {sorted(table)}")
        table[args.name]().write.mode("overwrite").parquet(args.out)


if __name__ == "__main__":
    main()
