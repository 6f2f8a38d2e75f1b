"""ridepulse: transit-delay analytics as Spark DataFrame functions.

Realtime vehicle and trip-update snapshots are flattened into bronze rows, typed into silver tables and
rolled up into fact and gold tables; report functions answer the operator questions (where each vehicle is,
how late each trip is and whether it is getting worse, which trips report a delay but no position, which
routes perform worst by weekday and period, how healthy the network is). Every function takes and returns
DataFrames or Columns built from built-in Spark expressions.
"""

__version__ = "0.1.0"

from ridepulse.functions.columns import (  # noqa: E402
    clean_nonfinite, clean_route_name, day_of_week, delay_category, route_code, surrogate_key, time_period,
    time_period_of, to_minutes, trend,
)
from ridepulse.operators.ingest import flatten_trip_feed, flatten_vehicle_feed  # noqa: E402
from ridepulse.operators.keyed import (  # noqa: E402
    incremental_since, insert_if_absent, latest_per_key, merge_by_key, previous_before, prune_old, upsert,
)
from ridepulse.operators.silver import silver_trip_updates, silver_vehicle_positions  # noqa: E402
from ridepulse.plans.gold import (  # noqa: E402
    dim_routes, fact_historical_delays, gold_network_summary, gold_route_performance,
    gold_route_performance_hourly, gold_worst_routes_by_period, route_period_stats,
)
from ridepulse.plans.live import (  # noqa: E402
    ghost_count, ghost_dots, ghost_trips, incident_list, live_dots, live_trips, route_menu, selection_bounds,
    trend_counts, vehicle_delay_info, with_route_description, worst_delay_by_route,
)
from ridepulse.plans.reports import (  # noqa: E402
    delay_distribution, delay_trend, delay_trend_series, delays, delays_summary, gps_delay_coverage, latest_delay, latest_positions,
    latest_vehicles, network_health, previous_delay, routes, total_trips, trip_history, worst_routes,
)
