"""Physical-plan summary of every registered (non-streaming) query: exchanges and flagged operators.

Usage: python tools/plan_report.py [sf_dir]   (broadcast joins disabled, so every shuffle is visible)

Flags: nested-loop / cartesian joins, Python evaluation, sort-based aggregation, single-partition exchanges
(global aggregates and scalar subqueries after partial aggregation), top-k and broadcast exchanges.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ridepulse.plans.catalog import QUERIES  # noqa: E402
from ridepulse.session import get_session  # noqa: E402

FLAGS = re.compile(r"NestedLoop|Cartesian|EvalPython|FlatMapGroupsInPandas|SortAggregate|SinglePartition|"
                   r"TakeOrdered|BroadcastExchange|WindowGroupLimit")


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", 8, extra={"spark.sql.autoBroadcastJoinThreshold": "-1"})
    print(f"{'query':34s} {'exchanges':>9s}  flagged operators")
    for name, fn in QUERIES.items():
        if name.startswith(("stream", "refresh", "warehouse")):
            continue          # these run their writes when called
        plan = fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        n = len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|RoundRobin)", plan))
        print(f"{name:34s} {n:9d}  {', '.join(sorted(set(FLAGS.findall(plan))))}")


if __name__ == "__main__":
    main()
