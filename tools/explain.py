"""Print the final (post-AQE) physical plans of the headline marts.

Writes the sf dir's test table once as a raw events table partitioned by
``event_date`` (below the checkpoint folder), reads it back through
``read_raw_events`` with an analysis window (PartitionFilters), runs each
query, and prints its executed plan with long attribute lists elided.
Usage: python tools/explain.py [sf_dir] [query ...]
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

DEFAULT = ["user_funnel_steps", "friction_score", "category_performance"]
KEEP = re.compile(
    r"Exchange|Scan|Join|Union|HashAggregate|TakeOrdered|Window|QueryStage|Reused|Generate|Limit|LocalTableScan"
)


def main() -> None:
    from stepwise.plans.catalog import Marts
    from stepwise.session import build_session, shared_dir
    from stepwise.sources.fixture import load_raw
    from stepwise.sources.ga4 import read_raw_events, write_raw_events

    args = sys.argv[1:]
    sf_dir = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.1"
    names = [a for a in args if not os.path.isdir(a)] or DEFAULT
    spark = build_session("local[8]", 8)
    path = shared_dir(spark, "explain")
    write_raw_events(load_raw(spark, sf_dir), path)
    raw = read_raw_events(spark, path, ("20240101", "20240131"))
    for name in names:
        df = getattr(Marts(raw), name)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan()
        # After execution the adaptive plan holds its final form.
        final = plan.finalPhysicalPlan() if hasattr(plan, "finalPhysicalPlan") else plan
        print(f"## {name}\n")
        print("```")
        for line in final.toString().split("\n"):
            if KEEP.search(line):
                line = re.sub(r"\[[^\]]{80,}\]", "[...]", line)
                print(line[:220])
        print("```\n")


if __name__ == "__main__":
    main()
