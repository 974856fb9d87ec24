"""Plan shape of the main queries: exchanges, joins, aggregates, pushdown.

    python tools/plan_report.py [sf_dir] [name ...]

Prints one line per query from the executed physical plan, so the scale
claims in README.md (co-located joins, few exchanges, pushed filters) can be
re-checked after a change.
"""

from __future__ import annotations

import collections
import re
import sys

sys.path.insert(0, ".")
from tracery.plans import registry as Q  # noqa: E402
from tracery.session import local_session  # noqa: E402

DEFAULT = ("job_io", "lineage_inputs", "schema_fields", "aspects", "catalog_current", "flow_members",
           "first_events", "event_plan_nodes")
PATTERN = re.compile(r"(Exchange \w+|SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin|HashAggregate|"
                     r"ObjectHashAggregate|SortAggregate|Window|FileScan)")


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or DEFAULT
    spark = local_session("plan-report")
    for name in names:
        df = Q.QUERIES[name](spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        counts = collections.Counter(PATTERN.findall(plan))
        pushed = len(re.findall(r"PushedFilters: \[[^\]]+\]", plan))
        bucketed = plan.count("Bucketed: true")
        print(f"{name:22s} {dict(sorted(counts.items()))} pushed_filter_scans={pushed} bucketed_scans={bucketed}")


if __name__ == "__main__":
    main()
