"""Write PLANS.md: the physical plan shape of every registered analytics query.

    python scripts/plan_report.py [sf_dir]

Per query: exchanges (hash / range / single), broadcasts, joins, windows,
sort-based aggregates, and the Parquet scans' read schema and pushed filters,
taken from the executed (AQE final) plan after one collect of the same frame.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

COUNTS = [("hash exch", "Exchange hashpartitioning"), ("range exch", "Exchange rangepartitioning"),
          ("single exch", "Exchange SinglePartition"), ("broadcast", "BroadcastExchange"),
          ("SMJ", "SortMergeJoin"), ("BHJ", "BroadcastHashJoin"), ("window", "Window ["),
          ("sort agg", "SortAggregate"), ("cartesian", "CartesianProduct"),
          ("BNLJ", "BroadcastNestedLoopJoin")]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from roadsight.queries import queries
    from roadsight.session import get_session
    spark = get_session(master="local[8]", shuffle_partitions=8)
    lines = ["# PLANS", "",
             f"Executed (AQE final) plan shape of every registered query at `{sf_dir}`,",
             "written by `scripts/plan_report.py`. Counts are of plan nodes; the "
             "source/sink queries also run their writes before the plan shown "
             "(the plan is of the DataFrame they return).", "",
             "| query | " + " | ".join(c for c, _ in COUNTS) + " | parquet scans: columns / pushed filters / partition filters |",
             "| --- | " + " | ".join("---" for _ in COUNTS) + " | --- |"]
    for name, fn in queries().items():
        df = fn(spark, sf_dir)
        df.collect()       # an action of this frame: the plan read next is the one that ran
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        scans = []
        for line in plan.split("\n"):
            m = re.search(r"FileScan parquet \[([^\]]*)\]", line)
            if not m:
                continue
            cols = ",".join(c.split("#")[0] for c in m.group(1).split(","))
            pushed = re.search(r"PushedFilters: \[([^\]]*)", line)
            parts = re.search(r"PartitionFilters: \[([^\]]*)", line)
            part = re.sub(r"#\d+", "", parts.group(1)) if parts and parts.group(1) else ""
            pushed = pushed.group(1).split(", ReadSchema")[0] if pushed else ""
            scans.append(f"{cols} / {pushed or '-'}"
                         + (f" / partitions: {part}" if part else ""))
        scans = sorted(set(scans))
        cells = [str(plan.count(pat)) for _, pat in COUNTS]
        lines.append(f"| {name} | " + " | ".join(cells) + " | "
                     + "<br>".join(s.replace("|", "/") for s in scans) + " |")
        print(name, cells, flush=True)
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                           "PLANS.md"), "w") as f:
        f.write("\n".join(lines) + "\n")
    spark.stop()


if __name__ == "__main__":
    main()
