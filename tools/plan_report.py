"""Summarise the final (post-AQE) physical plan of every registered query.

usage: python tools/plan_report.py [sf_dir] > PLANS.md
For each query: shuffles, reused shuffles, broadcast / sort-merge joins,
single-partition exchanges, scans and whether the status predicate reached
the parquet scan.  Each query is executed once so AQE's final plan is shown.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main():
    from tillscope.registry import queries
    from tillscope.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    print(f"# Final physical plans ({sf_dir}, local[*], AQE on)\n")
    print("Counts are taken from each query's final adaptive plan.  `SinglePartition` exchanges come")
    print("only from global aggregates after a map-side partial step (one row per task), or from")
    print("windows over bounded frames (partition offsets of the distributed NTILE, monthly totals).")
    print("Queries that checkpoint (NTILE, pivots, basket pairs) or read a per-star shared table show the plan after")
    print("that table was materialised: the scans that built it ran in its own checkpoint job and do not appear")
    print("in the query's plan (e.g. the orders scan behind the per-customer table).\n")
    print("| query | shuffles | reused | BHJ | SMJ | SinglePartition | scans | pushed status filter |")
    print("|---|---|---|---|---|---|---|---|")
    scan_rows = []
    for name, q in queries().items():
        df = q(spark, sf_dir)
        df.collect()  # run it through this QueryExecution so the final AQE plan is recorded
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        shuffles = len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|RoundRobin|SinglePartition)", plan))
        single = plan.count("Exchange SinglePartition")
        reused = plan.count("ReusedExchange")
        bhj = plan.count("BroadcastHashJoin") + plan.count("BroadcastNestedLoopJoin")
        smj = plan.count("SortMergeJoin")
        scans = plan.count("FileScan") + plan.count("Scan ExistingRDD")
        pushed = "yes" if "EqualTo(o_orderstatus,F)" in plan else "-"
        print(f"| {name} | {shuffles} | {reused} | {bhj} | {smj} | {single} | {scans} | {pushed} |")
        formatted = spark.sparkContext._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        scan_rows.append((name, _scans(formatted)))
    print("\n## Parquet scans: columns read and filters pushed\n")
    print("| query | table | columns read | pushed filters |")
    print("|---|---|---|---|")
    for name, found in scan_rows:
        for table, cols, filters in found:
            print(f"| {name} | {table} | {cols} | {filters} |")
    spark.stop()


def _scans(formatted: str) -> list[tuple[str, str, str]]:
    """(table, columns, pushed filters) of each distinct parquet scan in a formatted plan."""
    out = []
    for block in re.findall(r"\(\d+\) Scan parquet.*?(?=\n\(\d+\) |\Z)", formatted, flags=re.S):
        loc = re.search(r"Location: \S+ \[file:[^\]]*/([a-z_]+)\.parquet\]", block)
        schema = re.search(r"ReadSchema: struct<(.*)>", block)
        pushed = re.search(r"PushedFilters: \[(.*)\]", block)
        cols = ", ".join(c.split(":")[0] for c in (schema.group(1).split(",") if schema else []))
        row = (loc.group(1) if loc else "?", cols, pushed.group(1) if pushed else "")
        if row not in out:
            out.append(row)
    return out


if __name__ == "__main__":
    main()
