"""Summarise the physical plan of every registered query as it would run on
big inputs: broadcast thresholds disabled (only explicit, size-checked
broadcasts remain), 200 shuffle partitions. The training-data operators write
intermediate tables while their plans are built, so they are left out.

Each query is executed (noop sink) and AQE's *final* plan is read, so an
exchange that several branches share is counted once and reported under
``reused``.

    python tools/plan_report.py [--sf DIR] > PLANS.md

Model fits and stream runs execute while their plan is built and are skipped.
"""

from __future__ import annotations

import argparse
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SKIP = {"shipment_delay_predictions", "pricing_recommendations", "stream_order_alerts",
        "stream_daily_metrics", "customer_state_index"}


def summarise(plan: str) -> dict:
    if "== Initial Plan ==" in plan:            # keep AQE's final plan only
        plan = plan.split("== Initial Plan ==")[0]
    exch = re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobinPartitioning)\(([^)]*)", plan)
    keys = sorted({re.sub(r"#\d+L?", "", k.split(",")[0].strip()) if kind == "hashpartitioning" else kind
                   for kind, k in exch})
    return {
        "shuffle stages": len(re.findall(r"ShuffleQueryStage \d+", plan)),
        "reused": plan.count("ReusedExchange"),
        "shuffle keys": ", ".join(keys),
        "broadcasts": plan.count("BroadcastExchange"),
        "smj": plan.count("SortMergeJoin"),
        "windows": len(re.findall(r"\bWindow \[", plan)),
        "scans pushed": sum(1 for ln in plan.splitlines() if "FileScan" in ln and "PushedFilters: [I" in ln)
                        + sum(1 for ln in plan.splitlines() if "FileScan" in ln and "PushedFilters: [" in ln
                              and "PushedFilters: []" not in ln and "PushedFilters: [I" not in ln),
        "python": "yes" if re.search(r"ArrowEvalPython|FlatMapGroupsInPandas|BatchEvalPython|PythonUDF", plan) else "",
    }


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    a = ap.parse_args()
    from storelake.session import get_session
    from storelake.sources import tables
    spark = get_session("local[8]", 200, extra={
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"})
    tables._SHARED[(id(spark), a.sf.rstrip("/"))] = tables.Tables(spark, a.sf)
    from storelake.plans.registry import QUERIES
    cols = ["shuffle stages", "reused", "shuffle keys", "broadcasts", "smj", "windows", "scans pushed", "python"]
    print("| query | " + " | ".join(cols) + " |")
    print("|---|" + "---|" * len(cols))
    for name, q in QUERIES.items():
        if name in SKIP:
            continue
        df = q(spark, a.sf)
        df._jdf.queryExecution().toRdd().count()
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = summarise(plan)
        print(f"| {name} | " + " | ".join(str(s[c]) for c in cols) + " |", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
