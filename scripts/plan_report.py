"""Summarize the physical plan of every registered query into PLANS.md.

For each query: shuffles (with their partitioning), broadcasts, window
partition keys, and what the Parquet scans read and push down.  Built from
``DataFrame.explain("formatted")`` at sf0.01.

    python scripts/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def _strip_ids(text: str) -> str:
    return re.sub(r"#\d+L?", "", text)


def summarize(plan: str) -> dict:
    shuffles = [_strip_ids(m) for m in re.findall(r"Arguments: (hashpartitioning\([^)]*\)|SinglePartition|rangepartitioning\([^)]*\))", plan)]
    windows = [_strip_ids(m) for m in re.findall(r"Arguments: \[.*?windowspecdefinition\(([^,]*(?:, [^,]*)*?), ", plan)]
    schemas = [re.sub(r"struct<|>$", "", m) for m in re.findall(r"ReadSchema: (struct<.*?>)\n", plan + "\n")]
    pushed = [m for m in re.findall(r"PushedFilters: \[(.*)\]$", plan, re.M) if m]
    return {
        "shuffles": shuffles,
        "broadcasts": plan.count("BroadcastExchange"),
        "windows": len(re.findall(r"^\(\d+\) Window\b", plan, re.M)),
        "group_limit": "WindowGroupLimit" in plan,
        "scans": schemas,
        "pushed": pushed,
    }


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from mqtable.session import local_session

    spark = local_session(8)
    from mqtable.plans.catalog import QUERIES

    print("# Physical plans of the registered queries\n")
    print(f"Generated by `scripts/plan_report.py` from `explain(\"formatted\")` at `{sf}` (AQE initial plans).")
    print("`hashpartitioning(queue, …)` over an aggregate is a small table; message-sized data is never")
    print("partitioned by `queue` alone (see README, Scale design).  Jobs while built: what ran before the plan")
    print("existed (schema reads, publishing a log); jobs of streams run in threads of their own and are not counted.\n")
    print("| query | jobs while built | shuffles (partitioning) | broadcasts | windows | scans read (columns) | pushed filters |")
    print("|---|---|---|---|---|---|---|")
    for name, q in QUERIES.items():
        buf = io.StringIO()
        spark.sparkContext.setJobGroup(f"build-{name}", name)
        df = q(spark, sf)
        built = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"build-{name}"))
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        s = summarize(buf.getvalue())
        shuffles = "; ".join(sorted(set(s["shuffles"]))) or "none"
        count = len(s["shuffles"])
        wins = f"{s['windows']}" + (" (+partial top-N)" if s["group_limit"] else "")
        scans = "; ".join(sorted(set(s["scans"]))) or "—"
        pushed = "; ".join(sorted(set(s["pushed"]))) or "—"
        print(f"| `{name}` | {built} | {count}: {shuffles} | {s['broadcasts']} | {wins} | {scans} | {pushed} |")


if __name__ == "__main__":
    main()
