"""Summarise the physical plan of every registered query into PLANS.md:
exchanges (shuffles), join strategies, explicit/automatic broadcasts, scans
and their pushed filters, window and generator operators.

Usage: python tools/plans.py [sf_dir] > PLANS.md
The plans are taken after one execution, so AQE's final plan is shown.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shelfline.plans import catalog  # noqa: E402
from shelfline.session import local_session  # noqa: E402

PATTERNS = {
    "shuffles": r"\bExchange hashpartitioning|\bExchange rangepartitioning|\bExchange RoundRobin|\bExchange SinglePartition",
    "broadcasts": r"BroadcastExchange",
    "bhj": r"BroadcastHashJoin",
    "smj": r"SortMergeJoin",
    "shj": r"ShuffledHashJoin",
    "windows": r"\bWindow\b",
    "generate": r"\bGenerate\b",
    "python": r"MapInPandas|FlatMapCoGroupsInPandas|FlatMapGroupsInPandasWithState|ArrowEvalPython",
    "takeordered": r"TakeOrderedAndProject",
}


def summarise(plan: str) -> dict:
    out = {k: len(re.findall(p, plan)) for k, p in PATTERNS.items()}
    scans = re.findall(r"FileScan parquet [^\n]*?Location: [^\[\n]*\[([^\]]*)\][^\n]*?"
                       r"PushedFilters: \[([^\]]*)\]", plan)
    names = []
    for loc, pf in scans:
        base = os.path.basename(loc.split(",")[0].rstrip("/")).replace(".parquet", "")
        base = re.sub(r"-[0-9a-f]{12}$", "", base)
        pf = ", ".join(f for f in pf.split(", ") if not f.startswith("IsNotNull"))
        item = (base, pf if len(pf) < 80 else pf[:77] + "...")
        if item not in names:
            names.append(item)
    out["scans"] = names
    return out


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    qs = catalog.QUERIES
    print("# PLANS — physical plan shape per registered query\n")
    print(f"Generated by `tools/plans.py` at `{sf}` on local[8] after one execution (AQE final plans).")
    print("Shuffles = hash/range/round-robin/single-partition exchanges; BHJ/SMJ/SHJ = broadcast-hash /"
          " sort-merge / shuffled-hash joins; scans list the table and its pushed filters.")
    print("`model-*` scans read the materialised model tables (plans/model.py).\n")
    print("| key | shuffles | BHJ | SMJ | SHJ | window | generate | python | top-k | scans (pushed filters) |")
    print("|---|---|---|---|---|---|---|---|---|---|")
    for k in sorted(qs):
        df = qs[k](spark, sf)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = summarise(plan)
        scans = "; ".join(f"{t} [{pf}]" if pf else t for t, pf in s["scans"])
        print(f"| `{k}` | {s['shuffles']} | {s['bhj']} | {s['smj']} | {s['shj']} | {s['windows']} | "
              f"{s['generate']} | {s['python']} | {s['takeordered']} | {scans} |")


if __name__ == "__main__":
    main()
