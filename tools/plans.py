"""Summarise the physical plans of the registered queries.

Usage: python tools/plans.py [sf_dir] > PLANS.md

Plans are taken with AQE off, i.e. as Catalyst plans them statically (AQE
can only coalesce partitions, split skewed ones, or turn a shuffle join
into a broadcast at runtime).  Each plan is summarised: exchanges by kind,
join strategies, windows, whole-stage-codegen stages, and what reached each
file scan (columns read, pushed and partition filters).
"""

from __future__ import annotations

import re
import sys

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])
from adtrail.plans import registry  # noqa: E402
from adtrail.session import get_spark  # noqa: E402


def summarise(plan: str) -> dict:
    c = lambda pat: len(re.findall(pat, plan))
    scans = []
    for m in re.finditer(r"(?:FileScan|Scan) (parquet|orc|text|json)[^\n]*", plan):
        line = m.group(0)
        rs = re.search(r"ReadSchema: (struct<.*?>)(?:,? \w+:|$)", line)
        pf = re.search(r"PushedFilters: \[([^\]]*)\]", line)
        part = re.search(r"PartitionFilters: \[([^\]]*)\]", line)
        scans.append((m.group(1), rs.group(1)[:100] if rs else "", (pf.group(1)[:80] if pf else ""),
                      (part.group(1)[:50] if part else "")))
    return {
        "shuffle": (c(r"(?<!Reused)Exchange hashpartitioning") + c(r"Exchange rangepartitioning")
                    + c(r"Exchange RoundRobin")) - c(r"ReusedExchange \[[^\]]*\], Exchange"),
        "broadcast": c(r"BroadcastExchange"),
        "BHJ": c(r"BroadcastHashJoin"), "SMJ": c(r"SortMergeJoin"), "SHJ": c(r"ShuffledHashJoin"),
        "BNLJ": c(r"BroadcastNestedLoopJoin"), "window": c(r"\bWindow \["),
        "codegen": c(r"\*\(\d+\)"), "scans": scans,
    }


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark("local[8]", 8, extra={"spark.sql.adaptive.enabled": "false"})
    print(f"# Physical plans of the registered queries ({sf}, static plans, AQE off)\n")
    print("Generated by `python tools/plans.py`. Counts are over the plan of the query's returned")
    print("DataFrame; a query's staging jobs (parsed log, agent table, flagged keys) are separate plans")
    print("and appear here as parquet scans. shuffle = hash/range/round-robin exchanges; reused")
    print("exchanges are not counted twice.\n")
    print("| query | shuffle | broadcast | BHJ | SMJ | SHJ | BNLJ | window | codegen stages |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- | --- |")
    details = []
    for k, fn in registry.QUERIES.items():
        df = fn(spark, sf)
        s = summarise(df._jdf.queryExecution().executedPlan().toString())
        print(f"| {k} | {s['shuffle']} | {s['broadcast']} | {s['BHJ']} | {s['SMJ']} | {s['SHJ']} | {s['BNLJ']} | "
              f"{s['window']} | {s['codegen']} |")
        details.append((k, s["scans"]))
    print("\n## Scans (format, columns read, pushed filters, partition filters)\n")
    for k, scans in details:
        for fmt, rs, pf, part in scans:
            print(f"* `{k}`: {fmt} `{rs}` pushed `[{pf}]` partitions `[{part}]`")


if __name__ == "__main__":
    main()
