"""Summarise the physical plan of every registered query into PLANS.md.

Usage: python tools/plan_report.py [sf_dir]

For each query (run once so the adaptive plan is final): shuffle exchanges
and their keys, broadcasts, partial top-N, Python nodes, and the columns
each parquet scan reads.
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def summarise(plan: str) -> dict:
    shuffles = re.findall(r"Exchange (hashpartitioning\([^)]*\)|rangepartitioning\([^)]*\)|SinglePartition|"
                          r"RoundRobinPartitioning\([^)]*\))", plan)
    keys = [re.sub(r"#\d+L?", "", s) for s in shuffles]
    reads = sorted(set(re.findall(r"ReadSchema: (struct<[^>]*>)", plan)))
    return {
        "shuffles": len(shuffles) - plan.count("ReusedExchange"),
        "shuffle_keys": sorted(set(keys)),
        "broadcasts": plan.count("BroadcastExchange"),
        "partial_topn": plan.count("WindowGroupLimit") > 0,
        "python": any(p in plan for p in ("ArrowEvalPython", "BatchEvalPython", "ArrowUDF", "MapInPandas",
                                           "FlatMapGroupsInPandas")),
        "reads": reads,
    }


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from tessera.session import get_spark
    from tessera.queries import QUERIES

    spark = get_spark("local[8]", 8)
    out = ["# Physical plans of the registered queries", "",
           f"Final adaptive plans at `{os.path.basename(sf_dir)}` (`tools/plan_report.py`). "
           "Shuffle keys with `_chunk`, `_c`, `_s` or `_b` are chunk/bucket keys: no window or "
           "exchange keyed by a run alone moves raw rows. Streaming queries are listed by their "
           "batch read-back only.", "",
           "| query | shuffles | shuffle keys | broadcasts | partial top-N | Python | parquet columns read |",
           "|---|---|---|---|---|---|---|"]
    for name, fn in QUERIES.items():
        df = fn(spark, sf_dir)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = summarise(plan)
        keys = "<br>".join(f"`{k}`" for k in s["shuffle_keys"]) or "-"
        reads = "<br>".join(f"`{r}`" for r in s["reads"]) or "(checkpointed input)"
        out.append(f"| `{name}` | {s['shuffles']} | {keys} | {s['broadcasts']} | "
                   f"{'yes' if s['partial_topn'] else '-'} | {'yes' if s['python'] else '-'} | {reads} |")
        print(name, s["shuffles"], file=sys.stderr)
    with open(os.path.join(ROOT, "PLANS.md"), "w") as f:
        f.write("\n".join(out) + "\n")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
