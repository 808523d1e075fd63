"""Summarise the physical plan of every registered query into PLANS.md.

usage: python tools/plan_report.py [sf_dir] > PLANS.md
Queries that fit models while their frame is built are listed without a plan.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TRAINED = {"model_comparison", "model_comparison_cv", "progressive_accuracy", "feature_importances",
           "scored_results", "biggest_surprises", "residual_histogram", "ols_split250", "predict_from_text",
           "ols_split250_reaction", "prediction_example", "linear_holdout", "polynomial_holdout", "linear_cv", "linear_by_distance",
           "linear_scored", "linear_surprises", "linear_residual_histogram", "ingest_in_batches"}


def summarise(plan: str) -> dict:
    scans = []
    for m in re.finditer(r"FileScan (\w+) \[[^\]]*\].*?Location: [^\[]*\[([^\]]*)\].*?ReadSchema: struct<([^>]*)>",
                         plan):
        source = os.path.basename(m.group(2).split(",")[0]).replace(".parquet", "")
        cols = [c.split(":")[0] for c in m.group(3).split(",") if c]
        scans.append(f"{source}({len(cols)})")
    return {
        "shuffles": len(re.findall(r"\bExchange (?:hashpartitioning|rangepartitioning|RoundRobin|SinglePartition)", plan))
                    + len(re.findall(r"\bShuffleExchange", plan)),
        "broadcasts": len(re.findall(r"BroadcastExchange", plan)),
        "joins": sorted(set(re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|"
                                       r"CartesianProduct) \w*", plan))),
        "windows": len(re.findall(r"\bWindow \[", plan)) + len(re.findall(r"WindowGroupLimit", plan)),
        "python": any(k in plan for k in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas")),
        "scans": sorted(set(scans)),
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from lapline.plans.registry import REGISTRY
    from lapline.session import local_session
    spark = local_session(8)
    print("# Physical plans of the registered queries\n")
    print(f"Generated by `tools/plan_report.py` at `{sf_dir}` (initial AQE plans; AQE may still turn a shuffle join "
          "into a broadcast join at run time). `scans` lists table(columns read); checkpointed inputs read no table.\n")
    print("| query | shuffles | broadcasts | joins | windows | python | scans |")
    print("|---|---|---|---|---|---|---|")
    for name, fn in REGISTRY.items():
        if name in TRAINED:
            print(f"| {name} | (fits a model while building) | | | | | |")
            continue
        plan = fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        s = summarise(plan)
        joins = ", ".join(j.strip() for j in s["joins"]) or "-"
        print(f"| {name} | {s['shuffles']} | {s['broadcasts']} | {joins} | {s['windows']} | "
              f"{'yes' if s['python'] else 'no'} | {' '.join(s['scans']) or '-'} |")


if __name__ == "__main__":
    main()
