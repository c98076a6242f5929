"""Summarise the physical plan of every registered query into PLANS.md.

Plans are taken with automatic broadcast disabled (the plan a cluster gets
for tables far beyond the broadcast threshold): what remains broadcast is
only what the code broadcasts on purpose, after a size check.

usage: python tools/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

OPS = ["SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct",
       "WindowGroupLimit", "TakeOrderedAndProject", "Window", "Expand", "Generate"]


def _keys(raw: str) -> str:
    return re.sub(r"#\d+L?", "", raw)


def summarise(text: str, fmt: str) -> dict:
    """``text``: the executed plan tree (operators, exchanges); ``fmt``: the
    formatted explain (scan details)."""
    shuffles = []
    for m in re.finditer(r"Exchange (hashpartitioning\((.*?), \d+\)|rangepartitioning\((.*?), \d+\)|"
                         r"RoundRobinPartitioning\(\d+\)|SinglePartition)", text):
        if m.group(2) is not None:
            shuffles.append(f"hash({_keys(m.group(2))})")
        elif m.group(3) is not None:
            shuffles.append(f"range({_keys(m.group(3)).split(' ')[0]})")
        elif m.group(1).startswith("RoundRobin"):
            shuffles.append("round-robin")
        else:
            shuffles.append("single")
    out = {
        "shuffles": shuffles,
        "broadcasts": text.count("BroadcastExchange"),
        "ops": {op: len(re.findall(rf"\b{op}\b", text)) for op in OPS},
        "pushed": sorted(set(re.findall(r"PushedFilters: \[([^\]]+)\]", fmt))),
        "partition_filters": sorted(set(re.findall(r"PartitionFilters: \[([^\]]+)\]", fmt))),
        "bucketed": "Bucketed: true" in fmt,
    }
    return out


REFLECTION = """## Reading the table at 1000× the data

* Every broadcast here has a bound that does not grow with the data: nation/region (checked ≤ 25 / ≤ 5
  rows), the 3-row event dictionary, the k = 3 edge keys of `trim_edges`, and the partition-offset table of
  the dense-id job (one row per partition). Dimensions that grow (customers, parts) are shuffled; AQE may
  still broadcast them when their runtime size is small.
* The fact table (`lineitem`) is shuffled at most twice: by product for the category lookup, then by order.
  Per-order steps after that (`dominant_category`, `category_cooccurrence`, `top_line_share`, `nest_orders`)
  reuse the order partitioning; per-order totals are windows over at most one row per category.
* Windows never see raw rows of a hot key. Top-n uses `WindowGroupLimit` (partial before the shuffle); the
  per-user windows of Q-H1/Q-H4 run on (user, category) sums; running totals and `lag` run on (user, day)
  chunks; latest/first rows are `max_by`/`min_by` aggregates.
* `single` exchanges carry one partial row per task (global aggregates) or one row per partition (dense-id
  offsets), never data rows.
* Queries with no shuffle at all either stream rows through (projections, casts, unnesting) or read back what
  their load job just wrote (the keyed loads, layouts and streams; their writes are shown in the tests).
* Hot keys in joins: AQE splits skewed sort-merge partitions; `skew_join_salted` shows the explicit salt
  (`hash(user_id, __salt)`), and `skew_agg_salted` the two-phase aggregate salted by the distinct column.

"""


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from lakemart.plans.registry import load_all
    from lakemart.session import build_session

    spark = build_session()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    print("# Physical plans of the registered queries\n")
    print("Generated by `tools/plan_report.py` with automatic broadcast disabled, so every broadcast listed "
          "is one the code asks for after a size check (nation ≤ 25, region ≤ 5 rows, a 3-row dictionary, "
          "top-3 keys, salted-key copies). `shuffles` are the Exchanges of the initial plan (AQE may still "
          "coalesce partitions, split skewed ones, reuse identical exchanges or switch a join to broadcast "
          "from runtime sizes). Single-partition exchanges only ever carry per-task partial results of a "
          "global aggregate or one row per partition.\n")
    print(REFLECTION)
    print("| key | SURVEY | shuffles | joins | broadcasts | windows / limits | pushed to scan |")
    print("|---|---|---|---|---|---|---|")
    for key, spec in sorted(load_all().items(), key=lambda kv: kv[1].survey_id):
        df = spec.fn(spark, sf_dir)
        text = df._jdf.queryExecution().executedPlan().toString()  # noqa: SLF001
        fmt = df._jdf.queryExecution().explainString(  # noqa: SLF001
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))  # noqa: SLF001
        s = summarise(text, fmt)
        joins = ", ".join(f"{n}×{op}" for op, n in s["ops"].items()
                          if n and ("Join" in op or op == "CartesianProduct"))
        wins = ", ".join(f"{n}×{op}" for op, n in s["ops"].items()
                         if n and op in ("WindowGroupLimit", "TakeOrderedAndProject", "Window", "Expand"))
        pushed = "; ".join(re.sub(r"IsNotNull\([^)]*\),? ?", "", p).strip(", ") for p in s["pushed"])
        pushed = "; ".join(x for x in pushed.split("; ") if x)[:160]
        if s["partition_filters"]:
            pushed = (pushed + "; " if pushed else "") + "partition filter"
        if s["bucketed"]:
            pushed = (pushed + "; " if pushed else "") + "bucketed scan"
        shuffles = ", ".join(s["shuffles"]) or "–"
        print(f"| `{key}` | {spec.survey_id} | {len(s['shuffles'])}: {shuffles} | {joins or '–'} | "
              f"{s['broadcasts']} | {wins or '–'} | {pushed or '–'} |")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
