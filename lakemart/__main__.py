"""Run registered queries from the command line.

    python -m lakemart list
    python -m lakemart run <key> [--sf DIR] [--show N] [--out PATH] [--explain]
    python -m lakemart sql <key>          # print the query's SQL oracle

``--out`` writes the full result as Parquet (overwrite); ``--show`` prints
the first N rows (``take``, never a full collect).
"""

from __future__ import annotations

import argparse
import sys


def main(argv: list[str] | None = None) -> int:
    from lakemart.plans.registry import load_all, oracle_text

    p = argparse.ArgumentParser(prog="lakemart")
    sub = p.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list")
    r = sub.add_parser("run")
    r.add_argument("key")
    r.add_argument("--sf", default="/root/testdata/sf0.01")
    r.add_argument("--show", type=int, default=20)
    r.add_argument("--out")
    r.add_argument("--explain", action="store_true")
    q = sub.add_parser("sql")
    q.add_argument("key")
    a = p.parse_args(argv)

    registry = load_all()
    if a.cmd == "list":
        for key, spec in sorted(registry.items(), key=lambda kv: kv[1].survey_id):
            print(f"{spec.survey_id:8} {key}")
        return 0
    spec = registry.get(a.key)
    if spec is None:
        print(f"unknown key {a.key!r}", file=sys.stderr)
        return 2
    if a.cmd == "sql":
        print(oracle_text(spec) or "(no SQL oracle)")
        return 0

    from lakemart.session import build_session

    spark = build_session(app_name=f"lakemart-{a.key}")
    df = spec.fn(spark, a.sf)
    if a.explain:
        df.explain("formatted")
    if a.out:
        df.write.mode("overwrite").parquet(a.out)
        print(f"wrote {a.out}")
    for row in df.take(a.show):
        print(row)
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
