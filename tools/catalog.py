"""Write the query catalogue (QUERIES.md) from the registry.

usage: python tools/catalog.py > QUERIES.md
"""

from __future__ import annotations

import inspect
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def main() -> None:
    from lakemart.plans.registry import load_all
    from lakemart.session import build_session

    spark = build_session(app_name="lakemart-catalog")
    sf = "/root/testdata/sf0.001"
    print("# Query catalogue\n")
    print("Every registered query: `python -m lakemart run <key> --sf <dir>` runs it, "
          "`python -m lakemart sql <key>` prints its SQL oracle. Columns are those of the result.\n")
    print("| key | SURVEY | what it computes | columns | module |")
    print("|---|---|---|---|---|")
    for key, spec in sorted(load_all().items(), key=lambda kv: (kv[1].survey_id, kv[0])):
        doc = inspect.getdoc(spec.fn) or ""
        first = " ".join(doc.split("\n\n")[0].split()).replace("|", "\\|") if doc else "–"
        cols = ", ".join(spec.fn(spark, sf).columns)
        module = spec.fn.__module__.replace("lakemart.", "")
        print(f"| `{key}` | {spec.survey_id} | {first} | {cols} | `{module}` |")
    spark.stop()


if __name__ == "__main__":
    main()
