"""The flat feed through the star-schema load (own rows)."""

from __future__ import annotations

import csv
import datetime as dt
import random
from collections import defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakemart.plans import warehouse as W
from lakemart.sources.files import read_csv_typed

COLUMNS = [c.split()[0] for c in W.FLAT_DDL.split(", ")]


def feed() -> list[dict]:
    rng, out = random.Random(21), []
    for o in range(1, 26):
        user, when = rng.randint(1, 7), dt.datetime(2023, 9, rng.randint(1, 5), rng.randint(0, 23), 5)
        for line in range(1, rng.randint(1, 3) + 1):
            product = rng.randint(1, 9)
            values = [len(out) + 1, o, line, when, when, rng.choice(["paid", "shipped", "created"]) if line == 1
                      else out[-1]["order_status"], f"C{user}", f"name {user}", f"c{user}@x.test", "Lima", dt.date(2022, 1, user),
                      f"K{product}", f"thing {product}", "kind", "maker", rng.randint(1, 4), Decimal(product * 3),
                      Decimal(rng.choice([0, 0, 2])), "cash", "bike"]
            out.append(dict(zip(COLUMNS, values)))
    return out


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    folder, rows = tmp_path_factory.mktemp("dwh"), feed()
    with open(folder / "flat.csv", "w", newline="") as fh:
        w = csv.DictWriter(fh, COLUMNS)
        w.writeheader()
        w.writerows(rows)
    flat = read_csv_typed(spark, str(folder / "flat.csv"), W.FLAT_DDL, header=True, mode="FAILFAST",
                          timestampNTZFormat="yyyy-MM-dd HH:mm:ss")
    root = str(folder / "lake")
    return rows, root, W.load_core(spark, flat, root), W.load_core(spark, flat, root)


def test_second_load_adds_nothing(loaded):
    rows, _, first, second = loaded
    distinct = lambda *cols: len({tuple(r[c] for c in cols) for r in rows})
    assert first == {"users": distinct("user_external_id"), "products": distinct("product_sku"),
                     "orders": distinct("source_order_id"), "order_items": len(rows)}
    assert set(second.values()) == {0}


def test_surrogate_ids_are_dense_and_resolve(spark, loaded):
    rows, root, first, _ = loaded
    core = W.Core(spark, root)
    assert sorted(r.user_id for r in core.users.read().collect()) == list(range(1, first["users"] + 1))
    lines = core.order_items.read()
    assert lines.join(core.orders.read(), "order_id", "left_anti").isEmpty()
    assert lines.join(core.products.read(), "product_id", "left_anti").isEmpty()


def test_daily_sales(spark, loaded):
    rows, root, _, _ = loaded
    want = defaultdict(lambda: [Decimal(0), Decimal(0)])
    for r in rows:
        if r["order_status"] in W.SALES_STATUSES:
            gross = r["item_quantity"] * r["item_price"]
            want[r["order_created_at"].date()][0] += gross
            want[r["order_created_at"].date()][1] += gross - r["item_discount"]
    got = {r.dt: [r.gross_amount, r.line_amount] for r in W.daily_sales(W.sales_lines(spark, root)).collect()}
    assert got == dict(want)


def test_days_without_a_range_are_rejected(spark, loaded):
    _, root, _, _ = loaded
    late = spark.createDataFrame([(dt.date(2023, 11, 2), Decimal(5), Decimal(4))],
                                 "dt date, gross_amount decimal(14,2), line_amount decimal(14,2)")
    mart = W.daily_sales(W.sales_lines(spark, root)).unionByName(late)
    two = {r.dt: r.partition_name for r in W.route_daily_sales(spark, mart, "2023-09-01", 2).collect()}
    assert two[dt.date(2023, 11, 2)] == "rejected" and two[dt.date(2023, 9, 1)] == "daily_sales_2023_09"
    assert W.route_daily_sales(spark, mart, "2023-09-01", 3).filter(F.col("partition_name") == "rejected").isEmpty()
