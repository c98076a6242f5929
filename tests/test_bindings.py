"""The bound views: exact half-up cents, status mapping, view sets."""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakemart import bindings as b


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.integers(min_value=1, max_value=10_000_000), st.integers(min_value=1, max_value=50)),
                min_size=1, max_size=40))
def test_cents_price_is_exact_half_up(spark, pairs):
    rows = [(c / 100.0, float(q)) for c, q in pairs]
    got = spark.createDataFrame(rows, "amount double, q double").select(
        b.cents_price(F.col("amount"), F.col("q")).alias("p")).collect()
    want = [(Decimal(c) / 100 / q).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP) for c, q in pairs]
    assert [r.p for r in got] == want


def test_status_names_and_pushed_filter(spark):
    o = b.orders(spark, "/root/testdata/sf0.001", statuses=("paid", "created"))
    assert {r.status for r in o.select("status").distinct().collect()} == {"paid", "created"}
    plan = o._jdf.queryExecution().executedPlan().toString()  # noqa: SLF001
    assert "In(o_orderstatus, [F,O])" in plan or "In(o_orderstatus, [O,F])" in plan


def test_view_set_falls_back_to_raw_tables(spark):
    nation = spark.createDataFrame([(0, "N0", 0)], "n_nationkey int, n_name string, n_regionkey int")
    customer = spark.createDataFrame([(7, "Customer#7", 0, 1.0, "BUILDING")],
                                     "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                                     "c_mktsegment string")
    u = b.users(spark, b.ViewSet(nation=nation, customer=customer)).first()
    assert (u.user_id, u.email, u.city, u.segment) == (7, "customer#7@example.com", "N0", "building")
