"""Nested order documents, event lines and shipments (own documents)."""

from __future__ import annotations

import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakemart import schemas
from lakemart.operators import nested as N
from lakemart.operators.loads import VersionedTable, load_df
from lakemart.operators.quality import EmptyInputError
from lakemart.plans.documents import run_order_documents
from lakemart.sources import files


def item(no, product, quantity, price, path, adjustments=()):
    return {"line_no": no, "product_id": product, "sku": f"S{product}", "quantity": quantity, "unit_price": price,
            "category_path": path, "adjustments": list(adjustments)}


def attempt(provider, status, **error):
    return {"provider": provider, "status": status, "attempted_at": "2024-11-02T08:00:00Z", **error}


def order(key, user, city, status, amount, attempts, items):
    return {"order_id": key, "cart_id": key * 10, "customer": {"user_id": user, "city": city}, "status": status,
            "created_at": "2024-11-02T07:59:00Z", "channel": {"name": "kiosk", "utm": {"source": "flyer", "campaign": "fall"}},
            "payment": {"payment_id": f"P{key}", "status": "Paid", "amount": amount, "currency": "NOK", "attempts": attempts},
            "items": items}


# Quoted numbers, mixed case, error null and absent, empty list and empty path.
ORDERS = [
    order(1, 7, "Bergen", "OPEN", "61.00",
          [attempt("north", "failed", error={"code": "timeout"}), attempt("south", "success", error=None)],
          [item(1, 70, "3", "12.00", ["tools", "saws"], [{"type": "coupon", "amount": "-6.00", "reason": "loyal"},
                                                         {"type": "freight", "amount": "11.00", "reason": "heavy"}]),
           item(2, 71, "4", "5.00", [])]),
    order(2, 8, "Tromso", "open", "8.25", [attempt("north", "success")], [item(1, 72, "1", "8.25", ["seeds"])]),
]


@pytest.fixture(scope="module")
def path(tmp_path_factory):
    p = tmp_path_factory.mktemp("docs") / "orders.json"
    p.write_text(json.dumps(ORDERS, indent=1))
    return str(p)


@pytest.fixture(scope="module")
def docs(spark, path):
    return files.read_json_array(spark, path, schemas.ORDER_DOC)


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def test_headers(docs):
    assert rows(N.order_headers(docs), "order_id", "user_id", "city", "status", "channel", "utm_source", "utm_campaign") == [
        (1, 7, "Bergen", "open", "kiosk", "flyer", "fall"), (2, 8, "Tromso", "open", "kiosk", "flyer", "fall")]
    assert N.order_headers(docs).filter("created_at is null").isEmpty()


def test_items_cast_and_default_category(docs):
    assert rows(N.unnest_items(docs), "order_id", "line_no", "category", "item_amount") == [
        (1, 1, "tools", Decimal("36.00")), (1, 2, "unknown", Decimal("20.00")), (2, 1, "seeds", Decimal("8.25"))]


def test_payments_and_attempts(docs):
    assert rows(N.payment_rows(docs), "payment_id", "payment_status", "amount", "currency") == [
        ("P1", "paid", Decimal("61.00"), "NOK"), ("P2", "paid", Decimal("8.25"), "NOK")]
    assert rows(N.payment_attempts(docs), "payment_id", "attempt_no", "provider", "error_code") == [
        ("P1", 1, "north", "timeout"), ("P1", 2, "south", None), ("P2", 1, "north", None)]


def test_adjustments_keep_items_without_any(docs):
    assert rows(N.item_adjustments(docs), "order_id", "line_no", "adjustment_type", "adjustment_amount") == [
        (1, 1, "coupon", Decimal("-6.00")), (1, 1, "freight", Decimal("11.00")), (1, 2, None, None), (2, 1, None, None)]


def test_raw_rows_and_nesting_back(docs):
    raw = {r.order_id: r for r in N.raw_order_rows(docs).collect()}
    assert raw[1].items_count == 2 and json.loads(raw[1].raw_payload)["payment"]["payment_id"] == "P1"
    assert raw[2].loaded_at is not None
    nested = N.nest(N.unnest_items(docs), "order_id", ["line_no", "product_id"])
    assert {r.order_id: [tuple(x) for x in r["items"]] for r in nested.collect()} == {1: [(1, 70), (2, 71)], 2: [(1, 72)]}


def test_latest_shipment_status(spark):
    legs = lambda *xs: [{"status": s, "event_time": f"2024-11-0{d}T06:00:00Z", "city": c} for s, d, c in xs]
    df = spark.createDataFrame([
        {"shipment_id": "A", "order_id": 1, "provider": "sled", "events": legs(("done", 5, "Bergen"), ("packed", 3, "Oslo"))},
        {"shipment_id": "B", "order_id": 2, "provider": "boat", "events": legs(("packed", 4, "Oslo"))}], schemas.SHIPMENT)
    assert rows(N.latest_shipment_status(df), "shipment_id", "last_status", "last_city") == [
        ("A", "done", "Bergen"), ("B", "packed", "Oslo")]


def test_event_lines_keep_open_bags_as_maps(spark, tmp_path):
    lines = [{"event_id": "x", "user_id": 7, "order_id": 1, "event_type": "scan", "event_time": "2024-11-02T07:00:00Z",
              "context": {"lane": "4"}, "attributes": {"weight": "12", "dock": "C"}},
             {"event_id": "y", "user_id": 8, "order_id": 2, "event_type": "scan", "event_time": "2024-11-02T07:05:00Z",
              "context": {}, "attributes": {"weight": "3"}}]
    (tmp_path / "e.jsonl").write_text("\n".join(map(json.dumps, lines)))
    df = files.read_json_lines(spark, str(tmp_path / "e.jsonl"), schemas.EVENT_LINE)
    got = {r.event_id: r.attributes for r in df.collect()}
    assert got["x"]["dock"] == "C" and "dock" not in got["y"] and dict(df.dtypes)["attributes"] == "map<string,string>"


def test_api_payload_to_rows(spark):
    page = {"products": [{"id": 5, "title": "rope", "price": 3.5, "stock": 40}, {"id": 6, "title": "tent", "price": 129.0,
                                                                                "stock": 0}], "total": 2, "skip": 0, "limit": 9}
    assert rows(N.api_products(spark.createDataFrame([page], schemas.API_PAGE)), "product_id", "price", "stock") == [
        (5, Decimal("3.50"), 40), (6, Decimal("129.00"), 0)]


def test_flow_twice_changes_nothing(spark, path, tmp_path):
    for _ in range(2):
        out = run_order_documents(spark, path, str(tmp_path / "lake"))
    assert out["orders_raw"].count() == 2
    assert rows(out["order_city_stats"], "city", "orders_count", "users_count", "total_payment_amount") == [
        ("Bergen", 1, 1, Decimal("61.00")), ("Tromso", 1, 1, Decimal("8.25"))]
    assert rows(out["order_status_stats"], "status", "orders_count", "total_payment_amount") == [("open", 2, Decimal("69.25"))]
    assert rows(out["category_revenue"], "category", "items_count", "total_quantity", "total_item_amount") == [
        ("seeds", 1, 1, Decimal("8.25")), ("tools", 1, 3, Decimal("36.00")), ("unknown", 1, 4, Decimal("20.00"))]
    with pytest.raises(EmptyInputError):
        run_order_documents(spark, str(tmp_path / "none.json"), str(tmp_path / "lake"))


def test_generic_keyed_load(spark, docs, tmp_path):
    tables = {"orders": (N.order_headers(docs), ["order_id"]), "lines": (N.unnest_items(docs), ["order_id", "line_no"]),
              "attempts": (N.payment_attempts(docs), ["payment_id", "attempt_no"])}
    for _ in range(2):
        for name, (df, keys) in tables.items():
            load_df(spark, df, f"{tmp_path}/{name}", keys)
    assert {n: VersionedTable(spark, f"{tmp_path}/{n}").read().count() for n in tables} == {
        "orders": 2, "lines": 3, "attempts": 3}
    v = VersionedTable(spark, f"{tmp_path}/orders").current_version()
    load_df(spark, N.order_headers(docs).limit(0), f"{tmp_path}/orders", ["order_id"])
    assert VersionedTable(spark, f"{tmp_path}/orders").current_version() == v


def test_json_text_to_struct_and_back(spark):
    doc = {"id": 4, "owner": {"name": "Ola", "zip": "5003"}, "parts": [{"code": "Q", "n": 2}]}
    ddl = "id bigint, owner struct<name: string, zip: string>, parts array<struct<code: string, n: int>>"
    parsed = spark.createDataFrame([(json.dumps(doc),)], "j string").select(F.from_json("j", ddl).alias("o"), "j")
    r = parsed.select("o.owner.zip", F.to_json("o").alias("back"), F.get_json_object("j", "$.owner.name").alias("name")).first()
    assert (r.zip, r.name) == ("5003", "Ola") and json.loads(r.back) == doc
