"""Computer-shop tasks over own tables, against plain Python."""

from __future__ import annotations

from collections import defaultdict

import pytest

from lakemart.plans import devices as D
from lakemart.sources.files import read_csv_strings

MODELS = [("N", 11, "PC"), ("N", 12, "Laptop"), ("N", 13, "Printer"), ("O", 14, "PC"), ("O", 15, "PC"), ("P", 16, "Laptop"),
          ("P", 17, "Laptop"), ("Q", 18, "Printer"), ("R", 19, "PC"), ("R", 20, "Laptop"), ("S", 21, "Laptop"),
          ("S", 22, "Printer")]
PCS = {11: (700, 410), 14: (900, 520), 15: (550, 300), 19: (900, 640), 30: (1500, 999)}      # 30: no product row
LAPTOPS = {12: 800, 16: 450, 20: 720}                                                         # 17 and 21: no price
PRINTERS = {13: 90, 18: 150, 22: 90}
PRICES = {**{m: p for m, (_, p) in PCS.items()}, **LAPTOPS, **PRINTERS}


@pytest.fixture(scope="module")
def shop(spark, tmp_path_factory):
    folder, frames = tmp_path_factory.mktemp("devices"), []
    tables = {"product": ("maker,model,type", MODELS), "pc": ("model,speed,ram,hd,price", [(m, s, 8, 128, p) for m, (s, p) in PCS.items()]),
              "laptop": ("model,speed,ram,hd,screen,price", [(m, 800, 8, 128, 13.5, p) for m, p in LAPTOPS.items()]),
              "printer": ("model,color,type,price", [(m, "y", "Laser", p) for m, p in PRINTERS.items()])}
    for name, (header, rows) in tables.items():
        (folder / f"{name}.csv").write_text("\n".join([header, *[",".join(map(str, r)) for r in rows]]))
        frames.append(read_csv_strings(spark, str(folder / f"{name}.csv")))
    return D.typed_devices(*frames)


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def makers(kind):
    return {m for m, _, t in MODELS if t == kind}


def test_prices(shop):
    product, pc, laptop, printer = shop
    devices = D.all_devices(pc, laptop, printer)
    by_maker, pcs, by_speed = defaultdict(list), defaultdict(list), defaultdict(list)
    for maker, model, _ in MODELS:
        if model in PRICES:
            by_maker[maker].append(PRICES[model])
        if model in PCS:
            pcs[maker].append(PCS[model][1])
    for speed, price in PCS.values():
        by_speed[speed].append(price)
    assert devices.count() == len(PRICES)
    assert [(r.model, r.price) for r in D.top_devices(devices).collect()] == sorted(
        PRICES.items(), key=lambda x: (-x[1], x[0]))[:5]
    for got, want, n in ((D.maker_price_stats(product, devices), by_maker, "priced_models_count"),
                         (D.maker_pc_stats(product, pc), pcs, "pc_models_count")):
        assert rows(got, "maker", n, "min_price", "max_price", "avg_price") == sorted(
            (m, len(p), min(p), max(p), sum(p) / len(p)) for m, p in want.items())
    assert rows(D.avg_pc_price_by_speed(pc), "speed", "avg_price") == sorted(
        (s, sum(p) / len(p)) for s, p in by_speed.items() if s > 600)


def test_members(shop):
    product, pc, laptop, printer = shop
    assert rows(D.laptop_not_printer_makers(product), "maker") == sorted((m,) for m in makers("Laptop") - makers("Printer"))
    assert rows(D.full_coverage_makers(product), "maker") == [("N",)]
    assert rows(D.pc_coverage(product, pc), "maker", "product_pc_models", "matched_pc_models") == [
        ("N", 1, 1), ("O", 2, 2), ("R", 1, 1)]
    assert rows(D.pc_mismatch(product, pc), "model", "issue_type") == [(30, "missing_in_product")]
    assert rows(D.trim_models(product), "model") == [(m,) for m in range(14, 20)]
    assert rows(D.type_counts(product), "maker", "pc_count", "laptop_count", "printer_count") == [
        (m, *[sum(x == m and t == k for x, _, t in MODELS) for k in D.DEVICE_TYPES]) for m in "NOPQRS"]


def test_cheapest_of_each_type(shop):
    product, pc, laptop, printer = shop
    want = []
    for kind in D.DEVICE_TYPES:
        priced = sorted((PRICES[n], n, m) for m, n, t in MODELS if t == kind and n in PRICES)
        want += [(kind, m, n, p) for p, n, m in priced[:2]]
    got = D.cheapest_per_type(product, D.all_devices(pc, laptop, printer))
    assert rows(got, "type", "maker", "model", "price") == sorted(want)
