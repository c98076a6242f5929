"""Computer-shop tasks over the product / pc / laptop / printer tables written
with the shared operators.

These take the four tables as DataFrames (read as all-string CSV and typed
with ``typed_devices``); they are library functions, not registered keys,
because the driver tables have no device catalogue.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.operators.casting import typed_projection
from lakemart.operators.joins import all_members_match, anti_join, mismatch_report
from lakemart.operators.windows import top_n_per_group, trim_edges

# Declared types of the four CSV tables.
PRODUCT_TYPES = {"maker": "string", "model": "int", "type": "string"}
PC_TYPES = {"model": "int", "speed": "int", "ram": "int", "hd": "int", "price": "int"}
LAPTOP_TYPES = {"model": "int", "speed": "int", "ram": "int", "hd": "int", "screen": "double", "price": "int"}
PRINTER_TYPES = {"model": "int", "color": "string", "type": "string", "price": "int"}
DEVICE_TYPES = ("PC", "Laptop", "Printer")


def typed_devices(product: DataFrame, pc: DataFrame, laptop: DataFrame, printer: DataFrame):
    """Tasks 5–6: cast the all-string reads to their declared types (strict:
    the catalogue is trusted).  The printer's ``type`` becomes
    ``printer_type`` so it cannot clash with ``product.type`` in joins."""
    return (typed_projection(product, PRODUCT_TYPES, strict=True).drop("_bad_fields"),
            typed_projection(pc, PC_TYPES, strict=True),
            typed_projection(laptop, LAPTOP_TYPES, strict=True),
            typed_projection(printer, PRINTER_TYPES, strict=True, rename={"type": "printer_type"}))


def _price_stats(df: DataFrame, group: str, n_name: str) -> DataFrame:
    return (df.groupBy(group).agg(F.count(F.lit(1)).alias(n_name), F.avg("price").alias("avg_price"),
                                  F.min("price").alias("min_price"), F.max("price").alias("max_price")))


def maker_pc_stats(product: DataFrame, pc: DataFrame) -> DataFrame:
    """Task 4: per PC maker, models with a price row and their price stats."""
    return _price_stats(product.join(pc.select("model", "price"), "model"), "maker", "pc_models_count")


def trim_models(product: DataFrame, k: int = 3) -> DataFrame:
    """Task 7: all products but the k lowest and k highest model numbers."""
    return trim_edges(product, [F.col("model")], [F.col("model").desc()], "model", k)


def avg_pc_price_by_speed(pc: DataFrame, min_speed: int = 600) -> DataFrame:
    """Task 8."""
    return pc.filter(F.col("speed") > min_speed).groupBy("speed").agg(F.avg("price").alias("avg_price"))


def pc_coverage(product: DataFrame, pc: DataFrame) -> DataFrame:
    """Task 9: PC makers all of whose PC models have a ``pc`` row."""
    members = (product.filter(F.col("type") == "PC").select("maker", "model")
               .join(pc.select("model", F.lit(True).alias("in_pc")), "model", "left"))
    return (all_members_match(members, "maker", F.col("in_pc").isNotNull())
            .select("maker", F.col("members").alias("product_pc_models"),
                    F.col("matched").alias("matched_pc_models")))


def makers_of(product: DataFrame, device_type: str) -> DataFrame:
    return product.filter(F.col("type") == device_type).select("maker").distinct()


def laptop_not_printer_makers(product: DataFrame) -> DataFrame:
    """Task 10 (left anti join)."""
    return anti_join(makers_of(product, "Laptop"), makers_of(product, "Printer"), "maker")


def all_devices(pc: DataFrame, laptop: DataFrame, printer: DataFrame) -> DataFrame:
    """Task 11: one priced-device table with a type label (bag union)."""
    return (pc.select("model", F.lit("PC").alias("device_type"), "price")
            .unionByName(laptop.select("model", F.lit("Laptop").alias("device_type"), "price"))
            .unionByName(printer.select("model", F.lit("Printer").alias("device_type"), "price")))


def top_devices(devices: DataFrame, k: int = 5) -> DataFrame:
    return devices.orderBy(F.col("price").desc(), F.col("model")).limit(k)


def maker_price_stats(product: DataFrame, devices: DataFrame) -> DataFrame:
    """Task 12 (M7): price statistics per maker over every priced model;
    a priced model without a product row drops out of the inner join."""
    return _price_stats(product.select("maker", "model").join(devices.select("model", "price"), "model"),
                        "maker", "priced_models_count")


def pc_mismatch(product: DataFrame, pc: DataFrame) -> DataFrame:
    """Task 13: PC models missing on one side, with ``issue_type``."""
    return mismatch_report(product.filter(F.col("type") == "PC").select("model"), pc.select("model"),
                           "model", "product", "pc")


def cheapest_per_type(product: DataFrame, devices: DataFrame, n: int = 2) -> DataFrame:
    """Task 14: the n cheapest models of each type (tie-break model)."""
    priced = product.join(devices.select("model", "price"), "model")
    return top_n_per_group(priced, ["type"], [F.col("price"), F.col("model")], n).drop("rn")


def type_counts(product: DataFrame) -> DataFrame:
    """Task 15: models of each type per maker (conditional counts)."""
    return product.groupBy("maker").agg(
        *[F.count(F.when(F.col("type") == t, 1)).alias(f"{t.lower()}_count") for t in DEVICE_TYPES])


def full_coverage_makers(product: DataFrame) -> DataFrame:
    """Task 16: makers with at least one model of every type."""
    return (product.groupBy("maker").agg(F.countDistinct("type").alias("types"))
            .filter(F.col("types") == len(DEVICE_TYPES)).select("maker"))
