"""Writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  compression: str | None = None, partition_by: list[str] | None = None) -> None:
    """Parquet write (optionally compressed / partitioned)."""
    w = df.write.mode(mode)
    if compression:
        w = w.option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_json_lines(df: DataFrame, path: str, mode: str = "overwrite",
                     compression: str | None = None) -> None:
    """Row-store variant of S19 (JSON Lines, optional codec)."""
    w = df.write.mode(mode)
    if compression:
        w = w.option("compression", compression)
    w.json(path)


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", header).csv(path)


def save_table(df: DataFrame, name: str, path: str | None = None, mode: str = "overwrite",
               fmt: str = "parquet") -> None:
    """Catalog table, overwritten per run (external when ``path``)."""
    w = df.write.mode(mode).format(fmt)
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)


def land_raw(df: DataFrame, root: str, source: str, entity: str, dt_col: str = "dt",
             fmt: str = "json", one_day: bool = False) -> str:
    """Land rows untouched at ``raw/<source>/<entity>/dt=…/``;
    re-landing a day replaces only that day (dynamic overwrite).  Rows are
    clustered by day first, so a day gets files by its size, not one per task;
    rows of ``one_day`` are written where they are."""
    path = f"{root}/raw/{source}/{entity}"
    ((df if one_day else df.hint("rebalance", dt_col)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(dt_col).format(fmt).save(path))
    return path


def land_payloads(lines: DataFrame, root: str, source: str, entity: str, dt_col: str = "dt", one_day: bool = False) -> str:
    """S16 byte for byte: text lines (column ``value``) landed as they are, as
    bytes with their SHA-256, at ``raw/<source>/<entity>/dt=…/``; a re-landed
    day replaces itself.  Lines of ``one_day`` are written where they are."""
    path = f"{root}/raw/{source}/{entity}"
    payload = F.col("value").cast("binary")
    landed = lines.select(payload.alias("payload"), F.sha2(payload, 256).alias("sha256"), F.col(dt_col).alias("dt"))
    ((landed if one_day else landed.hint("rebalance", "dt")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
     .partitionBy("dt").parquet(path))
    return path


def land_files(spark: SparkSession, source_path: str, root: str, source: str, entity: str, day: str) -> str:
    """S16 for whole files of any kind: name, bytes and SHA-256 of every file
    under ``source_path``, one row each (a file is held in memory by one task;
    Spark's file sources skip empty files, so those are not landed)."""
    path = f"{root}/raw/{source}/{entity}"
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(source_path)
    (found.select(F.col("_metadata.file_name").alias("file_name"), F.col("content").alias("payload"),
                  F.sha2("content", 256).alias("sha256"), F.lit(day).cast("date").alias("dt"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dt").parquet(path))
    return path


def memory_table(df: DataFrame, name: str) -> DataFrame:
    """In-memory table — a cached temp view (release it with
    ``drop_memory_table``)."""
    df.createOrReplaceTempView(name)
    spark: SparkSession = df.sparkSession
    spark.catalog.cacheTable(name)
    return spark.table(name)


def drop_memory_table(spark: SparkSession, name: str) -> None:
    spark.catalog.uncacheTable(name)
    spark.catalog.dropTempView(name)


def list_tables(spark: SparkSession, database: str | None = None, like: str | None = None) -> list[str]:
    """Table names of a database, optionally filtered by a LIKE pattern."""
    sql = "SHOW TABLES" + (f" IN {database}" if database else "") + (f" LIKE '{like}'" if like else "")
    return [r.tableName for r in spark.sql(sql).collect()]


def list_partitions(spark: SparkSession, table: str) -> list[str]:
    return [r.partition for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
