"""JDBC tables (PostgreSQL, ClickHouse, Greenplum targets).

Reads are split into ``num_partitions`` range queries on a numeric column so
executors read in parallel; writes batch inserts per task.  No driver jar or
server ships here, so the option builders are what the tests exercise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# JDBC driver classes of the supported targets.
DRIVERS = {
    "postgresql": "org.postgresql.Driver",
    "clickhouse": "com.clickhouse.jdbc.ClickHouseDriver",
    "greenplum": "org.postgresql.Driver",
}


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None,
                 partition_column: str | None = None, lower_bound: int | None = None,
                 upper_bound: int | None = None, num_partitions: int | None = None,
                 fetch_size: int = 10000, batch_size: int = 10000) -> dict[str, str]:
    kind = url.split(":")[1] if url.startswith("jdbc:") else ""
    opts = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), "batchsize": str(batch_size)}
    if kind in DRIVERS:
        opts["driver"] = DRIVERS[kind]
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    split = [partition_column, lower_bound, upper_bound, num_partitions]
    if any(v is not None for v in split):
        if not all(v is not None for v in split):
            raise ValueError("partitioned read needs column, lower, upper and num_partitions")
        opts.update(partitionColumn=partition_column, lowerBound=str(lower_bound),
                    upperBound=str(upper_bound), numPartitions=str(num_partitions))
    return opts


def read_jdbc(spark: SparkSession, **kwargs) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(**kwargs)).load()


def write_jdbc(df: DataFrame, mode: str = "append", truncate: bool = False, **kwargs) -> None:
    """Append, or full refresh with ``mode='overwrite', truncate=True``
    (TRUNCATE keeps the table's DDL and grants)."""
    opts = jdbc_options(**kwargs)
    if truncate:
        opts["truncate"] = "true"
    df.write.format("jdbc").options(**opts).mode(mode).save()
