"""File readers.

Paths may be local, ``hdfs://`` or ``s3a://``: the same reader works on any
Hadoop file system, so "remote CSV with an explicit schema" (S13) is a
path-prefix swap plus the schema.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_csv_strings(spark: SparkSession, path: str, header: bool = True, sep: str = ",") -> DataFrame:
    """Header CSV, every column a string (no inference pass)."""
    return spark.read.option("header", header).option("inferSchema", False).option("sep", sep).csv(path)


def read_csv_inferred(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """CSV with inferred types — for exploration only (an extra full
    pass over the input)."""
    return spark.read.option("header", header).option("inferSchema", True).csv(path)


def read_csv_typed(spark: SparkSession, path: str, schema: str | StructType, header: bool = False,
                   mode: str = "FAILFAST", sep: str = ",", **options) -> DataFrame:
    """Delimited text with a declared schema.  A malformed row
    fails the load (bulk copy into a typed table); ``rejects.read_with_rejects``
    sets such rows aside instead."""
    r = spark.read.schema(schema).option("header", header).option("mode", mode).option("sep", sep)
    for k, v in options.items():
        r = r.option(k, v)
    return r.csv(path)


def read_json_array(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A multi-line JSON file holding an array of documents (one row per
    element).  A multi-line file is not splittable: one task per file.  A file
    that is no JSON fails the load; ``rejects.read_json_documents`` reports it."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def read_json_lines(spark: SparkSession, path: str, schema: StructType | str, **options) -> DataFrame:
    """JSON Lines with a declared schema (splittable)."""
    r = spark.read.schema(schema)
    for k, v in options.items():
        r = r.option(k, v)
    return r.json(path)


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    """S8."""
    return spark.read.parquet(*paths)


def with_source_file(df: DataFrame) -> DataFrame:
    """The file each row came from (``_metadata`` of file sources)."""
    from pyspark.sql import functions as F

    return df.withColumn("source_file", F.col("_metadata.file_name"))
