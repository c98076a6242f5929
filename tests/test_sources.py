"""Sources, sinks and configuration builders."""

from __future__ import annotations

import json
import os
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lakemart.sources import api, files, jdbc, object_store, sinks


def tmp():
    return tempfile.mkdtemp(prefix="lakemart-src-")


CUSTOMERS_CSV = ("user_id,email,country,segment,status\n1,alice@example.com,US,Premium,ACTIVE\n"
                 "2,bob@example.com,US,New,active\n3,carlos@example.com,MX,Regular,ACTIVE")


def test_s1_s2_csv_strings_and_inferred(spark):
    p = Path(tmp()) / "customers.csv"
    p.write_text(CUSTOMERS_CSV)
    s = files.read_csv_strings(spark, str(p))
    assert all(t == "string" for _, t in s.dtypes)
    inferred = files.read_csv_inferred(spark, str(p))
    assert dict(inferred.dtypes)["user_id"] == "int"
    lowered = s.select(F.lower("segment").alias("segment"), F.lower("status").alias("status"))
    assert sorted(r.status for r in lowered.collect()) == ["active"] * 3


def test_s3_s4_typed_csv_failfast(spark):
    d = Path(tmp())
    (d / "events.csv").write_text("1,10,view,100,site,2026-05-24 10:00:00\nx,11,view,101,site,2026-05-24\n")
    ddl = "event_id INT, user_id INT, event_type STRING, product_id INT, source STRING, event_ts STRING"
    ok = files.read_csv_typed(spark, str(d), ddl, mode="PERMISSIVE")
    assert ok.count() == 2 and ok.filter(F.col("event_id").isNull()).count() == 1
    with pytest.raises(Exception):
        files.read_csv_typed(spark, str(d), ddl, mode="FAILFAST").collect()


def test_s15_paged_api_source(spark):
    d = Path(tmp())
    items = [{"id": i, "title": f"p{i}", "price": float(i), "stock": i % 3} for i in range(70)]
    for skip in range(0, 90, 30):
        page = {"products": items[skip:skip + 30], "total": len(items), "skip": skip, "limit": 30}
        (d / f"page_{skip}.json").write_text(json.dumps(page))
    api.register(spark)
    url = f"file://{d}/page_{{skip}}.json"
    df = spark.read.format("paged_api").option("url", url).option("limit", 30).option("max_rows", 60).load()
    assert df.rdd.getNumPartitions() == 2
    assert sorted(r.id for r in df.collect()) == list(range(60))
    full = spark.read.format("paged_api").option("url", url).option("limit", 30).load()
    assert full.count() == 70


@pytest.mark.parametrize("total,cap,rows", [(True, 100, 70), (True, 7, 70), (False, 100, 70), (False, 7, 70)])
def test_s15_capped_pages_and_missing_total(total, cap, rows, monkeypatch):
    """A server that caps its pages or does not say the total loses no row."""
    from pyspark.sql.types import LongType, StructField, StructType

    def page(url, *_):
        skip, limit = map(int, url.split("/"))
        items = [{"id": k} for k in range(rows)][skip:skip + min(limit, cap)]
        return {"products": items, **({"total": rows} if total else {})}

    monkeypatch.setattr(api, "fetch_json", page)
    reader = api.PagedApiReader(StructType([StructField("id", LongType())]), {"url": "{skip}/{limit}", "limit": 30})
    assert sorted(x for p in reader.partitions() for (x,) in reader.read(p)) == list(range(rows))
    limited = api.PagedApiReader(reader.schema, {"url": "{skip}/{limit}", "limit": 30, "max_rows": 41})
    assert sorted(x for p in limited.partitions() for (x,) in limited.read(p)) == list(range(41))


def test_s15_a_window_that_ends_early_is_an_error(monkeypatch):
    from pyspark.sql.types import LongType, StructField, StructType

    monkeypatch.setattr(api, "fetch_json", lambda *_: {"products": [], "total": 5})
    reader = api.PagedApiReader(StructType([StructField("id", LongType())]), {"url": "x", "limit": 30})
    with pytest.raises(api.IncompletePageError):
        list(reader.read(reader.partitions()[0]))


def test_cluster_without_shared_folder_is_an_error():
    from lakemart.session import ensure_checkpoint_dir, on_one_machine

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):  # noqa: N802 - Spark's name
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()  # noqa: N815 - Spark's name

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())
    assert on_one_machine("local[4]") and not on_one_machine("local-cluster[2,1,1024]")


def test_s15_window_plan():
    assert api.plan_windows(70, 30, None) == [(0, 30), (30, 30), (60, 10)]
    assert api.plan_windows(70, 30, 45) == [(0, 30), (30, 15)]


def test_s11_jdbc_options():
    opts = jdbc.jdbc_options("jdbc:postgresql://db:5432/shop", "ods.orders", user="u", password="p",
                             partition_column="order_id", lower_bound=1, upper_bound=1000, num_partitions=8)
    assert opts["driver"] == "org.postgresql.Driver" and opts["numPartitions"] == "8"
    with pytest.raises(ValueError):
        jdbc.jdbc_options("jdbc:postgresql://db/x", "t", partition_column="id")


def test_s12_object_store_conf():
    env = {"S3_ENDPOINT_URL": "http://minio:9000", "AWS_ACCESS_KEY_ID": "k", "AWS_SECRET_ACCESS_KEY": "s",
           "S3_BUCKET": "lake"}
    conf = object_store.s3a_conf(env)
    assert conf["spark.hadoop.fs.s3a.endpoint"] == "http://minio:9000"
    assert conf["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert object_store.lake_uri(env, "/raw/", "orders") == "s3a://lake/raw/orders"


def test_s16_land_raw_dynamic_by_day(spark):
    root = tmp()
    df = spark.createDataFrame([(1, "2026-05-24"), (2, "2026-05-25")], "id int, dt string")
    path = sinks.land_raw(df, root, "shop", "orders")
    sinks.land_raw(spark.createDataFrame([(3, "2026-05-25")], "id int, dt string"), root, "shop", "orders")
    got = sorted((r.id, str(r.dt)) for r in spark.read.json(path).collect())
    assert got == [(1, "2026-05-24"), (3, "2026-05-25")]


def test_s17_s19_compression_smaller(spark):
    df = spark.range(20000).select((F.col("id") % 10).cast("string").alias("v"))
    a, b2 = tmp() + "/plain", tmp() + "/gz"
    sinks.write_parquet(df, a, compression="none")
    sinks.write_parquet(df, b2, compression="gzip")

    def size(p):
        return sum(f.stat().st_size for f in Path(p).glob("*.parquet"))
    assert size(b2) < size(a)
    jl = tmp() + "/jl"
    sinks.write_json_lines(df, jl, compression="gzip")
    assert spark.read.json(jl).count() == 20000


def test_s18_s20_s21_catalog(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS ods")
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    sinks.save_table(df, "ods.t_demo", path=tmp() + "/t")
    sinks.save_table(df, "ods.t_demo", path=tmp() + "/t2")
    assert "t_demo" in sinks.list_tables(spark, "ods", like="t_*")
    m = sinks.memory_table(df, "mem_demo")
    assert spark.catalog.isCached("mem_demo") and m.count() == 1
    spark.catalog.uncacheTable("mem_demo")


def test_p16_source_file(spark):
    d = tmp()
    spark.range(3).write.mode("overwrite").parquet(d)
    names = {r.source_file for r in files.with_source_file(spark.read.parquet(d)).collect()}
    assert all(n.endswith(".parquet") for n in names)


def test_dq2_missing_or_empty_input(spark):
    from lakemart.operators.quality import EmptyInputError, ensure_not_empty

    with pytest.raises(EmptyInputError):
        ensure_not_empty(spark, os.path.join(tmp(), "nope"))
    d = tmp() + "/empty"
    spark.createDataFrame([], "id int").write.parquet(d)
    with pytest.raises(EmptyInputError):
        ensure_not_empty(spark, d)


def test_s21_show_partitions(spark):
    from lakemart.sources.sinks import list_partitions

    spark.sql("CREATE DATABASE IF NOT EXISTS raw")
    spark.sql("DROP TABLE IF EXISTS raw.events_by_day_demo")
    spark.sql(f"CREATE TABLE raw.events_by_day_demo (id INT, event_date STRING) USING parquet "
              f"PARTITIONED BY (event_date) LOCATION '{tmp()}/ev'")
    spark.createDataFrame([(1, "2026-05-24"), (2, "2026-05-25")], "id int, event_date string") \
        .write.insertInto("raw.events_by_day_demo")
    assert list_partitions(spark, "raw.events_by_day_demo") == ["event_date=2026-05-24", "event_date=2026-05-25"]


def test_p15_fill_and_dedupe(spark):
    from lakemart.functions.scalars import fill_missing

    df = spark.createDataFrame([(1, None), (1, None), (2, "x")], "id int, v string")
    filled = fill_missing(df, {"v": "unknown"}).dropDuplicates()
    assert sorted(tuple(r) for r in filled.collect()) == [(1, "unknown"), (2, "x")]


def test_s15_fetch_retries_then_fails_clearly(monkeypatch):
    calls = []
    real = api.urllib.request.urlopen

    def flaky(url, timeout):
        calls.append(url)
        if len(calls) < 3:
            raise OSError("temporary failure")
        return real(url, timeout=timeout)

    d = Path(tmp())
    (d / "page.json").write_text(json.dumps({"products": [], "total": 0}))
    monkeypatch.setattr(api.urllib.request, "urlopen", flaky)
    assert api.fetch_json(f"file://{d}/page.json", retries=3, backoff=0) == {"products": [], "total": 0}
    assert len(calls) == 3
    calls.clear()
    with pytest.raises(RuntimeError, match="after 2 attempts"):
        api.fetch_json(f"file://{d}/missing.json", retries=1, backoff=0)
