"""Payloads, documents, rejects and pages: what does not fit is kept and named."""

from __future__ import annotations

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from lakemart import schemas
from lakemart.operators.keyed import BucketTable
from lakemart.sources import api, files, rejects, sinks
from lakemart.streaming.streams import file_stream


def test_payload_bytes_survive_and_days_replace_themselves(spark, tmp_path):
    raw = [b'{"a": 1}', b"caf\xc3\xa9\r", b"\xff\xfe not utf-8", b"", b"  two  blanks "]
    (tmp_path / "in.txt").write_bytes(b"\n".join(raw) + b"\n")
    lines = spark.read.option("lineSep", "\n").text(str(tmp_path / "in.txt")).withColumn("dt", F.lit("2026-01-02").cast("date"))
    for _ in range(2):
        path = sinks.land_payloads(lines, str(tmp_path / "lake"), "shop", "lines")
    sinks.land_payloads(lines.limit(1).withColumn("dt", F.lit("2026-01-03").cast("date")), str(tmp_path / "lake"), "shop", "lines")
    landed = spark.read.parquet(path).collect()
    first = [r for r in landed if str(r.dt) == "2026-01-02"]
    assert sorted(bytes(r.payload) for r in first) == sorted(raw) and len(landed) == len(raw) + 1
    assert all(hashlib.sha256(bytes(r.payload)).hexdigest() == r.sha256 for r in landed)


def test_files_land_whole(spark, tmp_path):
    (tmp_path / "in" / "deep").mkdir(parents=True)
    content = {"a.bin": bytes(range(256)), "b.txt": b"\r\n\xff"}
    (tmp_path / "in" / "a.bin").write_bytes(content["a.bin"])
    (tmp_path / "in" / "deep" / "b.txt").write_bytes(content["b.txt"])
    (tmp_path / "in" / "deep" / "none.txt").write_bytes(b"")     # no bytes, no row
    for _ in range(2):
        path = sinks.land_files(spark, str(tmp_path / "in"), str(tmp_path / "lake"), "shop", "files", "2026-01-02")
    got = {r.file_name: (bytes(r.payload), r.sha256) for r in spark.read.parquet(path).collect()}
    assert got == {n: (x, hashlib.sha256(x).hexdigest()) for n, x in content.items()}


def test_a_file_that_is_no_json_is_one_reject(spark, tmp_path):
    (tmp_path / "in").mkdir()
    good = [{"order_id": 1, "status": "PAID", "items": [{"line_no": 1}]}, {"order_id": 2}]
    (tmp_path / "in" / "one.json").write_text(json.dumps(good, indent=1))
    (tmp_path / "in" / "two.json").write_text(json.dumps([{"order_id": 3}]))
    (tmp_path / "in" / "cut.json").write_text('[{"order_id": 4}, {"order')
    (tmp_path / "in" / "empty.json").write_text("[]")
    read = rejects.read_json_documents(spark, str(tmp_path / "in"), schemas.ORDER_DOC, str(tmp_path / "out"))
    assert {r.order_id for r in read.rows.collect()} >= {1, 2, 3} and read.rows.columns == schemas.ORDER_DOC.names
    assert {r.source_file for r in read.rejects.collect()} == {"cut.json"}
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|parse"):
        files.read_json_array(spark, str(tmp_path / "in"), schemas.ORDER_DOC).collect()


def test_bad_fields_are_rejects_not_nulls(spark, tmp_path):
    (tmp_path / "in.csv").write_text("1,a,2.50\nx,b,1.00\n3,c,\n4,d\n5,e,n/a\n6,f,1,7\n")
    ddl = "k int, v string, amount decimal(6,2)"
    read = rejects.read_with_rejects(spark, str(tmp_path / "in.csv"), ddl, "csv", str(tmp_path / "out"))
    assert sorted((r.k, r.v, r.amount and float(r.amount)) for r in read.rows.collect()) == [(1, "a", 2.5), (3, "c", None)]
    assert sorted(r[rejects.RECORD] for r in read.rejects.collect()) == ["4,d", "5,e,n/a", "6,f,1,7", "x,b,1.00"]
    assert read.rejects.first().source_file == "in.csv"
    with pytest.raises(Exception):
        files.read_csv_typed(spark, str(tmp_path / "in.csv"), ddl).collect()
    none = rejects.read_with_rejects(spark, str(tmp_path / "in.csv"), "a string, b string, c string, d string", "csv", str(tmp_path / "all"))
    assert none.rows.count() + none.rejects.count() == 6
    with pytest.raises(ValueError):
        rejects.with_record(f"{rejects.RECORD} int")


def test_messages_that_do_not_parse_are_kept(spark, tmp_path):
    schema = "k long, v string"
    batch = spark.createDataFrame([('{"k": 1, "v": "a"}',), ('{"k": "x", "v": "b"}',), ("{",), (None,), ("{}",)], "value string")
    got = sorted(map(tuple, rejects.typed_messages(batch, schema).collect()), key=repr)
    assert [r for r in got if r[2] is None] == [(1, "a", None), (None, None, None)]      # an empty object is a message
    assert sorted(r[2] for r in got if r[2] is not None) == ["", "{", '{"k": "x", "v": "b"}']
    (tmp_path / "in").mkdir()
    table = BucketTable(spark, str(tmp_path / "t"), ["k"], schema)
    for step, text in enumerate(['{"k": 1, "v": "a"}\n{"k": 2', '{"k": 1, "v": "b"}\nnothing\n{"k": 3, "v": "c"}', '{"k": 3, "v": "c"}']):
        (tmp_path / "in" / f"{step}.txt").write_text(text)
        source = rejects.typed_messages(file_stream(spark, str(tmp_path / "in"), "value string", "text"), schema)
        rejects.load_messages(source, table, str(tmp_path / "bad"), str(tmp_path / "ckpt"))
    assert sorted(map(tuple, table.read().collect())) == [(1, "b"), (3, "c")]
    assert sorted(r[0] for r in spark.read.parquet(str(tmp_path / "bad")).select(rejects.RECORD).collect()) == ["nothing", '{"k": 2']


@pytest.mark.parametrize("n", [0, 1, 30, 61, 200])
def test_capped_pages_lose_no_row(spark, tmp_path, n):
    rows = spark.range(n).selectExpr("id * 3 as id", "concat('t', id) as title", "id / 2.0D as price", "id as stock").repartition(3)
    url = api.write_pages(rows, str(tmp_path), "id", 30)
    api.register(spark)
    got = spark.read.format("paged_api").option("url", url).option("limit", 90).load()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, rows.collect()))


def test_memory_table_is_given_back(spark):
    from lakemart.plans.sources import memory_table_read

    got = memory_table_read(spark, "/root/testdata/sf0.001")
    assert got.count() == 3 and spark.sparkContext._jsc.getPersistentRDDs().size() == 0  # noqa: SLF001
