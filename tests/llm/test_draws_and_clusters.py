"""License scans, importance resampling and centroid clustering against
brute-force versions and their SQL."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from lakemart.llm import heap_means, license_diagonals, resampling
from lakemart.llm.queries import ORACLE_SQL, QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOW))


def sql_rows(name, folder):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    cur = con.execute(ORACLE_SQL[name])
    return [d[0] for d in cur.description], cur.fetchall()


def same_as_sql(spark, name, folder):
    columns, want = sql_rows(name, folder)
    got = [tuple(r) for r in QUERIES[name](spark, str(folder)).select(*columns).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    return [dict(zip(columns, r)) for r in got]


MIT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
       "documentation files (the \"Software\")")
LICENSED = [
    "x CC-BY 4.0 and cc by. CC\nBY!", "All rights reserved. ALL RIGHTS, reserved", "general public general public license v3",
    MIT, "intro words " + MIT.replace("free of charge", "entirely free of any charge") + " more words",
    MIT.replace("hereby ", ""), "permission is hereby refused to any person", "Licensed under the Apache License, Version 2.0.",
    "licensed under the old apache license version 2.0", "cc bÿ, ccby, acc by, cc byy", "ÀLL rights reserved Àcc by",
    "the general public, license", "cc by " * 3000, "", None, "1 2 3", "cc", "ſ K cc\x00by",
]


@pytest.fixture(scope="module")
def licensed(tmp_path_factory):
    folder = tmp_path_factory.mktemp("licensed")
    rng = random.Random(1)
    notices = [t for _, t in license_diagonals.CATALOGUE]
    texts = list(LICENSED)
    for _ in range(120):
        out = []
        for _ in range(rng.randint(0, 4)):
            out += rng.choices(["the", "of", "license", "this", "software", "public", "cc", "by", "rights"], k=rng.randint(0, 30))
            part = rng.choice(notices).split()
            for _ in range(rng.randint(0, 3)):
                k = rng.randrange(len(part))
                part[k:k + rng.randint(0, 1)] = rng.choice([["new"], ["a", "b"], []])
            out += part
        texts.append(" ".join(out))
    ids = [None if k % 9 == 4 else k for k in range(len(texts))]
    ids, texts = ids + ids[:30] * 2, texts + texts[:30] * 2     # repeated rows
    pq.write_table(pa.table({"doc_id": pa.array(ids, pa.int64()), "text": pa.array(texts, pa.string()),
                             "spans": [1] * len(ids), "template": [2] * len(ids)}), folder / "documents.parquet", row_group_size=40)
    for name in ("benchmark", "embeddings"):
        pq.write_table(pa.table({"text": pa.array([], pa.string())}), folder / f"{name}.parquet")
    return folder


def test_phrases_and_spans(spark, licensed):
    rows = same_as_sql(spark, "op11_license_diagonals", licensed)
    table = pq.read_table(licensed / "documents.parquet").to_pylist()
    want = []
    for r in table:
        w = words(r["text"])
        found = [(k, label) for label, phrase in license_diagonals.PHRASES for p in [phrase.split()]
                 for k in range(len(w)) if w[k:k + len(p)] == p]
        at = [k for k, _ in found]
        want.append((r["doc_id"], len(w), len(found), min(at, default=None), max(at, default=None),
                     ",".join(sorted({x for _, x in found}))))
    got = [tuple(r[c] for c in ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")) for r in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert all(0 <= r["score"] <= 1 and set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) for r in rows)


def test_edited_notices_are_found(spark, licensed):
    docs = spark.createDataFrame(list(enumerate(LICENSED)), "doc_id long, text string")
    found = {r["doc_id"]: r for r in license_diagonals.scan(docs).collect()}
    label = lambda k: {s["label"] for s in found[k]["spans"]}
    assert label(3) == label(4) == label(5) == {"mit"} and label(6) == set()
    assert label(7) == label(8) == {"apache-2.0"}
    span = found[4]["spans"][0]
    assert (span["first_word"], span["exact"]) == (2, False) and 0.7 <= span["score"] < 1 == found[3]["score"]
    assert len(found[12]["spans"]) == 3000                       # copies side by side stay apart
    own = license_diagonals.scan(docs, [("mine", "old apache license")])
    assert [r["doc_id"] for r in own.collect() if r["spans"]] == [8]
    with pytest.raises(ValueError):
        license_diagonals.scan(docs, [("short", "word")])


def test_license_copies_come_back_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(license_diagonals, "COPIES_AT_ONCE", 4)
    docs = spark.createDataFrame([(None, "cc by")] * 11 + [(1, "cc by")] * 4 + [(2, None)] * 5, "doc_id long, text string")
    got = license_diagonals.digest(license_diagonals.scan(docs)).collect()
    assert sorted((r["doc_id"] or 0, r["n_base"]) for r in got) == [(0, 1)] * 11 + [(1, 1)] * 4 + [(2, 0)] * 5


def brute_resample(rows, target, run=1, min_words=20):
    """rows: (id, text); one (id, n_features, weight, score, rank) each."""

    def buckets(text):
        w = words(text)
        return [zlib.crc32(" ".join(w[k:k + n]).encode()) % 10000 for n in range(1, run + 1) for k in range(len(w) - n + 1)]

    s, t = np.zeros(10000), np.zeros(10000)
    for _, x in rows:
        np.add.at(s, buckets(x), 1)
    for x in target:
        np.add.at(t, buckets(x), 1)
    out = []
    for i, x in rows:
        f = buckets(x)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (s.sum() + 10000) / ((s[b] + 1) * (t.sum() + 10000)))) for b in f)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words(x))])
    able = sorted((r for r in out if r[5] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0, -r[1]))
    for k, r in enumerate(able[:len(able) * 10 // 100]):
        r[4] = k + 1
    return [tuple(r[:5]) for r in out]


@pytest.mark.parametrize("run", [1, 3])
def test_resampling(spark, tiny, rows, run):
    # A word longer than what is hashed at once, and blanks of other kinds between words.
    docs = [(i, t) for i, t, *_ in rows] + [(None, rows[0][1]), (901, "Ab c, " + "é" * 90 + "  x_y " * 30)]
    target = [t for _, t, *_ in rows[:9]]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumnRenamed("text", "body").selectExpr(
        "*", "1 as score", "2 as rank", "3 as text").repartition(5)
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    got = resampling.resample(frame, goal, text_col="body", run=run)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    want = brute_resample(docs, target, run)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert sum(r[4] is not None for r in want) > 10
    if run == 1:
        same_as_sql(spark, "op12_importance_resampling", tiny)


def test_resampling_without_target_or_words(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None), (None, "")], "doc_id long, text string")
    none = spark.createDataFrame([], "text string")
    assert sorted((r["doc_id"] or 0, r["n_features"], r["rank"]) for r in resampling.resample(docs, none).collect()) == [
        (0, 0, None), (1, 2, None), (2, 0, None)]
    assert resampling.resample(docs.limit(0), none).count() == 0


def test_cutoff_among_ties(spark):
    rng = random.Random(4)
    table = [(rng.choice([None, *range(40)]), rng.choice([-5, 0, 0, 0, 7])) for _ in range(300)]
    frame = spark.createDataFrame(table, "doc_id long, score long")
    order = sorted(table, key=lambda r: (-r[1], r[0] is None, r[0] or 0))
    for wanted in (1, 40, 61, 120, 200, 235, 299, 300):
        assert resampling.cutoff(frame, wanted) == order[wanted - 1][::-1]
    assert resampling.bisect(3, 3, lambda p: []) == 3
    for good in (-70, -1, 0, 68, 69):
        assert resampling.bisect(-70, 69, lambda p: [x <= good for x in p], 3) == good


def test_ranks_over_partitions(spark):
    rows = spark.range(5000).selectExpr("id as doc_id", "id as n_features", "0L as weight", "pmod(hash(id), 50) as score").repartition(7)
    got = {r["doc_id"]: r["rank"] for r in resampling.ranked(rows).collect()}
    table = sorted(((-r["score"], r["doc_id"]) for r in rows.collect()))
    assert got == {i: k + 1 for k, (_, i) in enumerate(table)}


def brute_clusters(vectors, k=16, rounds=3):
    """vectors: (id, integer tuple)."""
    order = sorted(vectors, key=lambda v: (hashlib.sha256(f"1:{'' if v[0] is None else v[0]}".encode()).hexdigest(), v[1]))
    centroids = [list(v) for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in vectors]
        for n in range(len(centroids)):
            mine = [v for (_, v), o in zip(vectors, own) if o == n]
            if mine:
                centroids[n] = [sum(x) // len(mine) for x in zip(*mine)]
    found = [nearest(v) for _, v in vectors]
    inertia = [sum(d for d, n in found if n == c) for c in range(len(centroids))]
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, n, d, inertia[n], sum(inertia), sha[n]) for (i, _), (d, n) in zip(vectors, found)), key=repr)


@pytest.mark.parametrize("size", [0, 5, 300])
def test_clusters(spark, tmp_path, size):
    rng = np.random.default_rng(2)
    middles = rng.normal(size=(9, 64))
    x = [(middles[rng.integers(9)] + rng.normal(size=64) * 0.3).astype(np.float32).tolist() for _ in range(size)]
    x += x[:40] + x[:3]                                       # copies tie everywhere
    ids = [int(i) for i in rng.permutation(len(x))]
    if size > 5:
        ids[7] = None
        ids += [ids[0], ids[1]]                               # repeated ids with other and with equal vectors
        x += [x[5], x[1]]
    odd = [None, [], [0.0] * 63, [0.0] * 65, [None] + [1.0] * 63, [float("nan")] * 64, [float("inf")] + [0.0] * 63, [1e30] * 64]
    pq.write_table(pa.table({"vec_id": pa.array(ids + list(range(900, 900 + len(odd))), pa.int64()),
                             "embedding": pa.array(x + odd, pa.list_(pa.float32())),
                             "cluster": pa.array([3] * (len(x) + len(odd)))}), tmp_path / "embeddings.parquet", row_group_size=64)
    for name in ("benchmark", "documents"):
        pq.write_table(pa.table({"text": pa.array([], pa.string())}), tmp_path / f"{name}.parquet")
    kept = [(i, tuple(math.floor(64 * float(c)) for c in v)) for i, v in zip(ids, x)]
    got = QUERIES["op13_heap_means"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got), key=repr) == brute_clusters(kept)
    same_as_sql(spark, "op13_heap_means", tmp_path)


def test_bounds_spare_scans(spark):
    rng = np.random.default_rng(7)
    middles = rng.normal(size=(6, 8)) * 40
    x = np.round(middles[rng.integers(6, size=2000)] + rng.normal(size=(2000, 8))).tolist()
    frame = spark.createDataFrame(list(enumerate(x)), "vec_id long, embedding array<double>").repartition(3)
    found = heap_means.cluster_vectors(frame, k=6, rounds=6, dimensions=8, scale=1)
    assert found.scanned[0] == 2000 and sum(found.scanned[3:]) < 2000
    got = sorted(tuple(r) for r in found.members.collect())
    assert got == [(i, c, d) for i, c, d, *_ in sorted(brute_clusters([(k, tuple(map(int, v))) for k, v in enumerate(x)], 6, 6))]


def test_expired_are_popped_in_order():
    now = heap_means.Round(np.zeros((2, 1), np.int64), np.array([1.0, 5.0]))
    cluster, key = np.array([0, 1, 0, 1, 1]), np.array([0.5, 5.1, 1.2, 4.0, 5.0])
    assert heap_means.expired(cluster, key, now) == [0, 3, 4]


def test_large_components_are_exact():
    rng = np.random.default_rng(1)
    for top in (100, heap_means.IN_DOUBLES, heap_means.LARGEST):
        x, c = rng.integers(1 - top, top, size=(50, 64)), rng.integers(1 - top, top, size=(7, 64))
        want = [[sum((int(a) - int(b)) ** 2 for a, b in zip(v, w)) for w in c] for v in x]
        assert heap_means.squared_distances(x, c).tolist() == want
