"""Every registered query against a brute-force version on a small table."""

from __future__ import annotations

import base64
import collections
import hashlib
import math
import re
import zlib

import numpy as np
import public_tokenizers
import pytest

from lakemart.llm.queries import QUERIES

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LOW = bytes(i + 32 if 65 <= i < 91 else i for i in range(256))


def got(spark, name, sf, key="doc_id"):
    table = QUERIES[name](spark, sf).toPandas()
    return table.sort_values([c for c in table.columns if c != "spans"]).reset_index(drop=True)


def by_id(rows):
    return {i: t for i, t, *_ in rows}


def fold(i, k):
    return zlib.crc32(str(i).encode()) % k


def u32(ids):
    return np.array(ids, dtype="<u4").tobytes()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_table(spark, empty, name):
    assert QUERIES[name](spark, empty).count() == 0


def encoder():
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: tok.encode(text or "", add_special_tokens=False).ids


def test_token_ids(spark, tiny, rows):
    enc, start, want = encoder(), 0, []
    # Equal ids here have equal texts, so their order does not matter.
    for i, text, *_ in sorted(rows, key=lambda r: r[0]):
        ids = enc(text) + [0]
        want.append((i, start, len(ids), zlib.crc32(u32(ids))))
        start += len(ids)
    table = got(spark, "op4_simple8b_token_ids", tiny)
    assert sorted(table[["doc_id", "start", "n_tokens", "ids_crc32"]].itertuples(index=False, name=None)) == sorted(want)


def test_byte_bpe(spark, tiny, rows):
    import tiktoken

    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as fh:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, fh)}
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for i, text, *_ in rows:
        ids = enc.encode_ordinary(text or "")
        want.append((i, len(ids), hashlib.sha256(u32(ids)).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    table = got(spark, "op7_byte_bpe", tiny)
    assert sorted(table[["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]].itertuples(index=False, name=None)) == sorted(want)


def test_packing(spark, tiny, rows):
    enc, table = encoder(), got(spark, "op9_mixture_packing", tiny)
    copies = collections.Counter(i for i, *_ in rows)
    ids = {i: enc(t) + [0] for i, t, *_ in rows}
    assert (table.ids_crc32 == [zlib.crc32(u32(ids[r.doc_id][r.start:r.start + r.length])) for r in table.itertuples()]).all()
    assert (table.doc_tokens == [len(ids[i]) for i in table.doc_id]).all()
    for i, part in table.groupby("doc_id"):
        seen = collections.Counter(x for r in part.itertuples() for x in range(r.start, r.start + r.length))
        assert seen == {x: copies[i] for x in range(len(ids[i]))}
    sizes = []
    for _, part in table.sort_values("offset").groupby("sequence_id"):
        assert (part.offset.to_numpy() == np.append(0, part.length.cumsum())[:-1]).all()
        sizes.append(int(part.length.sum()))
    assert max(sizes) <= 1024 and sum(sizes) == sum(len(ids[i]) for i, *_ in rows)
    assert all(n & (n - 1) == 0 for n in sizes)   # no padding at all


ASSIGN = re.compile(r"""((?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base_spans(x):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(x) if len(m[2]) >= 12]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", x) if len(m[0]) >= 18]
    return out + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", x) if len(m[0]) >= 16]


def test_secrets(spark, tiny, rows):
    table, texts = got(spark, "op10_secret_markov", tiny), by_id(rows)
    assert len(table) == len(rows)
    for r in table.itertuples():
        spans = sorted(base_spans(texts[r.doc_id] or ""))
        text = ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in spans)
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == n for _, k, _ in spans) for n in range(3))
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert set(filter(None, text.split(","))) <= set(r.spans.split(","))


def test_quality_counts(spark, tiny, rows):
    table, texts = got(spark, "op8_weak_supervision_rules", tiny), by_id(rows)
    for r in table.itertuples():
        x = texts[r.doc_id] or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", x)
        lines = [y for y in x.split("\n") if re.search(r"[^\x20\x09-\x0D]", y)]
        grams = [tuple(w[k:k + 3]) for k in range(len(w) - 2)]
        twice = collections.Counter(grams)
        covered = {k + j for k, g in enumerate(grams) if twice[g] > 1 for j in range(3)}
        want = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in x), len(lines) - len(set(lines)), len(covered))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (len(w) < 50 or 100 * len(covered) > 50 * len(w))
        assert not (r.kept and r.base_failed)
    assert not table[table.doc_id.between(460, 471)].kept.any()
    assert table[table.doc_id.between(300, 339)].kept.all()


def test_base_scores(spark, tiny, rows, monkeypatch):
    from lakemart.llm import ppm

    monkeypatch.setattr(ppm, "MAX_FREQUENT", 100)   # most words take the join
    counts, texts = collections.Counter(), by_id(rows)
    words = {i: WORD.findall((t or "").encode().translate(LOW)) + [None] for i, t in texts.items()}
    for i, *_ in rows:
        if fold(i, 5) != 1:
            counts.update(words[i])
    n, v = sum(counts.values()), len(counts)
    table = got(spark, "op5_ppm_scores", tiny)
    assert len(table) == len(rows)
    for r in table.itertuples():
        w = words[r.doc_id]
        base = sum(math.log10((counts[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (fold(r.doc_id, 5) == 1, len(w), sum(x in counts for x in w), n)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.score <= 0


def components(links, ids):
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


@pytest.mark.parametrize("block, hot", [(4, 50_000), (128, 10)])
def test_ngram_join(spark, tiny, rows, block, hot, monkeypatch):
    from lakemart.llm import ngram_join

    monkeypatch.setattr(ngram_join, "BLOCK", block)   # 4: copies of one text spread over many blocks
    monkeypatch.setattr(ngram_join, "HOT_LEAST", hot)   # 10: lists of the copies' shingles are dealt over parts
    sets = {}
    for i, text in by_id(rows).items():
        w = WORD.findall((text or "").encode().translate(LOW))
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    ids = sorted(sets)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:]
             if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = components(links, ids)
    table = got(spark, "op6_ngram_jaccard_join", tiny)
    assert len(table) == len(rows) and len(set(want[i] for i in range(300, 340))) > 1
    for r in table.itertuples():
        assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), want[r.doc_id])


def test_held_out_labels(spark, rows):
    """Language and quality on documents that taught nothing."""
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    lang = QUERIES["op2_crf_language"](spark, sf).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    quality = QUERIES["op3_latent_neighbours"](spark, sf).join(labels, "doc_id").toPandas()
    assert (lang.held_out == [fold(i, 4) == 2 for i in lang.doc_id]).all() and lang.score.between(0, 1).all()
    lang, quality = lang[lang.held_out], quality[quality.held_out]
    assert (lang.lang == lang.lang_pred).mean() > 0.95
    assert (quality.quality == quality.predicted).mean() > 0.95


def test_language_and_quality_edges(spark, tiny, rows):
    texts = by_id(rows)
    lang = got(spark, "op2_crf_language", tiny)
    assert len(lang) == len(rows)
    for r in lang.itertuples():
        lettered = any(c.isalpha() for c in texts[r.doc_id] or "")
        assert (r.lang_pred == "und") == (not lettered) and 0 <= r.score <= 1
    quality = got(spark, "op3_latent_neighbours", tiny)
    assert len(quality) == len(rows) and quality.score.between(0, 1).all()
    assert (quality.predicted == (quality.score >= 0.7)).all()


def test_vectors(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    rng = np.random.default_rng(3)
    x = list(rng.normal(size=(300, 8)).astype(np.float32))
    x += [x[0] + rng.normal(size=8).astype(np.float32) * 0.2 for _ in range(150)] + [x[1]] * 60 + [x[2] * 3, x[2] * 1e-30]
    odd = [None, [], [0.0] * 8, [float("nan")] * 8, [float("inf")] + [0.0] * 7, [None] + [1.0] * 7, [1.0, 2.0], [2.0, 4.0]]
    vectors = [*map(np.ndarray.tolist, x), *odd]
    ids = [int(i) for i in rng.permutation(len(vectors))]
    pq.write_table(pa.table({"vec_id": pa.array(ids, pa.int64()), "embedding": pa.array(vectors, pa.list_(pa.float32())),
                             "n": pa.array([1] * len(ids))}), tmp_path / "embeddings.parquet")
    unit = np.array([np.asarray(v, np.float64) / np.linalg.norm(np.asarray(v, np.float64)) for v in x])
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    links = [(ids[a], ids[b]) for a, b in zip(*np.nonzero(near))] + [(ids[-2], ids[-1])]
    want = components(links, ids)
    counts = {**{i: 0 for i in ids}, **{ids[k]: int(n) for k, n in enumerate(near.sum(axis=1))}, ids[-1]: 1, ids[-2]: 1}
    table = got(spark, "op1_grid_order_join", str(tmp_path), "vec_id")
    assert len(table) == len(ids)
    for r in table.itertuples():
        assert (r.n_links, r.component_id, r.kept) == (counts[r.vec_id], want[r.vec_id], r.vec_id == want[r.vec_id])
