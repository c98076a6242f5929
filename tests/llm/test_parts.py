"""Parts of the operators against plain versions, and the whole pipeline."""

from __future__ import annotations

import collections
import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakemart.llm import common, langid_crf, ngram_join, packing, ppm, quality_knn, secret_markov, simple8b, weak_rules
from lakemart.llm import textbatch as tb
from lakemart.llm.components import components


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 255), st.integers(0, 2 ** 64 - 1), st.integers(0, 70_000)), max_size=3000))
def test_simple8b_round_trip(values):
    words, blocks = simple8b.encode(np.array(values, dtype=np.uint64))
    assert simple8b.decode(words, blocks).tolist() == values
    if len(blocks) > 2:
        assert simple8b.decode(words, blocks, slice(1, 2)).tolist() == values[1024:2048]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB \n\té　x", max_size=40)), max_size=12))
def test_word_spans(texts):
    b, off = tb.byte_view(pa.array(texts, pa.string()))
    starts, ends, woff = tb.word_spans(b, off)
    got = [[b[s:e].tobytes() for s, e in zip(starts[x:y], ends[x:y])] for x, y in zip(woff[:-1], woff[1:])]
    assert got == [re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode()) for t in texts]
    hashes = tb.hash_spans(b, starts, ends).tolist()
    words = [w for ws in got for w in ws]
    assert len(set(zip(words, hashes))) == len(set(words)) == len(set(hashes))


@pytest.mark.parametrize("keys", [
    np.zeros(0), np.array([0]), np.array([7, 2 ** 64 - 1], np.uint64), np.arange(5000), np.arange(5000) << 40, np.arange(70) ** 8])
def test_places_are_those_of_the_keys(keys):
    keys = np.random.default_rng(3).permutation(np.unique(keys.astype(np.uint64)))
    places, by = ppm.Places.of(keys)
    assert np.array_equal(places.keys, keys[by]) and np.diff(places.first).max() <= 12
    ask = np.unique(np.concatenate([keys, keys + np.uint64(1), keys ^ np.uint64(1 << 45)]))
    at, hit = places.find(ask)
    assert np.array_equal(hit, np.isin(ask, keys)) and np.array_equal(places.keys[at[hit]], ask[hit])


def test_a_known_byte_costs_less_than_a_bisection():
    rng = np.random.default_rng(4)
    codes = np.unique(rng.integers(0, 1 << 48, 1_500_000, dtype=np.uint64))
    trie, ask = ppm.Trie(codes, np.ones(len(codes), np.int64), 5), rng.permutation(codes)

    def seconds(f):
        times = []
        for _ in range(3):
            start = time.perf_counter()
            f()
            times.append(time.perf_counter() - start)
        return min(times)

    assert seconds(lambda: trie.log10(ask)) < seconds(lambda: np.searchsorted(codes, ask))


def test_trie_is_a_distribution_and_matches_plain_ppm():
    rng = random.Random(2)
    text = bytes(rng.choice(b"abcd ") for _ in range(400)) + b"abcabcabc"
    order = 3
    _, _, s, _ = ppm.symbols(pa.array([text.decode()]), order)
    codes, counts = np.unique(ppm.gram_codes(s, order)[s != ppm.START], return_counts=True)
    trie = ppm.Trie(codes, counts, order)
    seen: dict[bytes, dict[int, float]] = {}
    for k in range(order, len(s)):
        for n in range(order + 1):
            follow = seen.setdefault(s[k - n:k].tobytes(), {})
            follow[int(s[k])] = follow.get(int(s[k]), 0) + 1

    def plain(context: bytes, symbol: int) -> float:
        p, out = 1.0, set()
        for n in range(len(context), -1, -1):
            follow = {x: c for x, c in seen.get(context[len(context) - n:], {}).items() if x not in out}
            if not follow:
                continue
            total = sum(follow.values())
            if symbol in follow:
                return p * (2 * follow[symbol] - 1) / (2 * total)
            p *= len(follow) / (2 * total)
            out |= set(follow)
        return p / (256 - len(out))

    for context in (b"abc", b"zzz", b"dab", b"zza", bytes([ppm.START] * 3), b"za "):
        codes = np.array([int.from_bytes(context + bytes([x]), "big") for x in range(256)], dtype=np.uint64)
        p = 10 ** trie.log10(codes)
        assert p == pytest.approx([plain(context, x) for x in range(256)], rel=1e-4)
        assert p.sum() == pytest.approx(1, abs=1e-4)


def test_empty_trie_predicts_all_symbols_alike():
    trie = ppm.Trie(np.zeros(0, np.uint64), np.zeros(0, np.int64), 2)
    assert 10 ** trie.log10(np.arange(5, dtype=np.uint64)) == pytest.approx([1 / 256] * 5)


@pytest.mark.parametrize("most", [1, 300, 3000])
def test_scores_do_not_depend_on_what_travels_with_the_tasks(spark, tiny, monkeypatch, most):
    docs = spark.read.parquet(f"{tiny}/documents.parquet").select("doc_id", "text")

    def scores():
        table = ppm.score(docs, F.col("doc_id") % 5 != 1, keep=["doc_id"]).toPandas()
        return table.sort_values(["doc_id", "score"]).reset_index(drop=True)

    whole = scores()
    monkeypatch.setattr(ppm, "MAX_TRIE", most)
    cut = scores()
    assert cut.score.tolist() == pytest.approx(whole.score.tolist(), rel=1e-9)
    assert cut.drop(columns="score").equals(whole.drop(columns="score"))


def test_forward_backward():
    rng = np.random.default_rng(0)
    sizes, k = np.array([7, 0, 20, 1, 33]), 3
    scores, change, first = rng.normal(size=(sizes.sum(), k)), rng.normal(size=(k, k)), rng.normal(size=k)
    gamma, moves, firsts = langid_crf.forward_backward(scores, sizes, change, first, transitions=True)
    at, want_moves, want_first = 0, np.zeros((k, k)), np.zeros(k)
    for n in sizes:
        s, at = scores[at:at + n], at + n
        if not n:
            continue
        alpha, beta = np.zeros((n, k)), np.ones((n, k))
        alpha[0] = np.exp(first + s[0])
        for t in range(1, n):
            alpha[t] = (alpha[t - 1] @ np.exp(change)) * np.exp(s[t])
        for t in range(n - 2, -1, -1):
            beta[t] = np.exp(change) @ (np.exp(s[t + 1]) * beta[t + 1])
        z = alpha[-1].sum()
        assert np.allclose(alpha * beta / z, gamma[at - n:at])
        want_first += gamma[at - n]
        for t in range(n - 1):
            want_moves += np.outer(alpha[t], np.exp(s[t + 1]) * beta[t + 1]) * np.exp(change) / z
    assert np.allclose(moves, want_moves) and np.allclose(firsts, want_first)


def test_code_switched_words_get_their_own_language():
    en, fr = "the house with other water north when thing", "les maison où vous être après très château"
    rng = random.Random(1)
    texts = [" ".join(rng.choices(x.split(), k=40)) for x in [en, fr] * 30]
    model = langid_crf.fit(pa.array(texts), ["en", "fr"] * 30)
    lang, score, words, other = langid_crf.predict_batch(
        model, pa.array(["the house with other water les maison où", "très après vous être", "12 !?", None]))
    assert lang == ["en", "fr", "und", "und"] and other.tolist() == [3, 0, 0, 0] and words.tolist() == [8, 4, 0, 0]
    assert score[1] > 0.9 > score[0] > 0.5 and score[2] == score[3] == 0


def test_stretches_come_from_the_whole_text():
    text = " ".join(f"w{k}" for k in range(30_000))
    cut = common.stretches(text, 20_000)
    words = [int(w[1:]) for w in cut.split()]
    assert len(cut) <= 20_000 and len(words) > 2000 and words == sorted(set(words))
    assert words[0] < 5000 and words[-1] > 25_000 and set(cut.split()) <= set(text.split())
    assert common.stretches("ab c", 20_000) == "ab c" and common.stretches(None, 5) is None
    assert len(common.stretches("漢" * 50_000, 20_000)) == 20_000


def test_a_language_or_class_of_long_texts_is_learned(spark):
    words = {"en": "the house with other water north when thing", "fr": "les maison où vous être après très château"}
    rng = random.Random(1)
    rows = [(k, " ".join(rng.choices(words["fr" if k % 2 else "en"].split(), k=4500 if k % 2 else 40)),
             "fr" if k % 2 else "en", k % 2) for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, quality int")
    assert min(len(t) for _, t, lang, _ in rows if lang == "fr") > langid_crf.FIT_CHARS
    for teaches in (F.lit(True), F.col("lang") == "fr"):
        model = langid_crf.train(docs, teaches)
        assert langid_crf.predict_batch(model, pa.array(["très après vous être"]))[0] == ["fr"]
    model = quality_knn.train(docs, docs, F.lit(True))
    assert sorted(set(model.labels)) == [0, 1]
    held_out = pa.array([" ".join(rng.choices(words[x].split(), k=n)) for x, n in (("fr", 4500), ("en", 40))])
    assert (model.score(quality_knn.term_counts(held_out)) > 0.5).tolist() == [True, False]


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10_000))
def test_divide_skip_finds_all_components(seed):
    rng = random.Random(seed)
    base = rng.sample(range(1000), 40)
    sets = []
    for _ in range(25):
        s = set(base[:rng.choice([40, 20, 30])])
        for _ in range(rng.randint(0, 5)):
            s.discard(rng.choice(base))
            s.add(rng.randint(0, 2000))
        sets.append(np.array(sorted(s), dtype=np.uint64))
    links = ngram_join.divide_skip(sets, ngram_join.Forest(np.arange(25)))
    forest, want = ngram_join.Forest(np.arange(25)), ngram_join.Forest(np.arange(25))
    for x, y in links:
        a, b = set(sets[x].tolist()), set(sets[y].tolist())
        assert 100 * len(a & b) >= 80 * len(a | b)
        forest.join(x, y)
    for x in range(25):
        for y in range(x):
            a, b = set(sets[x].tolist()), set(sets[y].tolist())
            if 100 * len(a & b) >= 80 * len(a | b):
                want.join(x, y)
    assert [forest.root(x) for x in range(25)] == [want.root(x) for x in range(25)]


def test_similar_sets_share_a_listed_shingle():
    for n in range(1, 200):
        # The least overlap with any set of similarity 0.8 is ceil(0.8 n).
        assert ngram_join.prefix_size(n) == n - -(-4 * n // 5) + 1


def test_components(spark):
    rng = random.Random(4)
    edges = [(k, k + 1) for k in range(60)] + [(100 + rng.randint(0, 80), 100 + rng.randint(0, 80)) for _ in range(60)]
    edges += [(500, 500 + k) for k in range(1, 200)] + [(7, 7), (3, 2), (2, 3)]
    df = spark.createDataFrame([*edges, (None, 4)], "a long, b long")
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    got = {r["node"]: r["component"] for r in components(df, "a", "b").collect()}
    lonely = {a for a, b in edges if a == b} - {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: root(x) for x in parent if x not in lonely}
    assert components(df.limit(0), "a", "b").count() == 0


def test_very_many_secrets_in_one_text(spark):
    rng = random.Random(0)
    parts = [rng.choice(["deadbeef" * rng.randint(2, 4), "AKIA" + "Z9" * 9, "é word", "x=1"]) for _ in range(3000)]
    text = " ".join(parts)
    row = spark.createDataFrame([(text,)], "t string").select(
        secret_markov.find(F.col("t"), secret_markov.HEX, 2).alias("s")).first()
    assert [(s["start"], s["end"]) for s in row["s"]] == [m.span() for m in re.finditer("[0-9a-f]{16,}", text)]


def test_redaction_against_a_plain_one(spark):
    rng = random.Random(4)
    make = [lambda: "deadbeef" * rng.randint(2, 4), lambda: "AKIA" + "Z9" * 9, lambda: "é😀 word\n" * rng.randint(1, 300),
            lambda: "password=" + "ab.12" * rng.randint(1, 9) + " deadbeefdeadbeef00", lambda: "aX9" * rng.randint(4, 9)]
    texts = ["".join(rng.choice(make)() + rng.choice(["", " ", "."]) for _ in range(n)) for n in [1] * 20 + [5] * 20 + [400, 1200]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = secret_markov.RatioModel((2.0,) * secret_markov.SIZE ** 2)     # every candidate is random
    found = {r["doc_id"]: r["secrets"] for r in secret_markov.scan(docs, model=model).collect()}
    clean = {r["doc_id"]: r["text"] for r in secret_markov.redact(docs, model=model).collect()}
    for k, text in enumerate(texts):
        base = [(s["start"], s["kind"], s["end"]) for kind in ("assign", "access", "hex") for s in found[k][kind]]
        want = [(m.start(), 3, m.end()) for m in re.finditer(secret_markov.CANDIDATE, text)]
        want = [w for w in want if not any(s < w[2] and w[0] < e for s, _, e in base)]
        assert [(s["start"], s["kind"], s["end"]) for s in found[k]["markov"]] == want
        out, at = "", 0
        for start, kind, end in sorted(base + want):
            if start >= at:
                out += text[at:start] + f"<{secret_markov.KINDS[kind]}>"
            at = max(at, end)
        assert clean[k] == out + text[at:]


def test_models_tell_random_strings_from_words(spark, rows):
    text = "the other connection internationalisation north water " * 5
    secrets = [f"token = {random.Random(k).getrandbits(160):040x}" for k in range(80)]
    found = ["24be64439e3e-49cf46b2d7c9-0f3602a3d0b9", "otherconnectionnorthwater"]
    docs = spark.createDataFrame([(k, f"{text} {s}") for k, s in enumerate(secrets)]
                                 + [(999, f"é {found[0]} and {found[1]}"), (1000, None)], "doc_id long, text string")
    out = {r["doc_id"]: r["secrets"] for r in secret_markov.scan(docs).collect()}
    assert [(s["start"], s["end"]) for s in out[999]["markov"]] == [(2, 2 + len(found[0]))]
    assert out[1000]["markov"] == [] and all(len(out[k]["assign"]) == 1 and not out[k]["markov"] for k in range(80))
    clean = {r["doc_id"]: r["text"] for r in secret_markov.redact(docs).collect()}
    assert clean[0] == f"{text} <assign>" and clean[999] == f"é <markov> and {found[1]}" and clean[1000] is None


def test_rounds_fill_every_window():
    total, window, sizes = 10_007, 64, [1, 999, 5000, 4007]
    rounds, low, served = packing.Rounds(total, window), 0, np.zeros(total, dtype=int)
    for size in sizes:
        at = 0
        for k in range(0, size, 37):
            for place, n in rounds.runs(low, size, k, min(size, k + 37)) if size >= 2 * rounds.windows else []:
                served[place:place + n] += 1
                at += n
        if size >= 2 * rounds.windows:
            assert at == size
            # The deficit carried from window to window stays below one token.
            served_by = [rounds.served(low, size, w) for w in range(rounds.windows)]
            assert max(abs(x - size / total * w * window) for w, x in enumerate(served_by)) < 1
            assert max(abs(x - size / total * window) for x in np.diff(served_by)) < 2
        low += size
    assert served.max() == 1


def test_target_rounds_serve_shares_until_queues_run_dry():
    window, queues = 100, {"a": (700, 5), "b": (2000, 3), "c": (333, 2)}
    rounds = packing.TargetRounds(queues, window)
    served, at = np.zeros(3033, dtype=int), dict.fromkeys(queues, 0)
    left, fluid = {q: float(n) for q, (n, _) in queues.items()}, dict.fromkeys(queues, 0.0)
    for k, name in enumerate(rounds.names):
        for start in range(0, queues[name][0], 37):
            for place, n in rounds.runs(k, 1, start, min(queues[name][0], start + 37)):
                served[place:place + n] += 1
                at[name] += n
    assert served.tolist() == [1] * 3033 and at == {q: n for q, (n, _) in queues.items()}
    for w in range(rounds.windows):                   # a plain round-robin in small steps
        for k, name in enumerate(rounds.names):
            assert abs(rounds.served(k, 1, w) - fluid[name]) < 1.1
        room = min(window, 3033 - w * window)
        while room > 1e-6:
            alive = {q: queues[q][1] for q in left if left[q] > 1e-9}
            step = min([room] + [left[q] * sum(alive.values()) / x for q, x in alive.items()])
            for q, x in alive.items():
                fluid[q] += step * x / sum(alive.values())
                left[q] -= step * x / sum(alive.values())
            room -= step
    with pytest.raises(ValueError):
        packing.TargetRounds({"a": (700, 1), "b": (700, 99)}, window)


@pytest.mark.parametrize("targets", [{"src2": 0.6, "src1": 0.1, "absent": 0.2}, {"src0": 0.5, "src1": 0.5}, {"": 0.02}, {}])
def test_packing_to_targets(spark, tiny, empty, rows, targets):
    import public_tokenizers

    from lakemart.llm import bpe

    spec, window = bpe.tokenizer_from_file(public_tokenizers.path("byte_bpe_50k.json")), 1024
    pieces = packing.pack(spark.read.parquet(f"{tiny}/documents.parquet"), spec, window_sequences=1, targets=targets).toPandas()
    copies = collections.Counter(i for i, *_ in rows)
    for i, part in pieces.groupby("doc_id"):
        seen = collections.Counter(x for r in part.itertuples() for x in range(r.start, r.start + r.length))
        assert seen == {x: copies[i] for x in range(part.doc_tokens.iloc[0])}
    assert set(pieces.doc_id) == set(copies)
    source = {i: s or "" for i, _, _, s in rows}
    pieces["queue"] = [source[i] if source[i] in targets else "the rest" for i in pieces.doc_id]
    total = pieces.groupby("queue").length.sum()
    share = {q: targets.get(q, 1 - sum(targets.values())) for q in total.index}
    share = {q: max(x, 3 / window) / sum(max(x, 3 / window) for x in share.values()) for q, x in share.items()}
    dry = int(min(total[q] / share[q] for q in share) // window)      # windows before a queue runs dry
    assert dry >= 1
    for w in range(dry):
        here = pieces[pieces.sequence_id == w].groupby("queue").length.sum()
        assert here.sum() == window and all(abs(here.get(q, 0) - share[q] * window) < 2.01 for q in share)
    assert packing.pack(spark.read.parquet(f"{empty}/documents.parquet"), spec, targets=targets).count() == 0
    with pytest.raises(ValueError):
        packing.pack(spark.read.parquet(f"{empty}/documents.parquet"), spec, targets={"a": 0.7, "b": 0.7})


def test_votes_learn_kinds_of_bad_documents():
    patterns = {"gggg": 9000, "bggg": 500, "gbbg": 400, "ggg-": 300, "ggbg": 3, "----": 50}
    model = weak_rules.fit_votes(patterns, 4)
    assert sum(model.share[1:]) == pytest.approx(0.09, abs=0.03)
    assert max(model.bad_rate[0]) <= 0.05


def test_clean_texts_of_any_script_are_kept(spark):
    rng = random.Random(3)
    words = {"en": "the house with other water north when thing", "hi": "यह घर पानी के साथ उत्तर में हिन्दी भाषा और किताब है",
             "ko": "그 집은 물과 함께 북쪽에 있는 다른 것 입니다", "th": "บ้านหลังนี้มีน้ำ ภาษาไทยเขียนติดกัน อยู่ทางเหนือ",
             "zh": "这所房子在北方的水边，那里有很多其他的东西。 我们每天都在学习新的语言，也读很多书。 他们喜欢喝茶"}

    def text(lang):
        parts = [w + str(rng.randint(0, 9) if lang == "en" else "") for w in words[lang].split()]
        if lang in ("zh", "th"):
            parts = ["".join(rng.sample("".join(parts), len("".join(parts)))) for _ in range(30)]
        return " ".join(rng.choice(parts) + rng.choice(parts) for _ in range(120))

    rows = [(k, lang, text(lang)) for k, lang in enumerate(["en"] * 160 + ["hi", "ko", "th", "zh"] * 10)]
    rows += [(900 + k, "junk", " ".join(f"{rng.randint(0, 10 ** 6)} ☀— 😀😀" for _ in range(60))) for k in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    votes = weak_rules.with_counts(docs, "text", "c").select("lang", weak_rules.vote_pattern(F.col("c")).alias("v"))
    for r in votes.collect():
        assert r["v"] == "gggggbgg" if r["lang"] == "junk" else "b" not in r["v"], r
    judged = weak_rules.judge(docs.filter("lang != 'junk'")).collect()
    assert all(r["quality"]["kept"] for r in judged) and len(judged) == 200
    counts = weak_rules.count_batch(pa.array(["हिन्दी 漢字 été — 😀 1a", "中文，好。 ab", None]))
    at = weak_rules.COUNT_FIELDS.index
    assert counts[:, at("n_letter_words")].tolist() == [4, 2, 0] and counts[:, at("n_unspaced")].tolist() == [2, 5, 0]


def test_operators_keep_other_columns(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    judged = weak_rules.judge(docs)
    assert judged.columns == [*docs.columns, "quality_"] and judged.count() == docs.count()
    assert langid_crf.identify(docs, None).columns == [*docs.columns, "language_"]
    assert secret_markov.redact(docs).columns == docs.columns


def test_duplicates_without_ids(spark):
    import corpus_pipeline as pipeline

    text = {k: " ".join(f"{k}{n}" for n in range(40)) for k in "abc"}
    rows = [(5, text["a"]), (None, text["a"]), (3, text["a"]), (None, text["b"]), (None, text["b"] + " more"), (None, text["c"]),
            (None, text["c"]), (None, None), (7, None), (8, "")]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, _key int")
    left = pipeline.near_duplicates(spark, docs, "")
    assert left.columns == docs.columns
    got = sorted((r["doc_id"] or 0, (r["text"] or "")[:1]) for r in left.collect())
    assert got == [(0, ""), (0, "b"), (0, "c"), (3, "a"), (7, ""), (8, "")]


def test_pipeline(spark, tiny, empty, rows):
    import corpus_pipeline as pipeline

    docs, kept = spark.read.parquet(f"{tiny}/documents.parquet"), []
    for name, stage in pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, tiny).cache()
        assert docs.columns == before.columns
        kept.append({r["doc_id"] for r in docs.select("doc_id").collect()})
    quality, language, unique, scanned = kept
    assert not quality & set(range(460, 472)) and {300, 301, 302} <= quality
    assert language == quality and scanned == unique
    assert len(unique & {3, *range(400, 430)}) <= 1 and len(unique & {0}) <= 1
    assert not any(re.search("[0-9a-f]{16}", r["text"]) for r in docs.collect())
    out = pipeline.run(spark, tiny).toPandas()
    assert set(out.doc_id) == scanned
    assert pipeline.run(spark, empty).count() == 0
