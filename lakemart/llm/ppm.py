"""Language-model scoring by prediction by partial matching.

The model is a trie of byte contexts, pretrained on the training documents:
for every context of up to ORDER bytes, how often each byte followed.  A byte
is predicted from the longest context that the trie knows; if it was never
seen there, the model escapes to the next shorter context, whose estimate
leaves out every byte the longer one has ruled out (symbol exclusion).  The
escape estimate is that of method D: half a count of each seen byte is set
aside for unseen ones.  Since a byte seen after a context is also seen after
its shorter ones, the bytes excluded at a context are exactly those of the
context below it, so every node needs six numbers and no set of bytes.

    score = log10 of the product of the predictions of all bytes and the end

The base score beside it is that of smoothed word frequencies.

How it runs
    1. One scan counts words and (ORDER+1)-byte strings of the training
       documents, combined in each task, then summed by key.  Shorter contexts
       are sums over the longest ones.
    2. The trie goes to every task, whole if it has at most MAX_TRIE of the
       longest strings.  Else only the contexts seen most often go, with all
       that followed them, at most MAX_TRIE entries; the others stay staged.  A
       suffix of a frequent context is frequent, so a byte whose longest context
       is in the tasks' part needs no other.
       The tables are in the order of their keys' hashes: a byte found in its
       longest context costs one look-up of a place or two.
    3. A second scan scores the texts.  Counts of frequent words go along: those
       that are at least one in MAX_FREQUENT of all tokens, hence at most so
       many.  All other words of a text are joined to their counts by a shuffle,
       and so are bytes whose longest context is not in the tasks' part: each
       distinct one is looked up once, in the staged contexts that are longer
       than the tasks' part knows.  The order and the scores do not depend on
       MAX_TRIE.

Words are told apart by 64-bit hashes, byte strings exactly.

Defined results: a NULL text is empty: one end token.  Repeated rows score
alike and NULL ids are allowed (rows are told apart by their place).  With no
training document, N and V are 0, every base term is log10(0.5 / 0.5) and the
model predicts all 256 symbols alike.  A table without rows gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.llm import textbatch as tb
from lakemart.llm.common import staged

ORDER = 5
MAX_TRIE = 6_000_000
MAX_FREQUENT = 4_000_000
FLUSH = 1_000_000       # distinct keys a task holds before it hands them on
SLICE_BYTES = 1 << 20   # text worked on at once: some 100 bytes of work space for each
BLOCK = 1 << 18         # bytes looked up at once

END, START = 0xFF, 0xFE          # bytes that no UTF-8 text holds
WORD_KEY, GRAM_KEY, END_KEY = 0, 1, 2
COUNT_TYPE = T.StructType([T.StructField("kind", T.IntegerType(), False), T.StructField("key", T.LongType(), False),
                           T.StructField("n", T.LongType(), False)])


def symbols(texts: pa.Array, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes and offsets of the texts, and all texts with
    ``order`` start bytes before and an end byte behind each, with offsets."""
    b, off = tb.byte_view(texts)
    b = tb.LOWER[b]
    sizes = np.diff(off)
    at = np.append(0, np.cumsum(sizes + order + 1))
    out = np.full(at[-1], START, dtype=np.uint8)
    out[np.arange(len(b)) + np.repeat(at[:-1] + order - off[:-1], sizes)] = b
    out[at[1:] - 1] = END
    return b, off, out, at


def gram_codes(s: np.ndarray, order: int) -> np.ndarray:
    """Each byte behind its ``order`` previous bytes, as one number (the first
    ``order`` of the array are not full)."""
    out = np.zeros(len(s), dtype=np.uint64)
    for back in range(order, -1, -1):
        out <<= np.uint64(8)
        out[back:] |= s[:len(s) - back]
    return out


class Tally:
    """Sums by (kind, key), handed on when there are many."""

    def __init__(self, kind: int):
        self.kind, self.keys, self.sums, self.waiting = kind, np.zeros(0, np.int64), np.zeros(0, np.int64), []

    def add(self, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.waiting.append(np.unique(keys, return_counts=True))
        if sum(len(k) for k, _ in self.waiting) > FLUSH:
            yield from self.fold()

    def fold(self, last: bool = False) -> Iterator[pa.RecordBatch]:
        keys = np.concatenate([self.keys, *[k for k, _ in self.waiting]])
        sums = np.concatenate([self.sums, *[n for _, n in self.waiting]])
        self.waiting = []
        self.keys, where = np.unique(keys, return_inverse=True)
        self.sums = np.bincount(where, weights=sums, minlength=len(self.keys)).astype(np.int64)
        if len(self.keys) and (last or len(self.keys) > FLUSH):
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(self.keys), self.kind, dtype=np.int32)), pa.array(self.keys), pa.array(self.sums)],
                names=COUNT_TYPE.names)
            self.keys, self.sums = np.zeros(0, np.int64), np.zeros(0, np.int64)


def corpus_counts(docs: DataFrame, text_col: str, order: int) -> DataFrame:
    """Counts of the words, the byte strings of ``order`` + 1 and the ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, grams, ends = Tally(WORD_KEY), Tally(GRAM_KEY), 0
        for batch in batches:
            for lo, hi in tb.slices(batch.column(0), SLICE_BYTES):
                b, off, s, _ = symbols(batch.column(0).slice(lo, hi - lo), order)
                starts, stops, _ = tb.word_spans(b, off)
                yield from words.add(tb.hash_spans(b, starts, stops).view(np.int64))
                yield from grams.add(gram_codes(s, order)[s != START].view(np.int64))
                ends += hi - lo
        yield from words.fold(last=True)
        yield from grams.fold(last=True)
        if ends:
            yield pa.RecordBatch.from_arrays([pa.array([END_KEY], pa.int32()), pa.array([0], pa.int64()),
                                              pa.array([ends], pa.int64())], names=COUNT_TYPE.names)

    return docs.select(text_col).mapInArrow(run, COUNT_TYPE).groupBy("kind", "key").agg(F.sum("n").alias("n"))


class Places:
    """Where each of a table's distinct keys is.  Keys lie in the order of
    their hashes and ``first`` has where those of each hash begin (two keys a
    hash at most on average, if ``roomy`` one), so a look-up reads a place or
    two of the table where a bisection reads some twenty."""

    def __init__(self, bits: int):
        self.shift = np.uint64(64 - bits)
        self.first = np.zeros((1 << bits) + 1, dtype=np.int32)

    @classmethod
    def of(cls, keys: np.ndarray, roomy: bool = False) -> tuple[Places, np.ndarray]:
        """The places, and the key (by number) that each of them holds."""
        out = cls(max(1, len(keys).bit_length() - (not roomy)))
        slot = np.concatenate([out._slot(keys[k:k + BLOCK]).astype(np.uint32) for k in range(0, max(1, len(keys)), BLOCK)])
        np.cumsum(np.bincount(slot, minlength=len(out.first) - 1), out=out.first[1:])
        by = np.argsort(slot)
        out.keys = keys[by]
        return out, by

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (tb.mix(keys) >> self.shift).view(np.int64)

    def __len__(self) -> int:
        return len(self.keys)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each key, and whether it is there."""
        if not len(self.keys):
            return np.zeros(len(keys), np.int32), np.zeros(len(keys), dtype=bool)
        slot = self._slot(keys)
        # A place of another hash holds another key, so it needs no check.
        at = np.minimum(self.first[slot], np.int32(len(self.keys) - 1))
        hit = self.keys[at] == keys
        left = np.flatnonzero(~hit)
        while len(left):
            left = left[at[left] + 1 < self.first[slot[left] + 1]]
            at[left] += 1
            hit[left] = self.keys[at[left]] == keys[left]
            left = left[~hit[left]]
        return at, hit


@dataclass
class Level:
    """The contexts of one length and what followed them."""

    entry: Places            # context and byte
    count: np.ndarray        # log10 of twice the count less one; of the longest strings with ``top`` of the context
    context: Places
    top: np.ndarray          # log10 share denominator if the context is the longest known
    top_escape: np.ndarray
    next_share: np.ndarray   # the same in the next shorter context, without the bytes seen here
    next_escape: np.ndarray
    next_open: np.ndarray    # whether that context has any other byte


def _logs(total: np.ndarray, kinds: np.ndarray, rest: np.ndarray, more: np.ndarray) -> list[np.ndarray]:
    """top, top_escape, next_share and next_escape of contexts."""
    with np.errstate(divide="ignore", invalid="ignore"):
        logs = (-np.log10(2 * total), np.log10(kinds) - np.log10(2 * total),
                -np.log10(2 * rest), np.log10(more) - np.log10(2 * rest))
        return [x.astype(np.float32) for x in logs]


def _totals(entry: np.ndarray, count: np.ndarray, k: int, shorter: tuple | None) -> tuple[np.ndarray, ...]:
    """The contexts of ``k`` bytes and where their strings begin, total, kinds,
    rest and more; ``shorter`` has the strings one byte shorter, their counts,
    and their contexts, total and kinds."""
    context, first = np.unique(entry >> np.uint64(8), return_index=True)
    total = np.add.reduceat(count, first) if len(first) else np.zeros(0)
    kinds = np.diff(np.append(first, len(entry))).astype(np.float64)
    rest, more = np.zeros(len(context)), np.zeros(len(context))
    if k and len(first):
        strings, counts, below, below_total, below_kinds = shorter
        same = counts[np.searchsorted(strings, entry & _low_bytes(k))]
        parent = np.searchsorted(below, context & _low_bytes(k - 1))
        rest = below_total[parent] - np.add.reduceat(same, first)
        more = below_kinds[parent] - kinds
    return context, first, total, kinds, rest, more


class Trie:
    """All levels up to an order, from the counts of the longest strings, or
    from those of each level (ascending; with a context, all that followed it
    and all its suffixes are there)."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray, order: int,
                 tables: list[tuple[np.ndarray, np.ndarray]] | None = None):
        self.order, self.levels, self.whole = order, [], tables is None
        if tables is None:
            tables = [(codes, counts.astype(np.float64))]
            del codes, counts
            for k in range(order - 1, -1, -1):
                short = tables[0][0] & _low_bytes(k + 1)
                keys, where = np.unique(short, return_inverse=True)
                tables.insert(0, (keys, np.bincount(where, weights=tables[0][1], minlength=len(keys))))
        self.unseen = np.log10(1.0 / max(1, 256 - len(tables[0][0])))
        shorter = None
        for k in range(order + 1):
            entry, count = tables.pop(0)
            context, first, total, kinds, rest, more = _totals(entry, count, k, shorter)
            shorter = entry, count, context, total, kinds
            seen, logs = np.log10(2 * count - 1).astype(np.float32), _logs(total, kinds, rest, more)
            if k == order:
                seen += np.repeat(logs[0], np.diff(np.append(first, len(entry))))
                shorter = count = total = kinds = rest = first = None   # the largest: room for its places
            (entries, by), (contexts, nodes) = Places.of(entry, roomy=k == order), Places.of(context)
            self.levels.append(Level(entries, seen[by], contexts, *[x[nodes] for x in logs], more[nodes] > 0))

    def log10(self, codes: np.ndarray) -> np.ndarray:
        """log10 of the prediction of each byte in its context."""
        return np.concatenate([self._log10(codes[k:k + BLOCK]) for k in range(0, max(1, len(codes)), BLOCK)])

    def _log10(self, codes: np.ndarray) -> np.ndarray:
        out = np.zeros(len(codes))
        live, known = np.arange(len(codes)), np.zeros(len(codes), dtype=bool)
        share, escape = np.zeros(len(codes), np.float32), np.zeros(len(codes), np.float32)
        usable = np.ones(len(codes), dtype=bool)
        for k in range(self.order, -1, -1):
            level = self.levels[k]
            if not len(level.entry):
                continue
            code = codes[live] & _low_bytes(k + 1)
            at, hit = level.entry.find(code)
            if k == self.order and hit.any():
                # Nearly all bytes end here: one look-up and no state.
                out[live[hit]] = level.count[at[hit]]
                live, code, at, hit = live[~hit], code[~hit], at[~hit], hit[~hit]
            node, there = level.context.find(code >> np.uint64(8))
            fresh = there & ~known[live]
            mine = live[fresh]
            share[mine], escape[mine], usable[mine] = level.top[node[fresh]], level.top_escape[node[fresh]], True
            known[mine] = True
            hit &= there & usable[live]
            out[live[hit]] += level.count[at[hit]] + share[live[hit]]
            leave = there & ~hit & usable[live]
            out[live[leave]] += escape[live[leave]]
            mine, node = live[there], node[there]
            share[mine], escape[mine], usable[mine] = (
                level.next_share[node], level.next_escape[node], level.next_open[node])
            live = live[~hit]
        out[live] += self.unseen
        return out

    def knows(self, codes: np.ndarray, k: int) -> np.ndarray:
        """Whether the context of ``k`` bytes of each byte is here."""
        return self.levels[k].context.find((codes & _low_bytes(k + 1)) >> np.uint64(8))[1]

    def log10_beside(self, codes: np.ndarray, staged: dict[int, list[np.ndarray]]) -> np.ndarray:
        """``log10`` where some contexts, the longest at least, are not here:
        ``staged`` has for a level count, total, kinds, rest and more of them
        (total 0: unknown)."""
        n = len(codes)
        out, live, known, usable = np.zeros(n), np.ones(n, bool), np.zeros(n, bool), np.ones(n, bool)
        share, escape = np.zeros(n, np.float32), np.zeros(n, np.float32)
        for k in range(self.order, -1, -1):
            level, code = self.levels[k], codes & _low_bytes(k + 1)
            count, opens = np.zeros(n, np.float32), np.zeros(n, bool)
            hit, there = np.zeros(n, bool), np.zeros(n, bool)
            logs = [np.zeros(n, np.float32) for _ in range(4)]
            if k in staged:
                seen, total, kinds, rest, more = staged[k]
                hit, there, opens = seen > 0, total > 0, more > 0
                count[hit] = np.log10(2 * seen[hit] - 1)
                logs = _logs(total, kinds, rest, more)
            if k < self.order and len(level.entry):
                at, here = level.entry.find(code)
                hit[here], count[here] = True, level.count[at[here]]
                node, here = level.context.find(code >> np.uint64(8))
                node = node[here]
                there[here], opens[here] = True, level.next_open[node]
                for x, y in zip(logs, (level.top, level.top_escape, level.next_share, level.next_escape)):
                    x[here] = y[node]
            top, top_escape, next_share, next_escape = logs
            fresh = there & ~known
            share[fresh], escape[fresh], usable[fresh] = top[fresh], top_escape[fresh], True
            known |= there
            found = live & hit & there & usable
            out[found] += count[found] + share[found]
            leave = live & there & ~found & usable
            out[leave] += escape[leave]
            share[there], escape[there], usable[there] = next_share[there], next_escape[there], opens[there]
            live &= ~found
        out[live] += self.unseen
        return out


def _low_bytes(n: int) -> np.uint64:
    return np.uint64((1 << (8 * n)) - 1)


def _sorted_arrays(table: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    rows = table.select("key", "n").toArrow()
    keys, n = rows["key"].to_numpy().view(np.uint64), rows["n"].to_numpy()
    by = np.argsort(keys)
    return keys[by], n[by]


@dataclass
class Contexts:
    """What is too large for the tasks: strings (``entry``, n) and contexts
    (``context``, level, total, kinds, rest, more) of 2 bytes and more.  Keys
    have a one before their bytes, so those of all levels differ."""

    entries: DataFrame
    nodes: DataFrame


def _marked(key: Column, size: int) -> Column:
    return key.bitwiseOR(F.lit(1 << (8 * size)))


def train_trie(counts: DataFrame, order: int) -> tuple[Trie, Contexts | None]:
    """The tasks' part of the trie, and the staged rest if that is not all;
    about MAX_TRIE rows at most reach the driver."""
    grams = counts.filter(F.col("kind") == GRAM_KEY).select("key", "n")
    if order < 2 or grams.count() <= MAX_TRIE:
        return Trie(*_sorted_arrays(grams), order), None
    low = lambda c, size: F.col(c).bitwiseAND(F.lit((1 << (8 * size)) - 1))
    up = F.shiftright("key", 8)
    levels = [grams]
    for k in range(order - 1, -1, -1):
        shorter = levels[0].groupBy(low("key", k + 1).alias("key")).agg(F.sum("n").alias("n"))
        levels.insert(0, staged(shorter, f"ppm-level-{k}"))
    nodes, entries = [], []
    for k in range(2, order + 1):
        parents = levels[k - 1].groupBy(up.alias("parent")).agg(
            F.sum("n").alias("parent_total"), F.count("n").alias("parent_kinds"))
        below = levels[k - 1].select(F.col("key").alias("below"), F.col("n").alias("m"))
        own = (levels[k].withColumn("below", low("key", k)).join(below, "below").groupBy(up.alias("key"))
               .agg(F.sum("n").alias("total"), F.count("n").alias("kinds"), F.sum("m").alias("same")))
        nodes.append(own.withColumn("parent", low("key", k - 1)).join(parents, "parent").select(
            _marked(F.col("key"), k).alias("context"), F.lit(k).alias("level"), "total", "kinds",
            (F.col("parent_total") - F.col("same")).alias("rest"), (F.col("parent_kinds") - F.col("kinds")).alias("more")))
        entries.append(levels[k].select(_marked(F.col("key"), k + 1).alias("entry"), "n"))
    union = lambda parts: reduce(DataFrame.unionByName, parts)
    nodes = staged(union(nodes), "ppm-contexts")
    # Entries by the binary digits of their context's total: a context goes along if it has enough digits.
    digits, room, least = F.length(F.bin("total")), MAX_TRIE, 64
    for r in sorted(nodes.groupBy(digits.alias("d")).agg(F.sum("kinds").alias("n")).collect(), reverse=True):
        room -= r["n"]
        if room < 0:
            break
        least = r["d"]
    often = nodes.filter(digits >= least)
    tables = [_sorted_arrays(x) for x in levels[:2]]
    for k in range(2, order + 1):
        tables.append(_sorted_arrays(levels[k].withColumn("context", _marked(up, k)).join(
            often.filter(F.col("level") == k).select("context"), "context", "left_semi")))
    trie = Trie(*tables[-1], order, [(keys, n.astype(np.float64)) for keys, n in tables])
    return trie, Contexts(union(entries), nodes.filter(digits < least))


PROBE_TYPE = T.StructType([T.StructField(x, T.LongType(), False) for x in ("code", "entry", "context")])
STAGED_FIELDS = ["n", "total", "kinds", "rest", "more"]


def staged_scores(codes: DataFrame, model, contexts: Contexts, order: int) -> DataFrame:
    """log10 of the prediction (``p``) of each distinct ``code`` whose longest
    context is not in the tasks' part.  Only contexts that are not there are
    joined, so none of the keys was seen often."""

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code = batch.column(0).to_numpy().view(np.uint64)
            for k in range(order, 1, -1):
                ask = code[~model.value[0].knows(code, k)]
                entry = ask & _low_bytes(k + 1)
                yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (
                    ask, entry | np.uint64(1 << (8 * (k + 1))), (entry >> np.uint64(8)) | np.uint64(1 << (8 * k)))],
                    names=PROBE_TYPE.names)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code = batch.column(0).to_numpy()
            found = {k: [batch.column(f"{x}{k}").to_numpy().astype(np.float64) for x in STAGED_FIELDS]
                     for k in range(2, order + 1)}
            yield pa.RecordBatch.from_arrays(
                [pa.array(code), pa.array(model.value[0].log10_beside(code.view(np.uint64), found))], names=["code", "p"])

    found = (codes.mapInArrow(probe, PROBE_TYPE).join(contexts.nodes, "context", "left")
             .join(contexts.entries, "entry", "left").groupBy("code").agg(*[
                 F.coalesce(F.max(F.when(F.col("level") == k, F.col(x))), F.lit(0)).alias(f"{x}{k}")
                 for k in range(2, order + 1) for x in STAGED_FIELDS]))
    return found.mapInArrow(finish, "code long, p double")


def is_frequent(total: int) -> Column:
    """Whether a count is so large a part of ``total`` that at most
    MAX_FREQUENT words can have it."""
    return F.col("n") * MAX_FREQUENT >= total


def frequent_words(words: DataFrame, total: int) -> tuple[Places, np.ndarray]:
    """Places of the frequent words, and the count at each place."""
    table = words.filter(is_frequent(total)).select("key", "n").toArrow()
    places, by = Places.of(table["key"].to_numpy().view(np.uint64))
    return places, table["n"].to_numpy()[by]


def counted_lists(keys: np.ndarray, doc: np.ndarray, n_docs: int) -> list[pa.Array]:
    """The distinct keys of each document, and how often each is there."""
    by = np.lexsort((keys, doc))
    keys, doc = keys[by], doc[by]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = (keys[1:] != keys[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    lists = pa.array(np.searchsorted(doc[first], np.arange(n_docs + 1)).astype(np.int32))
    times = np.diff(np.append(first, len(keys))).astype(np.int32)
    return [pa.ListArray.from_arrays(lists, pa.array(x)) for x in (keys[first], times)]


SCORE_TYPE = T.StructType([
    T.StructField("row", T.LongType(), False), T.StructField("score", T.DoubleType(), False),
    T.StructField("n_tokens", T.LongType(), False), T.StructField("n_known", T.LongType(), False),
    T.StructField("known_sum", T.DoubleType(), False),     # sum of log10(count + 0.5) of the frequent words
    T.StructField("rare", T.ArrayType(T.LongType()), False), T.StructField("rare_n", T.ArrayType(T.IntegerType()), False),
    T.StructField("code", T.ArrayType(T.LongType()), False), T.StructField("code_n", T.ArrayType(T.IntegerType()), False)])


def score(docs: DataFrame, train: Column, keep: list[str], text_col: str = "text", order: int = ORDER) -> DataFrame:
    """The columns ``keep`` of ``docs`` with n_tokens, n_known, train_tokens,
    base_score and score.  ``train`` says which rows teach the model."""
    spark = docs.sparkSession
    counts = staged(corpus_counts(docs.filter(train), text_col, order), "ppm-counts")
    words = counts.filter(F.col("kind") == WORD_KEY)
    sums = counts.filter(F.col("kind") != GRAM_KEY).agg(
        F.sum("n").alias("tokens"), F.count("n").alias("types"),
        F.sum(F.when(F.col("kind") == END_KEY, F.col("n"))).alias("ends")).first()
    total, types, ends = sums["tokens"] or 0, sums["types"], sums["ends"] or 0
    frequent, n = frequent_words(words, total)
    trie, contexts = train_trie(counts, order)
    model = spark.sparkContext.broadcast((trie, frequent, np.log10(n + 0.5)))

    at = [docs.columns.index(c) for c in keep]
    text_at = docs.columns.index(text_col)
    names = [f"k{k}" for k in range(len(keep))]
    schema = T.StructType([*[T.StructField(x, docs.schema.fields[k].dataType) for x, k in zip(names, at)], *SCORE_TYPE.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, known, logs = model.value
        row = TaskContext.get().partitionId() << 36
        for batch in batches:
            for lo, hi in tb.slices(batch.column(text_at), SLICE_BYTES):
                b, off, s, place = symbols(batch.column(text_at).slice(lo, hi - lo), trie.order)
                real = s != START
                p = np.zeros(len(s) + 1)
                code, at_byte = gram_codes(s, trie.order)[real], np.flatnonzero(real)
                far = np.zeros(len(code), bool) if trie.whole else ~trie.knows(code, trie.order)
                p[1:][at_byte[~far]] = trie.log10(code[~far])
                np.cumsum(p, out=p)
                codes = counted_lists(code[far].view(np.int64),
                                      np.searchsorted(place, at_byte[far], side="right") - 1, hi - lo)
                starts, stops, woff = tb.word_spans(b, off)
                h = tb.hash_spans(b, starts, stops)
                found, hit = known.find(h)
                sums = np.zeros(len(h) + 1)
                sums[1:][hit] = logs[found[hit]]
                np.cumsum(sums, out=sums)
                rare = np.flatnonzero(~hit)
                rares = counted_lists(h[rare].view(np.int64), np.searchsorted(woff, rare, side="right") - 1, hi - lo)
                yield pa.RecordBatch.from_arrays([
                    *[batch.column(k).slice(lo, hi - lo) for k in at],
                    pa.array(row + np.arange(hi - lo)), pa.array(p[place[1:]] - p[place[:-1]]),
                    pa.array(np.diff(woff) + 1), pa.array(tb.count_per_doc(hit, woff)),
                    pa.array(sums[woff[1:]] - sums[woff[:-1]]),
                    *rares, *codes], names=schema.names)
                row += hi - lo

    scored = staged(docs.mapInArrow(run, schema), "ppm-scores")
    rare = scored.select("row", F.explode(F.arrays_zip("rare", "rare_n")).alias("w")).select(
        "row", F.col("w.rare").alias("key"), F.col("w.rare_n").alias("times"))
    more = (rare.join(words.filter(~is_frequent(total)).select("key", "n"), "key")
            .groupBy("row").agg(F.sum("times").alias("times"), F.sum(F.col("times") * F.log10(F.col("n") + 0.5)).alias("logs")))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    n_rare = F.aggregate("rare_n", F.lit(0), lambda a, x: a + x)
    size = float(np.log10(total + 0.5 * (types + 1)))
    base = (F.col("known_sum") + zero("logs") + (n_rare - zero("times")) * float(np.log10(0.5))
            + float(np.log10(ends + 0.5)) - F.col("n_tokens") * size)
    end_known = 1 if ends else 0
    score = F.col("score")
    if contexts:
        far = scored.select("row", F.explode(F.arrays_zip("code", "code_n")).alias("c")).select(
            "row", F.col("c.code").alias("code"), F.col("c.code_n").alias("times"))
        known = staged_scores(far.select("code").distinct(), model, contexts, order)
        more = far.join(known, "code").groupBy("row").agg(F.sum(F.col("times") * F.col("p")).alias("far")).join(
            more, "row", "full")
        score = score + zero("far")
    return scored.join(more, "row", "left").select(
        *[F.col(x).alias(c) for x, c in zip(names, keep)], "n_tokens",
        (F.col("n_known") + zero("times") + end_known).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"), base.alias("base_score"), score.alias("score"))
