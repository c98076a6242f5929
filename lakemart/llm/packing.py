"""Mixture-controlled packing of token ids into training sequences.

Every source has a queue of its documents' tokens.  Windows of
``window_sequences`` sequences are filled by deficit round-robin: at each
window a queue earns its target share of the window's tokens, serves the whole
tokens it has earned and carries the fraction on.  The target shares are the
sources' shares of all tokens, so every window mirrors the corpus and all
queues run dry in the last window.

What queue q has served after w windows is a closed form: with the queues laid
side by side and P(q) tokens in the first q queues of N,

    served(q, w) = floor(P(q+1)/N * w*W) - floor(P(q)/N * w*W)

(the deficit is the fractional part: at every window's end a queue has served
less than one token more or less than it has earned, so a window's share is
off by less than two).  The sum over queues is w*W exactly.  So
each document finds its places by itself from the totals of the queues: no
task walks over a queue, whatever share of the rows one source holds.  Shares
are double-precision, exact for corpora up to 2**50 tokens.

A queue must earn two tokens a window for the form to be monotone; sources
with less share one queue.

With ``targets`` (source -> share of every window, all of them at most 1
together) the named sources are queues with those shares; all other sources
form one queue with the share that is left.  A queue that runs dry hands its
share on to the others in proportion to theirs, and a source that the corpus
lacks does so from the start.  In the order in which queues run dry, what the
first q queues have served after t tokens is a closed form again
(``TargetRounds``, whole numbers throughout), so deficits are carried over
windows and tasks as above: until a queue runs dry, every window holds each
target share to less than two tokens.  All ids are packed, so once the others
are dry the last windows hold what is left.

Sequences hold ``length`` tokens.  The last window may end in fewer; that rest
is cut into sequences whose lengths are powers of two, which need no padding.

Defined results: a NULL text is empty (one end id); a NULL source is a queue
of its own with the empty source; repeated rows are packed as often as they
occur; a text of any length is cut at windows and sequences; an empty table
gives no pieces.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator
from fractions import Fraction
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.llm import textbatch as tb
from lakemart.llm.bpe import SLICE_BYTES, of_worker
from lakemart.llm.common import staged

# With targets, queues are called NAMED + source, which no source can turn into REST.
NAMED, REST = "=", "rest"
WEIGHTS = 10 ** 9      # shares become whole numbers of this unit

TOKENS_TYPE = T.StructType([
    T.StructField("chunk", T.IntegerType(), False),     # writing task
    T.StructField("source", T.StringType(), False),
    T.StructField("doc_id", T.LongType()),
    T.StructField("n_tokens", T.LongType(), False),     # with the end id
    T.StructField("before", T.LongType(), False),       # tokens of the source earlier in the chunk
    T.StructField("wide", T.BooleanType(), False),      # ids are uint32, else uint16
    T.StructField("ids", T.BinaryType(), False),
])
PIECE_TYPE = T.StructType([T.StructField(n, T.LongType()) for n in (
    "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")])


def tokenize(docs: DataFrame, spec: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text",
             source_col: str = "source", targets: dict[str, float] | None = None) -> DataFrame:
    """Every text's ids, with the place of the document among those of its
    source in the same task.  Sources without a target count as one, REST."""
    source = F.coalesce(F.col(source_col).cast("string"), F.lit(""))
    if targets is not None:
        named = source.isin(list(targets)) if targets else F.lit(False)
        source = F.when(named, F.concat(F.lit(NAMED), source)).otherwise(REST)
    rows = docs.select(source.alias("source"),
                       F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, chunk, total = of_worker(spec), TaskContext.get().partitionId(), {}
        for batch in batches:
            for lo, hi in tb.slices(batch.column(2), SLICE_BYTES):
                part = batch.slice(lo, hi - lo)
                ids, off = bpe.encode(part.column(2))
                sizes, before = np.diff(off) + 1, []
                for source, size in zip(part.column(0).to_pylist(), sizes.tolist()):
                    before.append(total.get(source, 0))
                    total[source] = before[-1] + size
                wide = bool(len(ids) and ids.max() > 0xFFFF) or end_id > 0xFFFF
                out = np.full(len(ids) + len(sizes), end_id, dtype="<u4" if wide else "<u2")
                out[np.arange(len(ids)) + np.repeat(np.arange(len(sizes)), sizes - 1)] = ids
                raw = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(
                    (np.append(0, np.cumsum(sizes)) * out.itemsize).astype(np.int32)), pa.py_buffer(out)])
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(sizes), chunk, dtype=np.int32)), part.column(0), part.column(1),
                    pa.array(sizes), pa.array(before, pa.int64()), pa.array([wide] * len(sizes)), raw],
                    names=TOKENS_TYPE.names)

    return rows.mapInArrow(run, TOKENS_TYPE)


def queue_places(tokens: DataFrame, window_tokens: int) -> DataFrame:
    """Per (chunk, source): the queue's start among all queues laid side by
    side (``low``), its length, the tokens of the queue before the chunk, and
    the corpus total.  One row per chunk and source is all that is shuffled."""
    totals = tokens.groupBy("source", "chunk").agg(F.sum("n_tokens").alias("n"))
    sources = totals.groupBy("source").agg(F.sum("n").alias("n"))
    corpus = sources.agg(F.sum("n").alias("total")).first()["total"] or 0
    windows = -(-corpus // window_tokens)
    # Sources too small for two tokens a window share the first queue; if even
    # together they are too small, the largest source joins them.
    small = sources.withColumn("small", F.col("n") < F.lit(2 * windows))
    pooled = small.filter("small").agg(F.sum("n").alias("n")).first()["n"] or 0
    if 0 < pooled < 2 * windows:
        largest = small.orderBy(F.desc("n"), "source").first()["source"]
        small = small.withColumn("small", F.col("small") | (F.col("source") == F.lit(largest)))
        pooled = small.filter("small").agg(F.sum("n").alias("n")).first()["n"]
    # One row per source from here to the join; the order is the queues' order.
    side = Window.orderBy(F.desc("small"), "source").rowsBetween(Window.unboundedPreceding, -1)
    laid = small.withColumn("at", F.coalesce(F.sum("n").over(side), F.lit(0)))
    queues = laid.select("source", F.when(F.col("small"), F.lit(0)).otherwise(F.col("at")).alias("low"),
                         F.when(F.col("small"), F.lit(pooled)).otherwise(F.col("n")).alias("size"),
                         F.when(F.col("small"), F.col("at")).otherwise(F.lit(0)).alias("inner"))
    earlier = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    return (totals.withColumn("queued", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
            .join(queues, "source")
            .select("chunk", "source", "low", "size", (F.col("inner") + F.col("queued")).alias("queued"),
                    F.lit(corpus).cast("long").alias("total")))


def target_places(tokens: DataFrame, targets: dict[str, float], window_tokens: int) -> tuple[DataFrame, "TargetRounds"]:
    """``queue_places`` for given shares, and their rounds.  ``low`` is a
    queue's number and ``size`` 1.  The driver holds a row for each target."""
    if any(not 0 < share <= 1 for share in targets.values()) or sum(targets.values()) > 1 + 1e-9:
        raise ValueError("targets are shares above 0 that add up to 1 at most")
    totals = tokens.groupBy("source", "chunk").agg(F.sum("n_tokens").alias("n"))
    found = {r["source"]: r["n"] for r in totals.groupBy("source").agg(F.sum("n").alias("n")).collect()}
    weights = {NAMED + name: round(share * WEIGHTS) for name, share in targets.items()}
    weights[REST] = max(0, WEIGHTS - sum(weights.values()))
    if REST in found and not weights[REST]:
        # No share is left: the rest comes at three tokens a window until targets are dry.
        weights[REST] = 3 * WEIGHTS // window_tokens + 1
    rounds = TargetRounds({q: (n, weights[q]) for q, n in found.items()}, window_tokens)
    numbers = tokens.sparkSession.createDataFrame(list(enumerate(rounds.names)), "low long, source string")
    earlier = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    places = totals.withColumn("queued", F.coalesce(F.sum("n").over(earlier), F.lit(0))).join(F.broadcast(numbers), "source")
    return places.select("chunk", "source", "low", F.lit(1).cast("long").alias("size"), "queued",
                         F.lit(rounds.total).cast("long").alias("total")), rounds


class Rounds:
    """The closed form of the round-robin for a corpus of ``total`` tokens."""

    def __init__(self, total: int, window_tokens: int):
        self.total, self.window = total, window_tokens
        self.windows = -(-total // window_tokens)

    def earned(self, tokens_below: int, w: int) -> int:
        """Tokens that the queues below a point have served after ``w`` windows."""
        if w >= self.windows:
            return tokens_below
        return int(tokens_below / self.total * (w * self.window))

    def served(self, low: int, size: int, w: int) -> int:
        return self.earned(low + size, w) - self.earned(low, w)

    def window_of(self, low: int, size: int, token: int) -> int:
        """The window that serves a queue's token."""
        w = min(self.windows - 1, int(token / size * (self.total / self.window)))
        while w > 0 and self.served(low, size, w) > token:
            w -= 1
        while self.served(low, size, w + 1) <= token:
            w += 1
        return w

    def runs(self, low: int, size: int, start: int, stop: int) -> Iterator[tuple[int, int]]:
        """(place in the packed stream, length) of each run of a queue's
        tokens [start, stop), in order."""
        w = self.window_of(low, size, start)
        while start < stop:
            first, last = self.served(low, size, w), self.served(low, size, w + 1)
            end = min(stop, last)
            if end > start:
                before_me = self.earned(low, w + 1) - self.earned(low, w)
                yield w * self.window + before_me + (start - first), end - start
                start = end
            w += 1


class TargetRounds(Rounds):
    """Rounds with given shares: queues are numbered in the order in which they
    run dry, and ``low`` and ``size`` count queues.

    ``queues`` maps a name to its tokens and its weight.  After t tokens, the
    queues below p are dry and the others have got the rest by weight:

        below(q, t) = N(p) + (t - N(p)) * (C(q) - C(p)) / (C - C(p))   for q > p

    with N and C the sums of tokens and weights of the queues below."""

    def __init__(self, queues: dict[str, tuple[int, int]], window_tokens: int):
        super().__init__(sum(n for n, _ in queues.values()), window_tokens)
        self.names = sorted(queues, key=lambda q: (Fraction(*queues[q]), q))
        self.sizes, self.weights = [queues[q][0] for q in self.names], [queues[q][1] for q in self.names]
        self.tokens, self.shares = [0, *accumulate(self.sizes)], [0, *accumulate(self.weights)]
        if any(w * window_tokens < 2 * self.shares[-1] for w in self.weights):
            raise ValueError("a target share must be worth two tokens a window")
        # Tokens served when queue p runs dry.
        self.dry = [self.tokens[p] + Fraction(n * (self.shares[-1] - self.shares[p]), w)
                    for p, (n, w) in enumerate(zip(self.sizes, self.weights))]

    def earned(self, queues_below: int, w: int) -> int:
        t = min(w * self.window, self.total)
        p = bisect_right(self.dry, t)
        if queues_below <= p:
            return self.tokens[queues_below]
        return self.tokens[p] + (t - self.tokens[p]) * (self.shares[queues_below] - self.shares[p]) // (
            self.shares[-1] - self.shares[p])

    def window_of(self, low: int, size: int, token: int) -> int:
        return bisect_right(range(self.windows), token, key=lambda w: self.served(low, size, w)) - 1


def sequence_cuts(total: int, length: int) -> tuple[int, list[int]]:
    """Number of full sequences, and the starts of those that follow: the
    rest, largest power of two first."""
    full, rest = divmod(total, length)
    starts, at = [], full * length
    bit = 1 << max(0, length.bit_length() - 1)
    while bit:
        if rest & bit:
            starts.append(at)
            at += bit
        bit >>= 1
    return full, starts


def pack(docs: DataFrame, spec: str, length: int = 1024, window_sequences: int = 64, end_id: int = 0,
         targets: dict[str, float] | None = None, **columns) -> DataFrame:
    """One row per piece: which ids of which document lie where in which
    sequence.  ``length`` is a power of two; ``targets`` are the sources'
    shares of every window (by default, of the corpus)."""
    if length & (length - 1):
        raise ValueError("the sequence length must be a power of two")
    window = length * window_sequences
    tokens = staged(tokenize(docs, spec, end_id, targets=targets, **columns), "packing-tokens")
    places, given = (queue_places(tokens, window), None) if targets is None else target_places(tokens, targets, window)
    places = staged(places, "packing-places")
    rows = tokens.join(places, ["chunk", "source"]).select(
        "doc_id", "n_tokens", (F.col("queued") + F.col("before")).alias("start"), "low", "size", "total", "wide", "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            *numbers, wide, ids = batch.columns
            for (doc_id, n, start, low, size, total, is_wide, raw) in zip(
                    *[c.to_pylist() for c in numbers], wide.to_pylist(), ids):
                raw = np.frombuffer(raw.as_buffer(), "<u4" if is_wide else "<u2").astype("<u4")
                raw, done = memoryview(raw).cast("B"), 0
                full, tail = sequence_cuts(total, length)
                for place, size_here in (given or Rounds(total, window)).runs(low, size, start, start + n):
                    end = place + size_here
                    while place < end:
                        if place < full * length:
                            number, offset = divmod(place, length)
                            stop = min(end, (number + 1) * length)
                        else:
                            k = max(i for i, s in enumerate(tail) if s <= place)
                            number, offset = full + k, place - tail[k]
                            stop = min(end, tail[k + 1] if k + 1 < len(tail) else total)
                        took = stop - place
                        out.append((doc_id, done, took, zlib.crc32(raw[4 * done:4 * (done + took)]), n, number, offset))
                        place, done = stop, done + took
            cols = list(zip(*out)) if out else [[] for _ in PIECE_TYPE]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=PIECE_TYPE.names)

    return rows.mapInArrow(run, PIECE_TYPE)
