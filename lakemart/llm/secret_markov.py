"""Secret scans: fixed patterns plus character Markov models.

Patterns find the secrets that announce themselves.  For strings that do not,
two first-order character models are trained: one of random strings (the
values of the pattern matches), one of the ordinary words of all documents; a
long word of key characters whose log-likelihood ratio speaks for "random" is a secret too.
Everything is DataFrame functions: no Python runs on the executors.

Positions are code points.  ``split`` and ``regexp_extract_all`` walk a text
with the same matcher, so the lengths of the parts between matches and of the
matches give every match's place without a Python or JVM loop of our own.

Defined results: a NULL or empty text has no spans; a NULL id passes through;
repeated rows give equal results; an empty table trains models without
evidence, which find nothing.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import drop_staged, free_name, staged

# The patterns of the base scan.  An access or hex match is a
# whole run of its characters, so the least length can stand in the pattern;
# an assignment's value is measured after the match.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
ASSIGN_VALUE_MIN = 12
KINDS = ("assign", "access", "hex", "markov")

# The models read runs of these characters, all between "+" and "z" in ASCII.
CANDIDATE = r"[A-Za-z0-9+/_=-]{16,}"
NO_WORD = r"[^A-Za-z0-9+/_=-]+"
CANDIDATE_MIN = 16
WORD_MIN = 4
FIRST, LAST = ord("+"), ord("z")
SIZE = LAST - FIRST + 1

SMOOTHING = 0.5        # pseudo-count of every character pair
RATIO_MIN = 1.0        # least mean log-likelihood ratio of a pair for a secret
RATIO_FLOOR = 0.5
RUNS = 32              # block length of running sums
SPAN_BITS = 27         # a text of 2**31 characters has fewer matches of 16 or more
CHUNK = 1024           # characters of the pieces that a text is cut from


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(values: Column, step: Callable[[Column, Column], Column] = lambda x, y: x + y, levels: int = 3) -> Column:
    """``step`` folded over the first 1, 2, ... elements (sums by default), from
    0 on.  Blocks of RUNS, and blocks of those, keep the work near linear where
    a text has very many matches.  ``values`` is used often: bind it."""
    fold = lambda a: F.aggregate(a, F.lit(0), step)
    plain = F.transform(values, lambda _, k: fold(F.slice(values, F.lit(1), k + 1)))
    if levels == 0:
        return plain
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(values) - 1) / RUNS).cast("int")),
                         lambda k: fold(F.slice(values, k * RUNS + 1, F.lit(RUNS))))
    block = lambda k: F.floor(k / RUNS).cast("int")
    return F.when(F.size(values) <= RUNS, plain).otherwise(bind(blocks, lambda b: bind(
        running(b, step, levels - 1), lambda done: F.transform(values, lambda _, k: step(
            F.coalesce(F.get(done, block(k) - 1), F.lit(0)), fold(F.slice(values, block(k) * RUNS + 1, k % RUNS + 1)))))))


def overlaps(spans: Column, s: Column) -> Column:
    """Whether one of ``spans`` (by start, apart from each other) overlaps ``s``.
    Bisection: as many of them as end at or before the start of ``s`` come first."""
    bits = F.lit(",".join(str(1 << k) for k in reversed(range(SPAN_BITS))))
    first = F.aggregate(F.split(bits, ",").cast("array<int>"), F.lit(0), lambda at, bit: at + F.when(
        F.get(spans, at + bit - 1)["end"] <= s["start"], bit).otherwise(0))
    return F.coalesce(F.get(spans, first)["start"] < s["end"], F.lit(False))


def find(text: Column, pattern: str, kind: int, value_group: int = 0, value_min: int = 0) -> Column:
    """Spans (start, kind, end, value) of the leftmost non-overlapping matches
    whose value (a group of the pattern) has ``value_min`` characters or more."""
    rx = F.lit(pattern)
    empty = F.expr("cast(array() as array<struct<start:int,kind:int,end:int,value:string>>)")

    def placed(found: Column) -> Column:
        values = found if value_group == 0 else F.regexp_extract_all(text, rx, F.lit(value_group))
        sizes = F.transform(found, lambda m: F.char_length(m))
        steps = F.zip_with(F.slice(F.transform(F.split(text, pattern, -1), lambda g: F.char_length(g)),
                                   F.lit(1), F.size(found)), sizes, lambda g, n: g + n)
        return bind(F.struct(steps.alias("steps"), sizes.alias("sizes"), values.alias("values")), lambda x: bind(
            running(x["steps"]), lambda ends: F.filter(
                F.transform(ends, lambda end, k: F.struct(
                    (end - F.get(x["sizes"], k)).alias("start"), F.lit(kind).alias("kind"), end.alias("end"),
                    F.get(x["values"], k).alias("value"))),
                lambda s: F.char_length(s["value"]) >= value_min)))

    return bind(F.regexp_extract_all(text, rx, F.lit(0)),
                lambda found: F.when(F.size(found) == 0, empty).otherwise(placed(found)))


def base_spans(text: Column) -> Column:
    """Struct of the span arrays of the three fixed patterns."""
    return F.struct(find(text, ASSIGN, 0, 2, ASSIGN_VALUE_MIN).alias("assign"),
                    find(text, ACCESS, 1).alias("access"), find(text, HEX, 2).alias("hex"))


@dataclass(frozen=True)
class RatioModel:
    """Log of how much likelier each character pair is in a random string than
    in an ordinary word, SIZE x SIZE values."""

    ratios: tuple[float, ...]
    least: float = RATIO_MIN     # mean ratio from which on a string is random

    def mean_ratio(self, word: Column) -> Column:
        """Mean log-likelihood ratio of a word's character pairs."""
        # A folded literal: one constant array, however often it is used.
        table = F.split(F.lit(" ".join(f"{x:.4f}" for x in self.ratios)), " ").cast("array<double>")
        code = lambda k: F.ascii(F.substr(word, k, F.lit(1))) - FIRST
        pairs = F.sequence(F.lit(1), F.char_length(word) - 1)
        return F.aggregate(pairs, F.lit(0.0), lambda acc, k: acc + F.coalesce(
            F.get(table, code(k) * SIZE + code(k + 1)), F.lit(0.0))) / (F.char_length(word) - 1)


def pair_counts(words: DataFrame) -> list[float]:
    """Counts of character pairs in the column ``word``; SIZE x SIZE cells
    reach the driver, whatever the number of words."""
    letters = words.select(F.split("word", "").alias("c"))
    # The last letter meets a NULL and drops out.
    pairs = letters.select(F.explode(F.arrays_zip(F.col("c").alias("a"), F.slice("c", F.lit(2), F.size("c")).alias("b"))).alias("p")).select(
        (F.ascii("p.a") - FIRST).alias("a"), (F.ascii("p.b") - FIRST).alias("b")).filter(
        F.col("a").between(0, SIZE - 1) & F.col("b").between(0, SIZE - 1))
    out = [0.0] * (SIZE * SIZE)
    for r in pairs.groupBy("a", "b").count().collect():
        out[r["a"] * SIZE + r["b"]] = float(r["count"])
    return out


def transitions(counts: list[float]) -> list[float]:
    """Log transition probabilities, smoothed."""
    out = []
    for a in range(SIZE):
        row = counts[a * SIZE:(a + 1) * SIZE]
        total = sum(row) + SMOOTHING * SIZE
        out += [math.log((x + SMOOTHING) / total) for x in row]
    return out


def train(docs: DataFrame, text_col: str = "text") -> RatioModel:
    """Both character models from all documents: the random one from the values
    that the fixed patterns find (the labelled strings), the ordinary one from
    words too short to be judged themselves, assigned values left out.

    A string is a secret from a mean ratio of RATIO_MIN on, or from less, down
    to RATIO_FLOOR, where a twentieth of the labelled strings would stay below.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(base_spans(text).alias("b"))
    secrets = staged(base.select(F.explode(F.concat("b.assign.value", "b.access.value", "b.hex.value")).alias("word")), "secret-values")
    plain = F.split(F.regexp_replace(text, F.lit(ASSIGN), F.lit(" ")), NO_WORD)
    words = docs.select(F.explode(plain).alias("word")).filter(F.char_length("word").between(WORD_MIN, CANDIDATE_MIN - 1))
    random, ordinary = transitions(pair_counts(secrets)), transitions(pair_counts(words))
    model = RatioModel(tuple(a - b for a, b in zip(random, ordinary)))
    long = secrets.filter(F.char_length("word") >= CANDIDATE_MIN)
    low = long.agg(F.percentile_approx(model.mean_ratio(F.col("word")), 0.05)).first()[0]
    drop_staged(secrets)
    return model if low is None else RatioModel(model.ratios, max(RATIO_FLOOR, min(RATIO_MIN, low)))


def scan(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", model: RatioModel | None = None) -> DataFrame:
    """``docs`` with a struct column ``secrets``: the spans of each kind as
    arrays of (start, kind, end, value).  The name gets underscores if taken.

    Strings that the models find never overlap a span of the fixed patterns;
    those stay as they are.
    """
    model = model or train(docs, text_col)
    name = free_name(docs, "secrets")
    text = F.coalesce(F.col(text_col), F.lit(""))

    def found(b: Column) -> Column:
        free = lambda s: ~(overlaps(b["assign"], s) | overlaps(b["access"], s) | overlaps(b["hex"], s))
        random = F.filter(find(text, CANDIDATE, 3),
                          lambda s: (model.mean_ratio(s["value"]) >= model.least) & free(s))
        return F.struct(b["assign"].alias("assign"), b["access"].alias("access"), b["hex"].alias("hex"),
                        random.alias("markov"))

    return docs.withColumn(name, bind(base_spans(text), found))


def in_order(*arrays: Column) -> Column:
    """Spans of several kinds by start, then kind."""
    return F.array_sort(F.transform(F.concat(*arrays), lambda s: F.struct(
        s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))


def span_list(spans: Column) -> Column:
    """kind:start:end of ordered spans, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", model: RatioModel | None = None) -> DataFrame:
    """``docs`` with every span of its texts replaced by its kind in angle
    brackets (spans that overlap an earlier one only lengthen the cut)."""
    scanned = scan(docs, text_col, id_col, model)
    s = F.col(next(c for c in scanned.columns if c not in docs.columns))
    spans = in_order(s["assign"], s["access"], s["hex"], s["markov"])
    kinds = F.array(*[F.lit(f"<{k}>") for k in KINDS])
    text = F.col(text_col)

    def cut(chunks: Column, start: Column, end: Column) -> Column:
        """Characters [start, end) of the text that was cut into chunks."""
        first = F.floor(start / CHUNK).cast("int")
        return F.substr(F.array_join(F.slice(chunks, first + 1, F.floor(end / CHUNK).cast("int") - first + 1), ""),
                        start - first * CHUNK + 1, F.greatest(end - start, F.lit(0)))

    def replaced(found: Column, chunks: Column, ends: Column) -> Column:
        pieces = F.transform(found, lambda s, k: bind(F.coalesce(F.get(ends, k - 1), F.lit(0)), lambda at: F.when(
            s["start"] >= at, F.concat(cut(chunks, at, s["start"]), F.get(kinds, s["kind"]))).otherwise("")))
        return F.concat(F.array_join(pieces, ""), cut(chunks, F.array_max(ends), F.char_length(text)))

    # Chunks keep a piece's cost from growing with the whole text.
    chunks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))
    clean = bind(spans, lambda found: F.when(F.size(found) == 0, text).otherwise(bind(
        chunks, lambda c: bind(F.transform(found, lambda s: s["end"]), lambda own: bind(
            running(own, lambda x, y: F.greatest(x, y)), lambda ends: replaced(found, c, ends))))))
    return scanned.withColumn(text_col, clean).select(*docs.columns)
