"""Quality rules by weak supervision.

Every rule votes "bad" or "good" on a document or abstains.  Nobody says how
far to trust a rule: expectation-maximisation estimates, for each rule, how
often it votes bad on bad documents and good on good ones, from the counts of
all vote patterns of the corpus.  The posterior probability of being good then
decides, instead of "must pass every rule".

Cost: one scan that counts per document (Arrow batches, numpy), one aggregate
over at most 3**len(RULES) patterns, one narrow projection.  Only the pattern
counts reach the driver; their number does not depend on the corpus.

Defined results
    NULL or empty text: all counts 0, every rule abstains, base_failed, not
    kept.  A NULL or repeated id, ties and extra columns pass through; columns
    are added under names that do not clash.  An empty table gives an empty
    table.  Texts are counted whole, whatever their length.
"""

from __future__ import annotations

import math
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.llm import textbatch as tb
from lakemart.llm.common import free_name, staged

MIN_WORDS = 50
SLICE_BYTES = 2 << 20     # text worked on at once: bounds a task's work space
SYMBOLS = b"#*$%&|<>"
COUNT_FIELDS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                "n_lines", "n_letters", "n_upper", "n_letter_words", "n_shouts", "n_distinct_words", "n_unspaced"]
COUNTS_TYPE = T.StructType([T.StructField(f, T.LongType(), False) for f in COUNT_FIELDS])

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(SYMBOLS)] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_LETTER = _UPPER.copy()
_LETTER[97:123] = True
_LETTER[0xC3:] = True   # lead byte of a non-ASCII character
# By code point, up to the last letter: letters and the marks that belong to them; scripts without blanks between words
# (Thai, Lao, Tibetan, Burmese, Khmer, Chinese, Japanese) and the signs written among them.
_ALPHA = np.array([unicodedata.category(chr(c))[0] in "LM" for c in range(0x323B0)] + [False])
_UNSPACED = np.zeros(len(_ALPHA), dtype=bool)
for _lo, _hi in ((0x0E00, 0x1100), (0x1780, 0x1800), (0x2E80, 0x3130), (0x31C0, 0xA4D0), (0xF900, 0xFB00),
                 (0xFE30, 0xFE50), (0xFF00, 0xFFA0), (0x20000, 0x323B0)):
    _UNSPACED[_lo:_hi] = True
_UNSPACED[0x10A0:0x1100] = False   # Georgian
_TRIM = " \t\n\x0b\x0c\r"


def _dup_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = text.split("\n")
    if len(lines) == len(set(lines)):
        return 0
    inked = [x for x in lines if x.strip(_TRIM)]
    return len(inked) - len(set(inked))


def repeats(h: np.ndarray, docs: np.ndarray, offs: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Words inside windows of ``width`` words found twice or more in their
    document, and the number of distinct words, per document."""
    n_docs = len(offs) - 1
    key = tb.mix(h + tb.mix(docs.astype(np.uint64)))
    order = np.argsort(key, kind="stable")
    new = np.ones(len(key), dtype=bool)
    new[1:] = key[order][1:] != key[order][:-1]
    distinct = np.bincount(docs[order][new], minlength=n_docs)
    covered = np.zeros(len(h), dtype=bool)
    win = tb.window_hashes(h, width)
    if len(win):
        inside = docs[width - 1:] == docs[:len(win)]
        at = np.flatnonzero(inside)
        wkey = tb.mix(win[at] + tb.mix(docs[at].astype(np.uint64)))
        order = np.argsort(wkey, kind="stable")
        same = wkey[order][1:] == wkey[order][:-1]
        twice = np.zeros(len(at), dtype=bool)
        twice[1:] |= same
        twice[:-1] |= same
        hit = at[order[twice]]
        for k in range(width):
            covered[hit + k] = True
    return tb.count_per_doc(covered, offs), distinct


def _scripts(b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marks on the first byte of each letter, and of each character of a
    script without blanks."""
    alpha, unspaced = _LETTER & (np.arange(256) < 0x80), np.zeros(len(b), dtype=bool)
    alpha = alpha[b]
    at = np.flatnonzero(b >= 0xC2)
    lead, tail = b[at].astype(np.int64), np.concatenate([b, np.zeros(3, np.uint8)]) & 0x3F
    x, y, z = (tail[at + k].astype(np.int64) for k in (1, 2, 3))
    point = np.where(lead < 0xE0, (lead & 0x1F) << 6 | x,
                     np.where(lead < 0xF0, (lead & 0x0F) << 12 | x << 6 | y, (lead & 7) << 18 | x << 12 | y << 6 | z))
    point = np.minimum(point, len(_ALPHA) - 1)
    alpha[at], unspaced[at] = _ALPHA[point], _UNSPACED[point]
    return alpha, unspaced


def count_batch(texts: pa.Array) -> np.ndarray:
    """The counts of COUNT_FIELDS, one row per text."""
    out = np.zeros((len(texts), len(COUNT_FIELDS)), dtype=np.int64)
    for lo, hi in tb.slices(texts, SLICE_BYTES):
        part = texts.slice(lo, hi - lo)
        b, off = tb.byte_view(part)
        starts, ends, woff = tb.word_spans(b, off)
        docs = tb.doc_of(woff)
        blank, lead = tb.BLANK[b], (b & 0xC0) != 0x80
        upper, letter = _UPPER[b], _LETTER[b]
        alpha, unspaced = _scripts(b)
        total = np.zeros(len(b) + 1, dtype=np.int64)
        # Twice the letters less the characters of a word: 0 or more where half of them are letters.
        np.cumsum(2 * alpha.astype(np.int8) - lead, out=total[1:])
        wordlike = total[ends] >= total[starts]
        shout = b[ends - 1] == ord("!") if len(ends) else np.zeros(0, bool)
        repeat, distinct = repeats(tb.hash_spans(b, starts, ends), docs, woff, 3)
        strings = part.to_pylist()
        cols = [np.diff(woff), tb.count_per_doc(lead & ~blank, off), tb.count_per_doc(_SYMBOL[b], off),
                np.array([_dup_lines(s) if s else 0 for s in strings], dtype=np.int64), repeat,
                np.array([s.count("\n") + 1 if s else 0 for s in strings], dtype=np.int64),
                tb.count_per_doc(letter, off), tb.count_per_doc(upper, off),
                np.bincount(docs, weights=wordlike, minlength=hi - lo).astype(np.int64),
                np.bincount(docs, weights=shout, minlength=hi - lo).astype(np.int64), distinct,
                tb.count_per_doc(unspaced, off)]
        out[lo:hi] = np.stack(cols, axis=1)
    return out


def with_counts(df: DataFrame, text_col: str, name: str, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``df`` (default: all) and a struct column
    ``name`` of the counts of each text.  Only texts go to Python, only counts
    come back."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.StructArray.from_arrays([pa.array(c) for c in count_batch(texts).T], names=COUNT_FIELDS)

    counts = F.arrow_udf(run, COUNTS_TYPE)
    return df.select(*(df.columns if keep is None else keep), counts(F.col(text_col)).alias(name))


@dataclass(frozen=True)
class Rule:
    """Votes bad where ``bad`` holds, else good where ``good`` holds, else abstains.

    Both take the counts column and return a condition; all conditions are
    ratios, so no text is too long for them.
    """

    name: str
    bad: Callable[[Column], Column]
    good: Callable[[Column], Column]


RULES = (
    Rule("symbols", lambda c: c["n_symbols"] * 10 > c["n_words"], lambda c: c["n_symbols"] * 50 <= c["n_words"]),
    Rule("repeated_lines", lambda c: (c["n_dup_lines"] > 1) & (c["n_dup_lines"] * 10 > c["n_lines"] * 3),
         lambda c: c["n_dup_lines"] * 10 <= c["n_lines"]),
    Rule("repeated_windows", lambda c: c["n_repeat_words"] * 10 > c["n_words"] * 3,
         lambda c: c["n_repeat_words"] * 10 <= c["n_words"]),
    # Characters of scripts without blanks say nothing of a word's length.
    Rule("word_length", lambda c: (c["word_chars"] - c["n_unspaced"] > c["n_words"] * 14)
         | (c["word_chars"] < c["n_words"] * 2),
         lambda c: c["word_chars"].between(c["n_words"] * 3, c["n_words"] * 11)),
    Rule("capitals", lambda c: c["n_upper"] * 5 > c["n_letters"] * 2, lambda c: c["n_upper"] * 7 <= c["n_letters"]),
    Rule("wordlike", lambda c: c["n_letter_words"] * 10 < c["n_words"] * 7,
         lambda c: c["n_letter_words"] * 20 >= c["n_words"] * 19),
    Rule("shouting", lambda c: c["n_shouts"] * 10 > c["n_words"], lambda c: c["n_shouts"] * 50 <= c["n_words"]),
    Rule("variety", lambda c: (c["n_words"] >= 100) & (c["n_distinct_words"] * 6 < c["n_words"]),
         lambda c: c["n_distinct_words"] * 3 >= c["n_words"]),
)


def vote_pattern(counts: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """One letter per rule: b(ad), g(ood) or - (abstains; always on no words)."""
    return F.concat(*[F.when(counts["n_words"] == 0, "-").when(r.bad(counts), "b").when(r.good(counts), "g")
                      .otherwise("-") for r in rules])


@dataclass(frozen=True)
class VoteModel:
    """Hidden classes of documents: class 0 is good, class k + 1 is the kind
    of bad document that rule k looks for.  ``share`` is each class's part of
    the corpus, ``bad_rate[c][k]`` how often rule k, if it votes, votes bad on
    class c (for class 0: its error rate)."""

    share: tuple[float, ...]
    bad_rate: tuple[tuple[float, ...], ...]

    def good_probability(self, pattern: Column) -> Column:
        """Posterior probability of class 0, from the vote letters."""
        others = []
        for c in range(1, len(self.share)):
            odds = F.lit(math.log(self.share[c] / self.share[0]))
            for k, (rate, base) in enumerate(zip(self.bad_rate[c], self.bad_rate[0])):
                letter = F.substring(pattern, k + 1, 1)
                odds = odds + (F.when(letter == "b", math.log(rate / base))
                               .when(letter == "g", math.log((1 - rate) / (1 - base))).otherwise(0.0))
            others.append(F.exp(odds))
        return 1.0 / (1.0 + sum(others[1:], others[0]))


def fit_votes(patterns: dict[str, int], n_rules: int, rounds: int = 100, max_error: float = 0.05) -> VoteModel:
    """Expectation-maximisation over pattern counts.

    Bad documents are of several kinds that trip different rules, so votes
    are independent only within a kind: there is one bad class per rule.  Two
    bounds name the classes: a rule errs on at most ``max_error`` of the good
    documents, and finds at least half of the kind it looks for.  Pseudo-counts
    keep every estimate inside (0, 1).
    """
    keys = sorted(patterns)
    count = np.array([patterns[k] for k in keys], dtype=np.float64)
    letters = np.array([list(k) for k in keys]).reshape(len(keys), n_rules)
    bad, good = (letters == "b").astype(np.float64), (letters == "g").astype(np.float64)
    own = np.vstack([np.zeros((1, n_rules)), np.eye(n_rules)])
    share = np.array([0.8] + [0.2 / n_rules] * n_rules)
    rate = np.where(own == 1, 0.9, 0.1)
    rate[0] = 0.02
    for _ in range(rounds):
        joint = np.log(share) + bad @ np.log(rate).T + good @ np.log(1 - rate).T
        joint = np.exp(joint - joint.max(axis=1, keepdims=True))
        part = joint / joint.sum(axis=1, keepdims=True) * count[:, None]
        share = (part.sum(axis=0) + 1) / (count.sum() + n_rules + 1)
        rate = (part.T @ bad + 0.5) / (part.T @ (bad + good) + 1)
        rate = np.clip(np.where(own == 1, np.maximum(rate, 0.5), rate), 1e-4, 1 - 1e-4)
        rate[0] = np.minimum(rate[0], max_error)
    return VoteModel(tuple(map(float, share)), tuple(tuple(map(float, r)) for r in rate))


def train(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> VoteModel:
    """The vote model of all documents; nothing but vote patterns leaves a task."""
    name = free_name(docs, "quality")
    voted = with_counts(docs, text_col, name, []).select(vote_pattern(F.col(name), rules).alias("votes"))
    return fit_votes({r[0]: r[1] for r in voted.groupBy("votes").count().collect()}, len(rules))   # 3 ** len(rules) rows at most


def judge(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES,
          threshold: float = 0.5, keep: list[str] | None = None, model: VoteModel | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (default: all) with a struct column ``quality`` (the counts, ``base_failed``,
    ``good_probability``, ``kept``); the name gets underscores if it is taken.

    Without a ``model`` the counted rows are staged once: the vote model and
    the verdicts read the same counts.  With one (``train``), nothing is
    staged; rows that carry their texts are better counted twice.
    """
    name, votes = free_name(docs, "quality"), free_name(docs, "votes")
    counted = with_counts(docs, text_col, name, keep)
    counted = counted.withColumn(votes, vote_pattern(F.col(name), rules))
    if model is None:
        counted = staged(counted, "quality-counts")
        found = {r[0]: r[1] for r in counted.groupBy(votes).count().collect()}   # at most 3 ** len(rules) rows
        model = fit_votes(found, len(rules))
    c = F.col(name)
    failed = (c["n_words"] < MIN_WORDS) | (c["n_repeat_words"] * 100 > c["n_words"] * 50)
    # Bound to one value: written out, the letters' expression would stand in every term.
    probability = F.get(F.transform(F.array(F.col(votes)), model.good_probability), F.lit(0))
    return counted.withColumn(name, F.struct(
        *[c[f].alias(f) for f in COUNT_FIELDS], failed.alias("base_failed"),
        probability.alias("good_probability"), (~failed & (probability >= threshold)).alias("kept"))).drop(votes)
