"""Language identification of words in code-switched text by a linear-chain CRF.

Words are runs of letters, lower-cased.  A word's score for a language is the
sum of learned weights of its features: the word itself if the training
lexicon has it, and its character n-grams of 1 to 4 with the word's ends
marked, so n-grams at an end are its affixes.  Learned transition weights say
how readily a text changes language between neighbouring words.  Training
maximises the likelihood of labelled word sequences; forward-backward gives
every word's probability of each language, given the whole text.

Training sequences join stretches of documents of different languages, since
that is where transitions come from; a word's label is its document's.

How it runs: the model is fitted on a bounded sample (FIT_DOCS documents a
language, chosen by hash; of a text longer than FIT_CHARS characters, stretches
from the whole of it with that many) on the driver and sent to every task (a
table of fixed size).  Prediction is one scan.
Forward and backward passes run over many documents at once: documents are
laid end to end in lanes, and a document's first word forgets the lane's past.

Defined results: a NULL text, or one without a letter, is ``und`` with score
0.  Ties go to the first language in alphabetical order.  Without a labelled
training document every text is ``und`` with score 0.  Repeated rows and NULL
ids change nothing; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.llm import textbatch as tb
from lakemart.llm.common import bounded_text, free_name, hash_spread

FIT_DOCS = 150
FIT_CHARS = 20_000
STRETCH = 40            # words of a training stretch
BUCKETS = 1 << 16       # weights of hashed n-grams
LEXICON_MIN = 3         # a word enters the lexicon when the sample has it so often
GRAMS = (1, 2, 3, 4)
STEPS = 40
RATE = 0.3
DECAY = 1e-4
LANES = 512
SLICE_BYTES = 2 << 20     # text worked on at once: bounds a task's work space
UNKNOWN = "und"

_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True
_LETTER[0x80:] = True
# Lower case of the two-byte letters U+00C0-U+00DE (second byte 0x80-0x9E, not 0x97).
_UPPER_SECOND = np.zeros(256, dtype=bool)
_UPPER_SECOND[0x80:0x9F] = True
_UPPER_SECOND[0x97] = False


def letter_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts as one binary array, and their n+1 offsets."""
    b, off = tb.byte_view(texts)
    b = tb.LOWER[b]
    if len(b) > 1:
        latin = np.flatnonzero((b[:-1] == 0xC3) & _UPPER_SECOND[b[1:]]) + 1
        b[latin] += 0x20
    ink = np.zeros(len(b) + 2, dtype=bool)
    ink[1:-1] = _LETTER[b]
    edge = np.zeros(len(b) + 1, dtype=bool)
    edge[off] = True
    starts = np.flatnonzero(ink[1:-1] & (~ink[:-2] | edge[:-1]))
    ends = np.flatnonzero(ink[1:-1] & (~ink[2:] | edge[1:])) + 1
    sizes = ends - starts
    at = np.append(0, np.cumsum(sizes)).astype(np.int32)
    flat = np.ascontiguousarray(b[tb.expand(starts, sizes)])
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(flat)])
    return words, np.searchsorted(starts, off)


def features(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each word, and the n-gram buckets of all words with offsets."""
    b, off = tb.byte_view(words)
    sizes = np.diff(off)
    whole = tb.hash_spans(b, off[:-1], off[1:])
    # ^word$ of every word, end to end.
    at = np.append(0, np.cumsum(sizes + 2))
    s = np.empty(at[-1], dtype=np.uint8)
    s[at[:-1]], s[at[1:] - 1] = ord("^"), ord("$")
    s[np.arange(len(b)) + np.repeat(at[:-1] + 1 - off[:-1], sizes)] = b
    word = np.repeat(np.arange(len(sizes)), sizes + 2)
    left = np.repeat(at[1:], sizes + 2) - np.arange(len(s))       # characters to the word's end
    code, rows, buckets = np.zeros(len(s), np.uint64), [], []
    for n in range(1, max(GRAMS) + 1):
        code[:len(s) - n + 1] = (code[:len(s) - n + 1] << np.uint64(8)) | s[n - 1:]
        if n in GRAMS:
            ok = np.flatnonzero(left >= n)
            rows.append(word[ok])
            buckets.append((tb.mix(code[ok] * np.uint64(8) + np.uint64(n)) >> np.uint64(48)).astype(np.int64) % BUCKETS)
    rows, buckets = np.concatenate(rows), np.concatenate(buckets)
    by = np.argsort(rows, kind="stable")
    return whole, buckets[by], np.searchsorted(rows[by], np.arange(len(sizes) + 1))


@dataclass
class Model:
    languages: list[str]
    lexicon: np.ndarray       # hashes of known words, ascending
    words: np.ndarray         # lexicon x languages
    grams: np.ndarray         # BUCKETS x languages
    change: np.ndarray        # languages x languages, from row to column
    first: np.ndarray         # languages

    def emissions(self, words: pa.Array) -> np.ndarray:
        """Scores of distinct words, words x languages."""
        whole, buckets, at = features(words)
        out = _gram_sums(self.grams, buckets, at)
        # A word's n-grams speak with one voice, however long it is.
        out /= np.sqrt(np.maximum(1, np.diff(at)))[:, None]
        k = _find(self.lexicon, whole)
        out[k >= 0] += self.words[k[k >= 0]]
        return out


def _find(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return np.where(table[at] == keys, at, -1)


def _gram_sums(grams: np.ndarray, buckets: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of the weights of each word's n-grams, a language at a time (every
    word has some)."""
    out = np.empty((len(at) - 1, grams.shape[1]))
    for c in range(grams.shape[1]):
        if len(out):
            out[:, c] = np.add.reduceat(np.ascontiguousarray(grams[:, c])[buckets], at[:-1])
    return out


def _sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of the rows of each range."""
    total = np.zeros((len(values) + 1, values.shape[1]))
    np.cumsum(values, axis=0, out=total[1:])
    return total[at[1:]] - total[at[:-1]]


def forward_backward(scores: np.ndarray, sizes: np.ndarray, change: np.ndarray, first: np.ndarray,
                     transitions: bool = False):
    """Posterior of every word's language, for sequences of ``sizes`` words
    laid end to end; with ``transitions`` also the expected transition counts
    and expected first labels.

    Sequences are dealt to lanes; one step handles one word of every lane.
    """
    n, k = scores.shape
    keep = np.flatnonzero(sizes)
    place, lane_len = _lanes(sizes[keep], LANES)
    starts = np.concatenate([[0], np.cumsum(sizes)])[keep]
    steps, lanes = int(lane_len.max(initial=0)), len(lane_len)
    if not steps:
        return (np.zeros((0, k)), np.zeros((k, k)), np.zeros(k)) if transitions else np.zeros((0, k))
    slot = tb.expand(place, sizes[keep])          # lane-major slots: step * lanes + lane comes from these
    lane, step = slot // steps, slot % steps
    cell = step * lanes + lane
    word = tb.expand(starts, sizes[keep])
    emit = np.ones((steps * lanes, k))
    top = scores.max(axis=1, keepdims=True)
    emit[cell] = np.exp(np.maximum(scores - top, -50.0))[word]
    emit = emit.reshape(steps, lanes, k)
    begins = np.zeros(steps * lanes, dtype=bool)
    begins[place % steps * lanes + place // steps] = True
    begins = begins.reshape(steps, lanes)
    used = np.zeros(steps * lanes, dtype=bool)
    used[cell] = True
    live = np.sort(lane_len)[::-1]                # lanes are ordered by length, longest first
    width = np.searchsorted(-live, -np.arange(1, steps + 1), side="right")
    jump, start = np.exp(change), np.exp(first)
    alpha = np.empty((steps, lanes, k))
    for t in range(steps):
        w = width[t]
        a = alpha[t - 1, :w] @ jump if t else np.empty((w, k))
        a[begins[t, :w]] = start
        a *= emit[t, :w]
        a /= a.sum(axis=1, keepdims=True)
        alpha[t, :w] = a
    gamma = np.ones((steps, lanes, k))
    beta = np.ones((lanes, k))
    moves = np.zeros((k, k))
    for t in range(steps - 1, -1, -1):
        w = width[t]
        if t + 1 < steps:
            v = width[t + 1]
            ahead = beta[:v] * emit[t + 1, :v]
            inside = ~begins[t + 1, :v]
            if transitions and inside.any():
                a, c = alpha[t, :v][inside], ahead[inside]
                z = ((a @ jump) * c).sum(axis=1)
                moves += (a / z[:, None]).T @ c * jump
            new = ahead @ jump.T
            new /= new.sum(axis=1, keepdims=True)
            new[~inside] = 1.0
            beta[:v] = new
        g = alpha[t, :w] * beta[:w]
        gamma[t, :w] = g / g.sum(axis=1, keepdims=True)
    out = np.empty((n, k))
    out[word] = gamma.reshape(-1, k)[cell]
    if not transitions:
        return out
    return out, moves, gamma.reshape(-1, k)[begins.reshape(-1)].sum(axis=0)


def _lanes(sizes: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Deals sequences to lanes of about equal length.  Returns each
    sequence's first slot (lane * steps + step) and the lanes' lengths,
    longest lane first."""
    target = max(int(sizes.max(initial=0)), -(-int(sizes.sum()) // most))
    order = np.argsort(-sizes, kind="stable")
    ends = np.cumsum(sizes[order])
    lane_of, used_at, lengths = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64), []
    k = 0
    while k < len(order):
        base = ends[k - 1] if k else 0
        stop = max(k + 1, int(np.searchsorted(ends, base + target, side="right")))
        lane_of[order[k:stop]] = len(lengths)
        used_at[order[k:stop]] = ends[k:stop] - sizes[order[k:stop]] - base
        lengths.append(int(ends[stop - 1] - base))
        k = stop
    lengths = np.array(lengths, dtype=np.int64)
    rank = np.empty(len(lengths), np.int64)
    by = np.argsort(-lengths, kind="stable")
    rank[by] = np.arange(len(lengths))
    steps = int(lengths.max(initial=0))
    return rank[lane_of] * steps + used_at, lengths[by]


def fit(texts: pa.Array, labels: list[str]) -> Model:
    """Adam ascent on the conditional likelihood of the label sequences."""
    languages = sorted(set(labels))
    words, woff = letter_words(texts)
    sizes = np.diff(woff)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    label = np.searchsorted(languages, np.array(labels, dtype=object))[doc] if len(doc) else np.zeros(0, np.int64)
    # Stretches of all documents in a fixed shuffled order, two or three to a sequence.
    nth = np.arange(len(doc)) - woff[:-1][doc]
    key = tb.mix((doc * 1_000_003 + nth // STRETCH).astype(np.uint64))
    order = np.lexsort((nth, key))
    new = np.ones(len(order), dtype=bool)
    new[1:] = key[order][1:] != key[order][:-1]
    stretch = np.cumsum(new) - 1
    seq = stretch // 2
    seq_sizes = np.bincount(seq) if len(seq) else np.zeros(0, np.int64)
    truth = label[order]
    coded = words.dictionary_encode()
    word = coded.indices.to_numpy()[order]
    whole, buckets, at = features(coded.dictionary)
    often = np.bincount(word, minlength=len(whole)) >= LEXICON_MIN
    lexicon = np.unique(whole[often])
    in_lex = _find(lexicon, whole)
    k, scale = len(languages), 1 / np.sqrt(np.maximum(1, np.diff(at)))
    model = Model(languages, lexicon, np.zeros((len(lexicon), k)), np.zeros((BUCKETS, k)), np.zeros((k, k)), np.zeros(k))
    params = [model.words, model.grams, model.change, model.first]
    mean, square = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    starts = np.cumsum(seq_sizes) - seq_sizes
    inside = np.ones(len(truth), dtype=bool)
    inside[starts] = False
    goal_moves = np.zeros((k, k))
    np.add.at(goal_moves, (truth[:-1][inside[1:]], truth[1:][inside[1:]]), 1)
    goal_first = np.bincount(truth[starts], minlength=k)
    owner = np.repeat(np.arange(len(whole)), np.diff(at))
    for step in range(1, STEPS + 1):
        scores = _gram_sums(model.grams, buckets, at) * scale[:, None]
        scores[in_lex >= 0] += model.words[in_lex[in_lex >= 0]]
        gamma, moves, firsts = forward_backward(scores[word], seq_sizes, model.change, model.first, transitions=True)
        miss = -gamma
        miss[np.arange(len(truth)), truth] += 1
        by_word = np.stack([np.bincount(word, weights=miss[:, c], minlength=len(whole)) for c in range(k)], axis=1)
        grads = [np.stack([np.bincount(in_lex[in_lex >= 0], weights=by_word[in_lex >= 0, c], minlength=len(lexicon))
                           for c in range(k)], axis=1) if len(lexicon) else model.words * 0,
                 np.stack([np.bincount(buckets, weights=(by_word[:, c] * scale)[owner], minlength=BUCKETS)
                           for c in range(k)], axis=1),
                 goal_moves - moves, goal_first - firsts]
        for p, g, m, v in zip(params, grads, mean, square):
            g = g / max(1, len(truth)) - DECAY * p
            m += 0.1 * (g - m)
            v += 0.02 * (g * g - v)
            p += RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.98 ** step)) + 1e-9)
    return model


def train(docs: DataFrame, teaches: Column, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang") -> Model | None:
    """A model of the bounded sample of the rows that ``teaches`` selects."""
    rows = docs.filter(teaches & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("i"), F.col(lang_col).alias("l"), F.col(text_col).alias("t"))
    chosen = hash_spread(rows.select("i", "l"), "i", "l", FIT_DOCS)
    # FIT_DOCS ids a language: a table of bounded size.
    table = rows.join(F.broadcast(chosen), ["i", "l"]).select(
        "l", bounded_text(F.col("t"), FIT_CHARS).alias("t"), "i").toArrow()
    table = table.take(pc.sort_indices(table, [("i", "ascending"), ("t", "ascending")]))
    return fit(table["t"].combine_chunks(), table["l"].to_pylist()) if table.num_rows else None


PREDICTION_TYPE = T.StructType([T.StructField("lang_pred", T.StringType(), False),
                                T.StructField("score", T.DoubleType(), False),
                                T.StructField("n_words", T.LongType(), False),
                                T.StructField("n_switched", T.LongType(), False)])

_PREDICTION_ARROW = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("n_words", pa.int64()),
                               ("n_switched", pa.int64())])


def predict_batch(model: Model | None, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Language, score, words, and words labelled with another language, per text."""
    n = len(texts)
    if model is None:
        return [UNKNOWN] * n, np.zeros(n), np.zeros(n, np.int64), np.zeros(n, np.int64)
    words, woff = letter_words(texts)
    sizes = np.diff(woff)
    if not len(words):
        return [UNKNOWN] * n, np.zeros(n), sizes, np.zeros(n, np.int64)
    coded = words.dictionary_encode()
    scores = model.emissions(coded.dictionary)[coded.indices.to_numpy()]
    gamma = forward_backward(scores, sizes, model.change, model.first)
    mass = _sums(gamma, woff) / np.maximum(1, sizes)[:, None]
    best = mass.argmax(axis=1)
    labels = gamma.argmax(axis=1)
    other = tb.count_per_doc(labels != np.repeat(best, sizes), woff)
    # Bytes above 0x7F are taken for letters; a text with no real letter has no language.
    plain = tb.count_per_doc(*_ascii_letters(texts)) > 0
    lettered = [bool(p) or (s > 0 and any(c.isalpha() for c in texts[d].as_py()))
                for d, (p, s) in enumerate(zip(plain.tolist(), sizes.tolist()))]
    score = np.where(lettered, mass[np.arange(n), best], 0.0)
    return [model.languages[x] if ok else UNKNOWN for x, ok in zip(best, lettered)], score, sizes, other


def _ascii_letters(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    b, off = tb.byte_view(texts)
    return _LETTER[b] & (b < 0x80), off


def identify(docs: DataFrame, model: Model | None, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (default: all) with a struct column
    ``language`` (lang_pred, score, n_words, n_switched); the name gets
    underscores if it is taken.  Only texts go to Python, only verdicts come
    back."""
    name = free_name(docs, "language")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            parts = []
            for lo, hi in tb.slices(texts, SLICE_BYTES):
                lang, score, words, other = predict_batch(shared.value, texts.slice(lo, hi - lo))
                parts.append(pa.StructArray.from_arrays(
                    [pa.array(lang, pa.string()), pa.array(score), pa.array(words), pa.array(other)],
                    names=PREDICTION_TYPE.names))
            yield pa.concat_arrays(parts) if parts else pa.array([], _PREDICTION_ARROW)

    verdict = F.arrow_udf(run, PREDICTION_TYPE)
    return docs.select(*(docs.columns if keep is None else keep), verdict(F.col(text_col)).alias(name))
