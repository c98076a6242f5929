"""Quality classification by nearest-neighbour voting in a latent space.

A text's terms are hashed byte trigrams of its lower-cased text (content), of
its character shapes (style) and the shares of repeated and other words
(repetition).  Each family is tf-idf weighted and scaled to length 1, so long
and short texts compare.  A truncated singular value decomposition of a
labelled sample gives the latent axes; labelled latent vectors go to every
task, every document is compared with all of them by exact blocked cosine
products, and its K nearest vote with their similarity as weight.

The sample (FIT_DOCS documents a class, chosen by hash; of a text longer than
FIT_CHARS characters, stretches from the whole of it with that many) is the
only thing fitted on a part of the data; class shares come from all training
rows.  Prediction is one scan.

Defined results: a NULL or empty text has no terms; its score is the share of
class 1.  All documents as similar as the K-th neighbour vote, so ties do not
depend on order.  Without training rows every score is 0.5.  Labels that are
NULL or neither 0 nor 1 are left out; a document with several labels counts
with each.  Repeated rows and NULL ids change nothing; an empty table gives no
rows.
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
from lakemart.llm.weak_rules import repeats

FIT_DOCS = 1000
FIT_CHARS = 20_000
CONTENT, STYLE = 4096, 2048       # hash buckets, powers of two
TERMS = CONTENT + STYLE + 2
FAMILIES = ((0, CONTENT, 0.7), (CONTENT, CONTENT + STYLE, 1.0), (CONTENT + STYLE, TERMS, 1.0))   # from, to, weight
AXES = 64
NEIGHBOURS = 15
SHARPNESS = 8                     # a neighbour votes with its similarity to this power
ROWS = 512                        # documents of a block

_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[65:91], _SHAPE[97:123], _SHAPE[48:58], _SHAPE[0x80:] = ord("A"), ord("a"), ord("0"), ord("a")


def _trigrams(s: np.ndarray, off: np.ndarray, buckets: int) -> np.ndarray:
    """Counts of hashed byte trigrams, documents x buckets."""
    n = len(off) - 1
    if len(s) < 3:
        return np.zeros((n, buckets), dtype=np.float32)
    code = s[:-2].astype(np.uint64) << np.uint64(16) | s[1:-1].astype(np.uint64) << np.uint64(8) | s[2:]
    doc = tb.doc_of(off)
    ok = doc[2:] == doc[:-2]
    bits = buckets.bit_length() - 1
    bucket = (code[ok] * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - bits)).astype(np.int64)
    return np.bincount(doc[:-2][ok] * buckets + bucket, minlength=n * buckets).reshape(n, buckets).astype(np.float32)


def term_counts(texts: pa.Array) -> np.ndarray:
    """Damped term counts, documents x TERMS."""
    b, off = tb.byte_view(texts)
    out = np.zeros((len(texts), TERMS), dtype=np.float32)
    out[:, :CONTENT] = _trigrams(tb.LOWER[b], off, CONTENT)
    out[:, CONTENT:CONTENT + STYLE] = _trigrams(_SHAPE[b], off, STYLE)
    np.log1p(out, out=out)
    starts, ends, woff = tb.word_spans(b, off)
    words = np.diff(woff)
    if len(starts):
        again, _ = repeats(tb.hash_spans(b, starts, ends), tb.doc_of(woff), woff, 3)
        share = again / np.maximum(1, words)
        out[:, -2], out[:, -1] = share, np.where(words > 0, 1 - share, 0)
    return out


def blocks(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Row ranges of bounded text and number."""
    for lo, hi in tb.slices(texts, 2 << 20):
        for k in range(lo, hi, ROWS):
            yield k, min(hi, k + ROWS)


@dataclass
class Model:
    idf: np.ndarray          # TERMS
    axes: np.ndarray         # TERMS x AXES
    vectors: np.ndarray      # labelled documents x AXES, length 1
    labels: np.ndarray       # 0 or 1
    share: float             # of class 1 among all training rows

    def weighted(self, counts: np.ndarray) -> np.ndarray:
        x = counts * self.idf
        for lo, hi, weight in FAMILIES:
            size = np.linalg.norm(x[:, lo:hi], axis=1, keepdims=True)
            x[:, lo:hi] *= weight / np.maximum(size, 1e-12)
        return x

    def latent(self, counts: np.ndarray) -> np.ndarray:
        y = self.weighted(counts) @ self.axes
        return y / np.maximum(np.linalg.norm(y, axis=1, keepdims=True), 1e-12)

    def score(self, counts: np.ndarray) -> np.ndarray:
        """Share of class 1 in the similarity-weighted vote."""
        sims = np.maximum(self.latent(counts).astype(np.float64) @ self.vectors.T, 0)
        k = min(NEIGHBOURS, sims.shape[1])
        least = np.partition(sims, sims.shape[1] - k, axis=1)[:, sims.shape[1] - k][:, None]
        votes = np.where(sims >= least, sims ** SHARPNESS, 0)
        # The sample holds both classes in parts of its own: votes are scaled to their true shares.
        ones = votes @ (self.labels == 1) * self.share / max(1, int((self.labels == 1).sum()))
        zeros = votes @ (self.labels == 0) * (1 - self.share) / max(1, int((self.labels == 0).sum()))
        total = ones + zeros
        return np.where(total > 0, ones / np.where(total > 0, total, 1), self.share)


def fit(texts: pa.Array, labels: np.ndarray, share: float) -> Model:
    """Latent axes by a randomised decomposition (fixed seed) and the sample's vectors."""
    counts = np.concatenate([term_counts(texts.slice(lo, hi - lo)) for lo, hi in blocks(texts)])
    idf = np.log((1 + len(counts)) / (1 + (counts > 0).sum(axis=0))).astype(np.float32) + 1
    model = Model(idf, np.zeros((TERMS, 0), np.float32), np.zeros((0, 0)), labels, share)
    x = model.weighted(counts)
    q = np.random.default_rng(7).normal(size=(TERMS, min(AXES + 16, len(x)))).astype(np.float32)
    for _ in range(4):
        q, _ = np.linalg.qr(x.T @ (x @ q))
    _, _, axes = np.linalg.svd(x @ q, full_matrices=False)
    model.axes = (q @ axes[:AXES].T).astype(np.float32)
    model.vectors = model.latent(counts).astype(np.float64)
    return model


def train(docs: DataFrame, labels: DataFrame, teaches: Column, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality") -> Model | None:
    """A model of the labelled rows that ``teaches`` (a condition on the id
    column) selects."""
    marks = labels.filter(teaches & F.col(label_col).isin(0, 1)).select(
        F.col(id_col).alias("i"), F.col(label_col).cast("int").alias("y"))
    sizes = {r["y"]: r["count"] for r in marks.groupBy("y").count().collect()}
    rows = docs.filter(F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("i"), F.col(text_col).alias("t"))
    known = marks.join(rows.select("i"), "i", "left_semi")
    chosen = hash_spread(known, "i", "y", FIT_DOCS)
    # FIT_DOCS ids a class: a table of bounded size.
    table = rows.join(F.broadcast(chosen), "i").select(
        "i", "y", bounded_text(F.col("t"), FIT_CHARS).alias("t")).toArrow()
    if not table.num_rows:
        return None
    table = table.take(pc.sort_indices(table, [("i", "ascending"), ("y", "ascending"), ("t", "ascending")]))
    return fit(table["t"].combine_chunks(), table["y"].to_numpy(), sizes.get(1, 0) / sum(sizes.values()))


def classify(docs: DataFrame, model: Model | None, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (default: all) with a column
    ``quality_score``; the name gets underscores if it is taken."""
    name = free_name(docs, "quality_score")
    at = [docs.columns.index(c) for c in (docs.columns if keep is None else keep)]
    text_at = docs.columns.index(text_col)
    schema = T.StructType([*[docs.schema.fields[k] for k in at], T.StructField(name, T.DoubleType(), False)])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            model, texts = shared.value, batch.column(text_at)
            score = np.full(batch.num_rows, 0.5)
            if model is not None:
                for lo, hi in blocks(texts):
                    score[lo:hi] = model.score(term_counts(texts.slice(lo, hi - lo)))
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in at], pa.array(score)],
                                             names=[f.name for f in schema.fields])

    return docs.mapInArrow(run, schema)
