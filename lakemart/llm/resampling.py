"""Target-distribution importance resampling.

Documents are drawn so that their features follow a target text collection.
A feature is a run of words; features fall into BUCKETS buckets by hash.  A
bucket's gain is the log ratio of its smoothed share in the target and in the
documents; a document's weight is the sum of its features' gains.  Gumbel noise
on the weights makes the highest scores a weighted sample without replacement.

    1. Bucket counts: one pass over each table; a task sends one row per
       bucket, so the driver gets BUCKETS sums whatever the corpus.
    2. Weights: a second pass looks the gains up in one array.  Scores are
       written to the shared folder; nothing later reads a text.
    3. Cutoff: bisection of the score's range, then of the ids tied at the
       cutoff, by exact counts over the written scores.  A job counts the
       LEVELS next levels of the bisection at once.
    4. Ranks: the drawn rows alone are range-partitioned and sorted; a row's
       rank is its place in its partition plus the sizes of those before.

Defined results: a NULL or empty text has no features, weight 0 and is not
drawn (it has too few words); a NULL id counts as empty text in the noise and
comes last among ties; repeated rows are scored alike and drawn one by one; an
empty target or an empty table gives no error (the table's result is empty);
columns other than the id and the text are not read, whatever their names.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm import textbatch as tb
from lakemart.llm.common import staged

BUCKETS = 10_000
RUN = 1              # words of the longest feature
MIN_WORDS = 20
PERCENT = 10
SEED = 2024
LEVELS = 4           # levels of the bisection that one job counts
LONG_WORD = 64       # bytes from which a feature is hashed by itself

_WORD = np.zeros(256, dtype=bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> np.uint32(1)) ^ np.uint32(0xEDB88320), c >> np.uint32(1))
    return c


_CRC = _crc_table()


def crc32_spans(b: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Unsigned crc32 of every span of the byte array ``b``, a byte of all
    spans at a time; long spans go one by one."""
    size = ends - starts
    out = np.full(len(starts), 0xFFFFFFFF, dtype=np.uint32)
    live, k = np.flatnonzero(size <= LONG_WORD), 0
    while True:
        live = live[size[live] > k]
        if not len(live):
            break
        c = out[live]
        out[live] = _CRC[(c ^ b[starts[live] + k]) & np.uint32(255)] ^ (c >> np.uint32(8))
        k += 1
    out ^= np.uint32(0xFFFFFFFF)
    for x in np.flatnonzero(size > LONG_WORD):
        out[x] = zlib.crc32(b[starts[x]:ends[x]])
    return out


def features(texts: pa.Array, run: int = RUN, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of every feature (all runs of 1 to ``run`` words, joined by one
    blank), the text that holds it, and the number of words of each text."""
    b, off = tb.byte_view(texts)
    b = tb.LOWER[b]
    ink = np.zeros(len(b) + 2, dtype=bool)
    ink[1:-1] = _WORD[b]
    first = np.zeros(len(b) + 1, dtype=bool)
    first[off] = True
    starts = np.flatnonzero(ink[1:-1] & (~ink[:-2] | first[:-1]))
    ends = np.flatnonzero(ink[1:-1] & (~ink[2:] | first[1:])) + 1
    at = np.searchsorted(starts, off)
    owner, words = tb.doc_of(at), np.diff(at)
    if run == 1:
        return (crc32_spans(b, starts, ends) % np.uint32(buckets)).astype(np.int64), owner, words
    # The words with one blank after each: a run is one stretch of these bytes.
    size = ends - starts
    to = np.cumsum(size + 1) - size - 1
    flat = np.full(int(size.sum()) + len(size), 0x20, dtype=np.uint8)
    flat[tb.expand(to, size)] = b[tb.expand(starts, size)]
    found, holder = [], []
    for n in range(1, run + 1):
        k = np.arange(max(0, len(starts) - n + 1))
        k = k[owner[k] == owner[k + n - 1]]
        found.append(crc32_spans(flat, to[k], to[k + n - 1] + size[k + n - 1]) % np.uint32(buckets))
        holder.append(owner[k])
    return np.concatenate(found).astype(np.int64), np.concatenate(holder), words


def bucket_counts(table: DataFrame, text_col: str = "text", run: int = RUN, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for lo, hi in tb.slices(batch.column(0)):
                seen += np.bincount(features(batch.column(0).slice(lo, hi - lo), run, buckets)[0], minlength=buckets)
        some = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(seen[some])], names=["bucket", "n"])

    sums = table.select(text_col).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, dtype=np.int64)
    out[sums["bucket"].to_numpy()] = sums["n"].to_numpy()
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Gain of each bucket, in thousandths."""
    k = len(corpus)
    all_s, all_t = float(int(corpus.sum()) + k), float(int(target.sum()) + k)
    return np.array([math.floor(1000 * math.log((float(t) + 1) * all_s / ((float(s) + 1) * all_t)))
                     for s, t in zip(corpus.tolist(), target.tolist())], dtype=np.int64)


def noise(id_col: Column, seed: int) -> Column:
    """Gumbel noise of an id, in thousandths."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))


def scores(docs: DataFrame, gains: np.ndarray, id_col: str = "doc_id", text_col: str = "text", run: int = RUN,
           seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score), one row per document."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in tb.slices(batch.column(1)):
                bucket, owner, words = features(batch.column(1).slice(lo, hi - lo), run, len(gains))
                # Sums of integers below 2**53: exact as doubles.
                weight = np.bincount(owner, weights=gains[bucket], minlength=hi - lo).astype(np.int64)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(lo, hi - lo), pa.array(words), pa.array(np.bincount(owner, minlength=hi - lo)),
                    pa.array(weight)], names=["doc_id", "n_words", "n_features", "weight"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long").withColumn(
        "score", F.col("weight") + noise(F.col("doc_id"), seed))


def bisect(lo: int, hi: int, holds: Callable[[list[int]], list[bool]], levels: int = LEVELS) -> int:
    """The largest value of lo .. hi for which ``holds``, which is true up to
    some value and false beyond; ``lo`` holds.  ``holds`` judges the values of
    several levels of the bisection in one call."""
    while lo < hi:
        parts = min(1 << levels, hi - lo + 1)
        probes = sorted({lo + (hi - lo + 1) * k // parts for k in range(1, parts)})
        for value, good in zip(probes, holds(probes)):
            if good:
                lo = value
            else:
                hi = value - 1
                break
    return lo


def _counts(table: DataFrame, conditions: list[Column]) -> list[int]:
    return list(table.agg(*[F.count(F.when(c, 1)).alias(f"c{k}") for k, c in enumerate(conditions)]).first())


def cutoff(able: DataFrame, wanted: int) -> tuple[int, int | None]:
    """Score and id of the last of the ``wanted`` best rows of ``able``
    (doc_id, score) by falling score, then rising id (None: a NULL id)."""
    least, most = able.agg(F.min("score"), F.max("score")).first()
    score = bisect(least, most, lambda probes: [n >= wanted for n in _counts(able, [F.col("score") >= x for x in probes])])
    tied = able.filter(F.col("score") == score)
    above, lowest, highest, named = able.agg(
        F.count(F.when(F.col("score") > score, 1)), F.min(F.when(F.col("score") == score, F.col("doc_id"))),
        F.max(F.when(F.col("score") == score, F.col("doc_id"))),
        F.count(F.when(F.col("score") == score, F.col("doc_id")))).first()
    if named < wanted - above:
        return score, None
    # The largest bound below which too few ids lie; the next id completes them.
    short = bisect(lowest - 1, highest, lambda probes: [
        n < wanted - above for n in _counts(tied, [F.col("doc_id") <= x for x in probes])])
    return score, short + 1


def ranked(rows: DataFrame) -> DataFrame:
    """``rows`` with ``rank`` 1, 2, 3, ... by falling score, then rising id."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features").desc()]
    # Partition number in the upper bits, place in the partition in the lower 33.
    placed = staged(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(
        "_place", F.monotonically_increasing_id()), "resampling-places")
    part = F.shiftrightunsigned("_place", 33)
    before, ahead = {}, 0
    for p, n in sorted(placed.groupBy(part.alias("p")).count().collect()):   # a row per partition
        before[p] = ahead
        ahead += n
    if not before:
        return rows.withColumn("rank", F.lit(None).cast("long"))
    spark = rows.sparkSession
    sums = F.broadcast(spark.createDataFrame(sorted(before.items()), "p long, ahead long"))
    return placed.withColumn("p", part.cast("long")).join(sums, "p").select(
        *rows.columns, (F.col("ahead") + F.col("_place").bitwiseAND((1 << 33) - 1) + 1).alias("rank"))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text",
             run: int = RUN, buckets: int = BUCKETS, min_words: int = MIN_WORDS, percent: int = PERCENT,
             seed: int = SEED) -> DataFrame:
    """(doc_id, n_features, weight, score, rank): every document, those drawn
    (``percent`` of the documents with ``min_words`` words) with their rank."""
    gains = bucket_gains(bucket_counts(docs, text_col, run, buckets), bucket_counts(target, target_text, run, buckets))
    table = staged(scores(docs, gains, id_col, text_col, run, seed), "resampling-scores")
    able = F.col("n_words") >= min_words
    wanted = table.filter(able).count() * percent // 100
    columns = ["doc_id", "n_features", "weight", "score"]
    none = F.lit(None).cast("long").alias("rank")
    if not wanted:
        return table.select(*columns, none)
    score, last = cutoff(table.filter(able).select("doc_id", "score"), wanted)
    tied = F.lit(True) if last is None else F.coalesce(F.col("doc_id") <= last, F.lit(False))
    drawn = able & ((F.col("score") > score) | ((F.col("score") == score) & tied))
    # Rows equal in score and id may reach beyond the last rank.
    best = ranked(table.filter(drawn).select(*columns)).withColumn("rank", F.when(F.col("rank") <= wanted, F.col("rank")))
    return table.filter(~drawn).select(*columns, none).unionByName(best)


def oracle_sql(buckets: int = BUCKETS, min_words: int = MIN_WORDS, percent: int = PERCENT, seed: int = SEED) -> str:
    """The same in DuckDB's SQL for features of one word: crc32 of each
    distinct word is folded over its bytes."""
    word, upper = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return rf"""
WITH src AS (SELECT row_number() OVER () AS k, doc_id,
  regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '{word}') AS w FROM documents),
goal AS (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '{word}')) AS word FROM benchmark),
words AS (SELECT k, unnest(w) AS word FROM src),
tab AS MATERIALIZED (SELECT list(c ORDER BY n) AS t FROM (SELECT n, list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
  lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(n))),
hashed AS MATERIALIZED (SELECT word, xor(list_reduce([4294967295] || list_transform(range(0, strlen(word)),
    lambda i: (instr('0123456789ABCDEF', substr(hex(word), 2 * i + 1, 1)) - 1) * 16
      + instr('0123456789ABCDEF', substr(hex(word), 2 * i + 2, 1)) - 1),
    lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % {buckets} AS bucket
  FROM (SELECT word FROM words UNION SELECT word FROM goal), tab),
s AS (SELECT bucket, count(*) AS s FROM words JOIN hashed USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM goal JOIN hashed USING (word) GROUP BY bucket),
total AS (SELECT (SELECT count(*) FROM words) AS s_all, (SELECT count(*) FROM goal) AS t_all),
gain AS (SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (s_all + {buckets})
  / ((coalesce(s, 0) + 1)::DOUBLE * (t_all + {buckets}))))::BIGINT AS gain FROM s FULL JOIN t USING (bucket), total),
weight AS (SELECT k, sum(gain)::BIGINT AS weight FROM words JOIN hashed USING (word) JOIN gain USING (bucket) GROUP BY k),
scored AS (SELECT k, doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
  (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{seed}:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE))))::BIGINT AS score
  FROM src LEFT JOIN weight USING (k)),
able AS (SELECT k, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n FROM scored WHERE n_features >= {min_words})
SELECT doc_id, n_features, weight, score, CASE WHEN r <= n * {percent} // 100 THEN r END::BIGINT AS rank
FROM scored LEFT JOIN able USING (k)"""
