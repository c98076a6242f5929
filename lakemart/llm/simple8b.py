"""Token-ID output in Simple-8b words.

A 64-bit word holds a 4-bit selector and 60 bits of payload: the selector says
how many ids of how many bits follow.  Each word takes as many of the next ids
as fit; an id of 60 bits or more is an escape word followed by the id itself.
Ids are coded in blocks of 1,024; a segment keeps the word offset of every
block, so all blocks of a segment are coded and decoded at once in numpy.

A segment (one row of the written table) holds whole documents in ascending
order and at most about a million ids (a longer document is a segment by
itself): its document ids and lengths, its block offsets and its words.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.llm import textbatch as tb
from lakemart.llm.bpe import SLICE_BYTES, of_worker
from lakemart.llm.common import staged
from lakemart.session import scratch_path

BLOCK = 1024
SEGMENT_IDS = 1 << 20

# Ids per word and bits per id, by selector; selector 0 is the escape.
COUNT = np.array([1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], dtype=np.int64)
BITS = np.array([64, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60], dtype=np.int64)

_SMALL_WIDTH = np.ceil(np.log2(np.arange(1 << 16) + 1)).astype(np.int8)

SEGMENT_TYPE = T.StructType([
    T.StructField("part", T.IntegerType(), False),       # writing task: parts ascend with the ids
    T.StructField("start_in_part", T.LongType(), False),  # ids of the part before this segment
    T.StructField("n_ids", T.LongType(), False),
    T.StructField("doc_ids", T.ArrayType(T.LongType()), False),
    T.StructField("doc_sizes", T.BinaryType(), False),    # uint32 per document
    T.StructField("block_words", T.BinaryType(), False),  # uint32: first word of each block, and the end
    T.StructField("words", T.BinaryType(), False),        # uint64 words, little-endian
])


def _widths(values: np.ndarray) -> np.ndarray:
    """Bits of each value (0 for 0)."""
    if len(values) and values.max() < 1 << 16:
        return _SMALL_WIDTH[values]
    out = np.zeros(values.shape, dtype=np.int8)
    rest = values.copy()
    for step in (32, 16, 8, 4, 2, 1):
        big = rest >= (np.uint64(1) << np.uint64(step))
        out[big] += step
        rest = np.where(big, rest >> np.uint64(step), rest)
    return out + (rest > 0)


def _pair(widest: np.ndarray, gap: int) -> np.ndarray:
    """Maximum of each window and the one that starts ``gap`` later."""
    out = widest.copy()
    np.maximum(widest[:, :-gap], widest[:, gap:], out=out[:, :-gap])
    return out


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words (uint64) and block offsets (uint32, one more than blocks)."""
    n = len(values)
    n_blocks = -(-n // BLOCK)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(1, np.uint32)
    grid = np.zeros(n_blocks * BLOCK, dtype=np.uint64)
    grid[:n] = values
    left = np.full(n_blocks, BLOCK, dtype=np.int64)
    left[-1] = n - (n_blocks - 1) * BLOCK
    width = np.full((n_blocks, BLOCK + 60), 127, dtype=np.int8)    # no word reaches past its block
    width[:, :BLOCK] = _widths(grid).reshape(n_blocks, BLOCK)
    width[-1, left[-1]:] = 127
    # Largest width among the next n values, for every n a selector counts;
    # a window is the maximum of two shorter ones that cover it.
    widest = {1: width}
    for n_ids in sorted(set(COUNT[1:].tolist()) - {1}):
        half = max(k for k in widest if k * 2 >= n_ids or k == max(widest))
        while half * 2 < n_ids:
            widest[half * 2] = _pair(widest[half], half)
            half *= 2
        widest[n_ids] = _pair(widest[half], n_ids - half)
    choice = np.zeros((n_blocks, BLOCK), dtype=np.int8)            # escape unless something fits
    for selector in range(len(COUNT) - 1, 0, -1):                  # few ids a word first, more overwrite
        np.copyto(choice, np.int8(selector), where=widest[int(COUNT[selector])][:, :BLOCK] <= BITS[selector])
    # All blocks advance together, one word each.
    flat_choice, begins = choice.reshape(-1), np.zeros(n_blocks * BLOCK, dtype=bool)
    pos, limit = np.arange(n_blocks) * BLOCK, np.arange(n_blocks) * BLOCK + left
    while len(pos):
        begins[pos] = True
        pos = pos + COUNT[flat_choice[pos]]
        more = pos < limit
        pos, limit = pos[more], limit[more]
    base = np.flatnonzero(begins)
    block = base // BLOCK
    sel = flat_choice[base].astype(np.int64)
    words = sel.astype(np.uint64) << np.uint64(60)
    for selector in np.unique(sel):
        if selector == 0:
            continue
        mine = np.flatnonzero(sel == selector)
        packed = words[mine]
        for k in range(COUNT[selector]):
            packed |= grid[base[mine] + k] << np.uint64(k * BITS[selector])
        words[mine] = packed
    size = 1 + (sel == 0)
    place = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), dtype=np.uint64)
    out[place] = words
    escaped = sel == 0
    out[place[escaped] + 1] = grid[base[escaped]]
    per_block = np.bincount(block, weights=size, minlength=n_blocks).astype(np.int64)
    return out, np.append(0, np.cumsum(per_block)).astype(np.uint32)


def decode(words: np.ndarray, block_words: np.ndarray, blocks: slice = slice(None)) -> np.ndarray:
    """The values of the chosen blocks (default: all), as uint64."""
    bounds = block_words.astype(np.int64)
    chosen = np.arange(len(bounds) - 1)[blocks]
    if not len(chosen):
        return np.zeros(0, np.uint64)
    w = words[bounds[chosen[0]]:bounds[chosen[-1] + 1]]
    sel = (w >> np.uint64(60)).astype(np.int64)
    raw = np.zeros(len(w), dtype=bool)
    if (sel == 0).any():
        # After an escape comes a verbatim word, whatever its top bits say.
        k, zeros = 0, np.flatnonzero(sel == 0)
        while k < len(zeros):
            raw[zeros[k] + 1] = True
            k = int(np.searchsorted(zeros, zeros[k] + 2))
    code, sel = w[~raw], sel[~raw]
    count, bits = COUNT[sel], BITS[sel]
    first = np.cumsum(count) - count
    nth = (np.arange(int(count.sum())) - np.repeat(first, count)).astype(np.uint64)
    bit = np.repeat(bits.astype(np.uint64), count)
    mask = np.where(bits < 64, (np.uint64(1) << np.minimum(bits, 60).astype(np.uint64)) - np.uint64(1), np.uint64(0))
    out = (np.repeat(code, count) >> (nth * np.where(bit == 64, 0, bit).astype(np.uint64))) & np.repeat(mask, count)
    if raw.any():
        out[first[sel == 0]] = w[raw]
    return out


def _segments(ends: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of documents of about SEGMENT_IDS ids (one document at least)."""
    first = 0
    while first < len(ends):
        done = ends[first - 1] if first else 0
        stop = max(first + 1, int(np.searchsorted(ends, done + SEGMENT_IDS, side="right")))
        yield first, stop
        first = stop


def write_ids(docs: DataFrame, spec: str, path: str, id_col: str = "doc_id", text_col: str = "text",
              end_id: int = 0) -> None:
    """Encode every text (NULL: empty), append ``end_id``, and write segments
    in ascending order of the ids to ``path``.

    Rows are range-partitioned and sorted by the id, ties by a hash of the
    text, so equal ids cannot gather in one task.  NULL ids come first.  A
    table without rows gives a table without segments.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    rows = rows.withColumn("_tie", F.xxhash64("_text"))
    rows = rows.repartitionByRange(F.col("_id"), F.col("_tie")).sortWithinPartitions("_id", "_tie")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, part, before = of_worker(spec), TaskContext.get().partitionId(), 0
        for batch in batches:
            texts, doc_ids = batch.column(1), batch.column(0)
            for lo, hi in tb.slices(texts, SLICE_BYTES):
                ids, off = bpe.encode(texts.slice(lo, hi - lo))
                sizes = np.diff(off)
                out = np.full(len(ids) + len(sizes), end_id, dtype=np.uint64)
                out[np.arange(len(ids)) + np.repeat(np.arange(len(sizes)), sizes)] = ids
                sizes = sizes + 1
                ends = np.cumsum(sizes)
                for first, stop in _segments(ends):
                    values = out[ends[first] - sizes[first]:ends[stop - 1]]
                    words, blocks = encode(values)
                    yield pa.RecordBatch.from_arrays([
                        pa.array([part], pa.int32()), pa.array([before], pa.int64()),
                        pa.array([len(values)], pa.int64()),
                        pa.array([doc_ids.slice(lo + first, stop - first).to_pylist()], pa.list_(pa.int64())),
                        pa.array([sizes[first:stop].astype("<u4").tobytes()], pa.binary()),
                        pa.array([blocks.astype("<u4").tobytes()], pa.binary()),
                        pa.array([words.astype("<u8").tobytes()], pa.binary())], names=SEGMENT_TYPE.names)
                    before += len(values)

    rows.mapInArrow(run, SEGMENT_TYPE).write.parquet(path)


DOC_TYPE = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()),
                         T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType()),
                         T.StructField("ids", T.BinaryType())])


def read_ids(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """One row per written document: its id, the number of ids before it, its
    number of ids, their crc32 (as little-endian uint32) and, if asked, the ids."""
    segments = spark.read.schema(SEGMENT_TYPE).parquet(path)
    parts = segments.groupBy("part").agg(F.sum("n_ids").alias("n"))
    # One row per writing task; written, so that its size is known and the
    # segments need not move to meet it.
    base = staged(parts.selectExpr("part", "sum(n) OVER (ORDER BY part ROWS UNBOUNDED PRECEDING) - n AS base"), "token-id-parts")
    rows = segments.join(base, "part").select("base", "start_in_part", "doc_ids", "doc_sizes", "block_words", "words")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                values = decode(np.frombuffer(r["words"], "<u8"), np.frombuffer(r["block_words"], "<u4"))
                raw = memoryview(values.astype("<u4").tobytes())
                sizes = np.frombuffer(r["doc_sizes"], "<u4").astype(np.int64)
                ends = np.cumsum(sizes)
                cuts = [raw[4 * (e - s):4 * e] for s, e in zip(sizes, ends)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(r["doc_ids"], pa.int64()), pa.array(r["base"] + r["start_in_part"] + ends - sizes),
                    pa.array(sizes), pa.array([zlib.crc32(c) for c in cuts], pa.int64()),
                    pa.array([bytes(c) if with_ids else None for c in cuts], pa.binary())], names=DOC_TYPE.names)

    out = rows.mapInArrow(run, DOC_TYPE)
    return out if with_ids else out.drop("ids")


def round_trip(docs: DataFrame, spec: str, **options) -> DataFrame:
    """Write the ids of all texts to the shared folder and read them back."""
    spark = docs.sparkSession
    path = scratch_path(spark, "token-ids")
    write_ids(docs, spec, path, **options)
    return read_ids(spark, path)
