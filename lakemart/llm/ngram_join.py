"""Near-duplicate join of documents by the Jaccard similarity of word n-grams.

A document is the set of its distinct WIDTH-word shingles (64-bit hashes); two
documents link when their sets' Jaccard similarity is THRESHOLD or more; linked
documents form components.

Method: T-occurrence search.  A document that links to a query shares at least
T of its shingles, so it occurs at least T times in the query's inverted
lists.  DivideSkip splits these lists: the short ones are merged, which leaves
few documents that occur often enough, and the L longest are only probed by
binary search for those.

At scale the lists live in Spark:
    1. Texts with equal sets are one *entity*, known by a hash of the set.
    2. Every entity's shingles are put in one global order, rarest first.  The
       rarity is the count of the shingle's hash bucket (2**18 buckets, a table
       of fixed size); any order is right, this one keeps frequent shingles out
       of the lists.  Two similar sets share a shingle among the first
       n - ceil(0.8 n) + 1 of each, so only those are listed.
    3. Lists of one entity are dropped.  Lists move once, for a window over
       each that tells whether it holds a second entity.  A shingle of a
       frequent bucket is dealt over several parts by its entities (and kept
       whatever its list holds), so no window grows with a hot list; later
       steps aggregate and join lists and gather none.
    4. Blocks of at most some BLOCK entities and BLOCK_SHINGLES shingles (one
       entity at least) are searched (numpy, DivideSkip).
       First each entity meets the most typical member of its lists (few
       shingles of its own: an original rather than its edited copies), if the
       lists they share leave a link possible.  Then lists whose entities still
       lie in different components say which blocks must meet: those whose
       shared lists leave a link possible.  A pair of blocks meets once.
       Blocks return a spanning forest of the links found, never all pairs.
    5. Links become components by star contraction.

Every pair of entities that shares a listed shingle is compared, already
connected or provably too different, so no link between different texts is
lost and the components are exact.  Only texts of entities in a block move: a
bitmap of fixed size (exact where it says no) drops the others before the
shuffle.

Defined results: a NULL or empty text, or one without words, has no shingle
and is its own component; fewer than WIDTH words are one shingle; repeated
rows and equal texts share a component; NULL ids join components and count
only where no other id is there; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.llm import textbatch as tb
from lakemart.llm.common import drop_staged, staged
from lakemart.llm.components import components

WIDTH = 5
BUCKET_BITS = 18
BITMAP_BITS = 26
BLOCK = 128
BLOCK_SHINGLES = 100_000   # shingles of a block: its work space, where texts are long
BAND = 1.05          # sizes of a block's entities differ by this factor at most
HOT_PARTS = 4096     # a bucket with more than this part of all shingles is dealt over several parts
HOT_LEAST = 50_000   # shingles that one part always takes
BANDS_APART = 5      # bands that similar sets may lie apart: 1.05 ** 5 > 1 / 0.8

_TOP = np.uint64(64 - BUCKET_BITS)


def shingle_sets(texts: pa.Array, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text, ascending, and the n+1 offsets."""
    b, off = tb.byte_view(texts)
    b = tb.LOWER[b]
    starts, ends, woff = tb.word_spans(b, off)
    h = tb.hash_spans(b, starts, ends)
    docs, sizes = tb.doc_of(woff), np.diff(woff)
    win = tb.window_hashes(h, width)
    at = np.flatnonzero(docs[width - 1:] == docs[:len(win)]) if len(win) else np.zeros(0, np.int64)
    keys, owner = win[at], docs[at]
    few = np.flatnonzero((sizes > 0) & (sizes < width))
    if len(few):
        # The whole sequence is the one shingle; its length keeps it apart.
        whole = np.array([_fold(h[woff[d]:woff[d + 1]]) for d in few], dtype=np.uint64)
        keys, owner = np.concatenate([keys, whole]), np.concatenate([owner, few])
    by = np.lexsort((keys, owner))
    keys, owner = keys[by], owner[by]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
    keys, owner = keys[new], owner[new]
    return keys, np.searchsorted(owner, np.arange(len(sizes) + 1))


def _fold(h: np.ndarray) -> np.uint64:
    out = np.array([len(h)], dtype=np.uint64)
    for x in h:
        out = tb.mix(out * np.uint64(0x9E3779B97F4A7C15) + x)
    return out[0]


def entity_keys(keys: np.ndarray, off: np.ndarray) -> np.ndarray:
    """A hash of each set: sums of mixed shingles, which do not depend on order."""
    mixed = tb.mix(keys ^ np.uint64(0x5851F42D4C957F2D))
    total = np.zeros(len(keys) + 1, dtype=np.uint64)
    np.cumsum(mixed, out=total[1:])
    return tb.mix(total[off[1:]] - total[off[:-1]] + tb.mix(np.diff(off).astype(np.uint64))).view(np.int64)


def prefix_size(n):
    """How many of ``n`` ordered shingles hold one of any similar set."""
    return n - (4 * n + 4) // 5 + 1


_SCAN_TYPE = T.StructType([
    T.StructField("bucket", T.IntegerType()), T.StructField("n", T.LongType()),
    T.StructField("doc_id", T.LongType()), T.StructField("entity", T.LongType())])


def scan_sets(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Two kinds of rows from one scan: (bucket, n) counts of shingle buckets,
    and (doc_id, entity, n) for each document (entity NULL: no shingle)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << BUCKET_BITS, dtype=np.int64)
        for batch in batches:
            for lo, hi in tb.slices(batch.column(1)):
                keys, off = shingle_sets(batch.column(1).slice(lo, hi - lo))
                seen += np.bincount((keys >> _TOP).astype(np.int64), minlength=len(seen))
                n = np.diff(off)
                yield pa.RecordBatch.from_arrays([
                    pa.nulls(hi - lo, pa.int32()), pa.array(n), batch.column(0).slice(lo, hi - lo),
                    pa.array(entity_keys(keys, off), mask=n == 0)], names=_SCAN_TYPE.names)
        some = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([
            pa.array(some.astype(np.int32)), pa.array(seen[some]), pa.nulls(len(some), pa.int64()),
            pa.nulls(len(some), pa.int64())], names=_SCAN_TYPE.names)

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, _SCAN_TYPE)


def bucket_ranks(buckets: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Rarity rank of every bucket and the parts its lists are dealt over
    (2**BUCKET_BITS values each, whatever the corpus)."""
    table = buckets.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    count = np.zeros(1 << BUCKET_BITS, dtype=np.int64)
    count[table["bucket"].to_numpy()] = table["n"].to_numpy()
    rank = np.empty(len(count), dtype=np.int32)
    rank[np.argsort(count, kind="stable")] = np.arange(len(count))
    return rank, (count // max(count.sum() // HOT_PARTS, HOT_LEAST)).astype(np.int32)


def listed(docs: DataFrame, text_col: str, ranks) -> DataFrame:
    """(shingle, part, entity) of the first shingles of every text, once per
    entity and batch; part 0 holds whole lists, the others parts of long ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank, parts = ranks.value
        for batch in batches:
            done = np.zeros(0, np.int64)
            for lo, hi in tb.slices(batch.column(0)):
                keys, off = shingle_sets(batch.column(0).slice(lo, hi - lo))
                entity, sizes = entity_keys(keys, off), np.diff(off)
                _, first = np.unique(entity, return_index=True)
                new = np.zeros(len(entity), dtype=bool)
                new[first] = True
                new &= (sizes > 0) & ~np.isin(entity, done)
                done = np.concatenate([done, entity[new]])
                owner = np.repeat(np.arange(len(sizes)), sizes)
                mine = new[owner]
                owner, keys = owner[mine], keys[mine]
                by = np.lexsort((keys, rank[(keys >> _TOP).astype(np.int64)], owner))
                owner, keys = owner[by], keys[by]
                nth = np.arange(len(keys)) - np.searchsorted(owner, owner)
                take = nth < prefix_size(sizes[owner])
                keys, entries = keys[take], entity[owner[take]]
                of = parts[(keys >> _TOP).astype(np.int64)]
                part = np.where(of > 0, 1 + entries.view(np.uint64) % np.maximum(of, 1).astype(np.uint64), 0)
                yield pa.RecordBatch.from_arrays([
                    pa.array(keys.view(np.int64)), pa.array(part.astype(np.int32)), pa.array(entries)],
                    names=["shingle", "part", "entity"])

    return docs.select(text_col).mapInArrow(run, "shingle long, part int, entity long")


def entity_texts(docs: DataFrame, text_col: str, wanted: DataFrame) -> DataFrame:
    """(entity, text), one row for each entity of ``wanted`` (and a few others)."""
    bit = F.expr(f"pmod(entity, {1 << BITMAP_BITS})")
    words = wanted.groupBy(F.shiftright(bit, 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(pmod(entity, 64) as int))")).alias("bits")).toArrow()
    bitmap = np.zeros(1 << (BITMAP_BITS - 6), dtype=np.uint64)
    bitmap[words["word"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            for lo, hi in tb.slices(batch.column(0)):
                part = batch.column(0).slice(lo, hi - lo)
                keys, off = shingle_sets(part)
                entity = entity_keys(keys, off)
                at = entity.view(np.uint64) & np.uint64((1 << BITMAP_BITS) - 1)
                take = (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1)
                _, first = np.unique(entity, return_index=True)
                once = np.zeros(len(entity), dtype=bool)
                once[first] = True
                rows = pa.array(np.flatnonzero(take.astype(bool) & once & (np.diff(off) > 0)))
                yield pa.RecordBatch.from_arrays([pa.array(entity).take(rows), part.take(rows)], names=["entity", "text"])

    found = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "entity long, text string")
    return found.groupBy("entity").agg(F.first("text").alias("text"))


class Forest:
    """Union-find over a block's entities."""

    def __init__(self, labels: np.ndarray):
        first: dict[int, int] = {}
        self.parent = [first.setdefault(x, k) for k, x in enumerate(labels.tolist())]

    def root(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        self.parent[max(x, y)] = min(x, y)
        return x != y


def divide_skip(sets: list[np.ndarray], forest: Forest, mu: float = 1.0) -> list[tuple[int, int]]:
    """Links among sets (ascending arrays) that join two trees of ``forest``.

    Sets are searched in order, each against those before it.  ``mu`` weighs
    the probing of a long list against merging it, as DivideSkip does.
    """
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    by = np.lexsort((owner, flat))
    term, owner = flat[by], owner[by]
    new = np.ones(len(term), dtype=bool)
    new[1:] = term[1:] != term[:-1]
    first = np.flatnonzero(new)
    stop = np.append(first[1:], len(term))
    shared = stop - first > 1                      # a list of one holds only the query itself
    terms, first, stop = term[first[shared]], first[shared], stop[shared]
    out: list[tuple[int, int]] = []
    for q, query in enumerate(sets):
        if q == 0 or not len(terms):
            continue
        at = np.minimum(np.searchsorted(terms, query), len(terms) - 1)
        lists = at[terms[at] == query]
        need = -(-4 * sizes[q] // 5)               # least overlap with any similar set
        if len(lists) < need:
            continue
        length = stop[lists] - first[lists]
        skip = min(need - 1, int(need / (mu * np.log2(length.max()) + 1)))
        order = np.argsort(length, kind="stable")
        short, long = lists[order[:len(lists) - skip]], lists[order[len(lists) - skip:]]
        hits = owner[tb.expand(first[short], stop[short] - first[short])]
        count = np.bincount(hits[hits < q], minlength=q)
        total = sizes[:q] + sizes[q]
        overlap_min = -(-4 * total // 9)           # overlap >= 4/9 of both sizes together
        for y in np.flatnonzero(count + skip >= overlap_min):
            if forest.root(int(y)) == forest.root(q):
                continue
            have, left = int(count[y]), skip
            for k in long:
                if have >= overlap_min[y] or have + left < overlap_min[y]:
                    break
                entries = owner[first[k]:stop[k]]
                p = np.searchsorted(entries, y)
                have += int(p < len(entries) and entries[p] == y)
                left -= 1
            if have >= overlap_min[y] and forest.join(int(y), q):
                out.append((int(y), q))
    return out


def search_blocks(rows: DataFrame) -> DataFrame:
    """Links inside each ``block`` of rows (block, entity, component, text)."""

    def run(table: pa.Table) -> pa.Table:
        entity = table["entity"].to_numpy()
        _, once = np.unique(entity, return_index=True)
        table = table.take(pa.array(once))
        entity = entity[once]
        keys, off = shingle_sets(table["text"].combine_chunks() if table.num_rows else pa.array([], pa.string()))
        sets = [keys[s:e] for s, e in zip(off[:-1], off[1:])]
        links = divide_skip(sets, Forest(table["component"].to_numpy())) if len(sets) > 1 else []
        return pa.table({"a": pa.array([entity[x] for x, _ in links], pa.int64()),
                         "b": pa.array([entity[y] for _, y in links], pa.int64())})

    return rows.select("block", "entity", "component", "text").groupBy("block").applyInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per document."""
    spark = docs.sparkSession
    scanned = staged(scan_sets(docs, id_col, text_col), "ngram-sets")
    ids = scanned.filter(F.col("bucket").isNull()).select("doc_id", "entity", F.col("n").alias("n_shingles"))
    ranks = spark.sparkContext.broadcast(bucket_ranks(scanned.filter(F.col("bucket").isNotNull())))

    def search(rows: DataFrame) -> DataFrame:
        """Links inside the blocks of rows (block, entity, component)."""
        rows = staged(rows, "ngram-rows")
        texts = staged(entity_texts(docs, text_col, rows), "ngram-texts")
        found = staged(search_blocks(rows.join(texts, "entity")), "ngram-links")
        drop_staged(rows, texts)
        return found

    # Parts of a group that a block can hold.
    enough_parts = F.ceil(F.greatest(F.count("entity") / BLOCK, F.sum("n") / BLOCK_SHINGLES)).alias("parts")

    # Lists of two entities or more.
    listing = Window.partitionBy("shingle", "part")
    shared = (listed(docs, text_col, ranks).repartition("shingle", "part")
              .withColumn("lo", F.min("entity").over(listing)).withColumn("hi", F.max("entity").over(listing))
              .filter("lo <> hi or part > 0").dropDuplicates(["shingle", "part", "entity"]).select("shingle", "entity"))
    shared = staged(shared, "ngram-lists")
    unlisted = F.floor((4 * F.col("n") + 4) / 5) - 1      # n - prefix_size(n)

    # The most typical entity of each list, and of all lists of an entity.
    # Sizes come from the documents' rows: lists are too many to carry them.
    entities = shared.groupBy("entity").agg(F.count("shingle").alias("shared")).join(
        ids.filter(F.col("entity").isNotNull()).groupBy("entity").agg(F.max("n_shingles").alias("n")), "entity")
    entities = staged(entities.select("entity", "n", unlisted.alias("unlisted"),
                                      (F.col("n") - unlisted - F.col("shared")).alias("own")), "ngram-entities")
    centre = staged(shared.join(entities.select("entity", "own"), "entity").groupBy("shingle").agg(
        F.min(F.struct("own", "entity")).alias("centre")), "ngram-centres")
    hubs = staged(shared.join(centre, "shingle").groupBy("entity").agg(F.min("centre").alias("centre"))
                  .select("entity", F.col("centre.entity").alias("hub")), "ngram-hubs")

    def possible(pairs: DataFrame, x: str, y: str) -> DataFrame:
        """Pairs with the occurrence bound of T-occurrence search: the listed
        shingles they share and all that one leaves unlisted suffice."""
        a = entities.select(F.col("entity").alias(x), F.col("n").alias("_na"), F.col("unlisted").alias("_ua"))
        b = entities.select(F.col("entity").alias(y), F.col("n").alias("_nb"), F.col("unlisted").alias("_ub"))
        return pairs.join(a, x).join(b, y).filter(
            ((F.col("lists") + F.greatest("_ua", "_ub")) * 9 >= (F.col("_na") + F.col("_nb")) * 4)
            & (F.col("_na") * 5 >= F.col("_nb") * 4) & (F.col("_nb") * 5 >= F.col("_na") * 4)).select(x, y, F.col("_na").alias("n"))

    # Round 1: entities that may link to their hub, with it, in parts of about BLOCK.
    at_hub = shared.select("shingle", F.col("entity").alias("hub"))
    stars = (shared.select("shingle", "entity").join(hubs.filter("entity <> hub"), "entity").join(at_hub, ["shingle", "hub"])
             .groupBy("entity", "hub").agg(F.count("shingle").alias("lists")))
    stars = staged(possible(stars, "entity", "hub"), "ngram-stars")
    parts = staged(stars.groupBy("hub").agg(enough_parts), "ngram-parts")
    placed = stars.join(parts, "hub").select(
        F.struct("hub", F.expr("pmod(xxhash64(entity), parts)").alias("part")).alias("block"), "entity", "hub")
    first = search(placed.select("block", "entity").unionByName(
        placed.select("block", F.col("hub").alias("entity")).distinct()).withColumn("component", F.col("entity")))
    drop_staged(stars, parts, centre)
    found = staged(components(first, "a", "b"), "ngram-components")

    # Round 2: blocks of one hub and size band that lists with several
    # components bring together.
    band = F.floor(F.log("n") / float(np.log(BAND))).cast("int")
    members = staged(hubs.join(entities, "entity").select("entity", "hub", "n", "unlisted", band.alias("band")), "ngram-members")
    parts = staged(members.groupBy("hub", "band").agg(enough_parts), "ngram-parts")
    state = staged(members.join(parts, ["hub", "band"]).join(found.withColumnRenamed("node", "entity"), "entity", "left").select(
        "entity", "n", "unlisted", F.coalesce("component", "entity").alias("component"),
        F.struct("band", "hub", F.expr("pmod(xxhash64(entity), parts)").alias("part")).alias("block")), "ngram-state")
    drop_staged(members, parts, hubs, entities, found)
    at = staged(shared.select("shingle", "entity").join(state.select("entity", "component", "block"), "entity"), "ngram-at")
    mixed = staged(at.groupBy("shingle").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
                   .filter("lo <> hi").select("shingle"), "ngram-mixed")
    blocks = staged(at.join(mixed, "shingle").groupBy("shingle", "block").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi")), "ngram-blocks")
    drop_staged(shared, at, mixed)
    sizes = staged(state.groupBy("block").agg(F.min("n").alias("least"), F.max("n").alias("most"),
                                              F.max("unlisted").alias("unlisted")), "ngram-sizes")
    x, y = blocks.alias("x"), blocks.alias("y")
    differs = ((F.col("x.lo") != F.col("y.lo")) | (F.col("x.hi") != F.col("y.hi")) | (F.col("x.lo") != F.col("x.hi")))
    near = F.abs(F.col("x.block.band") - F.col("y.block.band")) <= BANDS_APART + 1
    meet = x.join(y, (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.block") <= F.col("y.block")) & near & differs).groupBy(
        F.col("x.block").alias("x"), F.col("y.block").alias("y")).agg(F.count("*").alias("lists"))
    # The bound of ``possible`` for the best pair of two blocks.
    a = sizes.select(F.col("block").alias("x"), *[F.col(c).alias(f"x_{c}") for c in ("least", "most", "unlisted")])
    b = sizes.select(F.col("block").alias("y"), *[F.col(c).alias(f"y_{c}") for c in ("least", "most", "unlisted")])
    enough = (F.col("lists") + F.greatest("x_unlisted", "y_unlisted")) * 9 >= (F.col("x_least") + F.col("y_least")) * 4
    alike = (F.col("x_most") * 5 >= F.col("y_least") * 4) & (F.col("y_most") * 5 >= F.col("x_least") * 4)
    meet = staged(meet.join(a, "x").join(b, "y").filter(enough & alike).select(F.struct("x", "y").alias("block")), "ngram-meet")
    sides = meet.select("block", F.explode(F.array_distinct(F.array("block.x", "block.y"))).alias("side"))
    second = search(sides.join(state.select(F.col("block").alias("side"), "entity", "component"), "side")
                    .select("block", "entity", "component"))
    drop_staged(state, blocks, sizes, meet)
    classes = components(first.unionByName(second), "a", "b")

    labelled = ids.join(classes.select(F.col("node").alias("entity"), "component"), "entity", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "entity").alias("component"))
    labelled = staged(labelled, "ngram-labelled")
    drop_staged(first, second, scanned)
    least = staged(labelled.filter("component is not null").groupBy("component").agg(F.min("doc_id").alias("least")),
                   "ngram-least")
    return labelled.join(least, "component", "left").select(
        "doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id"))
