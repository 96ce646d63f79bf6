"""Filter interaction audit: what each filter of a chain removes, in every order.

A counting Bloom filter goes before the search for repeated texts. Each task counts
its texts' hashes in a sparse sketch of its own; the sketches are merged block by
block (a count stops at two), and a text whose cells are not all counted twice occurs
once for certain. Only the others, the possible repeats, are shuffled, as whole texts,
to find the smallest id of each. Every document then has a mask of the filters that
it fails; masks are counted, and all orders follow from those counts.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlens.llm.base import stored

FILTERS = "ABCDE"
BITS = {f: 1 << i for i, f in enumerate(FILTERS)}
#: Cells of a block of the sketch (all cells of a text lie in one block), cells a text, blocks a text.
CELLS, PROBES, CELLS_A_TEXT = 4096, 4, 32
#: A merged sketch up to this many bytes is broadcast; a larger one is joined by block.
BROADCAST_BYTES = 64_000_000
#: Parts that a block is dealt to in such a join, so that one text's block is no one task's work.
SALTS = 16
#: Hashes that a task holds before it gives out what it has counted.
HELD = 500_000


def failures(text: Column) -> Column:
    """Bits of the filters A to D that a text fails."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    fails = {"A": n < 100, "B": 100 * distinct < 80 * n, "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > 10 * F.length(text),
             "D": text.rlike(r"[#$%&*|]")}
    return sum((F.when(c, BITS[f]).otherwise(0) for f, c in fails.items()), F.lit(0)).cast("int")


def block_of(h: Column, blocks: int) -> Column:
    return F.pmod(h, F.lit(blocks).cast("long"))


def cell_of(h: Column, probe: int) -> Column:
    """Place in its block of a hash's ``probe``-th cell: bits of the hash mixed again,
    as the block already follows from the hash itself."""
    return F.shiftrightunsigned(F.xxhash64(h), 12 * probe).bitwiseAND(CELLS - 1).cast("int")


def sketch(hashes: DataFrame, blocks: int) -> DataFrame:
    """Merged sketch of a column ``h``: (block, twice), where bit i of the longs ``twice`` is
    set if cell i was counted at least twice. Blocks without such a cell are absent."""
    cells = hashes.select(block_of(F.col("h"), blocks).alias("block"), *[cell_of(F.col("h"), p).alias(f"c{p}") for p in range(PROBES)])
    form = pa.schema([("block", pa.int64()), ("cells", pa.binary()), ("again", pa.binary())])
    merged = pa.schema([("block", pa.int64()), ("twice", pa.list_(pa.int64()))])

    def counted(held):
        """One row a block: its cells in order, 16 bits each, and whether each was met again."""
        block, *places = (np.concatenate(c) for c in zip(*held, strict=True))
        places = np.sort(np.stack(places), axis=0)  # a text whose probes fall together counts that cell once
        fresh = np.concatenate([np.ones((1, len(block)), bool), places[1:] != places[:-1]])
        key, n = np.unique((block[None, :] * CELLS + places)[fresh], return_counts=True)
        own, lo = np.unique(key // CELLS, return_index=True)
        ranges = list(zip(lo, [*lo[1:], len(key)], strict=True))
        place, again = (key % CELLS).astype(np.uint16), n > 1
        return pa.RecordBatch.from_arrays(
            [pa.array(own, pa.int64()), pa.array([place[a:z].tobytes() for a, z in ranges], pa.binary()),
             pa.array([np.packbits(again[a:z]).tobytes() for a, z in ranges], pa.binary())], schema=form)

    def count(batches):
        held, n = [], 0
        for b in batches:
            held.append([c.to_numpy() for c in b.columns])
            n += b.num_rows
            if n >= HELD:
                yield counted(held)
                held, n = [], 0
        if n:
            yield counted(held)

    def merge(batches):
        """Blocks come sorted: one is held at a time, however many tasks counted in it."""
        at, once, twice = None, None, None
        for b in batches:
            done = []
            for block, places, again in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if block != at:
                    if at is not None and twice.any():
                        done.append((at, twice))
                    at, once, twice = block, np.zeros(CELLS, bool), np.zeros(CELLS, bool)
                places = np.frombuffer(places, np.uint16)
                twice[places] |= once[places] | np.unpackbits(np.frombuffer(again, np.uint8), count=len(places)).astype(bool)
                once[places] = True
            if done:
                yield packed(done)
        if at is not None and twice.any():
            yield packed([(at, twice)])

    def packed(done):
        longs = [np.packbits(t, bitorder="little").view(np.int64).tolist() for _, t in done]
        return pa.RecordBatch.from_arrays([pa.array([a for a, _ in done], pa.int64()), pa.array(longs, pa.list_(pa.int64()))], schema=merged)

    parts = cells.mapInArrow(count, "block long, cells binary, again binary")
    return parts.repartition("block").sortWithinPartitions("block").mapInArrow(merge, "block long, twice array<long>")


def with_possible(rows: DataFrame, merged: DataFrame, blocks: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Adds ``possible``: whether all cells of a row's hash ``h`` were counted twice. That
    holds for every text that occurs twice, and of the others for about two in ten thousand."""
    keys, own = ["block"], rows.withColumn("block", block_of(F.col("h"), blocks))
    if blocks * CELLS // 8 <= limit:
        merged = F.broadcast(merged)
    else:  # the part follows from the input split, so a task that runs again deals alike
        keys.append("_salt")
        merged = merged.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        own = own.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    possible = F.col("twice").isNotNull()
    for p in range(PROBES):
        cell = cell_of(F.col("h"), p)
        possible &= F.getbit(F.element_at("twice", F.shiftright(cell, 6) + 1), cell.bitwiseAND(63)) == 1
    return own.join(merged, keys, "left").withColumn("possible", F.coalesce(possible, F.lit(False))).drop("twice", *keys)


def first_ids(rows: DataFrame) -> DataFrame:
    """(doc_id, key): the smallest id of each text of ``rows`` (doc_id, text) and the text's
    digest. Texts are grouped as they are, copies of one text in a task before the shuffle."""
    return (rows.where("doc_id is not null").groupBy("text").agg(F.min("doc_id").alias("doc_id"))
            .select("doc_id", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("key")))


def masks(docs: DataFrame, labels: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """(part, mask, docs, good, toxic): documents by part and by the filters they fail."""
    rows = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text")) \
        .withColumn("h", F.xxhash64("text"))
    blocks = max(1, -(-docs.count() * CELLS_A_TEXT // CELLS))
    merged = stored(sketch(rows.select("h"), blocks), "sketch")
    first = first_ids(with_possible(rows.select("doc_id", "text", "h"), merged, blocks, limit).where("possible"))
    # rows that agree in all that counts are one row from here on, so neither a repeated nor a null id is hot
    key = F.when(F.col("possible") & F.col("doc_id").isNotNull(), F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    facts = with_possible(rows, merged, blocks, limit).select("doc_id", "part", failures(F.col("text")).alias("mask"), key.alias("key")) \
        .groupBy("doc_id", "part", "mask", "key").agg(F.count("*").alias("n"))
    flagged = facts.join(first.withColumn("first", F.lit(True)), ["doc_id", "key"], "left")
    known = labels.groupBy("doc_id").agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    mask = F.col("mask") + F.when(F.col("key").isNotNull() & F.col("first").isNull(), BITS["E"]).otherwise(0)
    return (flagged.withColumn("mask", mask).join(known, "doc_id", "left").groupBy("part", "mask")
            .agg(F.sum("n").alias("docs"), F.coalesce(F.sum(F.col("n") * F.col("good")), F.lit(0)).alias("good"),
                 F.coalesce(F.sum(F.col("n") * F.col("toxic")), F.lit(0)).alias("toxic")))


def by_order(counts: DataFrame) -> DataFrame:
    """All orders of the filters, step by step, from ``masks``: one row per part, order and step."""
    orders = ["".join(p) for p in permutations(FILTERS)]
    own = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "docs", "good", "toxic")).alias("seen"))  # 32 at most
    rows = own.withColumn("filter_order", F.explode(F.split(F.lit(",".join(orders)), ","))) \
        .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    place = {f: F.instr("filter_order", f) for f in FILTERS}
    rows = rows.withColumn("bit", sum((F.when(place[f] == F.col("step"), BITS[f]).otherwise(0) for f in FILTERS), F.lit(0))) \
        .withColumn("before", sum((F.when(place[f] < F.col("step"), BITS[f]).otherwise(0) for f in FILTERS), F.lit(0)))

    def total(value, which):
        return F.aggregate(F.filter("seen", which), F.lit(0).cast("long"), lambda a, x: a + value(x))

    def fails(x):
        return x["mask"].bitwiseAND(F.col("bit")) != 0

    def gone(x):
        return x["mask"].bitwiseAND(F.col("before")) != 0

    docs = lambda x: x["docs"]
    removed = lambda x: fails(x) & ~gone(x)
    # of all orders, a filter comes first among the b that a document fails in 1 of b
    share = F.array(*[F.lit(len(orders) // b).cast("long") for b in range(1, len(FILTERS) + 1)])
    return rows.select(
        "part", "filter_order", F.col("step").cast("int").alias("step"), F.substring("filter_order", F.col("step"), F.lit(1)).alias("filter"),
        total(docs, lambda x: ~gone(x) & ~fails(x)).alias("kept"), total(docs, removed).alias("removed"),
        total(docs, lambda x: fails(x) & gone(x)).alias("redundant"), total(docs, lambda x: x["mask"] == F.col("bit")).alias("unique_fails"),
        total(lambda x: x["good"], removed).alias("good_lost"), total(lambda x: x["toxic"], removed).alias("toxic_lost"),
        total(lambda x: F.element_at(share, F.bit_count(x["mask"])) * x["docs"], fails).alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """(part, filter_order, step, filter, kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley) of ``docs`` (doc_id, text, lang) and ``labels`` (doc_id, quality, toxic);
    other columns are ignored.

    A null text is empty (it fails A, and E after another empty one); a null lang is the part ''.
    A null id is smaller than none and has no label, so such a row never fails E and makes no other
    fail it; rows that repeat an id with one text don't fail E by each other. Of repeated
    labels of an id, one with the value 1 counts. Every row of ``docs`` counts; an
    empty table gives no rows."""
    return by_order(masks(docs, labels, limit))
