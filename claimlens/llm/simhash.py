"""SimHash near-copy classes by tiled exact comparison.

Fingerprints that are equal are collapsed first. The distinct ones fall into
tiles by the population counts of their segments. Two fingerprints at Hamming
distance r have segment counts that differ by r in sum at most, so only tile
pairs whose population counts differ by no more than the radius are compared,
with numpy exclusive-or and bit counts, and no link is lost. Linked fingerprints
are joined into components by alternating star steps on Spark tables.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from claimlens.llm.base import stored

SEED = 42
#: Shingles hashed at a time, so that a very long text needs bounded memory.
PIECE = 1 << 16
#: Fingerprints of a tile's own beyond which it's split, and rows compared at a time.
TILE, ROWS, COLUMNS = 1 << 15, 512, 8192
#: Distinct fingerprints above which tiles use eight segments in place of four.
FINE_FROM = 4_000_000
_BITS = np.array([[b >> k & 1 for k in range(8)] for b in range(256)])


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64-bit SimHash of a whole text, as an unsigned integer.

    A-Z are lower-cased; words are runs without space, tab, LF, VT, FF or CR.
    Fewer words than ``shingle`` make one shingle; none (or a null text) gives 0."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    begin, end = (end - size).tolist(), end.tolist()
    spans = list(zip(begin, end[shingle - 1 :])) if len(words) > shingle else [(0, len(joined))]
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(spans), PIECE):
        part = spans[at : at + PIECE]
        h = np.fromiter([digest(joined[a:b], SEED) for a, b in part], np.uint64, len(part)).view(np.uint8).reshape(-1, 8)
        for k in range(8):
            ones[8 * k : 8 * k + 8] += np.bincount(h[:, k], minlength=256) @ _BITS
    over = 2 * ones > len(spans)
    return int(np.packbits(over, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fp), one row per row of ``docs``; fp is the fingerprint's 64 bits as a signed long."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            fp = np.array([fingerprint(t, shingle) for t in b.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp, pa.int64())], names=["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, fp long")


def _segment_counts(fp: np.ndarray, segments: int) -> np.ndarray:
    by_byte = np.bitwise_count(fp.view(np.uint8).reshape(-1, 8)).astype(np.int64)
    return by_byte.reshape(len(fp), segments, -1).sum(2)


def _near_cells(segments: int, radius: int) -> np.ndarray:
    """Differences of segment counts that sum to the radius at most."""
    def grow(left, budget):
        if not left:
            yield ()
            return
        for d in range(-budget, budget + 1):
            for rest in grow(left - 1, budget - abs(d)):
                yield (d, *rest)
    return np.array(list(grow(segments, radius)))


def tiled(distinct: DataFrame, radius: int, segments: int) -> DataFrame:
    """(cell, part, own, fp): each fingerprint in its own tile, and as a visitor in
    each tile with a smaller number within the radius. A tile with over ``TILE``
    own fingerprints is dealt to several parts; what comes later in its order
    visits the parts before."""
    top = 64 // segments + 1
    weights = top ** np.arange(segments)
    steps = _near_cells(segments, radius)
    steps = steps[steps @ weights < 0]

    def home(batches):
        for b in batches:
            fp = b.column(0).to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(_segment_counts(fp, segments) @ weights)], names=["cell"])

    # one row per crowded tile: at most the distinct fingerprints / TILE
    crowded = {r[0]: -(-r[1] // TILE) for r in
               distinct.select("fp").mapInArrow(home, "cell long").groupBy("cell").count().where(F.col("count") > TILE).collect()}
    shared = distinct.sparkSession.sparkContext.broadcast(crowded)

    def deal(batches):
        names = ["cell", "part", "own", "fp"]
        for b in batches:
            every = b.column(0).to_numpy()
            for at in range(0, len(every), 8192):
                fp = every[at : at + 8192]
                counts = _segment_counts(fp, segments)
                cell = counts @ weights
                near = counts[:, None, :] + steps[None, :, :]
                who, which = np.nonzero(((near >= 0) & (near < top)).all(2))
                cells = np.concatenate([cell, cell[who] + steps[which] @ weights])
                fps = np.concatenate([fp, fp[who]])
                own = np.arange(len(cells)) < len(cell)
                parts = np.zeros(len(cells), np.int32)
                if shared.value:
                    split = np.array([shared.value.get(c, 1) for c in cells.tolist()])
                    place = (fps.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)).astype(np.int64) % split
                    more = [(cells[k], p, False, fps[k]) for k in np.nonzero(split > 1)[0]
                            for p in range(place[k] if own[k] else split[k]) if own[k] or p]
                    parts = np.where(own, place, 0).astype(np.int32)
                    if more:
                        c, p, o, f = zip(*more, strict=True)
                        cells, parts = np.concatenate([cells, c]), np.concatenate([parts, p]).astype(np.int32)
                        own, fps = np.concatenate([own, o]).astype(bool), np.concatenate([fps, f]).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int64()), pa.array(parts, pa.int32()), pa.array(own), pa.array(fps, pa.int64())], names=names)

    return distinct.select("fp").mapInArrow(deal, "cell long, part int, own boolean, fp long")


def _forest(nodes: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest node of each node's component under the links (a, b)."""
    root = np.arange(nodes)
    while True:
        x, y = root[a], root[b]
        if (x == y).all():
            return root
        low, high = np.minimum(x, y), np.maximum(x, y)
        np.minimum.at(root, high, low)
        while not np.array_equal(nxt := root[root], root):
            root = nxt


def _compare(left: np.ndarray, right: np.ndarray, radius: int):
    """Index pairs of fingerprints within the radius, block by block."""
    for i in range(0, len(left), ROWS):
        for j in range(0, len(right), COLUMNS):
            near = np.bitwise_count(left[i : i + ROWS, None] ^ right[None, j : j + COLUMNS]) <= radius
            a, b = np.nonzero(near)
            if len(a):
                yield a + i, b + j


def _links(own: np.ndarray, other: np.ndarray, radius: int):
    """Links that join what is within the radius: own with own, or own with others.
    Returned as a forest, so a crowd of n gives n - 1 rows and not n squared."""
    both = own if other is None else np.concatenate([own, other])
    root = np.arange(len(both))
    for a, b in _compare(own, own if other is None else other, radius):
        b = b if other is None else b + len(own)
        root = root[_forest(len(both), root[a], root[b])][root] if len(a) else root
    child = np.nonzero(root != np.arange(len(both)))[0]
    return both[child], both[root[child]]


def links(tiles: DataFrame, radius: int) -> DataFrame:
    """(a, b): enough linked pairs of fingerprints to join each class. A task walks
    its tiles in order: it holds one tile's own fingerprints and a batch of visitors."""
    def run(batches):
        key, own = None, np.zeros(0, np.uint64)
        out: list = []

        def found(pair):
            if len(pair[0]):
                out.append(pair)

        for b in batches:
            cell, part, mine, fp = (b.column(k).to_numpy(zero_copy_only=False) for k in range(4))
            fp = fp.view(np.uint64) if fp.flags.writeable else fp.copy().view(np.uint64)
            cut = np.concatenate([[0], np.nonzero((np.diff(cell) != 0) | (np.diff(part) != 0))[0] + 1, [len(cell)]])
            has = np.add.reduceat(mine, cut[:-1]) if len(cell) else []
            for k in range(len(cut) - 1):
                lo, hi = cut[k], cut[k + 1]
                this = (cell[lo], part[lo])
                if this != key:
                    key, own = this, np.zeros(0, np.uint64)
                if not has[k] and not len(own):
                    continue
                if has[k]:
                    new = fp[lo : lo + has[k]]  # own ones come first
                    if len(own):
                        found(_links(own, new, radius))
                    if len(new) > 1:
                        found(_links(new, None, radius))
                    own = np.concatenate([own, new])
                if hi - lo > has[k]:
                    found(_links(own, fp[lo + has[k] : hi], radius))
            if out:
                a, c = (np.concatenate(x).view(np.int64) for x in zip(*out, strict=True))
                out.clear()
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(c)], names=["a", "b"])

    return (tiles.repartition("cell", "part").sortWithinPartitions("cell", "part", F.desc("own"))
            .mapInArrow(run, "a long, b long"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root): for every node of ``edges`` (a, b) the smallest node that it
    reaches, by alternating large-star and small-star steps; every step is a table
    in the shared folder, and the hottest node's links may be split by AQE."""
    pairs = edges.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).where("v != u").distinct()
    cur = stored(pairs, "links")
    print_of = lambda d: d.agg(F.count("*"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
    mark = print_of(cur)
    while mark[0]:
        both = cur.unionByName(cur.select(F.col("u").alias("v"), F.col("v").alias("u")))
        low = both.groupBy("v").agg(F.least(F.min("u"), F.col("v")).alias("m"))
        large = both.join(low, "v").where("u > v").select(F.col("u").alias("v"), F.col("m").alias("u"))
        large = stored(large.distinct(), "links")
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(low, "v").select(F.when(F.col("u") == F.col("m"), F.col("v")).otherwise(F.col("u")).alias("v"), F.col("m").alias("u"))
        cur = stored(small.where("v != u").distinct(), "links")
        mark, last = print_of(cur), mark
        if mark == last:
            break
    return cur.select(F.col("v").alias("node"), F.col("u").alias("root")).unionByName(
        cur.select(F.col("u").alias("node"), F.col("u").alias("root"))).distinct()


def roots(prints: DataFrame, radius: int) -> DataFrame:
    """(fp, first, root), one row per distinct fingerprint of ``prints`` (doc_id, fp):
    its smallest doc_id, and the smallest fingerprint of its class."""
    distinct = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    segments = 4 if distinct.count() <= FINE_FROM else 8
    found = components(links(tiled(distinct, radius, segments), radius))
    return distinct.join(found, distinct.fp == found.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))


def near_copies(docs: DataFrame, radius: int = 2, shingle: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per row of ``docs`` (doc_id, text).

    Fingerprints link at ``radius`` or fewer differing bits; component_id is the
    smallest doc_id reachable over links, the document's own included. Null and
    empty texts have fingerprint zero, which links like any other. Rows with a
    null doc_id have a class too, but never name one: a class of only such rows
    has a null component_id. Repeated doc_ids give a row each."""
    prints = stored(fingerprints(docs, shingle), "prints")
    rooted = roots(prints, radius)
    alone = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    ids = rooted.join(alone, "root").select("fp", "component_id")
    return prints.join(ids, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, radius: int = 2, shingle: int = 3) -> DataFrame:
    """One row of ``docs`` (all columns) of each class: the first by doc_id, nulls last, then by
    the digest of its text, a null text first; of rows alike in both the one whose columns come first
    as JSON. It's chosen by row, so a row whose doc_id repeats in another class stands for its
    own class only. An empty table gives no rows.

    Classes are found on (fingerprint, doc_id, digest) alone. The rows meet the chosen ones in one
    semi join; only chosen ones that occur more than once go through an aggregate."""
    fp = "_fp_" + "_".join(docs.columns)
    digest = F.unhex(F.sha2(F.col("text").cast("binary"), 256))

    def run(batches):
        for b in batches:
            own = np.array([fingerprint(t, shingle) for t in b.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(own, pa.int64()), b.column(2)], names=["doc_id", "fp", "digest"])

    kind = docs.schema["doc_id"].dataType
    prints = StructType([StructField("doc_id", kind), StructField("fp", LongType()), StructField("digest", BinaryType())])
    rows = stored(docs.select("doc_id", "text", digest.alias("digest")).mapInArrow(run, prints), "prints")
    classes = roots(rows, radius).select("fp", "root")
    order = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"), F.col("digest"))
    first = rows.groupBy("fp").agg(F.min(order).alias("key"))  # copies meet map-side
    chosen = first.join(classes, "fp").groupBy("root").agg(F.min("key").alias("key")).select(F.col("key.id").alias("_id"), F.col("key.digest").alias("_digest"))
    chosen = stored(chosen, "chosen")
    again = stored(rows.groupBy("doc_id", "digest").agg(F.count("*").alias("n")).where("n > 1").join(
        chosen, F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("digest").eqNullSafe(F.col("_digest")), "left_semi").select(
        F.col("doc_id").alias("_id"), F.col("digest").alias("_digest")), "repeated")
    own = docs.withColumn(fp, digest)
    same = lambda t: own["doc_id"].eqNullSafe(t["_id"]) & own[fp].eqNullSafe(t["_digest"])
    kept = own.join(chosen, same(chosen), "left_semi")
    if again.limit(1).count() == 0:
        return kept.select(*(F.col(f"`{c}`") for c in docs.columns))
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    once = kept.join(again, same(again), "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))
    more = own.join(again, same(again), "left_semi").groupBy("doc_id", fp).agg(F.min_by(row, F.to_json(row)).alias("_row"))
    return once.unionByName(more.select(*(F.col(f"_row.`{c}`").alias(c) for c in docs.columns)))
