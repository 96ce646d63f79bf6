"""Nearest neighbours by cross-polytope hashing.

Each hash table turns a vector by three rounds of random signs and a fast
Hadamard transform and files it under the signed axis nearest to the result. A
query looks into the buckets of its nearest axes in every table (multiprobe);
what it meets there is ranked by the inner product of the original vectors.
Points are banded by norm, a band is hashed by direction in buckets of its own, and
a query looks into all bands. Equal vectors are searched once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimlens.llm.base import stored

#: Points of a bucket for which a second axis is added to the hash, and beyond
#: which a bucket (or its queries) is dealt to several tasks.
TARGET, CROWDED = 4096, 32_768
#: Queries compared at a time.
ROWS = 64
#: Queries hashed at a time.
ASKED = 1024
#: Power of the number of buckets by which probes grow.
WIDER = 0.75
#: Largest by smallest norm of a band, and points below which norms share a band
#: that isn't hashed but met as a whole by every query.
BAND, SMALL = 1.1, 256


def hadamard(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of the rows, whose length is a power of two."""
    n, h = x.shape[1], 1
    while h < n:
        y = x.reshape(len(x), n // (2 * h), 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], 2).reshape(len(x), n)
        h *= 2
    return x / np.sqrt(n)


class Hasher:
    """Hash functions for vectors of one length. ``second``: axes of the second
    polytope, 0 for none. ``norm``: where the norms differ, vectors get one more
    component that lifts them all to this norm (queries get 0), so that nearness
    in angle is nearness by inner product."""

    def __init__(self, dim: int, rows: int, low: float, high: float, tables: int, probes: int):
        self.norm = high if low < 0.999 * high else 0.0
        self.width = 1 << max(1, (dim + bool(self.norm) - 1).bit_length())
        self.tables, self.probes, self.second = tables, probes, 0
        while 2 * self.width * max(1, 2 * self.second) * TARGET < rows and self.second < self.width:
            self.second = max(1, 2 * self.second)
        signs = np.random.default_rng(dim)
        self.signs = signs.choice([-1.0, 1.0], (tables, 2, 3, self.width))
        # with a second axis there are more buckets, and a query looks into more
        more = max(1, 2 * self.second)
        self.probes = min(int(np.ceil(probes * more**WIDER)), 2 * self.width * more)

    def turned(self, x: np.ndarray, query: bool, table: int, which: int) -> np.ndarray:
        if not self.norm:
            x = x / np.abs(x).max(1, keepdims=True)  # no square leaves the range of doubles
        size = np.linalg.norm(x, axis=1)
        y = np.zeros((len(x), self.width))
        y[:, : x.shape[1]] = x
        if self.norm and not query:
            y[:, x.shape[1]] = np.sqrt(np.maximum(self.norm**2 - size**2, 0))
        y /= np.linalg.norm(y, axis=1)[:, None]
        for s in self.signs[table, which]:
            y = hadamard(y * s)
        return y[:, : self.second] if which else y

    def _ranked(self, y: np.ndarray, most: int):
        """Signed axes by nearness, and what each gives up against the nearest."""
        both = np.concatenate([y, -y], 1)
        order = np.argsort(-both, axis=1, kind="stable")[:, :most]
        value = np.take_along_axis(both, order, 1)
        return order, (value[:, :1] - value) ** 2

    def buckets(self, x: np.ndarray, table: int, query: bool = False) -> np.ndarray:
        """(rows, 1) bucket numbers of points, (rows, probes) of queries."""
        most = self.probes if query else 1
        first, lost = self._ranked(self.turned(x, query, table, 0), most)
        if not self.second:
            return first
        other, more = self._ranked(self.turned(x, query, table, 1), min(most, 2 * self.second))
        total = (lost[:, :, None] + more[:, None, :]).reshape(len(x), -1)
        best = np.argsort(total, axis=1, kind="stable")[:, :most]
        return np.take_along_axis(first, best // other.shape[1], 1) * 2 * self.second + np.take_along_axis(other, best % other.shape[1], 1)


def bands(shapes, tables: int, probes: int):
    """(band of each (dim, bin), bands of each dim as (first bucket, hasher)). A bin
    of ``SMALL`` points and more is a band of its own; smaller ones, in the order of
    their norms, fill bands without a hasher, which are one bucket each."""
    of: dict[tuple[int, int], int] = {}
    every: dict[int, list] = {}
    held: dict[int, list[int]] = {}  # the open small band of each dim: place, points
    bucket: dict[int, int] = {}
    for s in sorted(shapes, key=lambda s: (s.dim, s.bin)):
        own = every.setdefault(s.dim, [])
        if s.n < SMALL and s.dim in held and held[s.dim][1] < SMALL:
            held[s.dim][1] += s.n
            of[s.dim, s.bin] = held[s.dim][0]
            continue
        of[s.dim, s.bin] = len(own)
        hasher = None
        if s.n < SMALL:
            held[s.dim] = [len(own), s.n]
        else:
            hasher = Hasher(s.dim, s.n, 1.0, 1.0, tables, probes)  # directions only
        own.append((bucket.get(s.dim, 0), hasher))
        bucket[s.dim] = own[-1][0] + (2 * hasher.width * max(1, 2 * hasher.second) if hasher else 1)
    return of, every


def _matrix(column) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _by_length(batch, column: int):
    size = np.asarray(batch.column(column).value_lengths())
    for dim in np.unique(size):
        yield int(dim), batch.take(pa.array(np.nonzero(size == dim)[0]))


def _top(query, point, score, k):
    """The k largest scores of each query, ties to smaller points."""
    order = np.lexsort((point, -score, query))
    query, point, score = query[order], point[order], score[order]
    start = np.concatenate([[True], query[1:] != query[:-1]])
    at = np.arange(len(query))
    keep = at - np.maximum.accumulate(np.where(start, at, 0)) < k
    return query[keep], point[keep], score[keep]


def search(rows: DataFrame, is_query, k: int = 20, tables: int = 12, probes: int = 12) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` nearest rows of each query.

    ``rows``: (vec_id long, embedding array of floats); ``is_query``: condition on
    vec_id. Score: inner product of the original vectors, summed in double
    precision from the first component to the last; ties go to the smaller
    vec_id. Rows with a null vec_id and vectors that are null, empty, zero or hold
    a null or non-finite component take no part; vectors of other lengths than the
    query's are no candidates. Repeated rows count once; a row with the query's
    own id never is its neighbour. Recall is that of the hash tables, norms of any
    spread included; vectors whose norms are rare are compared with every query. A
    query that meets fewer than ``k`` is compared with all vectors of its length."""
    clean = rows.select("vec_id", F.col("embedding").alias("vec")).where(
        F.col("vec_id").isNotNull() & F.col("vec").isNotNull()
        & F.forall("vec", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
        & F.exists("vec", lambda v: v != 0))
    same = Window.partitionBy("vec")
    # of equal vectors the k + 1 smallest ids are all that any query can return
    members = stored(clean.withColumn("place", F.dense_rank().over(same.orderBy("vec_id"))).where(F.col("place") <= k + 1)
                     .dropDuplicates(["vec", "vec_id"]).withColumn("rep", F.min("vec_id").over(same))
                     .select("rep", "vec_id", "vec", (F.col("vec_id") == F.col("rep")).alias("first")), "members")
    reps = members.where("first").select("rep", "vec")
    asked = stored(clean.where(is_query(F.col("vec_id"))).select(F.col("vec_id").alias("query_id"), "vec")
                   .join(reps, "vec").select("query_id", "rep").distinct(), "queries")
    largest = F.array_max(F.transform("vec", lambda v: F.abs(v.cast("double"))))
    squares = F.aggregate("vec", F.lit(0.0), lambda a, v: a + (v.cast("double") / F.col("_largest")) * (v.cast("double") / F.col("_largest")))
    reps = (reps.withColumn("_largest", largest)
            .withColumn("bin", F.floor((F.log("_largest") + F.log(squares) / 2) / float(np.log(BAND)) + 0.5).cast("int")).drop("_largest"))
    # norms are doubles, so no length has more than 15,000 bins
    shapes = reps.groupBy(F.size("vec").alias("dim"), "bin").agg(F.count("*").alias("n")).collect()
    spark = rows.sparkSession
    plan = spark.sparkContext.broadcast(bands(shapes, tables, probes))
    flagged = stored(reps.join(asked.select("rep").distinct().withColumn("asks", F.lit(True)), "rep", "left")
                     .select("rep", "vec", F.coalesce("asks", F.lit(False)).alias("asks"), "bin"), "points")

    def entries(batch):
        """(dim, table, rows of the batch, their buckets, whether they ask)."""
        of, every = plan.value
        for dim, part in _by_length(batch, 1):
            x, asks = _matrix(part.column(1)), np.nonzero(part.column(2).to_numpy(zero_copy_only=False))[0]
            own = np.array([of[dim, k] for k in part.column(3).to_pylist()])
            for band, (base, hasher) in enumerate(every[dim]):
                mine = np.nonzero(own == band)[0]
                for t in range(tables if hasher else 1):
                    if len(mine):
                        yield dim, t, part, mine, base + (hasher.buckets(x[mine], t)[:, 0] if hasher else np.zeros(len(mine), np.int64)), False
                    for at in range(0, len(asks), ASKED):
                        some = asks[at : at + ASKED]
                        probed = hasher.buckets(x[some], t, True) if hasher else np.zeros((len(some), 1), np.int64)
                        yield dim, t, part, np.repeat(some, probed.shape[1]), base + probed.ravel(), True

    def sizes(batches):
        for batch in batches:
            for dim, t, _, _, bucket, asks in entries(batch):
                b, n = np.unique(bucket, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([dim] * len(b), pa.int32()), pa.array([t] * len(b), pa.int32()), pa.array(b, pa.int64()),
                     pa.array([asks] * len(b)), pa.array(n, pa.int64())], names=["dim", "t", "bucket", "asks", "n"])

    # crowded buckets: at most (points + probes) x tables / CROWDED rows
    crowded = {tuple(r)[:4]: -(-r.n // CROWDED) for r in flagged.mapInArrow(
        sizes, "dim int, t int, bucket long, asks boolean, n long").groupBy("dim", "t", "bucket", "asks").agg(
            F.sum("n").alias("n")).where(F.col("n") > CROWDED).collect()}
    split = spark.sparkContext.broadcast(crowded)
    names = ["dim", "t", "bucket", "part", "asked", "asks", "rep", "vec"]

    def deal(batches):
        for batch in batches:
            for dim, t, part, who, bucket, asks in entries(batch):
                rep = part.column(0).to_numpy()[who]
                mine, theirs = np.zeros(len(who), np.int32), np.zeros(len(who), np.int32)
                if split.value:
                    own = np.array([split.value.get((dim, t, b, asks), 1) for b in bucket.tolist()])
                    other = np.array([split.value.get((dim, t, b, not asks), 1) for b in bucket.tolist()])
                    mine = ((rep.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)).astype(np.int64) % own).astype(np.int32)
                    at = np.repeat(np.arange(len(who)), other)
                    theirs = (np.arange(len(at)) - np.repeat(np.cumsum(other) - other, other)).astype(np.int32)
                    who, bucket, rep, mine = who[at], bucket[at], rep[at], mine[at]
                points, queries = (theirs, mine) if asks else (mine, theirs)
                n = len(who)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, dim, np.int32)), pa.array(np.full(n, t, np.int32)), pa.array(bucket, pa.int64()),
                     pa.array(points, pa.int32()), pa.array(queries, pa.int32()), pa.array(np.full(n, asks)), pa.array(rep, pa.int64()),
                     part.column(1).take(pa.array(who))], names=names)

    kind = flagged.schema["vec"].dataType.simpleString()
    dealt = flagged.mapInArrow(deal, f"dim int, t int, bucket long, part int, asked int, asks boolean, rep long, vec {kind}")

    def compare(group: pa.Table) -> pa.Table:
        asks = group["asks"].to_numpy()
        x, rep = _matrix(group["vec"].combine_chunks()), group["rep"].to_numpy()
        q, p, qid, pid = x[asks], x[~asks], rep[asks], rep[~asks]
        found = []
        for at in range(0, len(q) if len(p) else 0, ROWS):
            s = q[at : at + ROWS] @ p.T
            least = np.partition(s, len(p) - k - 1, axis=1)[:, len(p) - k - 1] if len(p) > k + 1 else s.min(1)
            i, j = np.nonzero(s >= (least - 1e-9 * (1 + np.abs(s).max(1)))[:, None])
            exact = np.cumsum(q[at + i] * p[j], axis=1)[:, -1]
            found.append(_top(qid[at + i], pid[j], exact, k + 1))
        a, b, c = (np.concatenate(z) for z in zip(*found, strict=True)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        return pa.table({"asker": pa.array(a, pa.int64()), "rep": pa.array(b, pa.int64()), "score": pa.array(c, pa.float64())})

    by = Window.partitionBy("asker")
    own = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def ranked(dealt):
        met = (dealt.groupBy("dim", "t", "bucket", "part", "asked").applyInArrow(compare, "asker long, rep long, score double")
               .groupBy("asker", "rep").agg(F.max("score").alias("score")))
        near = met.withColumn("place", F.row_number().over(by.orderBy(F.desc("score"), "rep"))).where(F.col("place") <= k + 1)
        wide = (near.select("asker", "rep", "score").join(members.select("rep", "vec_id"), "rep")
                .withColumn("place", F.row_number().over(by.orderBy(F.desc("score"), "vec_id"))).where(F.col("place") <= k + 1))
        return (asked.join(wide.select(F.col("asker").alias("rep"), "vec_id", "score"), "rep").where("vec_id != query_id")
                .withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= k)
                .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))

    found = stored(ranked(dealt), "found")
    # lengths without a hasher were compared in full
    hashed = [dim for dim, own_bands in plan.value[1].items() if any(h for _, h in own_bands)]
    few = asked.join(found.groupBy("query_id").agg(F.count("*").alias("n")), "query_id", "left").where(F.coalesce("n", F.lit(0)) < k)
    short = stored(flagged.join(few.select("rep").distinct(), "rep").where(F.size("vec").isin(hashed)).select("rep", "vec"), "short")
    if not (left := short.count()):
        return found
    points, queries = (-(-n // CROWDED) for n in (sum(s.n for s in shapes), left))
    block = lambda n: F.pmod(F.xxhash64("rep"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    frame = lambda d, part, who, asks: (d.select("rep", "vec", part.alias("part")).select("*", who.alias("asked")).select(
        F.size("vec").alias("dim"), F.lit(-1).alias("t"), F.lit(0).cast("long").alias("bucket"), "part", "asked", F.lit(asks).alias("asks"), "rep", "vec"))
    full = frame(flagged, block(points), every(queries), False).unionByName(frame(short, every(points), block(queries), True))
    whole = ranked(full)
    return found.join(short.join(asked, "rep").select("query_id").distinct(), "query_id", "left_anti").unionByName(whole)
