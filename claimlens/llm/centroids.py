"""Centroid clustering with scalar lookup tables.

Vectors become integers once and are stored in blocks: of each dimension, the
integer values that occur in the block and every vector's place among them. In a
round, a task tabulates the squared difference of each dimension, occurring value
and centroid; the distances of all its vectors are gathers from those tables and
sums. All arithmetic is on integers, so the result does not depend on the order
in which partial sums meet, nor on tasks that run again.
"""

from __future__ import annotations

import hashlib
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.session import stored

#: Vectors of a block: it bounds the values that occur in a dimension, hence the tables.
BLOCK = 4096
#: Integers below this in size have distances that fit 64 bits (64 dimensions, 2^29 apart at most
#: 2^64 in theory, 2^62 here); larger ones are worked on as Python integers.
WIDE = 2**27
_BLOCKS = pa.schema([("ids", pa.list_(pa.int64())), ("codes", pa.binary()), ("values", pa.list_(pa.list_(pa.float64())))])


def kept(vectors: DataFrame, dims: int) -> DataFrame:
    """(vec_id long, x array<double>) of the rows whose ``embedding`` has exactly ``dims``
    components, none null, NaN or infinite, once 256 times as large."""
    x = F.col("embedding").cast("array<double>")
    good = (F.size(x) == dims) & ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v * 256) == float("inf")))
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x")).where(F.coalesce(good, F.lit(False)))


def blocks(vectors: DataFrame, dims: int, size: int = BLOCK) -> DataFrame:
    """Rows of ``kept`` as blocks: ids, the values floor(256 x) that occur in each
    dimension (doubles that hold integers), and 16-bit places among them, dimension by dimension."""
    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, size):
                part = b.slice(lo, size)
                x = np.floor(part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, dims) * 256)
                values, codes = zip(*(np.unique(x[:, d], return_inverse=True) for d in range(dims)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.column(0).to_pylist()], pa.list_(pa.int64())),
                     pa.array([np.stack([c.reshape(-1) for c in codes]).astype(np.uint16).tobytes()], pa.binary()),
                     pa.array([[v.tolist() for v in values]], pa.list_(pa.list_(pa.float64())))], schema=_BLOCKS)

    return kept(vectors, dims).mapInArrow(run, "ids array<long>, codes binary, values array<array<double>>")


def first_centroids(vectors: DataFrame, dims: int, k: int, salt: str) -> list[list[int]]:
    """The ``k`` kept vectors of smallest sha256 of ``salt:vec_id``, in that order, equal ids
    by their components. Vectors without an id are no starting points."""
    digest = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    rows = kept(vectors, dims).where("vec_id is not null").withColumn("digest", digest).orderBy("digest", "x").limit(k)
    return [[int(np.floor(v * 256)) for v in r.x] for r in rows.select("x").collect()]


def unpacked(b, row: int, centroids: list[list[int]]):
    """Of one block: ids, nearest centroid of each vector, its distance, codes and values."""
    ids = b.column(0)[row].as_py()
    values = [np.array(v) for v in b.column(2)[row].as_py()]
    codes = np.frombuffer(b.column(1)[row].as_py(), np.uint16).reshape(len(values), len(ids))
    wide = max(max(np.abs(v).max() for v in values), max(abs(c) for own in centroids for c in own)) > WIDE
    if wide:
        values = [np.array([int(u) for u in v], object) for v in values]
    else:
        values = [v.astype(np.int64) for v in values]
    at = np.array(centroids, object if wide else np.int64)
    far = np.zeros((len(ids), len(centroids)), at.dtype)
    for d, (own, code) in enumerate(zip(values, codes, strict=True)):
        far += ((own[:, None] - at[None, :, d]) ** 2)[code]  # the dimension's table, gathered
    near = far.argmin(axis=1)  # of equal distances the first
    return ids, near, far[np.arange(len(ids)), near], codes, values


def sums(data: DataFrame, centroids: list[list[int]]) -> dict[int, tuple[int, list[int]]]:
    """Per centroid that has vectors: their number and component sums. Each task adds
    up its own blocks, so a shuffle moves at most one row a task and centroid."""
    dims, k = len(centroids[0]), len(centroids)

    def run(batches):
        count, total = [0] * k, [[0] * dims for _ in range(k)]
        for b in batches:
            for row in range(b.num_rows):
                _, near, _, codes, values = unpacked(b, row, centroids)
                for c, n in enumerate(np.bincount(near, minlength=k).tolist()):
                    count[c] += n
                for d, (own, code) in enumerate(zip(values, codes, strict=True)):
                    # how often each value occurs in each cluster, times the value
                    often = np.bincount(near * len(own) + code, minlength=k * len(own)).reshape(k, len(own))
                    for c, s in enumerate((often.astype(own.dtype) @ own).tolist()):
                        total[c][d] += s
        got = [c for c in range(k) if count[c]]
        if got:
            yield pa.RecordBatch.from_arrays(
                [pa.array(got, pa.int32()), pa.array([count[c] for c in got], pa.int64()),
                 pa.array([[Decimal(s) for s in total[c]] for c in got], pa.list_(pa.decimal128(38, 0)))], names=["cluster", "n", "total"])

    parts = data.mapInArrow(run, "cluster int, n long, total array<decimal(38,0)>")
    rows = parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("total")[d]) for d in range(dims)]).alias("total"))
    return {r.cluster: (r.n, [int(s) for s in r.total]) for r in rows.collect()}  # one row a centroid


def assigned(data: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """(vec_id, cluster, distance) of every vector."""
    def run(batches):
        for b in batches:
            for row in range(b.num_rows):
                ids, near, far, _, _ = unpacked(b, row, centroids)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(near, pa.int32()), pa.array(far.tolist(), pa.int64())],
                                                 names=["vec_id", "cluster", "distance"])

    return data.mapInArrow(run, "vec_id long, cluster int, distance long")


def fit(data: DataFrame, centroids: list[list[int]], rounds: int) -> list[list[int]]:
    """Centroids after ``rounds`` of assignment and exact floor of the means; empty ones stay."""
    for _ in range(rounds if centroids else 0):
        for c, (n, total) in sums(data, centroids).items():
            centroids = [[s // n for s in total] if i == c else own for i, own in enumerate(centroids)]
    return centroids


def cluster(vectors: DataFrame, k: int = 40, rounds: int = 5, dims: int = 64, salt: str = "2") -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid, centroid_sha256), one
    row per kept vector of ``vectors`` (vec_id, embedding; other columns are ignored).

    Null, short, long, holed or non-finite vectors take no part. Repeated rows count as often
    as they occur; a vector without an id is clustered but starts no centroid, so a table
    without any id gives no rows, as does an empty one. With fewer than ``k`` vectors each
    starts a centroid. Ties go to the smaller centroid number. Distances must fit a long;
    components beyond about 10^7 can break that, which is an error, not a wrong number."""
    spark = vectors.sparkSession
    start = first_centroids(vectors, dims, k, salt)
    data = stored(blocks(vectors, dims), "blocks")
    if not start:
        data = data.limit(0)
    centroids = fit(data, start, rounds)
    rows = stored(assigned(data, centroids), "assigned")
    wide = F.sum(F.col("distance").cast("decimal(38,0)"))
    own = [(r.cluster, int(r.s)) for r in rows.groupBy("cluster").agg(wide.alias("s")).collect()]  # one row a centroid
    described = [(c, s, sum(s for _, s in own), centroids[c], hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for c, s in own]
    about = spark.createDataFrame(
        [(c, s, t, [Decimal(v) for v in own], h) for c, s, t, own, h in described],
        "cluster int, cluster_inertia long, inertia long, centroid array<decimal(38,0)>, centroid_sha256 string")
    return rows.join(F.broadcast(about), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid", "centroid_sha256")
