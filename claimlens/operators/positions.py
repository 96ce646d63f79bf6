"""Positional semantics without a global sort on one node.

A contiguous 0-based position is computed in two levels: rows are range
partitioned and sorted by the whole order tuple (Spark samples the ranges, so
they hold about equally many rows whatever the columns' types and however
common a leading value is) and kept as a table with each row's partition and
place in it; the rows before a partition are a running sum over one row per
partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimlens.session import packed, small_sorts, stored


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def with_row_index(df: DataFrame, order_cols: list, name: str = "row_index") -> DataFrame:
    """Add ``name`` = 0-based position of the row in ascending ``order_cols``.

    ``order_cols`` must give a total order (ties make the position
    non-deterministic); NULLs come first. The sorted rows are written to the shared
    folder once: the ranges are sampled anew by every execution, so place and
    partition sizes must come from the same one.
    """
    order = [_col(c) for c in order_cols]
    placed = (df.repartitionByRange(*order).sortWithinPartitions(*order)
              .withColumn("_part", F.spark_partition_id())
              .withColumn("_place", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)))
    with small_sorts(df.sparkSession), packed(df.sparkSession):
        placed = stored(placed, "positions")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per shuffle partition
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    offsets = stored(sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")), "offsets")
    return (placed.join(F.broadcast(offsets), "_part")
            .withColumn(name, (F.col("_before") + F.col("_place")).cast("long")).drop("_part", "_place", "_before"))


def slice_rows(df: DataFrame, start: int, n: int, index_col: str = "row_index") -> DataFrame:
    """Rows ``[start, start+n)`` by position (S4); out-of-range asks give no rows."""
    if n <= 0 or start < 0:
        return df.limit(0)
    return df.where((F.col(index_col) >= start) & (F.col(index_col) < start + n))


def assign_batches(df: DataFrame, batch_size: int, start_row: int = 0, start_batch: int = 0,
                   index_col: str = "row_index", name: str = "batch_id") -> DataFrame:
    """Fixed-size batches over the position (S5); rows before ``start_row`` are dropped."""
    return (df.where(F.col(index_col) >= start_row)
              .withColumn(name, (F.lit(start_batch) + F.floor((F.col(index_col) - start_row) / batch_size)).cast("int")))


def temporal_split(df: DataFrame, ratio: float, index_col: str = "row_index",
                   name: str = "is_train") -> DataFrame:
    """First ``floor(n * ratio)`` positions train, the rest test (O2).

    ``n`` is a scalar subquery (one aggregate, evaluated once), so the
    driver never sees the data and no join is needed.
    """
    total = df.agg(F.count(F.lit(1))).scalar()
    return (df.withColumn("split_idx", F.floor(total * F.lit(ratio)).cast("long"))
              .withColumn(name, F.col(index_col) < F.col("split_idx")))
