"""Keep-first deduplication (W1) and batch concatenation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimlens.settings import DEFAULTS, Settings


def dedup_first(df: DataFrame, keys, order_cols=("row_index",), scope=("batch_id",)) -> DataFrame:
    """The first row (by ``order_cols``) of every ``scope + keys`` group.

    Missing keys are equal to each other (SQL grouping). Implemented as the first row of a
    window, whose limit Spark also applies before the shuffle, so a hot key is collapsed
    map-side: a group holding a third of the rows costs no more than any other. The
    columns are sorted last key first, as those before it are the coarser ones.
    ``scope=()`` dedups across batches too.
    """
    w = Window.partitionBy(*reversed([*scope, *keys])).orderBy(*order_cols)
    return df.withColumn("_first", F.row_number().over(w)).where("_first = 1").select(*df.columns)


def rows_removed(before: DataFrame, after: DataFrame, batch_col: str = "batch_id") -> DataFrame:
    """Cleaning log: rows removed per batch."""
    b = before.groupBy(batch_col).agg(F.count(F.lit(1)).alias("rows_before"))
    a = after.groupBy(batch_col).agg(F.count(F.lit(1)).alias("rows_after"))
    return (b.join(a, batch_col, "left")
             .select(batch_col, "rows_before", F.coalesce("rows_after", F.lit(0)).alias("rows_after"))
             .withColumn("rows_removed", F.col("rows_before") - F.col("rows_after")))


def clean_batches(raw: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """The reference's cleaning step: keep-first dedup by (start date, object id) within a batch."""
    return dedup_first(raw, list(settings.dedup_keys), ("row_index",), ("batch_id",))


def concat_parts(parts: list[DataFrame], name: str = "part_ord") -> DataFrame:
    """Bag union in the given order; ``part_ord`` leads later position keys."""
    out = None
    for i, p in enumerate(parts):
        p = p.withColumn(name, F.lit(i))
        out = p if out is None else out.unionByName(p, allowMissingColumns=True)
    return out
