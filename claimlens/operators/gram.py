"""Linear model from additive statistics (M4): one Gram matrix per batch.

A batch's state is the upper triangle of ZᵀZ with Z = (1, features, target). States add
up, so a model over all batches is solved from stored states: new batches are read,
old ones are not, and the order of arrival does not matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlens.operators.models import L2, LinearModel
from claimlens.sources.batches import read_batch_table, write_batches

ONE = "__one__"


def gram(df: DataFrame, cols: list[str], label: str = "CLAIM_PAID", batch_col: str = "batch_id") -> DataFrame:
    """(batch_col, term1, term2, value): sums of products of the terms (1, ``cols``, ``label``),
    term1 not after term2, over the rows of each batch. Rows with a missing value
    are an error, as everywhere in training. A task adds up its rows of a batch first,
    so the shuffle moves one row per task, batch and pair of terms."""
    terms = [ONE, *cols, label]
    i, j = np.triu_indices(len(terms))

    def run(batches):
        sums: dict = {}
        for b in batches:
            keys = b.column(0).to_numpy(zero_copy_only=False)
            x = np.column_stack([np.ones(b.num_rows), *[c.to_numpy(zero_copy_only=False).astype(float) for c in b.columns[1:]]])
            if np.isnan(x).any():
                raise ValueError("features and target must not be missing")
            for k in np.unique(keys):
                own = x[keys == k]
                sums[k] = sums.get(k, 0) + own.T @ own
        for k, s in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([k] * len(i), pa.int64()), pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(s[i, j])],
                                             names=["b", "i", "j", "value"])

    parts = df.select(F.col(batch_col).cast("long"), *[F.col(c).cast("double") for c in terms[1:]]).mapInArrow(run, "b long, i int, j int, value double")
    names = F.array(*[F.lit(t) for t in terms])
    return parts.groupBy("b", "i", "j").agg(F.sum("value").alias("value")).select(
        F.col("b").cast(df.schema[batch_col].dataType).alias(batch_col), names[F.col("i")].alias("term1"), names[F.col("j")].alias("term2"), "value")


def solve(states: DataFrame, cols: list[str], label: str = "CLAIM_PAID", l2: float = L2) -> LinearModel:
    """The linear model of the L2-penalised squared loss (bias unpenalised) over all rows
    that ``states`` hold: d² numbers reach the driver, however many rows and batches."""
    terms = [ONE, *cols, label]
    at = {t: k for k, t in enumerate(terms)}
    g = np.zeros((len(terms), len(terms)))
    for r in states.groupBy("term1", "term2").agg(F.sum("value").alias("value")).collect():
        g[at[r["term1"]], at[r["term2"]]] = g[at[r["term2"]], at[r["term1"]]] = r["value"]
    n = g[0, 0]
    if not n:
        raise ValueError("no rows to fit on")
    mean = g[0] / n
    cov = g / n - np.outer(mean, mean)
    w = np.linalg.solve(cov[1:-1, 1:-1] + l2 * np.eye(len(cols)), cov[1:-1, -1])
    return LinearModel({c: float(v) for c, v in zip(cols, w, strict=True)}, float(mean[-1] - w @ mean[1:-1]))


def refit(spark: SparkSession, path: str, new: DataFrame | None, cols: list[str], label: str = "CLAIM_PAID", batch_col: str = "batch_id") -> LinearModel:
    """Store the states of the batches in ``new`` (a batch that was there before is replaced) and
    solve over all that are stored."""
    if new is not None:
        write_batches(gram(new, cols, label, batch_col), path, batch_col)
    states = read_batch_table(spark, path)
    if states is None:
        raise ValueError("no rows to fit on")
    return solve(states, cols, label)
