"""The linear model from stored batch states."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimlens.operators import gram as G
from claimlens.operators import models as M
from claimlens.session import scratch_dir


def frame(spark):
    df = spark.range(900).select((F.col("id") % 5).cast("int").alias("batch_id"), F.col("id").alias("row_index"), F.rand(1).alias("a"), F.rand(2).alias("b"), F.rand(3).alias("e"))
    return df.withColumn("CLAIM_PAID", 3 * F.col("a") - 2 * F.col("b") + 1 + F.col("e") / 10)


def plain(df, cols):
    """The same objective solved by NumPy over all rows."""
    t = df.select(*cols, "CLAIM_PAID").toPandas()
    x, y = t[cols].to_numpy(), t.CLAIM_PAID.to_numpy()
    c = x - x.mean(0)
    w = np.linalg.solve(c.T @ c / len(c) + M.L2 * np.eye(len(cols)), c.T @ (y - y.mean()) / len(c))
    return M.LinearModel(dict(zip(cols, w)), y.mean() - x.mean(0) @ w)


def close(m, n, by=1e-9):
    assert m.bias == pytest.approx(n.bias, abs=by) and m.weights == pytest.approx(n.weights, abs=by)


def test_refit_equals_the_full_fit_in_any_order(spark):
    df, cols = frame(spark), ["a", "b"]
    full = plain(df, cols)
    close(full, M.fit_linear(df, cols), 5e-4)    # the library's fit scales the penalty by the target's spread
    for order in ([0, 1, 2, 3, 4], [4, 2, 0, 3, 1]):
        path = scratch_dir(spark, "gram")
        for k in order:
            m = G.refit(spark, path, df.where(F.col("batch_id") == k), cols)
        close(m, full)
    # a batch that comes again replaces itself
    close(G.refit(spark, path, df.where("batch_id = 3"), cols), full)
    close(G.refit(spark, path, None, cols), full)
    # half of a batch in its place: as if the other half had never been
    close(G.refit(spark, path, df.where("batch_id = 3 and row_index < 400"), cols), plain(df.where("batch_id <> 3 or row_index < 400"), cols))


def test_only_new_batches_are_read(spark):
    """The states alone hold what is needed of older batches: their rows are gone."""
    df, cols, path = frame(spark), ["a", "b"], scratch_dir(spark, "gram")
    G.refit(spark, path, df.where("batch_id < 4"), cols)
    m = G.refit(spark, path, df.where("batch_id = 4"), cols)
    assert sorted(r[0] for r in spark.read.parquet(path).select("batch_id").distinct().collect()) == [0, 1, 2, 3, 4]
    close(m, plain(df, cols))


def test_missing_values_and_no_rows(spark):
    df = frame(spark).withColumn("a", F.when(F.col("row_index") != 7, F.col("a")))
    with pytest.raises(Exception, match="must not be missing"):
        G.gram(df, ["a"]).collect()
    with pytest.raises(ValueError):
        G.refit(spark, scratch_dir(spark, "gram"), None, ["a"])
    assert G.gram(df.limit(0), ["a"]).count() == 0
    constant = frame(spark).withColumn("c", F.lit(2.0))
    close(G.solve(G.gram(constant, ["a", "c"]), ["a", "c"]), plain(constant, ["a", "c"]))
