"""Disk that a job takes: shuffle files go with the write that made them, nothing is kept twice."""

import time

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from claimlens.operators import models as M
from claimlens.operators import prepare as E
from claimlens.operators.positions import with_row_index
from claimlens.session import freed_shuffles, stored, together
from claimlens.sources import batches as SB


def _shuffles(spark) -> set:
    """Shuffle files that lie on the disk of a local session."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for i in range(files.size()) if (n := files.apply(i).getName()).startswith("shuffle_")}


def _left(spark, before: set) -> set:
    """What is there beyond ``before``; files are removed in the background."""
    end = time.time() + 20
    while (left := _shuffles(spark) - before) and time.time() < end:
        time.sleep(0.2)
    return left


def _prepared(df):
    return E.Prepared(*[df] * 6, [], [], [])


@pytest.mark.parametrize("write", [
    lambda df, path: stored(df, "shuffled"),
    lambda df, path: with_row_index(df, ["k", "id"]),
    lambda df, path: SB.write_batches(df.withColumn("batch_id", F.col("k") % 3), path),
    lambda df, path: E.save_prepared(_prepared(df), path)])
def test_a_write_frees_its_shuffles(spark, tmp_path, write):
    df = spark.range(5000).withColumn("k", F.col("id") % 7).repartition(5, "k")
    before = _shuffles(spark)
    write(df, str(tmp_path / "t"))
    assert not _left(spark, before)


def test_a_setting_of_the_session_stays_and_others_are_taken_back(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    assert key not in spark.conf.getAll
    with freed_shuffles(spark):
        assert spark.conf.get(key) == "true"
    assert key not in spark.conf.getAll
    spark.conf.set(key, "false")
    try:
        with freed_shuffles(spark):
            assert spark.conf.get(key) == "false"
        assert spark.conf.get(key) == "false"
    finally:
        spark.conf.unset(key)


def test_stored_rows_are_packed(spark, tmp_path):
    """Tables of whole rows take zstd; the rows read back are the same."""
    df = spark.range(1000).select(F.col("id").alias("row_index"), (F.col("id") / 7).alias("x"), F.col("id").alias("CLAIM_PAID"), (F.col("id") % 2).alias("batch_id"))
    M.fit_model("knn", df, ["x"], str(tmp_path / "knn"))
    SB.write_batches(df, str(tmp_path / "batches"))
    for name in ("knn", "batches"):
        (one, *_) = (tmp_path / name).rglob("*.parquet")
        assert pq.ParquetFile(one).metadata.row_group(0).column(0).compression == "ZSTD"
        assert spark.read.parquet(str(tmp_path / name)).agg(F.sum("x"), F.count("*")).first() == df.agg(F.sum("x"), F.count("*")).first()


def test_a_fit_keeps_no_copy_of_its_rows(spark, monkeypatch):
    df = spark.range(200).select((F.col("id") % 9).cast("double").alias("x"), (F.col("id") % 5).cast("double").alias("y"), (2.0 * (F.col("id") % 9) + 1).alias("CLAIM_PAID"))
    monkeypatch.setattr(type(df), "persist", lambda self, *a: pytest.fail("rows were kept"))
    m = M.fit_linear(df, ["x", "y"])
    assert abs(m.weights["x"] - 2) < 1e-2 and abs(m.bias - 1) < 1e-1
    assert M.fit_tree(df, ["x", "y"]).depth >= 1


def test_jobs_side_by_side_share_what_they_set(spark):
    """Results come in order, an error of one is raised, and the last that holds a setting takes it back."""
    import threading
    key, both = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", threading.Barrier(2, timeout=60)

    def job(k):
        with freed_shuffles(spark):
            both.wait()
            if k:
                time.sleep(0.5)          # the other has left
            return k, spark.conf.get(key), spark.range(k + 3).count()
    assert together(spark, [lambda: job(0), lambda: job(1)]) == [(0, "true", 3), (1, "true", 4)]
    assert key not in spark.conf.getAll
    with pytest.raises(ValueError, match="broken"):
        together(spark, [lambda: 1, lambda: (_ for _ in ()).throw(ValueError("broken"))])
