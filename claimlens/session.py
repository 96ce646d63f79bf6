"""Spark session and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager, nullcontext

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


def get_spark(master: str | None = None, app: str = "claimlens",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Session with AQE on, UTC time zone and no UI.

    On a cluster ``master`` stays None and the submit command decides; the
    shuffle partition count then comes from the cluster config (AQE coalesces).
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if master and master.startswith("local"):
        conf["spark.driver.memory"] = "16g"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session; only a local session without the setting gets a
    fresh private folder (tests). A cluster session without it is an error:
    a machine-local folder is not visible to other executors.
    """
    sc = spark.sparkContext
    if d := sc.getCheckpointDir():      # set already; setting it again would nest a folder in it
        return d.rstrip("/")
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not _is_local(spark):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="claimlens-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir().rstrip("/")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared checkpoint folder."""
    root = checkpoint_root(spark)
    path = f"{root}/claimlens/{name}-{uuid.uuid4().hex[:12]}"
    if path.startswith("/") and _is_local(spark):
        os.makedirs(os.path.dirname(path), exist_ok=True)
    return path


#: Shuffled bytes that AQE gives a task which sorts whole rows: these are compressed, and about four times as large where they are sorted.
SORTED_BYTES = "16m"
_ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_CODEC = "spark.sql.parquet.compression.codec"


#: Settings that are held now: how many hold each, and whether the session had made it.
_HELD: dict = {}
_HOLDING = threading.Lock()


@contextmanager
def _unless_set(spark: SparkSession, key: str, value: str):
    """A setting for what runs inside; one that the session has made itself stays. Threads that hold
    the same setting share it, the last one takes it back."""
    at = (spark, key)
    with _HOLDING:
        n, own = _HELD.get(at) or (0, key in spark.conf.getAll)
        if not n and not own:
            spark.conf.set(key, value)
        _HELD[at] = n + 1, own
    try:
        yield
    finally:
        with _HOLDING:
            n, own = _HELD.pop(at)
            if n > 1:
                _HELD[at] = n - 1, own
            elif not own:
                spark.conf.unset(key)


#: Independent jobs that run side by side.
SIDE_BY_SIDE = 2


def together(spark: SparkSession, jobs: list) -> list:
    """Results of independent jobs (functions without arguments), ``SIDE_BY_SIDE`` at a time: a job of many
    small steps leaves cores idle that another can use. An error of one is raised when all have ended."""
    with ThreadPoolExecutor(SIDE_BY_SIDE) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]]


def small_sorts(spark: SparkSession):
    """What runs inside gets partitions of about ``SORTED_BYTES``, so that their sorts don't
    spill beside other tasks; a size that the session has set itself stays."""
    return _unless_set(spark, _ADVISORY, SORTED_BYTES)


def freed_shuffles(spark: SparkSession):
    """Writes inside give the disk of their shuffles back when they are over, not when the
    driver happens to collect its garbage: a write plans its own shuffles, nothing reads them again."""
    return _unless_set(spark, _CLEANUP, "true")


def packed(spark: SparkSession):
    """Parquet tables written inside take zstd, a smaller form than Spark's default codec."""
    return _unless_set(spark, _CODEC, "zstd")


def stored(df, name: str, sorts: bool = False):
    """Write to a new table in the shared folder and read it back: the lineage is
    cut and a lost executor costs no recomputation. ``sorts`` says that the job sorts
    whole rows (``small_sorts``) and stores them (``packed``)."""
    path, spark = scratch_dir(df.sparkSession, name), df.sparkSession
    with freed_shuffles(spark), small_sorts(spark) if sorts else nullcontext(), packed(spark) if sorts else nullcontext():
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
