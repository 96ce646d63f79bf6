"""Structured Streaming forms of ingest and monitoring.

* T1 ``stream_ingest``: files -> micro-batches; each micro-batch becomes one
  stored batch whose id is the epoch id, written with dynamic partition
  overwrite, so a replayed epoch replaces itself (idempotent, at-least-once
  source + idempotent sink). The checkpoint replaces the reference's
  "next offset" query.
* T2 ``stream_quality``, ``stream_analyse``: the batch operators run inside
  ``foreachBatch`` on all that arrived so far of the batches an epoch touches;
  outputs are replaced batch by batch.
* T3 ``stream_dedup``: keep-first per key within an event-time watermark;
  state is bounded by the watermark.
* T4 ``stream_profile``: count, nulls and mean per event-time window and
  type, late rows dropped by the watermark.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, LongType, StructField, StructType

from claimlens.operators.quality import quality_summary
from claimlens.settings import DEFAULTS, Settings
from claimlens.sources import batches as SB


def _file_stream(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet",
                 max_files: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        r = r.option("header", True)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(path)


def _checkpoint_guard(spark: SparkSession, checkpoint: str, table_path: str) -> None:
    """Refuse an empty checkpoint over a non-empty table: epochs would
    restart at 0 and replace stored batches. Works on any file system the
    session can read (the offsets log is plain text files)."""
    try:
        has_ckpt = spark.read.text(f"{checkpoint}/offsets").limit(1).count() > 0
    except AnalysisException as e:   # no offsets log yet
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        has_ckpt = False
    table = SB.read_batch_table(spark, table_path)
    if not has_ckpt and table is not None and table.limit(1).count() > 0:
        raise RuntimeError("empty checkpoint over a non-empty batch table; refusing to restart epochs at 0")


def stream_ingest(spark: SparkSession, source_path: str, schema: StructType, raw_path: str, meta_path: str,
                  checkpoint: str, sources_name: str, fmt: str = "parquet", files_per_batch: int = 1,
                  version: str = "1.0.0"):
    """Run until the available files are consumed (``availableNow``)."""
    _checkpoint_guard(spark, checkpoint, raw_path)
    stream = _file_stream(spark, source_path, schema, fmt, files_per_batch)

    def write(batch: DataFrame, epoch_id: int) -> None:
        b = batch.withColumn("batch_id", F.lit(int(epoch_id)))
        SB.write_batches(b, raw_path, cluster=False)   # one id: clustering would make one task of it
        meta = (b.agg(F.count(F.lit(1)).alias("size"))
                 .select(F.lit(int(epoch_id)).cast("int").alias("batch_id"), F.current_timestamp().alias("ts"),
                         F.lit(sources_name).alias("sources"), F.lit(None).cast("long").alias("index_in_source"),
                         "size", F.lit(version).alias("data_collection_version"),
                         F.lit(None).cast("string").alias("data_analysis_version")))
        SB.append_metadata(spark, meta_path, meta)

    q = (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
               .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def rows_of_batches(spark: SparkSession, path: str, ids: list, schema: StructType) -> DataFrame:
    """The stored rows of some batches, read from their own directories: neither what is
    listed nor what is read grows with the number of stored batches."""
    if not ids:
        return spark.createDataFrame([], schema)
    if not isinstance(schema["batch_id"].dataType, IntegralType):   # other ids are escaped in names
        return spark.read.schema(schema).parquet(path).where(F.col("batch_id").isin(ids))
    return spark.read.schema(schema).option("basePath", path).parquet(*[f"{path}/batch_id={i}" for i in ids])


def _stage(batch: DataFrame, epoch_id: int, path: str) -> tuple[DataFrame, list]:
    """Keep the micro-batch under (batch_id, epoch), so a replayed epoch replaces
    itself, and return the whole of what arrived so far of every batch it touches,
    with the touched ids (one number per batch of the micro-batch). A batch may come
    in any number of files and epochs; rows without a batch id belong to none."""
    spark = batch.sparkSession
    batch.withColumn("epoch", F.lit(int(epoch_id))).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy("batch_id", "epoch").parquet(path)
    touched = sorted(r[0] for r in batch.select("batch_id").distinct().collect() if r[0] is not None)
    whole = rows_of_batches(spark, path, touched, StructType([*batch.schema.fields, StructField("epoch", LongType())]))
    return whole.select(*batch.columns), touched


def _replace(df: DataFrame, path: str) -> None:
    """Rows of whole batches: what was stored for these batches before is replaced."""
    SB.write_batches(df, path)


def stream_quality(spark: SparkSession, source_path: str, schema: StructType, root: str, checkpoint: str,
                   settings: Settings = DEFAULTS, fmt: str = "parquet", files_per_batch: int = 1):
    """The quality summary of every batch, kept up to date as its files arrive
    (one row per ``batch_id`` below ``root``/quality_summary, whose path is returned)."""
    stream = _file_stream(spark, source_path, schema, fmt, files_per_batch)
    out = f"{root}/quality_summary"

    def analyse(batch: DataFrame, epoch_id: int) -> None:
        whole, _ = _stage(batch, epoch_id, f"{root}/arrived")
        _replace(quality_summary(whole, settings=settings), out)

    q = (stream.writeStream.foreachBatch(analyse).option("checkpointLocation", checkpoint)
               .trigger(availableNow=True).start())
    q.awaitTermination()
    return out


def _reference(spark: SparkSession, root: str):
    """The newest drift reference both of whose tables are there, else None."""
    bins, shares = (SB.read_batch_table(spark, f"{root}/{n}") for n in ("ref_bins", "ref_shares"))
    if bins is None or shares is None:
        return None
    newest = shares.select("epoch").intersect(bins.select("epoch")).agg(F.max("epoch")).first()[0]
    if newest is None:
        return None
    return tuple(t.where(F.col("epoch") == newest).drop("epoch") for t in (bins, shares))


def stream_analyse(spark: SparkSession, source_path: str, schema: StructType, root: str, checkpoint: str,
                   order_cols=("row_index",), settings: Settings = DEFAULTS, fmt: str = "parquet",
                   files_per_batch: int = 1):
    """The analysis loop per arriving micro-batch: quality summary,
    keep-first dedup, features, cleaned batch table, and drift.

    Every output holds whole batches and is replaced batch by batch, from all that
    arrived of a batch so far; so a batch may come in several files, and a replayed
    epoch changes nothing. The drift reference is fitted once all reference batches
    are stored, and again whenever one of them grows, and all drift follows from it
    then, also that of batches that waited for it; any other epoch works on the batches
    it touches alone and reads nothing else. So the result does not depend on the order
    in which files arrive, and the cost of an epoch not on what is stored."""
    from claimlens.functions.features import create_features
    from claimlens.operators.dedup import dedup_first
    from claimlens.operators.drift import detect_drift, fit_reference
    stream = _file_stream(spark, source_path, schema, fmt, files_per_batch)
    paths = {n: f"{root}/{n}" for n in ("arrived", "quality_summary", "cleaned_batches", "ref_bins", "ref_shares", "drift")}
    first_scored = settings.reference_batches

    def analyse(batch: DataFrame, epoch_id: int) -> None:
        whole, touched = _stage(batch, epoch_id, paths["arrived"])
        _replace(quality_summary(whole, settings=settings), paths["quality_summary"])
        clean = create_features(dedup_first(whole, list(settings.dedup_keys), tuple(order_cols)), settings)
        _replace(clean, paths["cleaned_batches"])
        grown = any(i < first_scored for i in touched)
        if grown:
            stored = spark.read.parquet(paths["cleaned_batches"])
            have = stored.where(F.col("batch_id") < first_scored).select("batch_id").distinct().count()
            if have < first_scored:
                return
            for table, name in zip(fit_reference(stored, settings), ("ref_bins", "ref_shares"), strict=True):
                table.withColumn("epoch", F.lit(int(epoch_id))).write.mode("overwrite").option(
                    "partitionOverwriteMode", "dynamic").partitionBy("epoch").parquet(paths[name])
        ref = _reference(spark, root)
        if ref is None:
            return
        # every scored batch of earlier epochs has its drift from this reference, unless that is new
        todo = stored if grown else rows_of_batches(spark, paths["cleaned_batches"], touched, clean.schema)
        _replace(detect_drift(todo.where(F.col("batch_id") >= first_scored), settings, reference=ref), paths["drift"])

    q = (stream.writeStream.foreachBatch(analyse).option("checkpointLocation", checkpoint)
               .trigger(availableNow=True).start())
    q.awaitTermination()
    return paths


def stream_dedup(spark: SparkSession, source_path: str, schema: StructType, keys: list[str], ts: str,
                 delay: str, out_path: str, checkpoint: str, files_per_batch: int | None = None):
    """First row per key within the watermark (bounded state)."""
    stream = _file_stream(spark, source_path, schema, "parquet", files_per_batch)
    d = stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)
    q = (d.writeStream.format("parquet").option("path", out_path).option("checkpointLocation", checkpoint)
          .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def stream_profile(spark: SparkSession, source_path: str, schema: StructType, ts: str, window: str,
                   delay: str, group: str, value: str, out_path: str, checkpoint: str,
                   files_per_batch: int | None = None, mode: str = "append"):
    """T4: per event-time window and ``group``: rows, missing values and mean
    of ``value``. ``mode="append"`` emits a window once the watermark passes it
    (late rows dropped, state bounded); each epoch's rows replace themselves when
    it is replayed. ``complete`` rewrites the whole result and keeps all windows."""
    stream = _file_stream(spark, source_path, schema, "parquet", files_per_batch)
    agg = (stream.withWatermark(ts, delay)
                 .groupBy(F.window(ts, window).alias("w"), group)
                 .agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col(value).isNull()).alias("nulls"),
                      F.avg(value).alias("mean")))

    def sink(batch: DataFrame, epoch_id: int) -> None:
        if mode == "complete":
            batch.write.mode("overwrite").parquet(out_path)
        else:
            batch.withColumn("epoch", F.lit(int(epoch_id))).write.mode("overwrite").option(
                "partitionOverwriteMode", "dynamic").partitionBy("epoch").parquet(out_path)

    q = (agg.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
            .outputMode(mode).trigger(availableNow=True).start())
    q.awaitTermination()
    return q
