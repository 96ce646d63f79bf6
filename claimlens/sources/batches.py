"""Sources, batch bookkeeping and batch tables.

Raw and cleaned batches live in Parquet tables partitioned by ``batch_id``
(replace-by-id = dynamic partition overwrite). Batch metadata is a small
append-only log whose newest non-null value per field wins, so an update
never rewrites files that readers may be reading.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlens.operators.positions import assign_batches, with_row_index
from claimlens.session import freed_shuffles, packed
from claimlens.sources.csvfiles import read_sources
from claimlens.sources.metadata import COMPACT_FROM, META_FIELDS, METADATA_SCHEMA, append_metadata, compact, read_metadata  # noqa: F401


# ---- S1 -------------------------------------------------------------------
def read_policies(spark: SparkSession, paths, schema: T.StructType | None) -> DataFrame:
    """CSV by its header: the columns of ``schema`` by name (absent: NULL; a bad
    value: NULL, never an error), then the others with inferred types. pandas' NA tokens
    are NULL, quotes may be doubled, quoted values may hold line ends (``csvfiles``).

    Dates stay strings here; P1/P2 parse them.
    """
    return read_sources(spark, [paths], schema).drop("source_ord", "row_index")


def read_ordered(spark: SparkSession, paths: list[str], schema: T.StructType | None) -> DataFrame:
    """S1 and S2 for files: each CSV in file order, one after the other, with one
    position across all of them and no sort."""
    return read_sources(spark, paths, schema).drop("source_ord")


# ---- S2, S3 ----------------------------------------------------------------
def union_sources(sources: list[DataFrame], order_cols: list[str],
                  name: str = "row_index") -> DataFrame:
    """Ordered concatenation, columns aligned by name (absent -> NULL),
    one contiguous global position across all sources."""
    out = None
    for k, s in enumerate(sources):
        s = s.withColumn("source_ord", F.lit(k))
        out = s if out is None else out.unionByName(s, allowMissingColumns=True)
    return with_row_index(out, ["source_ord", *order_cols], name)


def source_sizes(df: DataFrame) -> DataFrame:
    """S3: rows per source plus the total (``source_ord`` NULL)."""
    return df.rollup("source_ord").agg(F.count(F.lit(1)).alias("size"))


# ---- S7, S9, S11 ------------------------------------------------------------
def next_batch_id(table: DataFrame, batch_col: str = "batch_id") -> DataFrame:
    """``max(id) + 1``, 0 for an empty table (one row)."""
    return table.agg(F.coalesce(F.max(batch_col) + 1, F.lit(0)).cast("int").alias("next_batch_id"))


def next_source_offset(meta: DataFrame, sources_name: str) -> DataFrame:
    """``index_in_source + size`` of the batch with the largest
    ``index_in_source`` for that source list; 0 if none (one row)."""
    m = meta.where(F.col("sources") == sources_name)
    return m.agg(F.coalesce(F.max_by(F.col("index_in_source") + F.col("size"), F.col("index_in_source")),
                            F.lit(0)).cast("long").alias("next_source_offset"))


def batch_metadata(batches: DataFrame, sources_name: str, version: str,
                   index_col: str = "row_index") -> DataFrame:
    """Metadata rows of freshly cut batches (one per batch)."""
    return (batches.groupBy("batch_id")
                   .agg(F.min(index_col).alias("index_in_source"), F.count(F.lit(1)).alias("size"))
                   .select(F.col("batch_id").cast("int"), F.current_timestamp().alias("ts"),
                           F.lit(sources_name).alias("sources"), "index_in_source", "size",
                           F.lit(version).alias("data_collection_version"),
                           F.lit(None).cast("string").alias("data_analysis_version")))


def upsert_metadata(meta: DataFrame, updates: DataFrame) -> DataFrame:
    """Fields present (non-NULL) in ``updates`` replace the stored ones;
    unknown ids are inserted (full outer join on ``batch_id``)."""
    fields = [c for c in META_FIELDS if c in meta.columns]
    u = updates.select("batch_id", *[(F.col(c) if c in updates.columns else F.lit(None).cast(meta.schema[c].dataType)).alias(f"_u_{c}")
                                     for c in fields])
    j = meta.join(u, "batch_id", "full_outer")
    return j.select("batch_id", *[F.coalesce(F.col(f"_u_{c}"), F.col(c)).alias(c) for c in fields])


def contiguous_batches(table: DataFrame, batch_col: str = "batch_id") -> DataFrame:
    """Batches 0, 1, 2, ... up to the first missing id: a range filter whose
    upper end is a scalar subquery over the ids, so nothing is joined."""
    present = table.select(batch_col).distinct().where(F.col(batch_col) >= 0)
    nxt = present.select((F.col(batch_col) + 1).alias(batch_col)).unionByName(table.sparkSession.sql(f"SELECT 0 AS {batch_col}"))
    first_gap = nxt.join(present, batch_col, "left_anti").agg(F.min(batch_col)).scalar()
    return table.where((F.col(batch_col) >= 0) & (F.col(batch_col) < first_gap))


# ---- S5, S6, S8, S10 --------------------------------------------------------
def write_batches(df: DataFrame, path: str, batch_col: str = "batch_id", cluster: bool = True) -> None:
    """Insert or replace whole batches (dynamic partition overwrite). Rows are
    clustered by batch first, so a batch is a file or few, not one for each task;
    AQE splits a batch that is large."""
    if cluster:
        df = df.hint("rebalance", F.col(batch_col))
    with freed_shuffles(df.sparkSession), packed(df.sparkSession):
        (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy(batch_col).parquet(path))


def read_batch_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The table, or None where there is none yet. Any other error is an error."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def read_batch(spark: SparkSession, path: str, batch_id: int, batch_col: str = "batch_id") -> DataFrame:
    """One batch; the partition filter prunes every other directory."""
    return spark.read.parquet(path).where(F.col(batch_col) == batch_id)


def read_batches(spark: SparkSession, path: str, batch_col: str = "batch_id") -> DataFrame:
    """S11 on a stored table."""
    return contiguous_batches(spark.read.parquet(path), batch_col)


def ingest(spark: SparkSession, rows: DataFrame, raw_path: str, meta_path: str, sources_name: str,
           batch_size: int, version: str = "1.0.0", index_col: str = "row_index", chunk: int | None = None) -> int:
    """Resume at the stored offset of ``sources_name`` and cut the rest into
    batches numbered after the last recorded id.

    Ids and offset both come from the metadata, which is written after the data: a
    run that dies between the two is repeated over the same partitions. With
    ``chunk``, so many batches are written and recorded at a time; the first chunk
    that fails ends the run, and the next run resumes there.

    Returns the number of batches written; a re-run writes none.
    """
    meta = read_metadata(spark, meta_path)
    offset = next_source_offset(meta, sources_name).first()[0]
    start = next_batch_id(meta).first()[0]
    last = rows.agg(F.max(index_col)).first()[0]
    total = 0 if last is None or last < offset else -(-(last + 1 - offset) // batch_size)
    todo = assign_batches(rows, batch_size, start_row=offset, start_batch=start, index_col=index_col)
    for lo in range(start, start + total, chunk or max(total, 1)):
        hi = min(lo + (chunk or total), start + total)
        own = (F.col("batch_id") >= lo) & (F.col("batch_id") < hi)
        write_batches(todo.where(own), raw_path)
        written = spark.read.parquet(raw_path).where(own)   # prunes to this chunk's partitions
        append_metadata(spark, meta_path, batch_metadata(written, sources_name, version, index_col))
    compact(spark, meta_path, COMPACT_FROM)
    return total


# ---- S12 ------------------------------------------------------------------------
def load_cleaned(spark: SparkSession, cleaned_table: str, cleaned_csv: str | None, raw_paths: list[str],
                 csv_schema: T.StructType | None = None) -> DataFrame:
    """The cleaned batches (contiguous prefix, all batches together),
    else a cleaned CSV, else the **last** raw source. CSV is read by S1, so its missing
    tokens and types are the same with and without a schema."""
    t = read_batch_table(spark, cleaned_table)
    if t is not None and t.limit(1).count() > 0:
        return contiguous_batches(t)
    if cleaned_csv:
        try:
            return read_policies(spark, cleaned_csv, csv_schema)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    last = raw_paths[-1]
    return read_policies(spark, last, csv_schema) if last.endswith(".csv") else spark.read.parquet(last)
