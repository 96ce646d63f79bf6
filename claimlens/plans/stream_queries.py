"""Registered queries: Structured Streaming forms (T1-T4). Each one streams
files that Spark derives from the given tables (one file per batch) with
``trigger(availableNow=True)`` and reads the sink back; the result must
equal the batch computation (the oracle)."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimlens.plans.quality_queries import A5_SQL
from claimlens.plans.registry import query, r6
from claimlens.session import scratch_dir, stored
from claimlens.sources.fixtures import policies, read_table, with_policies
from claimlens.streaming import jobs as T


_SOURCES: dict = {}
#: Rows of a file of the policies' source; a batch with more has more than two files.
FILE_ROWS = 8_000_000


def file_of(sizes: dict, per_file: int) -> tuple[Column, int]:
    """The file of a row, two and more for each batch of ``sizes`` (rows by id), and their number: no two
    batches or parts of one share a task, and no task has much more than ``per_file`` rows."""
    parts = {k: max(2, -(-n // per_file)) for k, n in sizes.items()}
    first = dict(zip(parts, accumulate(parts.values(), initial=0), strict=False))
    at = F.coalesce(*[F.when(F.col("batch_id").eqNullSafe(F.lit(k)), first[k] + F.pmod(F.xxhash64("tie1", "tie2"), F.lit(n))) for k, n in parts.items()], F.lit(0))
    return at.cast("int"), max(1, sum(parts.values()))


def _policy_files(spark, sf_dir):
    """The policies view as a file source, two files and more per batch
    (written once per session; each stream keeps its own checkpoint)."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), "policies")
    if key not in _SOURCES:
        src = scratch_dir(spark, "policy_files")
        p = policies(spark, sf_dir, with_index=False)
        at, n = file_of({r[0]: r[1] for r in p.groupBy("batch_id").count().collect()}, FILE_ROWS)     # one number per batch
        p.repartitionById(n, at).write.parquet(src)     # a task has rows of one batch: not sorted by it
        _SOURCES[key] = src
    src = _SOURCES[key]
    return src, spark.read.parquet(src).schema


@query("t1_stream_ingest", with_policies("SELECT OBJECT_ID, tie1, tie2, PREMIUM FROM policies", indexed=False))
def t1_stream_ingest(spark, sf_dir):
    src, schema = _policy_files(spark, sf_dir)
    raw, meta, ckpt = (scratch_dir(spark, n) for n in ("raw", "meta", "ckpt"))
    T.stream_ingest(spark, src, schema, raw, meta, ckpt, "policies", files_per_batch=2)
    # a second run over the same checkpoint must add nothing
    T.stream_ingest(spark, src, schema, raw, meta, ckpt, "policies")
    return spark.read.parquet(raw).select("OBJECT_ID", "tie1", "tie2", "PREMIUM")


@query("t2_stream_quality", A5_SQL)
def t2_stream_quality(spark, sf_dir):
    src, schema = _policy_files(spark, sf_dir)
    out, ckpt = scratch_dir(spark, "quality_stream"), scratch_dir(spark, "ckpt")
    return spark.read.parquet(T.stream_quality(spark, src, schema, out, ckpt, files_per_batch=6))


@query("t2_stream_analyse", __import__("claimlens.plans.profile_queries", fromlist=["A17_SQL"]).A17_SQL)
def t2_stream_analyse(spark, sf_dir):
    """Per micro-batch analysis; the drift rows appended over all epochs equal the batch drift report."""
    src, schema = _policy_files(spark, sf_dir)
    root, ckpt = scratch_dir(spark, "analyse_stream"), scratch_dir(spark, "ckpt")
    paths = T.stream_analyse(spark, src, schema, root, ckpt, order_cols=("tie1", "tie2", "tie3"), files_per_batch=6)
    return spark.read.parquet(paths["drift"]).withColumn("psi", r6("psi"))


# ---- T3, T4: events in time order, some late, some delivered twice ---------------------
SLICES, DELAY_HOURS = 6, 6
# An event arrives with its time slice; every 20th comes two slices late, every 10th of
# the others is delivered again one slice later.
_ARRIVED_SQL = f"""
WITH span AS (SELECT min(ts) AS lo, epoch(max(ts)) - epoch(min(ts)) + 1 AS secs FROM events),
own AS (SELECT e.*, CAST(floor((epoch(ts) - epoch(lo)) * {SLICES} / secs) AS INTEGER) AS slice FROM events e, span),
arrived AS (SELECT *, CASE WHEN event_id % 20 = 0 THEN least(slice + 2, {SLICES - 1}) ELSE slice END AS arrival FROM own
            UNION ALL SELECT *, slice + 1 AS arrival FROM own WHERE event_id % 20 = 10 AND slice + 1 < {SLICES}),
seen AS (SELECT arrival, max(max(ts)) OVER (ORDER BY arrival) - INTERVAL {DELAY_HOURS} HOUR AS mark FROM arrived GROUP BY arrival),
-- an epoch drops what lies before the mark that the last but one epoch left
timed AS (SELECT a.*, s.mark AS late_mark FROM arrived a LEFT JOIN seen s ON s.arrival = a.arrival - 2)"""


def _event_slices(spark, sf_dir):
    """The events as a file source, one file for each arrival slice, written one after the other."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), "slices")
    if key not in _SOURCES:
        src = scratch_dir(spark, "event_slices")
        # event time must be a (UTC) TIMESTAMP for watermarks
        e = read_table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
        sec = F.unix_micros("ts") / 1_000_000
        lo, hi = e.agg(F.min(sec)).scalar(), e.agg(F.max(sec)).scalar()
        own = e.withColumn("slice", F.floor((sec - lo) * SLICES / (hi - lo + 1)).cast("int"))
        arrived = own.withColumn("arrival", F.when(F.col("event_id") % 20 == 0, F.least(F.col("slice") + 2, F.lit(SLICES - 1))).otherwise(F.col("slice")))
        again = own.where((F.col("event_id") % 20 == 10) & (F.col("slice") + 1 < SLICES)).withColumn("arrival", F.col("slice") + 1)
        arrived = stored(arrived.unionByName(again), "arrived")
        for k in range(SLICES):
            arrived.where(F.col("arrival") == k).coalesce(1).write.mode("append").parquet(src)
        _SOURCES[key] = src
    return _SOURCES[key], spark.read.parquet(_SOURCES[key]).schema


@query("t3_stream_dedup", _ARRIVED_SQL + """
SELECT event_id, user_id, min(arrival) AS arrival FROM timed WHERE late_mark IS NULL OR ts > late_mark GROUP BY event_id, user_id""")
def t3_stream_dedup(spark, sf_dir):
    """One slice an epoch: of an event delivered twice the first arrival is kept, what
    comes behind the watermark is dropped."""
    src, schema = _event_slices(spark, sf_dir)
    out, ckpt = scratch_dir(spark, "dedup_out"), scratch_dir(spark, "ckpt")
    T.stream_dedup(spark, src, schema, ["event_id"], "ts", f"{DELAY_HOURS} hours", out, ckpt, files_per_batch=1)
    return spark.read.parquet(out).select("event_id", "user_id", "arrival")


@query("t4_stream_profile", _ARRIVED_SQL + f""",
kept AS (SELECT *, date_trunc('day', ts) AS day FROM timed
         WHERE late_mark IS NULL OR date_trunc('day', ts) + INTERVAL 1 DAY > late_mark),
final AS (SELECT max(ts) - INTERVAL {DELAY_HOURS} HOUR AS mark FROM events)
SELECT CAST(day AS DATE) AS day, event_type, count(*) AS rows, count(*) - count(value) AS nulls, round(avg(value), 6) AS mean
FROM kept, final WHERE day + INTERVAL 1 DAY <= mark GROUP BY ALL""")
def t4_stream_profile(spark, sf_dir):
    """One slice an epoch, append mode: a day is emitted once the watermark has passed
    it; rows that come later are dropped, days still open stay in the state."""
    src, schema = _event_slices(spark, sf_dir)
    out, ckpt = scratch_dir(spark, "profile_out"), scratch_dir(spark, "ckpt")
    T.stream_profile(spark, src, schema, "ts", "1 day", f"{DELAY_HOURS} hours", "event_type", "value", out, ckpt, files_per_batch=1)
    r = spark.read.parquet(out)
    return r.select(F.to_date(F.col("w.start")).alias("day"), "event_type", "rows", "nulls", r6("mean").alias("mean"))
