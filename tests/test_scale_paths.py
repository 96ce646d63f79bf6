"""Code paths that only trigger at scale, forced on small data."""

import pytest
from pyspark.sql import functions as F

from claimlens.operators import positions, stats
from claimlens.operators.positions import with_row_index
from claimlens.operators.profile import histogram
from claimlens.operators.quality import flag_outliers, outlier_profile
from claimlens.operators.stats import group_quantiles
from claimlens.sources.fixtures import MISSING_DATE_SENTINEL, cleaned, policies
from tests.conftest import SF_SMALL

ORDER = ["_bk", "OBJECT_ID", "tie1", "tie2", "tie3"]


def _keyed(spark):
    return policies(spark, SF_SMALL, with_index=False, stored=False).withColumn(
        "_bk", F.coalesce("INSR_BEGIN", F.lit(MISSING_DATE_SENTINEL).cast("date")))


def test_positions_whatever_leads(spark):
    """A leading column with two values and a date second (source, date), and one value
    with a third of all rows: positions follow the order, contiguous, in many partitions."""
    df = _keyed(spark).withColumn("source_ord", F.when(F.col("batch_id") < 3, 0).otherwise(1))
    order = ["source_ord", *ORDER]
    got = with_row_index(df, order).select(*order, "row_index").toPandas()
    want = got.sort_values(order, ignore_index=True)
    assert want.row_index.tolist() == list(range(len(want)))
    names = with_row_index(df.select("MAKE", "tie1", "tie2", "tie3"), ["MAKE", "tie1", "tie2", "tie3"]).toPandas()   # strings, nulls first
    names = names.sort_values("row_index", ignore_index=True)
    keys = [(m is not None, m or "", *t) for m, *t in names[["MAKE", "tie1", "tie2", "tie3"]].itertuples(index=False)]
    assert keys == sorted(keys)


def test_positions_spread_a_common_leading_value(spark, monkeypatch):
    kept = []
    store = positions.stored
    monkeypatch.setattr(positions, "stored", lambda df, name: kept.append(store(df, name)) or kept[-1])
    df = spark.range(20_000).select(F.lit(1).alias("lead"), F.date_add(F.lit("2000-01-01").cast("date"), (F.col("id") % 5000).cast("int")).alias("day"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        with_row_index(df, ["lead", "day", "id"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sizes = [r["count"] for r in kept[0].groupBy("_part").count().collect()]
    assert len(sizes) >= 6 and max(sizes) < 20_000 / 3


def test_quantile_candidates_are_bounded(spark, monkeypatch):
    """One group with a continuous column: brackets are cut until a window task sees
    few rows, from the sketch and from the whole range alike, and the value is exact."""
    monkeypatch.setattr(stats, "MAX_CANDIDATES", 100)
    df = spark.range(30_000).select(F.lit(1).alias("g"), (F.rand(3) * 1000).alias("v"))
    probs = [0.25, 0.5, 0.99]
    exact = pytest.approx(tuple(group_quantiles(df, ["g"], "v", probs, method="spark").first()), abs=1e-9)
    assert tuple(group_quantiles(df, ["g"], "v", probs).first()) == exact
    assert tuple(group_quantiles(df, ["g"], "v", probs, accuracy=10, halfwidth=1e-9).first()) == exact
    n = df.count()
    rows = [(1, n, k, 0.0, 1000.0, (n - 1) * p, int((n - 1) * p), int((n - 1) * p) + 1) for k, p in enumerate(probs)]
    whole = spark.createDataFrame(rows, "g int, _n long, k int, _lo double, _hi double, _h double, _i long, _j long")
    nn = df.withColumnRenamed("v", "_v")
    got = stats._narrowed(nn, ["g"], whole, 5000)
    inside = nn.join(F.broadcast(got.select("g", "k", "_lo", "_hi")), "g").where(F.col("_v").between(F.col("_lo"), F.col("_hi"))).groupBy("k").count()
    assert max(r["count"] for r in inside.collect()) <= 100


def test_fact_rows_are_not_shuffled_on_few_keys(spark):
    """Small tables join the facts by a checked broadcast, also where Spark's own
    estimate would not allow one."""
    keep = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold") if spark.conf.get(k, None)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1024")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        c = cleaned(spark, SF_SMALL)
        for df in (outlier_profile(c, ["PREMIUM"]), flag_outliers(c, ["PREMIUM"]), histogram(c, ["PREMIUM"])):
            text = df._jdf.queryExecution().executedPlan().toString()
            assert "BroadcastHashJoin" in text
    finally:
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
        for k, v in keep.items():
            spark.conf.set(k, v)


def test_exact_quantiles_fallback_when_bracket_misses(spark):
    """A coarse sketch misses brackets; the affected groups are recomputed
    exactly, so the result still equals Spark's exact percentile."""
    df = spark.range(5000).select((F.col("id") % 3).alias("g"), ((F.col("id") * 7919) % 1009).cast("double").alias("v"))
    probs = [0.1, 0.5, 0.9]
    exact = {r.g: tuple(r[1:]) for r in group_quantiles(df, ["g"], "v", probs, method="spark").collect()}
    # a coarse sketch with a near-zero bracket misses the target ranks
    coarse = {r.g: tuple(r[1:]) for r in
              group_quantiles(df, ["g"], "v", probs, accuracy=10, halfwidth=1e-9).collect()}
    assert exact == coarse
    wide = {r.g: tuple(r[1:]) for r in group_quantiles(df, ["g"], "v", probs, accuracy=10).collect()}
    assert exact == wide


def test_rows_are_stored_once_and_cleaned_without_positions(spark, monkeypatch, tmp_path):
    """The positions' table is the stored policies; cleaning alone neither orders nor stores raw rows,
    and nothing is sorted for a write into one folder for each batch."""
    import claimlens.session as session
    from claimlens.sources import fixtures
    names = []
    scratch = session.scratch_dir
    monkeypatch.setattr(session, "scratch_dir", lambda s, name: names.append(name) or scratch(s, name))
    monkeypatch.setattr(fixtures, "_STORED", {})
    rows = fixtures.cleaned(spark, SF_SMALL)
    assert names == ["fixture-cleaned"]
    own = rows.count()
    names.clear()
    indexed = fixtures.policies(spark, SF_SMALL)
    assert names == ["positions", "offsets"]
    n = indexed.count()
    assert sorted(r[0] for r in indexed.select("row_index").collect()) == list(range(n)) and own <= n
    names.clear()
    assert fixtures.policies(spark, SF_SMALL, with_index=False).count() == n and not names


def test_files_of_a_batch_share_no_task(spark):
    """Sixteen hashed tasks gave several batches to one; a large batch has more files than two."""
    from claimlens.plans.stream_queries import file_of
    sizes = {None: 40, 0: 100, 1: 1000, 7: 300}
    rows = [(k, i, i % 7) for k, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(rows, "batch_id int, tie1 long, tie2 long")
    at, n = file_of(sizes, 100)
    assert n == 2 + 2 + 10 + 3
    got = df.repartitionById(n, at).withColumn("p", F.spark_partition_id()).groupBy("p").agg(F.count_distinct(F.coalesce("batch_id", F.lit(-1))).alias("b"), F.count("*").alias("n")).collect()
    assert len(got) == n and all(r.b == 1 and r.n < 200 for r in got)
