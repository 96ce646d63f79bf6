"""Steps that several queries share sort no more rows than they must (findings F13 to F27)."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from claimlens.operators import prepare as E
from claimlens.operators.dedup import dedup_first
from claimlens.operators.stats import group_quantiles, unpivot
from claimlens.session import scratch_dir
from claimlens.sources import csvfiles
from tests.test_plans import plan


def test_dedup_keeps_the_first_row_without_sorting_twice_as_wide_rows(spark):
    """Repeated and missing keys and a hot one; rows aren't put into sorted aggregation buffers."""
    rnd = random.Random(3)
    rows = [(rnd.choice([0, 1, None]), rnd.choice([dt.date(1998, 1, 1), None]), rnd.choice([7, 7, 7, rnd.randrange(40), None]), i, f"t{i}") for i in rnd.sample(range(500), 500)]
    df = spark.createDataFrame(rows, "batch_id int, INSR_BEGIN date, OBJECT_ID long, tie1 long, MAKE string").repartition(5)
    got = dedup_first(df, ["INSR_BEGIN", "OBJECT_ID"], ("tie1",))
    want: dict = {}
    for r in rows:
        want[r[:3]] = min(want.get(r[:3], r), r, key=lambda x: x[3])
    assert sorted(map(tuple, got.collect()), key=lambda r: r[3]) == sorted(want.values(), key=lambda r: r[3])
    assert got.columns == df.columns
    text = plan(got)
    assert "SortAggregate" not in text and text.count("WindowGroupLimit") >= 2      # a hot key is cut before the shuffle


def test_scalers_of_many_columns_are_compiled(spark):
    cols = [f"c{i}" for i in range(30)]
    df = spark.range(50).select(*[((F.col("id") * (i + 1)) % 7).cast("double").alias(c) for i, c in enumerate(cols)])
    got = {r["column"]: r for r in E.fit_scalers(df, cols).collect()}
    assert [got[c]["col_ord"] for c in cols] == list(range(30))
    values = {c: [float((k * (i + 1)) % 7) for k in range(50)] for i, c in enumerate(cols)}
    for c, v in values.items():
        mean = sum(v) / 50
        assert got[c]["mean"] == pytest.approx(mean) and (got[c]["min"], got[c]["max"]) == (min(v), max(v))
        assert got[c]["std"] == pytest.approx((sum((x - mean) ** 2 for x in v) / 50) ** 0.5)
    # a part's aggregate has fewer fields than spark.sql.codegen.maxFields
    assert 7 * E.SCALED_AT_ONCE <= int(spark.conf.get("spark.sql.codegen.maxFields", "100"))


def test_correlations_of_many_columns_are_compiled(spark):
    """Every pair once, in order, and no aggregate with more fields than Spark compiles."""
    from claimlens.operators import profile as P
    cols = [f"c{i}" for i in range(8)]
    df = spark.range(60).select((F.col("id") % 2).cast("int").alias("batch_id"), *[((F.col("id") * (i + 2)) % 11).cast("double").alias(c) for i, c in enumerate(cols)])
    rows = P.correlation_pairs(df, cols).where("batch_id = 0").orderBy("pair_ord").collect()
    assert [(r["pair_ord"], r["col1"], r["col2"]) for r in rows] == [(k, a, b) for k, (a, b) in enumerate((cols[i], cols[j]) for i in range(8) for j in range(i + 1, 8))]
    x = {c: [float((k * (i + 2)) % 11) for k in range(0, 60, 2)] for i, c in enumerate(cols)}
    for r in rows:
        a, b = x[r["col1"]], x[r["col2"]]
        ma, mb = sum(a) / 30, sum(b) / 30
        want = sum((p - ma) * (q - mb) for p, q in zip(a, b)) / (sum((p - ma) ** 2 for p in a) * sum((q - mb) ** 2 for q in b)) ** 0.5
        assert r["correlation"] == pytest.approx(want)
    assert 10 * P.PAIRS_AT_ONCE <= int(spark.conf.get("spark.sql.codegen.maxFields", "100"))


def test_ranks_are_read_by_compiled_code(spark, monkeypatch):
    """Rows are compared with their brackets after these are exploded, not by functions over arrays."""
    from claimlens.operators import stats
    seen = []
    own = stats._read_ranks
    monkeypatch.setattr(stats, "_read_ranks", lambda *a: seen.append(own(*a)) or seen[-1])
    df = spark.range(101).select(F.col("id").cast("double").alias("x"), (F.col("id") % 3).cast("double").alias("y"))
    got = {r["column"]: (r.q25, r.q50) for r in group_quantiles(unpivot(df, [], ["x", "y"]), ["column"], "value", [0.25, 0.5]).collect()}
    assert got == {"x": (25.0, 50.0), "y": (0.0, 1.0)}
    assert seen and not any("lambdafunction" in plan(d) for d in seen)


def test_csv_splits_are_counted_without_sorting_lines(spark, monkeypatch):
    path = scratch_dir(spark, "csv")
    spark.range(40).select("id", F.lit("a, b").alias("t")).repartition(3).write.option("header", True).csv(path)
    plans = []
    own = csvfiles._counted
    monkeypatch.setattr(csvfiles, "_counted", lambda *a: plans.append(plan(own(*a))) or own(*a))
    got = csvfiles.read_sources(spark, [path], None)
    assert sorted(r.id for r in got.collect()) == list(range(40)) and {r.t for r in got.collect()} == {"a, b"}
    assert plans and not any("SortAggregate" in p for p in plans)


def test_line_items_are_not_sorted_for_their_orders(spark):
    from claimlens.sources.fixtures import policies
    from tests.conftest import SF_SMALL
    assert "SortMergeJoin" not in plan(policies(spark, SF_SMALL, with_index=False, stored=False))


def test_a_file_of_the_stream_source_has_one_batch(spark):
    """Its rows need no sort by batch: no directory of a batch is written."""
    from claimlens.plans import stream_queries as Q
    from tests.conftest import SF_SMALL
    src, schema = Q._policy_files(spark, SF_SMALL)
    rows = spark.read.schema(schema).parquet(src).select("batch_id", F.input_file_name().alias("f"))
    assert rows.groupBy("f").agg(F.countDistinct("batch_id").alias("n")).agg(F.max("n")).first()[0] == 1
    assert rows.where("f like '%batch_id=%'").count() == 0


def test_serving_prep_joins_the_tables_once(spark, monkeypatch):
    """e8 stores the raw rows first, so that the preparation reads them."""
    import __spark_entry__ as entry
    from claimlens.plans import job_queries as J
    from tests.conftest import SF_SMALL
    order = []
    own = (J.policies, J._prepared)
    monkeypatch.setattr(J, "policies", lambda *a, **k: order.append("rows") or own[0](*a, **k))
    monkeypatch.setattr(J, "_prepared", lambda *a, **k: order.append("prepared") or own[1](*a, **k))
    entry.queries()["e8_serving_prep"](spark, SF_SMALL)
    assert order == ["rows", "prepared"]


def test_sorts_of_whole_rows_get_small_partitions(spark):
    """The positions' table and the cleaned rows are written with small partitions; the
    session's own setting is as before, and one that it has made stays."""
    from pyspark.sql import functions as F
    from claimlens import session
    from claimlens.operators.positions import with_row_index
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    with session.small_sorts(spark):
        assert spark.conf.get(key) == session.SORTED_BYTES
    assert spark.conf.get(key) == before and key not in spark.conf.getAll
    # 5 million bytes that don't compress, sorted with 1 MB a task instead of all in one
    df = spark.range(200_000, numPartitions=4).select("id", F.sha2(F.col("id").cast("string"), 256).alias("s"))
    was, lone = session.SORTED_BYTES, "spark.sql.adaptive.coalescePartitions.parallelismFirst"
    try:
        spark.conf.set(lone, "false")
        session.SORTED_BYTES = "1m"
        got = with_row_index(df, ["s"])
        assert got.count() == 200_000 and len(got.inputFiles()) > 4
        spark.conf.set(key, "64m")
        with session.small_sorts(spark):
            assert spark.conf.get(key) == "64m"
    finally:
        session.SORTED_BYTES = was
        spark.conf.unset(key)
        spark.conf.unset(lone)
