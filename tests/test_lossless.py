"""Ingest, streaming and analysis lose and double nothing, whatever goes wrong between."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlens.functions.dates import parse_mixed_date
from claimlens.operators import models as M
from claimlens.plans import jobs as J
from claimlens.session import scratch_dir
from claimlens.settings import DEFAULTS
from claimlens.sources import batches as SB
from claimlens.sources.fixtures import policies
from claimlens.streaming import jobs as ST
from tests.conftest import SF_SMALL


def rows(spark, n=6000):
    return policies(spark, SF_SMALL).drop("batch_id").where(F.col("row_index") < n)


def stored_rows(spark, path):
    t = spark.read.parquet(path)
    return t.count(), t.select("row_index").distinct().count(), sorted(r[0] for r in t.select("batch_id").distinct().collect())


def test_ingest_after_a_crash_between_data_and_metadata(spark, monkeypatch):
    raw, meta = scratch_dir(spark, "raw"), scratch_dir(spark, "meta")
    with monkeypatch.context() as m:
        m.setattr(SB, "append_metadata", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            SB.ingest(spark, rows(spark), raw, meta, "x", 1000)
    assert SB.ingest(spark, rows(spark), raw, meta, "x", 1000) == 6
    assert stored_rows(spark, raw) == (6000, 6000, list(range(6)))


def test_ingest_goes_on_with_new_rows_and_sources(spark):
    raw, meta = scratch_dir(spark, "raw"), scratch_dir(spark, "meta")
    assert SB.ingest(spark, rows(spark, 2500), raw, meta, "x", 1000) == 3
    assert SB.ingest(spark, rows(spark, 4000), raw, meta, "x", 1000) == 2      # rows appended to the source
    assert stored_rows(spark, raw) == (4000, 4000, list(range(5)))
    assert SB.ingest(spark, rows(spark, 1500), raw, meta, "x;y", 1000) == 2    # another source list starts at its own 0
    assert stored_rows(spark, raw) == (5500, 4000, list(range(7)))
    assert SB.read_metadata(spark, meta).agg(F.sum("size")).first()[0] == 5500


def test_ingest_stops_at_the_first_chunk_that_fails(spark, monkeypatch):
    raw, meta = scratch_dir(spark, "raw"), scratch_dir(spark, "meta")
    write, calls = SB.write_batches, []

    def failing(df, *a, **k):
        calls.append(1)
        if len(calls) == 3:
            raise OSError("disk")
        write(df, *a, **k)
    with monkeypatch.context() as m:
        m.setattr(SB, "write_batches", failing)
        with pytest.raises(OSError):
            SB.ingest(spark, rows(spark), raw, meta, "x", 1000, chunk=2)
    assert stored_rows(spark, raw)[0] == 4000
    assert SB.ingest(spark, rows(spark), raw, meta, "x", 1000, chunk=2) == 2
    assert stored_rows(spark, raw) == (6000, 6000, list(range(6)))


def test_only_an_absent_table_is_absent(spark, tmp_path):
    assert SB.read_batch_table(spark, str(tmp_path / "none")) is None
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        SB.read_batch_table(spark, str(tmp_path / "bad"))

    class Denied(AnalysisException):
        def __init__(self):
            pass

        def getCondition(self):
            return "ACCESS_DENIED"

    class Broken:
        class read:
            @staticmethod
            def parquet(path):
                raise Denied
    with pytest.raises(Denied):
        SB.read_batch_table(Broken, "x")


def test_stream_analysis_of_split_batches_and_replays(spark):
    """Two files a batch, one file an epoch; then every epoch again over a new checkpoint."""
    p = policies(spark, SF_SMALL, with_index=False).where("batch_id < 2")
    src, root = scratch_dir(spark, "split"), scratch_dir(spark, "out")
    p.repartition(4, "batch_id", F.col("tie1") % 2).write.partitionBy("batch_id").parquet(src)
    schema = spark.read.parquet(src).schema
    S = DEFAULTS.with_(reference_batches=1)
    from claimlens.functions.features import create_features
    from claimlens.operators.dedup import dedup_first
    want = create_features(dedup_first(p, list(S.dedup_keys), ("tie1", "tie2", "tie3")), S)
    for _ in range(2):
        paths = ST.stream_analyse(spark, src, schema, root, scratch_dir(spark, "ckpt"), ("tie1", "tie2", "tie3"), S, files_per_batch=1)
        got = spark.read.parquet(paths["cleaned_batches"])
        cols = ["batch_id", "OBJECT_ID", "tie1", "tie2", "tie3"]
        assert got.select(cols).exceptAll(want.select(cols)).count() == 0 and got.count() == want.count()
        assert spark.read.parquet(paths["quality_summary"]).count() == 2
        drift = spark.read.parquet(paths["drift"])
        assert drift.count() == drift.select("batch_id", "column").distinct().count() > 0


def test_an_epoch_works_on_its_own_batches(spark, monkeypatch):
    """Batches wait for the reference, then only what an epoch touches is scored; the drift is the batch job's."""
    from claimlens.operators import drift as D
    from claimlens.operators.dedup import dedup_first
    from claimlens.functions.features import create_features
    p = policies(spark, SF_SMALL, with_index=False).where("batch_id < 5")
    src, root = scratch_dir(spark, "order"), scratch_dir(spark, "out")
    S = DEFAULTS.with_(reference_batches=2)
    schema, worked, read = p.schema, [], []
    detect, rows_of = D.detect_drift, ST.rows_of_batches
    monkeypatch.setattr(D, "detect_drift", lambda df, *a, **k: worked.append(sorted(r[0] for r in df.select("batch_id").distinct().collect())) or detect(df, *a, **k))

    def reading(spark_, path, ids, schema_):
        df = rows_of(spark_, path, ids, schema_)
        read.append({f.split("batch_id=")[1].split("/")[0] for f in df.inputFiles()} == {str(i) for i in ids})
        return df
    monkeypatch.setattr(ST, "rows_of_batches", reading)
    ckpt = scratch_dir(spark, "ckpt")
    for own in (2, 0, 1, 3, 4):
        p.where(F.col("batch_id") == own).coalesce(1).write.mode("append").parquet(src)
        paths = ST.stream_analyse(spark, src, schema, root, ckpt, ("tie1", "tie2", "tie3"), S, files_per_batch=1)
    assert worked == [[2], [3], [4]] and read and all(read)
    clean = create_features(dedup_first(p, list(S.dedup_keys), ("tie1", "tie2", "tie3")), S)
    rounded = lambda df: sorted((r.batch_id, r.column, None if r.psi is None else round(r.psi, 9)) for r in df.select("batch_id", "column", "psi").collect())
    assert rounded(spark.read.parquet(paths["drift"])) == rounded(detect(clean, S))


def test_rows_of_batches_without_ids_or_with_text_ids(spark):
    path = scratch_dir(spark, "ids")
    df = spark.createDataFrame([("a b", 1), ("c=d", 2)], "batch_id string, x int")
    df.write.partitionBy("batch_id").parquet(path)
    assert ST.rows_of_batches(spark, path, [], df.schema).count() == 0
    assert [r.x for r in ST.rows_of_batches(spark, path, ["c=d"], df.schema).collect()] == [2]


SCHEMA = T.StructType([T.StructField(n, t) for n, t in (
    ("SEX", T.StringType()), ("INSR_BEGIN", T.StringType()), ("PREMIUM", T.DoubleType()), ("OBJECT_ID", T.LongType()))])


def test_missing_values_at_the_source(spark, tmp_path):
    """Missing tokens are exact, other spellings of NaN are missing too, files keep their order."""
    (tmp_path / "a.csv").write_text("SEX,INSR_BEGIN,PREMIUM,OBJECT_ID\n NA,08-AUG-13,NAN,1\nNA,x, 2.5 ,2\n,y,inf,3\n")
    (tmp_path / "b.csv").write_text("SEX,INSR_BEGIN,PREMIUM,OBJECT_ID\n1,z,bad,4\n")
    got = SB.read_ordered(spark, [str(tmp_path / "b.csv"), str(tmp_path / "a.csv")], SCHEMA).orderBy("row_index").collect()
    assert [(r.row_index, r.OBJECT_ID, r.SEX, r.PREMIUM) for r in got] == [(0, 4, "1", None), (1, 1, " NA", None), (2, 2, None, 2.5), (3, 3, None, float("inf"))]


@pytest.mark.parametrize("text,day", [("3/4/14", "2014-03-04"), ("13-04-14", "2014-04-13"), ("2014-02-03 00:00:00", "2014-02-03"), ("2014-2-3T07:08", "2014-02-03"),
                                      ("08-AUG-13", "2013-08-08"), ("25/12/2013", "2013-12-25"), ("", None), ("x", None), (None, None)])
def test_mixed_dates(spark, text, day):
    got = spark.createDataFrame([(text,)], "d string").select(parse_mixed_date("d").cast("string")).first()[0]
    assert got == day


def test_analysis_is_incremental(spark):
    """Only batches without an analysis version are worked on; the tables then equal one full run's."""
    raw, layout = policies(spark, SF_SMALL), J.Layout(scratch_dir(spark, "inc"))
    S = DEFAULTS.with_(reference_batches=2)
    J.analyse(spark, raw.where("batch_id < 3"), layout, S, eda_enabled=False, incremental=True)
    J.analyse(spark, raw.where("batch_id < 5"), layout, S, eda_enabled=False, incremental=True)
    full = J.Layout(scratch_dir(spark, "full"))
    J.analyse(spark, raw.where("batch_id < 5"), full, S, eda_enabled=False)
    for name in ("quality_summary", "quality_issues", "cleaning_log", "drift"):
        a, b = spark.read.parquet(getattr(layout, name)), spark.read.parquet(getattr(full, name))
        a, b = (x.select(*[F.round(c, 9).alias(c) if t == "double" else c for c, t in b.dtypes]) for x in (a, b))
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name
    log = spark.read.parquet(layout.metadata)
    J.analyse(spark, raw.where("batch_id < 5"), layout, S, eda_enabled=False, incremental=True)
    assert spark.read.parquet(layout.metadata).count() == log.count() == 5


def test_linear_model_goes_on_from_its_newest_version(spark):
    """Saved, found again as the newest, continued by one gradient step, loaded and validated."""
    df = spark.range(400).select(F.col("id").alias("row_index"), (F.col("id") % 7 / 7).alias("a"), (F.col("id") % 3 / 3).alias("b"))
    df = df.withColumn("CLAIM_PAID", 3 * F.col("a") - F.col("b") + 1)
    d = scratch_dir(spark, "models")
    M.train_all(df, df, ["a", "b"], d, kinds=("sgd",))
    newest = M.latest_versions(M.registry(spark, d)).where("variant = 'A'").first()
    first = M.LinearModel.load(spark, newest["path"])
    assert abs(first.weights["a"] - 3) < 0.05 and abs(first.bias - 1) < 0.05
    step = {r.term: r.weight for r in M.gradient_step(df, ["a", "b"], first.weights, first.bias).collect()}
    path = f"{d}/sgd_A_next"
    m = M.fit_model("sgd", df, ["a", "b"], path, previous=first)
    assert {**m.weights, M.BIAS: m.bias} == step
    M.register(spark, [M.Trained("sgd", "A", "next", path, 320)], d)
    M.register(spark, [M.Trained("sgd", "A", "gone", f"{d}/nowhere", 320)], d)
    with pytest.warns(UserWarning, match="nowhere"):
        got = {r["model"] for r in M.validate(M.stored_versions(spark, d), {"A": df, "B": df}, ["a", "b"], spark=spark).collect()}
    assert "sgd_A_next" in got and len(got) == 3
    with pytest.raises(RuntimeError):
        M.validate([], {}, [], spark=spark)


def test_preparation_options(spark):
    """Parameters from the training rows alone, and missing target features imputed."""
    from claimlens.operators import prepare as E
    from claimlens.operators.positions import temporal_split
    from claimlens.sources.fixtures import cleaned
    ties = ("OBJECT_ID", "tie1", "tie2", "tie3")
    c = cleaned(spark, SF_SMALL)
    p = E.prepare(c, DEFAULTS.with_(fit_on="train"), tie_cols=ties)
    train = temporal_split(p.table_a, DEFAULTS.train_split).where("is_train")
    # scaled on the training rows: there, and only there, mean 0 and deviation 1
    m = train.agg(F.avg("PREMIUM"), F.stddev_pop("PREMIUM")).first()
    assert abs(m[0]) < 1e-9 and abs(m[1] - 1) < 1e-9
    assert abs(p.table_a.agg(F.avg("PREMIUM")).first()[0]) > 1e-6
    q = E.prepare(c, DEFAULTS.with_(claim_ratio_fill="median"), tie_cols=ties)
    medians = {r["column"]: r["median"] for r in q.medians.collect()}
    missing = c.where("CLAIM_PAID is null").count()
    assert missing and medians["claim_ratio"] > 0
