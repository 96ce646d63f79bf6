"""The mergeable profile: exact results from two scans, merged states, measured sketch errors."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from claimlens.operators import quality as Q
from claimlens.operators import state as S
from claimlens.session import scratch_dir
from claimlens.settings import DEFAULTS


@pytest.fixture(scope="module")
def data(spark):
    """Skewed, constant, missing, tied and tiny columns over batches of very different size."""
    rng = np.random.default_rng(5)
    n = 30_000
    t = pd.DataFrame({"batch_id": np.r_[np.zeros(n - 403), np.ones(400), [2, 3, 3]].astype(int), "A": np.exp(3 * rng.standard_normal(n)),
                      "B": rng.integers(0, 4, n).astype(float), "C": 7.25, "D": rng.standard_normal(n), "SEX": rng.choice(["m", "f", ""], n), "MAKE": rng.integers(0, 20_000, n).astype(str)})
    t.loc[rng.random(n) < 0.3, "D"] = np.nan
    t.loc[t.batch_id == 2, "A"] = np.nan
    t.loc[::7, "MAKE"] = None
    t = t.astype(object).where(t.notna(), None)
    path = scratch_dir(spark, "profiled")
    spark.createDataFrame(list(t.itertuples(index=False, name=None)), "batch_id int, A double, B double, C double, D double, SEX string, MAKE string").repartition(6).write.parquet(path)
    return spark.read.parquet(path), t, path


NUMERIC = ["A", "B", "C", "D"]


def test_exact_profile_equals_pandas_in_two_scans(spark, data, monkeypatch):
    df, t, _ = data
    plans, keep = [], S.stored

    def watched(frame, name):
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return keep(frame, name)
    monkeypatch.setattr(S, "stored", watched)
    got = {(r.batch_id, r.column): r for r in S.exact_profile(df, NUMERIC, ["SEX", "MAKE"]).collect()}
    scans = [line for p in plans for line in p.split("\n") if "FileScan" in line and "MAKE#" in line]
    assert len(scans) == 2
    for b, own in t.groupby("batch_id"):
        for c in NUMERIC:
            v, r = own[c].dropna().astype(float), got[b, c]
            assert (r.total_rows, r["count"], r.nulls) == (len(own), len(v), len(own) - len(v))
            if not len(v):
                assert r.q25 is None and r.outliers == 0
                continue
            q = v.quantile([0.25, 0.5, 0.75]).tolist()
            assert [r.q25, r.q50, r.q75] == pytest.approx(q, rel=1e-12)
            lo, hi = r.q25 - 1.5 * (r.q75 - r.q25), r.q75 + 1.5 * (r.q75 - r.q25)
            assert (r.lower_bound, r.upper_bound, r.outliers) == (lo, hi, int(((v < lo) | (v > hi)).sum()))
            assert [r.min, r.max, r.mean] == pytest.approx([v.min(), v.max(), v.mean()]) and (r.std is None or r.std == pytest.approx(v.std()))
        for c in ("SEX", "MAKE"):
            assert got[b, c].n_unique == own[c].nunique()


def test_same_issues_both_ways(spark, data):
    df = data[0]
    settings = DEFAULTS.with_(numeric_columns=("D", "A", "none", "C"), categorical_columns=("MAKE", "SEX"))
    key = lambda rows: sorted((*r[:4], round(r[4], 9)) for r in rows)
    assert key(Q.quality_issues(df, settings=settings).collect()) == key(Q.quality_issues(df, settings=settings.with_(few_scans=True)).collect())


def test_where_two_scans_do_not_apply(spark, data, monkeypatch):
    """NaN, large batches and missed brackets are noticed; no numeric column and no row are no problem."""
    df = data[0]
    assert S.exact_profile(df.withColumn("A", F.when(F.col("B") == 1, float("nan")).otherwise(F.col("A"))), NUMERIC, []) is None
    assert S.exact_profile(df.limit(0), NUMERIC, ["SEX"]).count() == 0
    assert S.exact_profile(df, [], ["SEX"]).where("is_categorical").agg(F.min("n_unique")).first()[0] >= 1
    with monkeypatch.context() as m:
        m.setattr(S, "MAX_CANDIDATES", 10)
        assert S.exact_profile(df, NUMERIC, []) is None
    with monkeypatch.context() as m:
        right = S.approximate
        m.setattr(S, "approximate", lambda *a: right(*a).withColumn("q", F.transform("q", lambda v: v + 1e9)))
        assert S.exact_profile(df, ["A"], []) is None


def test_states_merge_and_their_errors(spark, data):
    """States of the batches merged equal those of the whole; ranks and distinct counts within the stated errors."""
    df, t, _ = data
    whole = S.merged(S.batch_state(df.withColumn("batch_id", F.lit(0)), NUMERIC, ["MAKE"]), ["column"])
    parts = S.merged(S.batch_state(df, NUMERIC, ["MAKE"]), ["column"])
    a, b = ({r.column: r for r in x.collect()} for x in (whole, parts))
    for c in NUMERIC:
        assert (a[c].n, a[c].nulls, a[c].min, a[c].max) == (b[c].n, b[c].nulls, b[c].min, b[c].max)
        assert b[c].mean == pytest.approx(a[c].mean) and b[c].m2 == pytest.approx(a[c].m2, rel=1e-9, abs=1e-9)
    probs = [0.01, 0.25, 0.5, 0.75, 0.99]
    got = {r.column: r for r in S.approximate(parts, probs).collect()}
    for c in ("A", "D"):
        v = np.sort(t[c].dropna().to_numpy(float))
        ranks = np.searchsorted(v, got[c].q) / len(v)
        assert np.abs(ranks - probs).max() < 0.004
    true = t.MAKE.nunique()
    assert abs(got["MAKE"].n_unique / true - 1) < 0.025 and got["A"].n_unique is None
