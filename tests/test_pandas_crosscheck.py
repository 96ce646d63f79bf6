"""Independent pandas / NumPy computations (the reference's own semantics)
compared with the Spark operators on the sf0.001 cleaned batches."""

import math

import numpy as np
import pandas as pd
import pytest

from claimlens.operators import drift as D
from claimlens.operators import prepare as E
from claimlens.operators import profile as P
from claimlens.sources.fixtures import cleaned
from tests.conftest import SF_SMALL

NUM = ["OBJECT_ID", "INSURED_VALUE", "PREMIUM", "CLAIM_PAID", "PROD_YEAR", "SEATS_NUM", "CARRYING_CAPACITY", "CCM_TON"]


@pytest.fixture(scope="module")
def frames(spark):
    c = cleaned(spark, SF_SMALL, features=True)
    pdf = c.toPandas()
    for col in NUM + ["premium_per_seat", "insured_value_per_ton", "claim_ratio", "premium_log"]:
        pdf[col] = pdf[col].astype("float64")
    return c, pdf


def close(a, b, rel=1e-9, abs_=1e-9):
    if a is None or (isinstance(a, float) and math.isnan(a)):
        return b is None or (isinstance(b, float) and math.isnan(b))
    return math.isclose(a, b, rel_tol=rel, abs_tol=abs_)


def test_describe_matches_pandas(frames):
    c, pdf = frames
    ours = {(r.batch_id, r.column): r for r in P.describe_numeric(c.drop(
        "policy_duration_days", "premium_per_seat", "insured_value_per_ton", "claim_ratio", "is_claim",
        "premium_log"), NUM).collect()}
    for b, g in pdf.groupby("batch_id"):
        d = g[NUM].describe()
        for col in NUM:
            r = ours[(b, col)]
            assert r["count"] == d.loc["count", col]
            for mine, theirs in ((r.mean, "mean"), (r.std, "std"), (r["min"], "min"), (r.q25, "25%"),
                                 (r.q50, "50%"), (r.q75, "75%"), (r["max"], "max")):
                assert close(mine, float(d.loc[theirs, col])), (b, col, theirs, mine, d.loc[theirs, col])


def test_correlations_match_pandas(frames):
    c, pdf = frames
    ours = {(r.batch_id, r.col1, r.col2): r.correlation for r in P.correlation_pairs(c, NUM).collect()}
    for b, g in pdf.groupby("batch_id"):
        m = g[NUM].corr()
        for i, x in enumerate(NUM):
            for y in NUM[i + 1:]:
                assert close(ours[(b, x, y)], float(m.loc[x, y]), rel=1e-7, abs_=1e-9), (b, x, y)


def test_density_psi_matches_numpy(frames):
    c, pdf = frames
    col = "INSURED_VALUE"
    ref = pdf[pdf.batch_id < 5][col].dropna()
    hist, edges = np.histogram(ref, bins=10, density=True)
    ref_h = D.reference_histogram(c, [col])
    ours = {r.batch_id: r.psi for r in D.psi_numeric(c, ref_h, [col], "density").collect()}
    for b, g in pdf[pdf.batch_id >= 5].groupby("batch_id"):
        cur, _ = np.histogram(g[col].dropna(), bins=edges, density=True)
        cur, r = cur + 1e-6, hist + 1e-6
        psi = float(np.sum((cur - r) * np.log(cur / r)))
        assert close(ours[b], psi, rel=1e-6, abs_=1e-9), (b, ours[b], psi)


def test_medians_and_modes_match_pandas(frames):
    c, pdf = frames
    cols = ["PREMIUM", "SEATS_NUM", "CARRYING_CAPACITY", "premium_log", "claim_ratio"]
    med = {r.column: r.median for r in E.fit_medians(c, cols).collect()}
    for col in cols:
        assert close(med[col], float(pdf[col].median())), col
    cats = ["USAGE", "MAKE", "TYPE_VEHICLE"]
    modes = {r.column: r.mode for r in E.fit_modes(c, cats).collect()}
    for col in cats:
        assert modes[col] == pdf[col].mode()[0], col


def test_features_match_pandas(frames):
    c, pdf = frames
    begin, end = pd.to_datetime(pdf.INSR_BEGIN), pd.to_datetime(pdf.INSR_END)
    dur = (end - begin).dt.days.fillna(365)
    assert (dur.astype(int).values == pdf.policy_duration_days.values).all()
    ratio = (pdf.CLAIM_PAID / (pdf.PREMIUM + 1e-6)).clip(0, 10)
    same = (ratio.isna() & pdf.claim_ratio.isna()) | np.isclose(ratio, pdf.claim_ratio, rtol=1e-12)
    assert same.all()
    assert ((pdf.CLAIM_PAID > 0).astype(int).values == pdf.is_claim.values).all()
