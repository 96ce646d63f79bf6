
import math

from pyspark.sql import functions as F

from claimlens.operators import models as M
from claimlens.operators import prepare as E
from claimlens.operators import profile as P
from claimlens.operators.dedup import dedup_first
from claimlens.operators.positions import temporal_split
from claimlens.sources.fixtures import cleaned, policies
from tests.conftest import SF_SMALL


def test_dedup_idempotent(spark):
    c = cleaned(spark, SF_SMALL, stored=False)
    again = dedup_first(c, ["INSR_BEGIN", "OBJECT_ID"], ("tie1", "tie2", "tie3"))
    assert c.count() == again.count() == 4599          # FIXTURES.md: rows after dedup at sf0.001
    assert c.exceptAll(again).count() == 0


def test_row_index_contiguous(spark):
    p = policies(spark, SF_SMALL, stored=False)
    s = p.agg(F.min("row_index"), F.max("row_index"), F.count(F.lit(1)), F.count_distinct("row_index")).first()
    assert (s[0], s[1] + 1, s[3]) == (0, s[2], s[2])


def test_histogram_sums_to_non_null_rows(spark):
    c = cleaned(spark, SF_SMALL)
    h = P.histogram(c, ["PREMIUM"]).groupBy("batch_id").agg(F.sum("count").alias("n"))
    nn = c.groupBy("batch_id").agg(F.count("PREMIUM").alias("n"))
    assert sorted(h.collect()) == sorted(nn.collect())


def test_prepare_invariants(spark):
    p = E.prepare(cleaned(spark, SF_SMALL), tie_cols=("OBJECT_ID", "tie1", "tie2", "tie3"))
    a, b = p.table_a, p.table_b
    for c in ("PREMIUM", "INSURED_VALUE", "policy_duration_days", "MAKE"):
        s = a.agg(F.avg(c), F.stddev_pop(c)).first()
        assert abs(s[0]) < 1e-9 and abs(s[1] - 1.0) < 1e-9
        r = b.agg(F.min(c), F.max(c)).first()
        assert abs(r[0]) < 1e-12 and abs(r[1] - 1.0) < 1e-12
    assert a.where(F.greatest(*[F.col(c).isNull() for c in p.feature_cols])).count() == 0
    split = temporal_split(a, 0.8)
    n = a.count()
    tr, te = split.where("is_train").count(), split.where("NOT is_train").count()
    assert tr + te == n and tr == int(n * 0.8)


def test_split_is_time_ordered(spark):
    c = cleaned(spark, SF_SMALL)
    pos = E.order_by_start(c, ("OBJECT_ID", "tie1", "tie2", "tie3"), "row_index")
    s = temporal_split(pos, 0.8)
    last_train = s.where("is_train").agg(F.max("INSR_BEGIN")).first()[0]
    first_test = s.where("NOT is_train AND INSR_BEGIN IS NOT NULL").agg(F.min("INSR_BEGIN")).first()[0]
    assert last_train <= first_test


def test_models_beat_nothing_and_importances_sum_to_one(spark):
    p = E.prepare(cleaned(spark, SF_SMALL), tie_cols=("OBJECT_ID", "tie1", "tie2", "tie3"))
    cols = M.feature_columns(p.feature_cols)
    s = temporal_split(p.table_a, 0.8)
    tree = M.fit_tree(s.where("is_train"), cols)
    imp = M.feature_importances(tree, cols, spark)
    assert math.isclose(imp.agg(F.sum("importance")).first()[0], 1.0, rel_tol=1e-9)
    pred = M.predictions("decision_tree", tree, s.where("NOT is_train"), cols)
    assert pred.count() == s.where("NOT is_train").count()


def test_drift_recipe(spark):
    """clamp mode flags INSURED_VALUE in batches 8 and 9 only; density flags nothing."""
    from claimlens.operators.drift import detect_drift
    c = cleaned(spark, SF_SMALL, features=True)
    d = detect_drift(c).where("column = 'INSURED_VALUE'").collect()
    flagged = sorted(r.batch_id for r in d if r.drifted)
    assert flagged == [8, 9]
    dens = detect_drift(c, mode="density").where("column = 'INSURED_VALUE' AND drifted").count()
    assert dens == 0
