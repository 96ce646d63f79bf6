"""Hand-made frames for each null / tie / edge rule (FIXTURES.md section 4)."""

import datetime as dt
import math

from pyspark.sql import functions as F

from claimlens.functions import dates as DT
from claimlens.functions import features as X
from claimlens.operators import drift as D
from claimlens.operators import prepare as E
from claimlens.operators import profile as P
from claimlens.operators.positions import slice_rows
from claimlens.operators.stats import group_quantiles
from claimlens.sources import batches as SB


def test_policy_date_parse(spark):
    df = spark.createDataFrame([("08-AUG-13",), ("8-Aug-13",), ("08-Aug-75",), ("01-Jan-68",), ("junk",), (None,)],
                               "s string")
    got = [r[0] for r in df.select(DT.parse_policy_date("s")).collect()]
    assert got == [dt.date(2013, 8, 8), dt.date(2013, 8, 8), dt.date(1975, 8, 8), dt.date(2068, 1, 1), None, None]


def test_mixed_date_parse(spark):
    df = spark.createDataFrame([("08-AUG-13",), ("2014-02-03",), ("03-04-14",)], "s string")
    got = [r[0] for r in df.select(DT.parse_mixed_date("s")).collect()]
    assert got == [dt.date(2013, 8, 8), dt.date(2014, 2, 3), dt.date(2014, 3, 4)]


def test_null_rules(spark):
    rows = [(None, None, None), (0.0, 0.0, 0.0), (5.0, -1.0, 4.0), (1e9, 100.0, None)]
    df = spark.createDataFrame(rows, "CLAIM_PAID double, PREMIUM double, SEATS_NUM double")
    out = df.select(X.claim_ratio().alias("cr"), X.is_claim().alias("ic"), X.premium_log().alias("pl"),
                    X.premium_per_seat().alias("ps")).collect()
    assert [r.ic for r in out] == [0, 0, 1, 1]
    assert out[0].cr is None and out[1].cr == 0.0
    assert out[2].cr == 0.0            # negative ratio clipped to 0
    assert out[3].cr == 10.0           # clipped to 10
    assert out[0].pl is None and out[2].pl is None          # ln of non-positive -> NULL
    assert math.isclose(out[1].pl, math.log(1e-6))
    assert out[0].ps is None and math.isclose(out[2].ps, -1.0 / (4.0 + 1e-6))


def test_duration_default(spark):
    df = spark.createDataFrame([(dt.date(2014, 1, 1), dt.date(2014, 12, 31)), (None, dt.date(2014, 1, 1)),
                                (dt.date(2014, 2, 1), dt.date(2014, 1, 1))], "INSR_BEGIN date, INSR_END date")
    assert [r[0] for r in df.select(X.policy_duration_days()).collect()] == [364, 365, -31]


def test_mode_ties_smallest(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), ("b",), (None,)], "c string")
    m = E.fit_modes(df, ["c"]).collect()[0]
    assert m["mode"] == "a"


def test_encoder_unseen_and_missing(spark):
    fit = spark.createDataFrame([("b",), ("a",), ("C",)], "c string")
    d = E.fit_dictionary(fit, ["c"])
    assert sorted((r.value, r.code) for r in d.collect()) == [("C", 0), ("a", 1), ("b", 2)]
    new = spark.createDataFrame([(1, "a"), (2, "zzz"), (3, None)], "k int, c string")
    got = {r.k: r.c for r in E.encode(new, d, ["c"]).collect()}
    assert got == {1: 1, 2: -1, 3: -1}


def test_scalers_constant_column(spark):
    df = spark.createDataFrame([(7.0, 1.0), (7.0, 2.0), (7.0, 6.0)], "k double, v double")
    params = E.fit_scalers(df, ["k", "v"])
    a = E.scale_standard(df, params, ["k", "v"]).collect()
    b = E.scale_minmax(df, params, ["k", "v"]).collect()
    assert [r.k for r in a] == [0.0, 0.0, 0.0]
    assert [r.k for r in b] == [0.0, 0.0, 0.0]
    assert [round(r.v, 6) for r in b] == [0.0, 0.2, 1.0]
    std = math.sqrt(((1 - 3) ** 2 + (2 - 3) ** 2 + (6 - 3) ** 2) / 3)   # population std
    assert math.isclose(a[2].v, 3 / std)


def test_quantiles_interpolated(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 2.0), (1, 4.0), (1, 9.0), (1, None)], "g int, v double")
    for method in ("exact", "spark"):
        r = group_quantiles(df, ["g"], "v", [0.25, 0.5, 0.75], method=method).collect()[0]
        assert (r.q25, r.q50, r.q75) == (1.75, 3.0, 5.25)


def test_exact_quantiles_many_groups_match_spark(spark):
    df = spark.range(20000).select((F.col("id") % 7).alias("g"),
                                   (F.sin(F.col("id")) * 1000).alias("v"))
    a = {r.g: (r.q10, r.q50, r.q90) for r in group_quantiles(df, ["g"], "v", [0.1, 0.5, 0.9]).collect()}
    b = {r.g: (r.q10, r.q50, r.q90) for r in group_quantiles(df, ["g"], "v", [0.1, 0.5, 0.9], method="spark").collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert all(math.isclose(x, y, rel_tol=1e-12, abs_tol=1e-9) for x, y in zip(a[k], b[k]))


def test_correlation_constant_and_nulls(spark):
    rows = [(0, 1.0, 5.0, 1.0), (0, 2.0, 5.0, None), (0, 3.0, 5.0, 3.0), (0, 4.0, 5.0, 4.5)]
    df = spark.createDataFrame(rows, "batch_id int, x double, c double, y double")
    got = {(r.col1, r.col2): r.correlation for r in P.correlation_pairs(df, ["x", "c", "y"]).collect()}
    assert got[("x", "c")] is None                        # constant column
    xs, ys = [1.0, 3.0, 4.0], [1.0, 3.0, 4.5]             # pairwise complete rows
    mx, my = sum(xs) / 3, sum(ys) / 3
    r = sum((a - mx) * (b - my) for a, b in zip(xs, ys)) / math.sqrt(
        sum((a - mx) ** 2 for a in xs) * sum((b - my) ** 2 for b in ys))
    assert math.isclose(got[("x", "y")], r, rel_tol=1e-12)


def test_histogram_edges_and_constant(spark):
    rows = [(0, 0.0), (0, 3.0), (0, 1.5), (0, 3.0), (1, 2.0), (1, 2.0)]
    df = spark.createDataFrame(rows, "batch_id int, v double")
    h = P.histogram(df, ["v"], bins=3).collect()
    b0 = sorted((r.bin, r["count"]) for r in h if r.batch_id == 0)
    assert b0 == [(0, 1), (1, 1), (2, 2)]                 # max lands in the closed last bin
    b1 = [r for r in h if r.batch_id == 1]
    assert sum(r["count"] for r in b1) == 2 and min(r.bin_lo for r in b1) == 1.5


def test_psi_rules(spark):
    ref = [(b, float(v), "x" if v % 2 else "y") for b in range(5) for v in range(10)]
    cur = [(5, 100.0, "z"), (5, 1.0, "x"), (6, 2.0, "x")]
    df = spark.createDataFrame(ref + cur, "batch_id int, INSURED_VALUE double, USAGE string")
    s = __import__("claimlens.settings", fromlist=["DEFAULTS"]).DEFAULTS.with_(monitor_columns=("INSURED_VALUE", "USAGE"))
    ref_h = D.reference_histogram(df, ["INSURED_VALUE"], settings=s)
    dens = {r.batch_id: r.psi for r in D.psi_numeric(df, ref_h, ["INSURED_VALUE"], "density", s).collect()}
    prop = {r.batch_id: r.psi for r in D.psi_numeric(df, ref_h, ["INSURED_VALUE"], "proportion", s).collect()}
    assert dens.keys() == {5, 6} and math.isclose(prop[5], prop[6], rel_tol=1e-12)   # out-of-range 100 ignored
    cat = {r.batch_id: r.psi for r in D.psi_categorical(df, ["USAGE"], s).collect()}
    # batch 6 has only "x": y absent -> 1e-6; new category "z" in batch 5 ignored
    r_x = r_y = 0.5
    expect6 = (1.0 - r_x) * math.log(1.0 / r_x) + (1e-6 - r_y) * math.log(1e-6 / r_y)
    expect5 = (0.5 - r_x) * math.log(0.5 / r_x) + (1e-6 - r_y) * math.log(1e-6 / r_y)
    assert math.isclose(cat[6], expect6, rel_tol=1e-9) and math.isclose(cat[5], expect5, rel_tol=1e-9)


def test_psi_reference_against_itself_is_zero(spark):
    ref = [(b, float(v)) for b in range(6) for v in range(10)]
    df = spark.createDataFrame(ref, "batch_id int, INSURED_VALUE double")
    s = __import__("claimlens.settings", fromlist=["DEFAULTS"]).DEFAULTS
    ref_h = D.reference_histogram(df, ["INSURED_VALUE"], settings=s)
    for mode in ("clamp", "proportion", "density"):
        r = D.psi_numeric(df, ref_h, ["INSURED_VALUE"], mode, s).collect()[0]
        assert abs(r.psi) < 1e-12


def test_batch_bookkeeping(spark):
    empty = spark.createDataFrame([], "batch_id int")
    assert SB.next_batch_id(empty).first()[0] == 0
    one = spark.createDataFrame([(0,)], "batch_id int")
    assert SB.next_batch_id(one).first()[0] == 1            # reference quirk Q1 fixed
    gap = spark.createDataFrame([(0,), (1,), (3,)], "batch_id int")
    assert sorted(r[0] for r in SB.contiguous_batches(gap).collect()) == [0, 1]
    no_zero = spark.createDataFrame([(1,), (2,)], "batch_id int")
    assert SB.contiguous_batches(no_zero).count() == 0
    meta = spark.createDataFrame([(0, "a", 0, 3), (1, "a", 3, 2), (2, "b", 0, 9)],
                                 "batch_id int, sources string, index_in_source long, size long")
    assert SB.next_source_offset(meta, "a").first()[0] == 5
    assert SB.next_source_offset(meta, "c").first()[0] == 0


def test_range_read_across_sources(spark):
    s1 = spark.createDataFrame([(i,) for i in range(3)], "k int")
    s2 = spark.createDataFrame([(i,) for i in range(10, 12)], "k int")
    u = SB.union_sources([s1, s2], ["k"])
    keys = lambda df: [r.k for r in df.orderBy("row_index").collect()]
    assert keys(slice_rows(u, 1, 3)) == [1, 2, 10]
    assert keys(slice_rows(u, 2, 2)) == [2, 10]
    assert keys(slice_rows(u, 4, 10)) == [11]             # truncated at the end
    assert keys(slice_rows(u, 5, 1)) == []                # past the end
    assert keys(slice_rows(u, 0, 0)) == []                # non-positive size


def test_metadata_upsert(spark):
    meta = spark.createDataFrame([(0, "s", 0, 5, "1.0.0", None)],
                                 "batch_id int, sources string, index_in_source long, size long, "
                                 "data_collection_version string, data_analysis_version string")
    upd = spark.createDataFrame([(0, "1.0.0"), (1, "2.0.0")], "batch_id int, data_analysis_version string")
    got = {r.batch_id: r for r in SB.upsert_metadata(meta, upd).collect()}
    assert got[0].data_analysis_version == "1.0.0" and got[0].size == 5
    assert got[1].sources is None and got[1].data_analysis_version == "2.0.0"
