"""Registered queries: EDA profile (A7-A11, O3) and drift.

Inputs are the cleaned batches (dedup within batch); drift also uses the
derived features, as the reference's analysis loop does.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from claimlens.operators import drift as D
from claimlens.operators import profile as P
from claimlens.operators.quality import missing_counts
from claimlens.plans.registry import query, r6, union_all_sql
from claimlens.settings import DEFAULTS, HISTOGRAM_COLUMNS
from claimlens.sources.fixtures import POLICY_COLUMNS, cleaned, with_cleaned

S = DEFAULTS
EDA_NUM = ["OBJECT_ID", "INSURED_VALUE", "PREMIUM", "CLAIM_PAID", "PROD_YEAR", "SEATS_NUM",
           "CARRYING_CAPACITY", "CCM_TON"]
MON_NUM = [c for c in S.monitor_columns if c in ("INSURED_VALUE", "PREMIUM", "CLAIM_PAID", "SEATS_NUM")]
MON_CAT = [c for c in S.monitor_columns if c in ("TYPE_VEHICLE", "USAGE")]


def _q(c):
    return f'"{c}"'


def r12(c):
    return F.round(c, 12)


# ---- A7 describe -------------------------------------------------------------
_A7_BODY = union_all_sql([
    f"""SELECT batch_id, {i} AS col_ord, '{c}' AS "column", count({_q(c)}) AS count,
       round(avg(CAST({_q(c)} AS DOUBLE)), 6) AS mean, round(stddev_samp(CAST({_q(c)} AS DOUBLE)), 6) AS std,
       CAST(min({_q(c)}) AS DOUBLE) AS min,
       round(quantile_cont(CAST({_q(c)} AS DOUBLE), 0.25), 9) AS q25,
       round(quantile_cont(CAST({_q(c)} AS DOUBLE), 0.5), 9) AS q50,
       round(quantile_cont(CAST({_q(c)} AS DOUBLE), 0.75), 9) AS q75,
       CAST(max({_q(c)}) AS DOUBLE) AS max
FROM cleaned GROUP BY batch_id""" for i, c in enumerate(EDA_NUM)])
A7_SQL = with_cleaned(_A7_BODY)


@query("a7_describe", A7_SQL)
def a7_describe(spark, sf_dir):
    d = P.describe_numeric(cleaned(spark, sf_dir))
    return d.select("batch_id", "col_ord", "column", "count", r6("mean").alias("mean"), r6("std").alias("std"),
                    "min", F.round("q25", 9).alias("q25"), F.round("q50", 9).alias("q50"), F.round("q75", 9).alias("q75"), "max")


@query("a2_quantiles", with_cleaned(union_all_sql([
    f"""SELECT batch_id, '{c}' AS "column", round(quantile_cont({_q(c)}, 0.25), 9) AS q25,
       round(quantile_cont({_q(c)}, 0.5), 9) AS q50, round(quantile_cont({_q(c)}, 0.75), 9) AS q75
FROM cleaned GROUP BY batch_id HAVING count({_q(c)}) > 0""" for c in S.numeric_columns])))
def a2_quantiles(spark, sf_dir):
    from claimlens.operators.stats import group_quantiles, unpivot
    long = unpivot(cleaned(spark, sf_dir), ["batch_id"], list(S.numeric_columns))
    q = group_quantiles(long, ["batch_id", "column"], "value", [0.25, 0.5, 0.75])
    return q.select("batch_id", "column", F.round("q25", 9).alias("q25"), F.round("q50", 9).alias("q50"), F.round("q75", 9).alias("q75"))


# ---- A8 correlations, O3 top 5 -----------------------------------------------
def _pairs():
    return [(i, j) for i in range(len(EDA_NUM)) for j in range(i + 1, len(EDA_NUM))]


_CORR_CTE = "corr AS (" + union_all_sql([
    f"""SELECT batch_id, {k} AS pair_ord, '{EDA_NUM[i]}' AS col1, '{EDA_NUM[j]}' AS col2,
       covar_samp(xm, ym) / nullif(stddev_samp(xm) * stddev_samp(ym), 0) AS correlation
FROM (SELECT batch_id,
             CASE WHEN {_q(EDA_NUM[j])} IS NOT NULL THEN CAST({_q(EDA_NUM[i])} AS DOUBLE) END AS xm,
             CASE WHEN {_q(EDA_NUM[i])} IS NOT NULL THEN CAST({_q(EDA_NUM[j])} AS DOUBLE) END AS ym
      FROM cleaned) t GROUP BY batch_id""" for k, (i, j) in enumerate(_pairs())]) + ")"

A8_SQL = with_cleaned(f""", {_CORR_CTE}
SELECT batch_id, pair_ord, col1, col2, round(correlation, 6) AS correlation FROM corr""")
O3_SQL = with_cleaned(f""", {_CORR_CTE}
SELECT batch_id, pair_ord, col1, col2, round(correlation, 6) AS correlation, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY batch_id ORDER BY round(abs(correlation), 9) DESC NULLS LAST, pair_ord) AS rank
  FROM corr) t WHERE rank <= 5""")


@query("a8_correlations", A8_SQL.replace("\n, corr AS", ",\ncorr AS"))
def a8_correlations(spark, sf_dir):
    c = P.correlation_pairs(cleaned(spark, sf_dir), EDA_NUM)
    return c.withColumn("correlation", r6("correlation"))


@query("o3_top_correlations", O3_SQL.replace("\n, corr AS", ",\ncorr AS"))
def o3_top_correlations(spark, sf_dir):
    c = P.top_correlations(P.correlation_pairs(cleaned(spark, sf_dir), EDA_NUM))
    return c.withColumn("correlation", r6("correlation"))


# ---- A9 missing counts ------------------------------------------------------
A9_SQL = with_cleaned(union_all_sql([
    f"SELECT batch_id, {i} AS col_ord, '{c}' AS \"column\", count(*) - count({_q(c)}) AS nulls "
    f"FROM cleaned GROUP BY batch_id" for i, c in enumerate(POLICY_COLUMNS)]))


@query("a9_missing", A9_SQL)
def a9_missing(spark, sf_dir):
    return missing_counts(cleaned(spark, sf_dir))


# ---- A10 EDA record (composition of A7, O3, A9, A3; JSON text) -------------
_A10_OUT = union_all_sql([
    f"""SELECT t.batch_id, 'outliers' AS part, '{c}' AS name,
       CAST(count(*) FILTER (WHERE {_q(c)} < q25 - {S.iqr_factor} * (q75 - q25) OR {_q(c)} > q75 + {S.iqr_factor} * (q75 - q25)) AS DOUBLE) AS value
FROM cleaned t JOIN (SELECT * FROM described WHERE "column" = '{c}') d USING (batch_id) GROUP BY t.batch_id""" for c in EDA_NUM])
_A10_MISS = union_all_sql([
    f"SELECT batch_id, 'missing' AS part, '{c}' AS name, CAST(count(*) - count({_q(c)}) AS DOUBLE) AS value FROM cleaned GROUP BY batch_id"
    for c in POLICY_COLUMNS])
A10_SQL = with_cleaned(f""", {_CORR_CTE},
described AS ({_A7_BODY}),
best AS (SELECT *, row_number() OVER (PARTITION BY batch_id ORDER BY round(abs(correlation), 9) DESC NULLS LAST, pair_ord) AS rn FROM corr)
SELECT batch_id, 'basic.' || m AS part, "column" AS name, CAST(v AS DOUBLE) AS value
FROM described UNPIVOT INCLUDE NULLS (v FOR m IN (mean, std, min, q50, max))
UNION ALL SELECT batch_id, 'basic.count', "column", CAST(count AS DOUBLE) FROM described
UNION ALL {_A10_MISS}
UNION ALL {_A10_OUT}
UNION ALL SELECT batch_id, 'correlation', col1 || '~' || col2, round(correlation, 6) FROM best WHERE rn <= 5""")


@query("a10_eda", A10_SQL)
def a10_eda(spark, sf_dir):
    """The stored EDA records, opened again into one row per number."""
    e = P.eda(cleaned(spark, sf_dir))
    number = "struct<count:long,mean:double,std:double,min:double,q25:double,q50:double,q75:double,max:double>"
    basic = e.select("batch_id", F.explode(F.from_json("basic_stats", f"map<string,{number}>")).alias("name", "s")).select(
        "batch_id", "name", F.inline(F.array(*[F.struct(F.lit(f"basic.{m}").alias("part"), (F.round(F.col(f"s.{m}"), n) if n else F.col(f"s.{m}")).cast("double").alias("value"))
                                               for m, n in (("count", 0), ("mean", 6), ("std", 6), ("min", 0), ("q50", 9), ("max", 0))])))
    miss = e.select("batch_id", F.explode(F.from_json("missing_patterns", "map<string,long>")).alias("name", "value")).select(
        "batch_id", "name", F.lit("missing").alias("part"), F.col("value").cast("double").alias("value"))
    outl = e.select("batch_id", F.explode(F.from_json("outliers_summary", "map<string,struct<count:long>>")).alias("name", "s")).select(
        "batch_id", "name", F.lit("outliers").alias("part"), F.col("s.count").cast("double").alias("value"))
    corr = e.select("batch_id", F.inline(F.from_json("correlations", "array<struct<col1:string,col2:string,correlation:double>>"))).select(
        "batch_id", F.concat_ws("~", "col1", "col2").alias("name"), F.lit("correlation").alias("part"), r6("correlation").alias("value"))
    return basic.unionByName(miss).unionByName(outl).unionByName(corr).select("batch_id", "part", "name", "value")


# ---- A11 histogram ----------------------------------------------------------
def _hist_sql(source: str, cols: list[str], bins: int, keyed: bool = True) -> str:
    k = "batch_id, " if keyed else ""
    long = union_all_sql([
        f"SELECT {k}{i} AS col_ord, '{c}' AS \"column\", CAST({_q(c)} AS DOUBLE) AS v FROM {source} "
        f"WHERE {_q(c)} IS NOT NULL" for i, c in enumerate(cols)])
    return f"""
hlong AS ({long}),
rng AS (SELECT {k}col_ord, "column", count(*) AS n,
          CASE WHEN min(v) = max(v) THEN min(v) - 0.5 ELSE min(v) END AS lo,
          CASE WHEN min(v) = max(v) THEN max(v) + 0.5 ELSE max(v) END AS hi
        FROM hlong GROUP BY ALL),
cnt AS (SELECT {k.replace('batch_id', 'l.batch_id')}l.col_ord, l."column",
          CAST(least(floor((v - lo) / ((hi - lo) / {bins})), {bins - 1}) AS BIGINT) AS bin, count(*) AS count
        FROM hlong l JOIN rng r ON {'l.batch_id = r.batch_id AND ' if keyed else ''}l."column" = r."column"
        GROUP BY ALL),
hist AS (SELECT {k.replace('batch_id', 'r.batch_id')}r.col_ord, r."column", b.range AS bin, r.lo, r.hi, r.n,
           coalesce(c.count, 0) AS count
         FROM rng r CROSS JOIN range(0, {bins}) b
         LEFT JOIN cnt c ON {'c.batch_id = r.batch_id AND ' if keyed else ''}c."column" = r."column" AND c.bin = b.range)"""


A11_SQL = with_cleaned(f""",{_hist_sql('cleaned', EDA_NUM[:4], 30)}
SELECT batch_id, col_ord, "column", bin, round(lo + bin * ((hi - lo) / 30), 6) AS bin_lo,
       round(CASE WHEN bin = 29 THEN hi ELSE lo + (bin + 1) * ((hi - lo) / 30) END, 6) AS bin_hi,
       count, round(lo, 6) AS lo, round(hi, 6) AS hi
FROM hist""")


@query("a11_histogram", A11_SQL)
def a11_histogram(spark, sf_dir):
    h = P.histogram(cleaned(spark, sf_dir), EDA_NUM[:HISTOGRAM_COLUMNS])
    return h.select("batch_id", "col_ord", "column", "bin", r6("bin_lo").alias("bin_lo"),
                    r6("bin_hi").alias("bin_hi"), "count", r6("lo").alias("lo"), r6("hi").alias("hi"))


# ---- A12 reference histogram ------------------------------------------------
A12_SQL = with_cleaned(f""",
ref AS (SELECT * FROM cleaned WHERE batch_id < {S.reference_batches}),{_hist_sql('ref', MON_NUM, 10, keyed=False)}
SELECT "column", bin, round(lo + bin * ((hi - lo) / 10), 6) AS bin_lo,
       round(CASE WHEN bin = 9 THEN hi ELSE lo + (bin + 1) * ((hi - lo) / 10) END, 6) AS bin_hi,
       count, n, round(count / n, 6) AS share, round(count / (n * ((hi - lo) / 10)), 12) AS density
FROM hist""", features=True)


@query("a12_reference", A12_SQL)
def a12_reference(spark, sf_dir):
    h = D.reference_histogram(cleaned(spark, sf_dir, features=True), MON_NUM)
    return h.select("column", "bin", r6("bin_lo").alias("bin_lo"), r6("bin_hi").alias("bin_hi"), "count", "n",
                    r6("share").alias("share"), r12("density").alias("density"))


# ---- A13 category distribution ---------------------------------------------
A13_SQL = with_cleaned(union_all_sql([
    f"""SELECT batch_id, '{c}' AS "column", CAST({_q(c)} AS VARCHAR) AS value, count(*) AS count,
       round(count(*) / sum(count(*)) OVER (PARTITION BY batch_id), 6) AS share
FROM cleaned WHERE {_q(c)} IS NOT NULL GROUP BY batch_id, {_q(c)}""" for c in MON_CAT]))


@query("a13_distribution", A13_SQL)
def a13_distribution(spark, sf_dir):
    d = D.category_distribution(cleaned(spark, sf_dir), MON_CAT, keys=("batch_id",))
    return d.select("batch_id", "column", "value", "count", r6("share").alias("share"))


# ---- A14 reference moments --------------------------------------------------
A14_SQL = with_cleaned(union_all_sql([
    f"""SELECT '{c}' AS "column", round(avg({_q(c)}), 6) AS mean, round(stddev_samp({_q(c)}), 6) AS std
FROM cleaned WHERE batch_id < {S.reference_batches}""" for c in MON_NUM]), features=True)


@query("a14_reference_moments", A14_SQL)
def a14_reference_moments(spark, sf_dir):
    m = D.reference_moments(cleaned(spark, sf_dir, features=True), MON_NUM)
    return m.select("column", r6("mean").alias("mean"), r6("std").alias("std"))


# ---- A15 numeric PSI (three modes) -------------------------------------------
def _psi_num_sql(mode: str) -> str:
    long = union_all_sql([
        f"SELECT batch_id, '{c}' AS \"column\", CAST({_q(c)} AS DOUBLE) AS v FROM cur WHERE {_q(c)} IS NOT NULL"
        for c in MON_NUM])
    raw_bin = "floor((v - lo) / ((hi - lo) / 10))"
    if mode == "clamp":
        bin_expr, where = f"least(greatest({raw_bin}, 0), 9)", ""
    else:
        bin_expr, where = f"least({raw_bin}, 9)", "WHERE v >= lo AND v <= hi"
    cval = ("count / nullif(n_cur * ((hi - lo) / 10), 0)" if mode == "density"
            else "count / nullif(CAST(n_cur AS DOUBLE), 0)")
    rval = "density" if mode == "density" else "share"
    return f""",
ref AS (SELECT * FROM cleaned WHERE batch_id < {S.reference_batches}),{_hist_sql('ref', MON_NUM, 10, keyed=False)},
refh AS (SELECT "column", bin, lo, hi, count / n AS share, count / (n * ((hi - lo) / 10)) AS density FROM hist),
cur AS (SELECT * FROM cleaned WHERE batch_id >= {S.reference_batches}),
clong AS ({long}),
pairs AS (SELECT b.batch_id, r."column", r.lo, r.hi FROM (SELECT DISTINCT batch_id FROM cur) b CROSS JOIN rng r),
cb AS (SELECT l.batch_id, l."column", CAST({bin_expr} AS BIGINT) AS bin
       FROM clong l JOIN rng USING ("column") {where}),
ccount AS (SELECT batch_id, "column", bin, count(*) AS count FROM cb GROUP BY ALL),
cn AS (SELECT p.batch_id, p."column", coalesce(sum(c.count), 0) AS n_cur
       FROM pairs p LEFT JOIN ccount c ON c.batch_id = p.batch_id AND c."column" = p."column" GROUP BY ALL),
grid AS (SELECT p.batch_id, p."column", h.bin, h.share, h.density, p.lo, p.hi, coalesce(cc.count, 0) AS count, cn.n_cur
         FROM pairs p JOIN refh h ON h."column" = p."column"
         JOIN cn ON cn.batch_id = p.batch_id AND cn."column" = p."column"
         LEFT JOIN ccount cc ON cc.batch_id = p.batch_id AND cc."column" = p."column" AND cc.bin = h.bin),
terms AS (SELECT batch_id, "column", ({cval}) + 1e-6 AS c, {rval} + 1e-6 AS r FROM grid),
psi_num AS (SELECT batch_id, "column", sum((c - r) * ln(c / r)) AS psi FROM terms GROUP BY ALL)"""


def _psi_num_query(mode):
    sql = with_cleaned(_psi_num_sql(mode) + "\nSELECT batch_id, \"column\", round(psi, 6) AS psi FROM psi_num",
                       features=True)

    def run(spark, sf_dir):
        df = cleaned(spark, sf_dir, features=True)
        ref = D.reference_histogram(df, MON_NUM)
        return D.psi_numeric(df, ref, MON_NUM, mode=mode).withColumn("psi", r6("psi"))
    return sql, run


for _mode in ("clamp", "proportion", "density"):
    _sql, _run = _psi_num_query(_mode)
    query(f"a15_psi_{_mode}", _sql)(_run)


# ---- A16 categorical PSI ----------------------------------------------------
def _psi_cat_sql() -> str:
    rcat = union_all_sql([f"SELECT '{c}' AS \"column\", CAST({_q(c)} AS VARCHAR) AS value FROM cleaned "
                          f"WHERE batch_id < {S.reference_batches} AND {_q(c)} IS NOT NULL" for c in MON_CAT])
    ccat = union_all_sql([f"SELECT batch_id, '{c}' AS \"column\", CAST({_q(c)} AS VARCHAR) AS value FROM cleaned "
                          f"WHERE batch_id >= {S.reference_batches} AND {_q(c)} IS NOT NULL" for c in MON_CAT])
    return f""",
rdist AS (SELECT "column", value, count(*) / sum(count(*)) OVER (PARTITION BY "column") AS r
          FROM ({rcat}) x GROUP BY "column", value),
cdist AS (SELECT batch_id, "column", value, count(*) / sum(count(*)) OVER (PARTITION BY batch_id, "column") AS c
          FROM ({ccat}) y GROUP BY batch_id, "column", value),
cpairs AS (SELECT b.batch_id, x."column"
           FROM (SELECT DISTINCT batch_id FROM cleaned WHERE batch_id >= {S.reference_batches}) b
           CROSS JOIN (SELECT DISTINCT "column" FROM rdist) x),
psi_cat AS (
  SELECT p.batch_id, p."column", sum((coalesce(cd.c, 1e-6) - rd.r) * ln(coalesce(cd.c, 1e-6) / rd.r)) AS psi
  FROM cpairs p JOIN rdist rd ON rd."column" = p."column"
  LEFT JOIN cdist cd ON cd.batch_id = p.batch_id AND cd."column" = p."column" AND cd.value = rd.value
  GROUP BY ALL)"""


A16_SQL = with_cleaned(_psi_cat_sql() + "\nSELECT batch_id, \"column\", round(psi, 6) AS psi FROM psi_cat",
                       features=True)


@query("a16_psi_categorical", A16_SQL)
def a16_psi_categorical(spark, sf_dir):
    return D.psi_categorical(cleaned(spark, sf_dir, features=True), MON_CAT).withColumn("psi", r6("psi"))


# ---- A17 drift report -------------------------------------------------------
A17_SQL = with_cleaned(_psi_num_sql("clamp") + _psi_cat_sql() + f""",
allpsi AS (SELECT batch_id, "column", 'numeric' AS kind, psi FROM psi_num
           UNION ALL SELECT batch_id, "column", 'categorical' AS kind, psi FROM psi_cat)
SELECT batch_id, "column", kind, round(psi, 6) AS psi, CAST({S.psi_threshold} AS DOUBLE) AS threshold,
       coalesce(psi > {S.psi_threshold}, false) AS drifted,
       CASE WHEN coalesce(psi > {S.psi_threshold}, false) THEN (CASE WHEN psi > 0.3 THEN 'high' ELSE 'moderate' END) END AS severity
FROM allpsi""", features=True)


@query("a17_drift", A17_SQL)
def a17_drift(spark, sf_dir):
    return D.detect_drift(cleaned(spark, sf_dir, features=True)).withColumn("psi", r6("psi"))
