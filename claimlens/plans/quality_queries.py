"""Registered queries: data quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimlens.operators import quality as Q
from claimlens.plans.registry import query, r6, union_all_sql
from claimlens.settings import DEFAULTS
from claimlens.sources.fixtures import POLICY_COLUMNS, policies, with_policies

S = DEFAULTS
NUM = list(S.numeric_columns)
CAT = list(S.categorical_columns)


def _q(c: str) -> str:
    return f'"{c}"'


# ---- A1 --------------------------------------------------------------------
A1_SQL = with_policies(union_all_sql([
    f"SELECT batch_id, {i} AS col_ord, '{c}' AS \"column\", count(*) - count({_q(c)}) AS nulls, "
    f"count(*) AS total_rows, round((count(*) - count({_q(c)})) / count(*), 6) AS null_ratio "
    f"FROM policies GROUP BY batch_id"
    for i, c in enumerate(POLICY_COLUMNS)]), indexed=False)


@query("a1_null_ratios", A1_SQL)
def a1_null_ratios(spark, sf_dir):
    df = policies(spark, sf_dir, with_index=False)
    return Q.null_ratios(df).withColumn("null_ratio", r6("null_ratio"))


# ---- A3 --------------------------------------------------------------------
def _iqr_cte(source: str, cols: list[str]) -> str:
    """SQL: per (batch, column) quartiles and fences, plus outlier counts."""
    long = union_all_sql([
        f"SELECT batch_id, {i} AS col_ord, '{c}' AS \"column\", CAST({_q(c)} AS DOUBLE) AS v FROM {source}"
        for i, c in enumerate(cols)])
    return f"""
long AS ({long}),
q AS (SELECT batch_id, col_ord, "column",
             quantile_cont(v, 0.25) AS q25, quantile_cont(v, 0.75) AS q75
      FROM long GROUP BY batch_id, col_ord, "column"),
b AS (SELECT *, q25 - 1.5 * (q75 - q25) AS lower_bound, q75 + 1.5 * (q75 - q25) AS upper_bound FROM q),
prof AS (
  SELECT l.batch_id, l.col_ord, l."column", count(*) AS total_rows,
         count(*) FILTER (WHERE l.v < b.lower_bound OR l.v > b.upper_bound) AS outliers,
         any_value(b.lower_bound) AS lower_bound, any_value(b.upper_bound) AS upper_bound
  FROM long l LEFT JOIN b ON l.batch_id = b.batch_id AND l."column" = b."column"
  GROUP BY l.batch_id, l.col_ord, l."column")"""


A3_SQL = with_policies(f""",{_iqr_cte('policies', NUM)}
SELECT batch_id, col_ord, "column", total_rows, outliers,
       round(lower_bound, 8) AS lower_bound, round(upper_bound, 8) AS upper_bound,
       round(outliers / total_rows, 6) AS outlier_ratio
FROM prof""", indexed=False)


@query("a3_outlier_profile", A3_SQL)
def a3_outlier_profile(spark, sf_dir):
    df = policies(spark, sf_dir, with_index=False)
    return (Q.outlier_profile(df)
            .select("batch_id", "col_ord", "column", "total_rows", "outliers",
                    # fences of 6-decimal data have 7 decimals: round past them (no ties)
                    F.round("lower_bound", 8).alias("lower_bound"), F.round("upper_bound", 8).alias("upper_bound"),
                    r6("outlier_ratio").alias("outlier_ratio")))


# ---- A4 --------------------------------------------------------------------
A4_SQL = with_policies(union_all_sql([
    f"SELECT batch_id, {i} AS col_ord, '{c}' AS \"column\", count(*) AS total_rows, "
    f"count(DISTINCT {_q(c)}) AS n_unique, round(count(DISTINCT {_q(c)}) / count(*), 6) AS unique_ratio "
    f"FROM policies GROUP BY batch_id"
    for i, c in enumerate(CAT)]), indexed=False)


@query("a4_unique_ratios", A4_SQL)
def a4_unique_ratios(spark, sf_dir):
    df = policies(spark, sf_dir, with_index=False)
    return Q.unique_ratios(df).withColumn("unique_ratio", r6("unique_ratio"))


@query("a4_unique_approx", A4_SQL)
def a4_unique_approx(spark, sf_dir):
    """By the sketches of one scan: so few distinct values they count exactly."""
    df = policies(spark, sf_dir, with_index=False)
    return Q.unique_ratios(df, method="approx").withColumn("unique_ratio", r6("unique_ratio"))


# ---- A5 --------------------------------------------------------------------
def _issues_sql() -> str:
    nulls = union_all_sql([
        f"SELECT batch_id, {i} AS issue_ord, 'high_null_ratio' AS type, '{c}' AS \"column\", "
        f"(count(*) - count({_q(c)})) / count(*) AS value, CAST({S.max_null_ratio} AS DOUBLE) AS threshold "
        f"FROM policies GROUP BY batch_id HAVING (count(*) - count({_q(c)})) / count(*) > {S.max_null_ratio}"
        for i, c in enumerate(POLICY_COLUMNS)])
    cards = union_all_sql([
        f"SELECT batch_id, {2000 + i} AS issue_ord, 'low_cardinality' AS type, '{c}' AS \"column\", "
        f"count(DISTINCT {_q(c)}) / count(*) AS value, CAST({S.min_unique_ratio} AS DOUBLE) AS threshold "
        f"FROM policies GROUP BY batch_id HAVING count(DISTINCT {_q(c)}) / count(*) < {S.min_unique_ratio}"
        for i, c in enumerate(CAT)])
    return f""",{_iqr_cte('policies', NUM)},
issues AS (
  {nulls}
  UNION ALL
  SELECT batch_id, 1000 + col_ord AS issue_ord, 'high_outlier_ratio' AS type, "column",
         outliers / total_rows AS value, CAST({S.max_outlier_ratio} AS DOUBLE) AS threshold
  FROM prof WHERE outliers / total_rows > {S.max_outlier_ratio}
  UNION ALL
  {cards}),
totals AS (SELECT batch_id, count(*) AS total_rows FROM policies GROUP BY batch_id),
summary AS (
  SELECT t.batch_id, t.total_rows, {len(POLICY_COLUMNS)} AS total_columns,
         coalesce(i.n, 0) AS issue_count,
         CAST(greatest(0, 100 - 2 * coalesce(i.n, 0)) AS DOUBLE) AS quality_score
  FROM totals t LEFT JOIN (SELECT batch_id, count(*) AS n FROM issues GROUP BY batch_id) i
    ON t.batch_id = i.batch_id)"""


A5_SQL = with_policies(_issues_sql() + "\nSELECT * FROM summary", indexed=False)
A5_ISSUES_SQL = with_policies(_issues_sql() + """
SELECT batch_id, issue_ord, type, "column", round(value, 6) AS value, threshold FROM issues""", indexed=False)
A6_SQL = with_policies(_issues_sql() + """
SELECT s.batch_id, s.quality_score, s.issue_count, coalesce(r.issues, '') AS issues
FROM summary s LEFT JOIN (
  SELECT batch_id, string_agg(printf('%s: %s (value=%.3f)', type, "column", value), '<br>' ORDER BY issue_ord) AS issues
  FROM issues GROUP BY batch_id) r ON s.batch_id = r.batch_id""", indexed=False)


def quality_flagship(spark, sf_dir):
    df = policies(spark, sf_dir, with_index=False)
    return Q.quality_summary(df)


query("a5_quality", A5_SQL)(quality_flagship)


@query("a5_quality_issues", A5_ISSUES_SQL)
def a5_quality_issues(spark, sf_dir):
    df = policies(spark, sf_dir, with_index=False)
    return Q.quality_issues(df).withColumn("value", r6("value"))


@query("a5_issues_two_scans", A5_ISSUES_SQL)
def a5_issues_two_scans(spark, sf_dir):
    df = policies(spark, sf_dir, with_index=False)
    return Q.quality_issues(df, settings=S.with_(few_scans=True)).withColumn("value", r6("value"))


@query("a6_report_rows", A6_SQL)
def a6_report_rows(spark, sf_dir):
    df = policies(spark, sf_dir, with_index=False)
    return Q.quality_report_rows(df)


# ---- P18 -------------------------------------------------------------------
P18_SQL = with_policies(f""",{_iqr_cte('policies', ['PREMIUM', 'INSURED_VALUE'])}
SELECT p.batch_id, count(*) AS total_rows,
       count(*) FILTER (WHERE coalesce(p.PREMIUM < bp.lower_bound OR p.PREMIUM > bp.upper_bound, false)
                           OR coalesce(p.INSURED_VALUE < bi.lower_bound OR p.INSURED_VALUE > bi.upper_bound, false)) AS outlier_rows
FROM policies p
LEFT JOIN b bp ON bp.batch_id = p.batch_id AND bp."column" = 'PREMIUM'
LEFT JOIN b bi ON bi.batch_id = p.batch_id AND bi."column" = 'INSURED_VALUE'
GROUP BY p.batch_id""", indexed=False)


@query("p18_outlier_rows", P18_SQL)
def p18_outlier_rows(spark, sf_dir):
    df = policies(spark, sf_dir, with_index=False)
    flagged = Q.flag_outliers(df, ["PREMIUM", "INSURED_VALUE"])
    return flagged.groupBy("batch_id").agg(F.count(F.lit(1)).alias("total_rows"),
                                           F.count_if("is_outlier").alias("outlier_rows"))
