"""Registered queries: features (P1-P15, P19-P20), dedup and positions (W1,
W2, O2, U2), sources and batch bookkeeping (S1-S11) and preparation
(E1-E7, A20)."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimlens.functions import dates as DT
from claimlens.functions import features as X
from claimlens.operators import prepare as E
from claimlens.operators.dedup import concat_parts
from claimlens.operators.positions import assign_batches, slice_rows, temporal_split, with_row_index
from claimlens.plans.registry import query, r6, union_all_sql
from claimlens.session import scratch_dir
from claimlens.settings import DEFAULTS
from claimlens.sources import batches as SB
from claimlens.sources.fixtures import (CLEANED_SQL, FEATURES_SQL, POLICIES_SQL, POLICY_COLUMNS, cleaned,
                                        policies, with_cleaned, with_policies)

S = DEFAULTS
KEYS = ["batch_id", "OBJECT_ID", "tie1", "tie2"]
KEYS_SQL = "batch_id, OBJECT_ID, tie1, tie2"
FIX_TIES = ("OBJECT_ID", "tie1", "tie2", "tie3")
FIX_YEAR = 1998          # year present in both the old (< 5) and new (>= 5) batches of the fixture
BEGIN_KEY = "coalesce(INSR_BEGIN, DATE '9999-12-31')"


def _q(c):
    return f'"{c}"'


# ---- P1, P2, P3 dates -------------------------------------------------------------
@query("p1_parse_dates", with_cleaned(f"""
SELECT {KEYS_SQL}, upper(strftime(INSR_BEGIN, '%d-%b-%y')) AS begin_text, INSR_BEGIN AS parsed
FROM cleaned"""))
def p1_parse_dates(spark, sf_dir):
    df = cleaned(spark, sf_dir).select(*KEYS, DT.format_policy_date("INSR_BEGIN").alias("begin_text"))
    return df.withColumn("parsed", DT.parse_policy_date("begin_text"))


_MIXED_SQL = """CASE OBJECT_ID % 3 WHEN 0 THEN upper(strftime(INSR_BEGIN, '%d-%b-%y'))
                   WHEN 1 THEN strftime(INSR_BEGIN, '%Y-%m-%d')
                   ELSE strftime(INSR_BEGIN, '%m-%d-%y') END"""


@query("p2_mixed_dates", with_cleaned(f"""
SELECT {KEYS_SQL}, {_MIXED_SQL} AS begin_text, INSR_BEGIN AS parsed FROM cleaned"""))
def p2_mixed_dates(spark, sf_dir):
    d = F.col("INSR_BEGIN")
    text = (F.when(F.col("OBJECT_ID") % 3 == 0, DT.format_policy_date(d))
             .when(F.col("OBJECT_ID") % 3 == 1, F.date_format(d, "yyyy-MM-dd"))
             .otherwise(F.date_format(d, "MM-dd-yy")))
    df = cleaned(spark, sf_dir).select(*KEYS, text.alias("begin_text"))
    return df.withColumn("parsed", DT.parse_mixed_date("begin_text"))


@query("p3_year", with_cleaned(f"SELECT {KEYS_SQL}, CAST(year(INSR_BEGIN) AS INTEGER) AS INSR_YEAR FROM cleaned"))
def p3_year(spark, sf_dir):
    return cleaned(spark, sf_dir).select(*KEYS, DT.policy_year("INSR_BEGIN").alias("INSR_YEAR"))


# ---- P4-P10 features -------------------------------------------------------------------
_FEATURE_SQL_LINES = {
    "policy_duration_days": "CAST(coalesce(date_diff('day', INSR_BEGIN, INSR_END), 365) AS INTEGER)",
    "premium_per_seat": "round(PREMIUM / nullif(SEATS_NUM + 1e-6, 0), 6)",
    "insured_value_per_ton": "round(INSURED_VALUE / nullif(CCM_TON + 1e-6, 0), 6)",
    "claim_ratio": ("round(CASE WHEN CLAIM_PAID / nullif(PREMIUM + 1e-6, 0) IS NULL THEN NULL "
                    "ELSE least(10e0, greatest(0e0, CLAIM_PAID / nullif(PREMIUM + 1e-6, 0))) END, 6)"),
    "is_claim": "coalesce(CAST(CLAIM_PAID > 0 AS INTEGER), 0)",
    "premium_log": "round(CASE WHEN PREMIUM + 1e-6 > 0 THEN ln(PREMIUM + 1e-6) END, 6)",
}
_FEATURE_COLS = {
    "policy_duration_days": lambda: X.policy_duration_days(),
    "premium_per_seat": lambda: r6(X.premium_per_seat()),
    "insured_value_per_ton": lambda: r6(X.insured_value_per_ton()),
    "claim_ratio": lambda: r6(X.claim_ratio()),
    "is_claim": lambda: X.is_claim(),
    "premium_log": lambda: r6(X.premium_log()),
}
_IDS = {"policy_duration_days": "p4_duration", "premium_per_seat": "p5_premium_per_seat",
        "insured_value_per_ton": "p6_value_per_ton", "claim_ratio": "p7_claim_ratio",
        "is_claim": "p8_is_claim", "premium_log": "p9_premium_log"}


def _feature_query(feat):
    def run(spark, sf_dir):
        return cleaned(spark, sf_dir).select(*KEYS, _FEATURE_COLS[feat]().alias(feat))
    return run


for _f, _name in _IDS.items():
    query(_name, with_cleaned(f"SELECT {KEYS_SQL}, {_FEATURE_SQL_LINES[_f]} AS {_f} FROM cleaned"))(_feature_query(_f))


@query("p10_features", with_cleaned(
    f"SELECT {KEYS_SQL}, " + ", ".join(f"{v} AS {k}" for k, v in _FEATURE_SQL_LINES.items()) + " FROM cleaned"))
def p10_features(spark, sf_dir):
    df = X.create_features(cleaned(spark, sf_dir))
    return df.select(*KEYS, *[(r6(F.col(f)) if f not in ("is_claim", "policy_duration_days") else F.col(f)).alias(f)
                              for f in S.features])


@query("p11_add_features", with_cleaned(
    f"SELECT {KEYS_SQL}, CAST(0 AS DOUBLE) AS premium_log, "
    + ", ".join(f"{v} AS {k}" for k, v in _FEATURE_SQL_LINES.items() if k != "premium_log") + " FROM cleaned"))
def p11_add_features(spark, sf_dir):
    df = cleaned(spark, sf_dir).withColumn("premium_log", F.lit(0.0))
    df = X.add_missing_features(df)
    return df.select(*KEYS, "premium_log", *[(r6(F.col(f)) if f not in ("is_claim", "policy_duration_days")
                                               else F.col(f)).alias(f) for f in S.features if f != "premium_log"])


@query("p12_fill_target", with_cleaned(f"SELECT {KEYS_SQL}, coalesce(CLAIM_PAID, 0e0) AS CLAIM_PAID FROM cleaned"))
def p12_fill_target(spark, sf_dir):
    return X.fill_target(cleaned(spark, sf_dir)).select(*KEYS, "CLAIM_PAID")


@query("p13_target_defaults", with_cleaned(
    f"SELECT {KEYS_SQL}, CAST(0 AS DOUBLE) AS claim_ratio, CAST(0 AS INTEGER) AS is_claim FROM cleaned"))
def p13_target_defaults(spark, sf_dir):
    df = X.target_free_defaults(cleaned(spark, sf_dir).drop("CLAIM_PAID"))
    return df.select(*KEYS, "claim_ratio", "is_claim")


_KEPT = [c for c in POLICY_COLUMNS if c not in S.drop_columns]


@query("p14_drop_columns", with_cleaned(
    "SELECT batch_id, tie1, tie2, tie3, " + ", ".join(_q(c) for c in _KEPT) + " FROM cleaned"))
def p14_drop_columns(spark, sf_dir):
    return X.drop_columns(cleaned(spark, sf_dir), list(S.drop_columns) + ["NOT_THERE"])


_ALIGN = ["tie1", "tie2", "PREMIUM", "EXTRA_FEATURE", "SEATS_NUM", "MAKE"]


@query("p15_align", with_cleaned(
    "SELECT tie1, tie2, PREMIUM, 0 AS EXTRA_FEATURE, SEATS_NUM, MAKE FROM cleaned"))
def p15_align(spark, sf_dir):
    return X.align_columns(cleaned(spark, sf_dir), _ALIGN, 0)


@query("p19_year_filter", with_cleaned(f"SELECT {KEYS_SQL}, PREMIUM FROM cleaned WHERE year(INSR_BEGIN) = {FIX_YEAR}"))
def p19_year_filter(spark, sf_dir):
    df = cleaned(spark, sf_dir).withColumn("INSR_YEAR", DT.policy_year("INSR_BEGIN"))
    return E.year_filter(df, FIX_YEAR).select(*KEYS, "PREMIUM")


# ---- A20, P20 inflation ---------------------------------------------------------------
_COEF_SQL = f"""coef AS (
  SELECT (SELECT median(PREMIUM) FROM cleaned WHERE batch_id >= 5 AND year(INSR_BEGIN) = {FIX_YEAR}) AS new_median,
         (SELECT median(PREMIUM) FROM cleaned WHERE batch_id < 5 AND year(INSR_BEGIN) = {FIX_YEAR}) AS old_median)"""


@query("a20_inflation", with_cleaned(f""", {_COEF_SQL}
SELECT round(new_median, 9) AS new_median, round(old_median, 9) AS old_median,
       round(new_median / nullif(old_median, 0), 6) AS coef FROM coef"""))
def a20_inflation(spark, sf_dir):
    df = cleaned(spark, sf_dir).withColumn("INSR_YEAR", DT.policy_year("INSR_BEGIN"))
    c = E.inflation_coefficient(df.where("batch_id < 5"), df.where("batch_id >= 5"), FIX_YEAR)
    return c.select(F.round("new_median", 9).alias("new_median"), F.round("old_median", 9).alias("old_median"),
                    r6("coef").alias("coef"))


@query("p20_inflate", with_cleaned(f""", {_COEF_SQL}
SELECT {KEYS_SQL},
       round(CLAIM_PAID * coalesce(new_median / nullif(old_median, 0), 1e0), 6) AS CLAIM_PAID,
       round(INSURED_VALUE * coalesce(new_median / nullif(old_median, 0), 1e0), 6) AS INSURED_VALUE,
       round(PREMIUM * coalesce(new_median / nullif(old_median, 0), 1e0), 6) AS PREMIUM
FROM cleaned, coef WHERE batch_id < 5"""))
def p20_inflate(spark, sf_dir):
    df = cleaned(spark, sf_dir).withColumn("INSR_YEAR", DT.policy_year("INSR_BEGIN"))
    old = E.apply_inflation(df.where("batch_id < 5"), df.where("batch_id >= 5"), year=FIX_YEAR)
    return old.select(*KEYS, *[r6(c).alias(c) for c in ("CLAIM_PAID", "INSURED_VALUE", "PREMIUM")])


# ---- W1, W2, O2, U2 --------------------------------------------------------------------
@query("w1_dedup", with_policies(f"SELECT * FROM ({CLEANED_SQL}) c", indexed=False))
def w1_dedup(spark, sf_dir):
    return cleaned(spark, sf_dir, stored=False)      # runs the dedup itself


@query("w1_rows_removed", with_policies(f"""
SELECT p.batch_id, p.n AS rows_before, c.n AS rows_after, p.n - c.n AS rows_removed
FROM (SELECT batch_id, count(*) AS n FROM policies GROUP BY batch_id) p
JOIN (SELECT batch_id, count(*) AS n FROM ({CLEANED_SQL}) x GROUP BY batch_id) c USING (batch_id)""", indexed=False))
def w1_rows_removed(spark, sf_dir):
    from claimlens.operators.dedup import rows_removed
    return rows_removed(policies(spark, sf_dir, with_index=False), cleaned(spark, sf_dir, stored=False))


@query("w2_row_index", with_policies(f"SELECT row_index, {KEYS_SQL} FROM policies"))
def w2_row_index(spark, sf_dir):
    # the two-level rank itself, over the stored (unindexed) raw rows
    from claimlens.sources.fixtures import MISSING_DATE_SENTINEL
    p = policies(spark, sf_dir, with_index=False).withColumn(
        "_bk", F.coalesce("INSR_BEGIN", F.lit(MISSING_DATE_SENTINEL).cast("date")))
    return with_row_index(p, ["_bk", *FIX_TIES]).select("row_index", *KEYS)


@query("o1_sort_by_start", with_cleaned(f"""
SELECT {KEYS_SQL}, row_number() OVER (ORDER BY {BEGIN_KEY}, OBJECT_ID, tie1, tie2, tie3) - 1 AS position
FROM cleaned"""))
def o1_sort_by_start(spark, sf_dir):
    return E.order_by_start(cleaned(spark, sf_dir), FIX_TIES, "position").select(*KEYS, "position")


@query("s12_fallback_load", with_policies(f"SELECT {KEYS_SQL}, PREMIUM FROM policies", indexed=False))
def s12_fallback_load(spark, sf_dir):
    """No cleaned table and no cleaned CSV yet: the last raw source is loaded."""
    missing = scratch_dir(spark, "not_written")
    raw = scratch_dir(spark, "raw_source")
    policies(spark, sf_dir, with_index=False).write.parquet(raw)
    return SB.load_cleaned(spark, missing, missing + "_csv", [missing + "_first", raw]).select(*KEYS, "PREMIUM")


@query("o2_split", with_cleaned(f"""
SELECT *, row_index < split_idx AS is_train FROM (
  SELECT {KEYS_SQL}, row_number() OVER (ORDER BY {BEGIN_KEY}, OBJECT_ID, tie1, tie2, tie3) - 1 AS row_index,
         CAST(floor(count(*) OVER () * {S.train_split}) AS BIGINT) AS split_idx
  FROM cleaned) t"""))
def o2_split(spark, sf_dir):
    df = E.order_by_start(cleaned(spark, sf_dir), FIX_TIES, "row_index").select("row_index", *KEYS)
    return temporal_split(df, S.train_split)


@query("u2_concat", with_cleaned(f"""
SELECT *, row_index < split_idx AS is_train FROM (
  SELECT part_ord, {KEYS_SQL},
         row_number() OVER (ORDER BY part_ord, {BEGIN_KEY}, OBJECT_ID, tie1, tie2, tie3) - 1 AS row_index,
         CAST(floor(count(*) OVER () * {S.train_split}) AS BIGINT) AS split_idx
  FROM (SELECT 0 AS part_ord, * FROM cleaned WHERE batch_id >= 5
        UNION ALL SELECT 1 AS part_ord, * FROM cleaned WHERE batch_id < 5) u) t"""))
def u2_concat(spark, sf_dir):
    c = cleaned(spark, sf_dir)
    both = concat_parts([c.where("batch_id >= 5"), c.where("batch_id < 5")])
    keyed = both.withColumn("_bk", F.coalesce("INSR_BEGIN", F.lit("9999-12-31").cast("date")))
    pos = with_row_index(keyed, ["part_ord", "_bk", *FIX_TIES]).select("part_ord", *KEYS, "row_index")
    return temporal_split(pos, S.train_split)


# ---- S1-S11 sources and batch bookkeeping -----------------------------------------------
_SRC_SQL = f"""src AS (
  SELECT *, row_number() OVER (ORDER BY source_ord, {BEGIN_KEY}, OBJECT_ID, tie1, tie2, tie3) - 1 AS row_index
  FROM (SELECT 0 AS source_ord, * FROM policies WHERE batch_id < 5
        UNION ALL SELECT 1 AS source_ord, * REPLACE (NULL::DOUBLE AS CARRYING_CAPACITY) FROM policies WHERE batch_id >= 5) u)"""


def _sources(spark, sf_dir):
    p = policies(spark, sf_dir, with_index=False).withColumn(
        "_bk", F.coalesce("INSR_BEGIN", F.lit("9999-12-31").cast("date")))
    return SB.union_sources([p.where("batch_id < 5"), p.where("batch_id >= 5").drop("CARRYING_CAPACITY")],
                            ["_bk", *FIX_TIES]).drop("_bk")


@query("s2_union_sources", with_policies(f""", {_SRC_SQL}
SELECT source_ord, row_index, {KEYS_SQL}, CARRYING_CAPACITY FROM src""", indexed=False))
def s2_union_sources(spark, sf_dir):
    return _sources(spark, sf_dir).select("source_ord", "row_index", *KEYS, "CARRYING_CAPACITY")


@query("s3_source_size", with_policies("""
SELECT source_ord, count(*) AS size FROM (
  SELECT CASE WHEN batch_id < 5 THEN 0 ELSE 1 END AS source_ord FROM policies) t
GROUP BY ROLLUP (source_ord)""", indexed=False))
def s3_source_size(spark, sf_dir):
    return SB.source_sizes(_sources(spark, sf_dir))


_SLICE = (20000, 30000)


@query("s4_slice_rows", with_policies(f""", {_SRC_SQL}
SELECT source_ord, row_index, {KEYS_SQL} FROM src
WHERE row_index >= {_SLICE[0]} AND row_index < {_SLICE[0] + _SLICE[1]}""", indexed=False))
def s4_slice_rows(spark, sf_dir):
    return slice_rows(_sources(spark, sf_dir), *_SLICE).select("source_ord", "row_index", *KEYS)


_BATCHES_SQL = f"""cut AS (
  SELECT CAST(floor(row_index / {S.batch_size}) AS INTEGER) AS batch_no, row_index FROM policies)"""


@query("s5_assign_batches", with_policies(f""", {_BATCHES_SQL}
SELECT batch_no, count(*) AS size, min(row_index) AS first_row, max(row_index) AS last_row
FROM cut GROUP BY batch_no"""))
def s5_assign_batches(spark, sf_dir):
    b = assign_batches(policies(spark, sf_dir).drop("batch_id"), S.batch_size, name="batch_no")
    return b.groupBy("batch_no").agg(F.count(F.lit(1)).alias("size"), F.min("row_index").alias("first_row"),
                                     F.max("row_index").alias("last_row"))


def _meta(spark, sf_dir):
    b = assign_batches(policies(spark, sf_dir).drop("batch_id"), S.batch_size)
    return SB.batch_metadata(b, "lineitem;orders;part;customer", "1.0.0")


@query("s7_next_offsets", with_policies(f""", {_BATCHES_SQL}
SELECT CAST(max(batch_no) + 1 AS INTEGER) AS next_batch_id,
       CAST(arg_max(first_row + size, first_row) AS BIGINT) AS next_source_offset
FROM (SELECT batch_no, min(row_index) AS first_row, count(*) AS size FROM cut GROUP BY batch_no) m"""))
def s7_next_offsets(spark, sf_dir):
    m = _meta(spark, sf_dir)
    a = SB.next_batch_id(m).withColumn("_k", F.lit(1))
    b = SB.next_source_offset(m, "lineitem;orders;part;customer").withColumn("_k", F.lit(1))
    return a.join(b, "_k").drop("_k")


@query("s9_metadata_upsert", with_policies(f""", {_BATCHES_SQL},
m AS (SELECT batch_no AS batch_id, min(row_index) AS index_in_source, count(*) AS size FROM cut GROUP BY batch_no)
SELECT batch_id, 'lineitem;orders;part;customer' AS sources, index_in_source, size,
       '1.0.0' AS data_collection_version,
       CASE WHEN batch_id = 0 THEN '1.0.0' END AS data_analysis_version FROM m
UNION ALL
SELECT 99, 'later', CAST(0 AS BIGINT), CAST(1 AS BIGINT), '1.0.0', NULL"""))
def s9_metadata_upsert(spark, sf_dir):
    m = _meta(spark, sf_dir)
    upd = spark.createDataFrame([(0, "1.0.0")], "batch_id int, data_analysis_version string")
    new = spark.createDataFrame([(99, "later", 0, 1, "1.0.0")],
                                "batch_id int, sources string, index_in_source long, size long, data_collection_version string")
    out = SB.upsert_metadata(SB.upsert_metadata(m, upd), new)
    return out.drop("ts")


@query("s9_compacted_metadata", with_policies(f""", {_BATCHES_SQL},
m AS (SELECT batch_no AS batch_id, min(row_index) AS index_in_source, count(*) AS size FROM cut GROUP BY batch_no)
SELECT batch_id, CASE WHEN batch_id = 1 THEN 'again' ELSE 'lineitem;orders;part;customer' END AS sources, index_in_source, size,
       '1.0.0' AS data_collection_version, CASE WHEN batch_id = 0 THEN '1.0.1' ELSE '1.0.0' END AS data_analysis_version FROM m"""))
def s9_compacted_metadata(spark, sf_dir):
    """The stored log after three rounds of changes, each folded into a snapshot, and one change since."""
    path, m = scratch_dir(spark, "metadata"), _meta(spark, sf_dir)

    def change(rows, **fields):
        SB.append_metadata(spark, path, rows.select("batch_id", *[
            F.lit(fields.get(f.name)).cast(f.dataType).alias(f.name) for f in SB.METADATA_SCHEMA.fields if f.name != "batch_id"]))
    SB.append_metadata(spark, path, m)
    SB.compact(spark, path)
    change(m, data_analysis_version="1.0.0")
    SB.compact(spark, path)
    change(m.where("batch_id = 0"), data_analysis_version="1.0.1")
    SB.compact(spark, path)
    change(m.where("batch_id = 1"), sources="again")
    return SB.read_metadata(spark, path).drop("ts")


@query("s11_contiguous_batches", with_policies("""
SELECT batch_id, count(*) AS n FROM policies WHERE batch_id < 3 GROUP BY batch_id""", indexed=False))
def s11_contiguous_batches(spark, sf_dir):
    t = policies(spark, sf_dir, with_index=False).where("batch_id <> 3")
    return SB.contiguous_batches(t).groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"))


@query("s10_read_batch", with_policies(f"SELECT {KEYS_SQL}, PREMIUM FROM policies WHERE batch_id = 3", indexed=False))
def s10_read_batch(spark, sf_dir):
    path = scratch_dir(spark, "raw_batches")
    SB.write_batches(policies(spark, sf_dir, with_index=False), path)
    return SB.read_batch(spark, path, 3).select(*KEYS, "PREMIUM")


@query("s1_csv_scan", with_cleaned(f'SELECT {KEYS_SQL}, INSR_BEGIN, PREMIUM, "USAGE" FROM cleaned'))
def s1_csv_scan(spark, sf_dir):
    from pyspark.sql import types as T
    path = scratch_dir(spark, "policies_csv")
    src = cleaned(spark, sf_dir).select(
        *KEYS, DT.format_policy_date("INSR_BEGIN").alias("INSR_BEGIN"),
        F.coalesce(F.col("PREMIUM").cast("string"), F.lit("NaN")).alias("PREMIUM"),
        F.coalesce("USAGE", F.lit("NA")).alias("USAGE"))
    src.write.option("header", True).csv(path)
    schema = T.StructType([T.StructField("batch_id", T.IntegerType()), T.StructField("OBJECT_ID", T.LongType()),
                           T.StructField("tie1", T.LongType()), T.StructField("tie2", T.LongType()),
                           T.StructField("INSR_BEGIN", T.StringType()), T.StructField("PREMIUM", T.DoubleType()),
                           T.StructField("USAGE", T.StringType())])
    df = SB.read_policies(spark, path, schema)
    return df.withColumn("INSR_BEGIN", DT.parse_policy_date("INSR_BEGIN"))


_NOTE_SQL = """CASE WHEN tie1 % 7 = 0 THEN 'two' || chr(10) || 'lines, "' || tie2 || '"' WHEN tie1 % 7 = 1 THEN NULL ELSE 'back\\slash' END"""


@query("s1_csv_by_header", with_policies(f"""
SELECT OBJECT_ID, tie1, tie2, PREMIUM, "USAGE", CASE WHEN batch_id < 5 THEN NULL ELSE {_NOTE_SQL} END AS NOTE,
       CAST(CASE WHEN batch_id < 5 THEN tie1 END AS DOUBLE) AS WEIGHT, CAST(NULL AS DOUBLE) AS CCM_TON,
       row_number() OVER (ORDER BY batch_id >= 5, row_index) - 1 AS position
FROM policies"""))
def s1_csv_by_header(spark, sf_dir):
    """Two folders of CSV files with their own column orders, a column of their own each,
    one that both lack, and quoted line ends in the second: read by name, in file order."""
    from pyspark.sql import types as T
    src = policies(spark, sf_dir)
    common = [F.coalesce(F.col("PREMIUM").cast("string"), F.lit("NaN")).alias("PREMIUM"), F.coalesce("USAGE", F.lit("NA")).alias("USAGE"), "tie2", "OBJECT_ID", "tie1"]
    first, second = scratch_dir(spark, "header_csv"), scratch_dir(spark, "header_csv")
    for path, rows in ((first, src.where("batch_id < 5").select("row_index", *common, F.col("tie1").alias("WEIGHT"))),
                       (second, src.where("batch_id >= 5").select("row_index", *reversed(common), F.expr(_NOTE_SQL.replace("\\", "\\\\")).alias("NOTE")))):
        rows.orderBy("row_index").drop("row_index").write.option("header", True).option("escape", '"').csv(path)
    schema = T.StructType([T.StructField("OBJECT_ID", T.LongType()), T.StructField("tie1", T.LongType()), T.StructField("tie2", T.LongType()),
                           T.StructField("PREMIUM", T.DoubleType()), T.StructField("USAGE", T.StringType()), T.StructField("CCM_TON", T.DoubleType())])
    got = SB.read_ordered(spark, [first, second], schema)
    return got.select("OBJECT_ID", "tie1", "tie2", "PREMIUM", "USAGE", "NOTE", "WEIGHT", "CCM_TON", F.col("row_index").alias("position"))


def _fallback(branch):
    """S12 by one of its branches: the cleaned table without its batch 3, the cleaned CSV, or the last of two raw CSVs."""
    def run(spark, sf_dir):
        none, csv, other = (scratch_dir(spark, "fallback") for _ in range(3))
        c = cleaned(spark, sf_dir).select(*KEYS, "PREMIUM", "USAGE")
        if branch == "table":
            SB.write_batches(c.where("batch_id <> 3"), none)
        c.write.option("header", True).csv(csv + ".csv")
        c.limit(1).write.option("header", True).csv(other + ".csv")
        got = SB.load_cleaned(spark, none, csv + ".csv" if branch == "csv" else other, [other + ".csv", csv + ".csv"])
        return got.select(*[F.col(k).cast(c.schema[k].dataType).alias(k) for k in KEYS], "PREMIUM", "USAGE")
    return run


_FALLBACK_SQL = f'SELECT {KEYS_SQL}, PREMIUM, "USAGE" FROM cleaned'
query("s12_cleaned_table", with_cleaned(_FALLBACK_SQL + " WHERE batch_id < 3"))(_fallback("table"))
query("s12_cleaned_csv", with_cleaned(_FALLBACK_SQL))(_fallback("csv"))
query("s12_raw_csv", with_cleaned(_FALLBACK_SQL))(_fallback("raw"))


# ---- E1-E7 preparation ----------------------------------------------------------------
_NUM_PREP = ["INSURED_VALUE", "PREMIUM", "PROD_YEAR", "SEATS_NUM", "CARRYING_CAPACITY", "CCM_TON",
             "policy_duration_days", "premium_per_seat", "insured_value_per_ton", "claim_ratio", "is_claim",
             "premium_log", "INSR_YEAR"]
_CAT_PREP = ["SEX", "INSR_TYPE", "TYPE_VEHICLE", "MAKE", "USAGE"]
_FEATS = _NUM_PREP + _CAT_PREP

_BASE_SQL = f"""filled AS (SELECT * REPLACE (coalesce(CLAIM_PAID, 0e0) AS CLAIM_PAID) FROM ({CLEANED_SQL}) c),
feat AS (SELECT *, year(INSR_BEGIN) AS INSR_YEAR, {FEATURES_SQL} FROM filled),
pos AS (SELECT *, row_number() OVER (ORDER BY {BEGIN_KEY}, OBJECT_ID, tie1, tie2, tie3) - 1 AS row_index FROM feat),
base AS (SELECT * EXCLUDE (INSR_BEGIN, INSR_END, OBJECT_ID) FROM pos),
medians AS ({union_all_sql([f"SELECT '{c}' AS column_name, median(CAST({_q(c)} AS DOUBLE)) AS median FROM base" for c in _NUM_PREP])}),
modes AS ({union_all_sql([f"SELECT '{c}' AS column_name, (SELECT v FROM (SELECT {_q(c)} AS v, count(*) AS n FROM base WHERE {_q(c)} IS NOT NULL GROUP BY v ORDER BY n DESC, v LIMIT 1) x) AS mode" for c in _CAT_PREP])}),
imputed AS (SELECT batch_id, tie1, tie2, row_index, CLAIM_PAID,
  {", ".join(f"coalesce(CAST({_q(c)} AS DOUBLE), (SELECT median FROM medians WHERE column_name = '{c}')) AS {_q(c)}" for c in _NUM_PREP)},
  {", ".join(f"coalesce({_q(c)}, (SELECT mode FROM modes WHERE column_name = '{c}')) AS {_q(c)}" for c in _CAT_PREP)}
  FROM base),
dict AS ({union_all_sql([f"SELECT '{c}' AS column_name, v AS value, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS code FROM (SELECT DISTINCT {_q(c)} AS v FROM imputed WHERE {_q(c)} IS NOT NULL) d" for c in _CAT_PREP])}),
encoded AS (SELECT batch_id, tie1, tie2, row_index, CLAIM_PAID, {", ".join(_q(c) for c in _NUM_PREP)},
  {", ".join(f"coalesce((SELECT code FROM dict WHERE column_name = '{c}' AND value = i.{_q(c)}), -1) AS {_q(c)}" for c in _CAT_PREP)}
  FROM imputed i),
scal AS ({union_all_sql([f"SELECT '{c}' AS column_name, avg(CAST({_q(c)} AS DOUBLE)) AS mean, stddev_pop(CAST({_q(c)} AS DOUBLE)) AS std, min(CAST({_q(c)} AS DOUBLE)) AS mn, max(CAST({_q(c)} AS DOUBLE)) AS mx FROM encoded" for c in _FEATS])})"""


_STORED_PREP: dict = {}


def _prepared(spark, sf_dir, stored: bool = False):
    """E7 over the cleaned batches. ``stored=True`` is what the training and
    serving stages read: the prepared tables and fitted parameters written
    once per session (S13 sinks) and read back."""
    if not stored:
        return E.prepare(cleaned(spark, sf_dir), tie_cols=FIX_TIES)
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _STORED_PREP:
        p = E.prepare(cleaned(spark, sf_dir), tie_cols=FIX_TIES)
        _STORED_PREP[key] = scratch_dir(spark, "prepared")
        E.save_prepared(p, _STORED_PREP[key])
    return E.load_prepared(spark, _STORED_PREP[key])


@query("e1_impute_median", with_policies(f", {_BASE_SQL}\nSELECT column_name AS \"column\", round(median, 9) AS median FROM medians", indexed=False))
def e1_impute_median(spark, sf_dir):
    p = _prepared(spark, sf_dir)
    return p.medians.select("column", F.round("median", 9).alias("median"))


@query("e2_impute_mode", with_policies(f", {_BASE_SQL}\nSELECT column_name AS \"column\", mode FROM modes", indexed=False))
def e2_impute_mode(spark, sf_dir):
    return _prepared(spark, sf_dir).modes


@query("e3_dictionary", with_policies(f", {_BASE_SQL}\nSELECT column_name AS \"column\", value, code FROM dict", indexed=False))
def e3_dictionary(spark, sf_dir):
    return _prepared(spark, sf_dir).dictionary


@query("e4_encode", with_cleaned(f""",
d AS ({union_all_sql([f"SELECT '{c}' AS column_name, v AS value, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS code FROM (SELECT DISTINCT {_q(c)} AS v FROM cleaned WHERE batch_id < 5 AND {_q(c)} IS NOT NULL) x" for c in _CAT_PREP])})
SELECT {KEYS_SQL}, {", ".join(f"coalesce((SELECT code FROM d WHERE column_name = '{c}' AND value = cleaned.{_q(c)}), -1) AS {_q(c)}" for c in _CAT_PREP)}
FROM cleaned"""))
def e4_encode(spark, sf_dir):
    c = cleaned(spark, sf_dir)
    d = E.fit_dictionary(c.where("batch_id < 5"), _CAT_PREP)
    return E.encode(c, d, _CAT_PREP).select(*KEYS, *_CAT_PREP)


@query("e5_standard", with_policies(f", {_BASE_SQL}\nSELECT column_name AS \"column\", round(mean, 6) AS mean, round(std, 6) AS std FROM scal", indexed=False))
def e5_standard(spark, sf_dir):
    return _prepared(spark, sf_dir).scalers.select("column", r6("mean").alias("mean"), r6("std").alias("std"))


@query("e6_minmax", with_policies(f", {_BASE_SQL}\nSELECT column_name AS \"column\", round(mn, 6) AS min, round(mx, 6) AS max FROM scal", indexed=False))
def e6_minmax(spark, sf_dir):
    return _prepared(spark, sf_dir).scalers.select("column", r6("min").alias("min"), r6("max").alias("max"))


def _scaled_cte(kind, name):
    if kind == "A":
        expr = lambda c: (f"(CAST(e.{_q(c)} AS DOUBLE) - (SELECT mean FROM scal WHERE column_name = '{c}')) / "
                          f"coalesce(nullif((SELECT std FROM scal WHERE column_name = '{c}'), 0), 1) AS {_q(c)}")
    else:
        expr = lambda c: (f"(CAST(e.{_q(c)} AS DOUBLE) - (SELECT mn FROM scal WHERE column_name = '{c}')) / "
                          f"coalesce(nullif((SELECT mx - mn FROM scal WHERE column_name = '{c}'), 0), 1) AS {_q(c)}")
    return (f"{name} AS (SELECT batch_id, tie1, tie2, row_index, CLAIM_PAID, "
            + ", ".join(expr(c) for c in _FEATS) + " FROM encoded e)")


def _scaled_sql(kind):
    if kind == "A":
        expr = lambda c: (f"round((CAST(e.{_q(c)} AS DOUBLE) - (SELECT mean FROM scal WHERE column_name = '{c}')) / "
                          f"coalesce(nullif((SELECT std FROM scal WHERE column_name = '{c}'), 0), 1), 6) AS {_q(c)}")
    else:
        expr = lambda c: (f"round((CAST(e.{_q(c)} AS DOUBLE) - (SELECT mn FROM scal WHERE column_name = '{c}')) / "
                          f"coalesce(nullif((SELECT mx - mn FROM scal WHERE column_name = '{c}'), 0), 1), 6) AS {_q(c)}")
    return with_policies(f", {_BASE_SQL}\nSELECT batch_id, tie1, tie2, row_index, round(CLAIM_PAID, 6) AS CLAIM_PAID, "
                         + ", ".join(expr(c) for c in _FEATS) + " FROM encoded e", indexed=False)


def _scaled(kind):
    def run(spark, sf_dir):
        p = _prepared(spark, sf_dir)
        t = p.table_a if kind == "A" else p.table_b
        return t.select("batch_id", "tie1", "tie2", "row_index", r6("CLAIM_PAID").alias("CLAIM_PAID"),
                        *[r6(c).alias(c) for c in p.feature_cols])
    return run


query("e7_prepare_a", _scaled_sql("A"))(_scaled("A"))
query("e7_prepare_b", _scaled_sql("B"))(_scaled("B"))
