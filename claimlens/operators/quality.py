"""Per-batch data-quality gates.

All operators run once over all batches with ``groupBy(batch_id, ...)``;
wide columns are unpivoted once so the number of shuffles does not grow
with the number of columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.operators.state import approximate, batch_state, exact_profile
from claimlens.operators.stats import bounded_broadcast, data_columns, group_quantiles, unpivot
from claimlens.session import stored
from claimlens.settings import DEFAULTS, Settings

B = "batch_id"


def null_ratios(df: DataFrame, columns: list[str] | None = None, batch_col: str = B) -> DataFrame:
    """A1: missing / rows for every data column, one aggregate for all columns.

    Returns ``batch_id, col_ord, column, nulls, total_rows, null_ratio``.
    """
    cols = columns or data_columns(df)
    wide = df.groupBy(batch_col).agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(cols)])
    items = [F.struct(F.lit(i).alias("col_ord"), F.lit(c).alias("column"), F.col(f"_n{i}").alias("nulls"))
             for i, c in enumerate(cols)]
    return (wide.select(batch_col, "total_rows", F.inline(F.array(*items)))
                .withColumn("null_ratio", F.col("nulls") / F.col("total_rows")))


def missing_counts(df: DataFrame, columns: list[str] | None = None, batch_col: str = B) -> DataFrame:
    """Number of missing values per column and batch."""
    return null_ratios(df, columns, batch_col).select(batch_col, "col_ord", "column", "nulls")


def iqr_bounds(df: DataFrame, columns: list[str], batch_col: str = B,
               settings: Settings = DEFAULTS) -> DataFrame:
    """Q1, Q3 and the IQR fences per (batch, column)."""
    long = unpivot(df, [batch_col], columns)
    q = group_quantiles(long, [batch_col, "col_ord", "column"], "value", [0.25, 0.75],
                        method=settings.quantile_method)
    return fences(q, settings)


def fences(q: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """IQR fences from a table holding ``q25`` and ``q75``."""
    k = settings.iqr_factor
    return (q.withColumn("lower_bound", F.col("q25") - k * (F.col("q75") - F.col("q25")))
             .withColumn("upper_bound", F.col("q75") + k * (F.col("q75") - F.col("q25"))))


def outlier_profile(df: DataFrame, columns: list[str] | None = None, batch_col: str = B,
                    settings: Settings = DEFAULTS, bounds: DataFrame | None = None) -> DataFrame:
    """A3: IQR fences and outlier ratio (outliers / all rows of the batch).

    Two passes over the unpivoted data: quantiles, then a count against the
    fences (a small per-(batch, column) table joined back).
    """
    cols = [c for c in (columns or settings.numeric_columns) if c in df.columns]
    long = unpivot(df, [batch_col], cols)
    bounds = bounds if bounds is not None else iqr_bounds(df, cols, batch_col, settings)
    v = F.col("value")
    counted = (long.join(bounded_broadcast(bounds.select(batch_col, "column", "lower_bound", "upper_bound")),
                         [batch_col, "column"], "left")
                   .groupBy(batch_col, "col_ord", "column")
                   .agg(F.count(F.lit(1)).alias("total_rows"),
                        F.count_if((v < F.col("lower_bound")) | (v > F.col("upper_bound"))).alias("outliers"),
                        F.first("lower_bound", ignorenulls=True).alias("lower_bound"),
                        F.first("upper_bound", ignorenulls=True).alias("upper_bound")))
    return counted.withColumn("outlier_ratio", F.col("outliers") / F.col("total_rows"))


def flag_outliers(df: DataFrame, columns: list[str], batch_col: str = B,
                  settings: Settings = DEFAULTS, name: str = "is_outlier") -> DataFrame:
    """Boolean column, true if any listed column lies outside its batch's fences."""
    bounds = iqr_bounds(df, columns, batch_col, settings)
    wide = bounds.groupBy(batch_col).agg(
        *[F.max(F.when(F.col("column") == c, F.struct("lower_bound", "upper_bound"))).alias(f"_b{i}")
          for i, c in enumerate(columns)])
    flags = [F.coalesce((F.col(c) < F.col(f"_b{i}.lower_bound")) | (F.col(c) > F.col(f"_b{i}.upper_bound")),
                        F.lit(False)) for i, c in enumerate(columns)]
    out = df.join(bounded_broadcast(wide), batch_col, "left").withColumn(name, F.greatest(*flags) if len(flags) > 1 else flags[0])
    return out.drop(*[f"_b{i}" for i in range(len(columns))])


def unique_ratios(df: DataFrame, columns: list[str] | None = None, batch_col: str = B,
                  settings: Settings = DEFAULTS, method: str = "exact") -> DataFrame:
    """A4: distinct non-null values / rows per categorical column and batch. With
    ``method="approx"`` the distinct values are estimated by the sketches of one scan
    (``state.batch_state``), for columns whose values are too many to shuffle.

    Distinct values are found with a grouped aggregate on the unpivoted form
    (map-side combined), then counted; no per-column distinct jobs.
    """
    cols = [c for c in (columns or settings.categorical_columns) if c in df.columns]
    if method == "approx":
        places = F.create_map(*[F.lit(x) for i, c in enumerate(cols) for x in (c, i)])
        state = approximate(batch_state(df, [], cols, batch_col).where("is_categorical"), [0.5])
        return state.select(batch_col, "total_rows", F.element_at(places, F.col("column")).alias("col_ord"), "column", "n_unique",
                            (F.col("n_unique") / F.col("total_rows")).alias("unique_ratio"))
    totals = df.groupBy(batch_col).agg(F.count(F.lit(1)).alias("total_rows"))
    long = unpivot(df, [batch_col], cols, cast="string")
    distinct = (long.where(F.col("value").isNotNull())
                    .select(batch_col, "col_ord", "column", "value").distinct()
                    .groupBy(batch_col, "col_ord", "column").agg(F.count(F.lit(1)).alias("n_unique")))
    grid = totals.select(batch_col, "total_rows", F.inline(F.array(
        *[F.struct(F.lit(i).alias("col_ord"), F.lit(c).alias("column")) for i, c in enumerate(cols)])))
    return (grid.join(distinct, [batch_col, "col_ord", "column"], "left")
                .withColumn("n_unique", F.coalesce("n_unique", F.lit(0)).cast("long"))
                .withColumn("unique_ratio", F.col("n_unique") / F.col("total_rows")))


def quality_issues(df: DataFrame, batch_col: str = B, settings: Settings = DEFAULTS) -> DataFrame:
    """A5 issues: ``batch_id, issue_ord, type, column, value, threshold``.

    ``issue_ord`` is the order the reference reports them in: null issues in
    column order, then outlier issues, then low-cardinality issues. With
    ``settings.few_scans`` the rows are scanned twice (``state.exact_profile``) where that
    applies, else about seven times, one operator after the other.
    """
    step = max(1000, len(df.columns))     # above any column's position
    seen = exact_profile(df, settings.numeric_columns, None, batch_col, settings) if settings.few_scans and settings.quantile_method == "exact" else None
    ratios = lambda n: F.col(n) / F.col("total_rows")
    own = lambda names: {c: i for i, c in enumerate(n for n in names if n in df.columns)}
    if seen is None:
        null, outlier, unique = (null_ratios(df, batch_col=batch_col), outlier_profile(df, batch_col=batch_col, settings=settings),
                                 unique_ratios(df, batch_col=batch_col, settings=settings))
    else:
        def placed(flag, names):
            at = F.create_map(*[F.lit(x) for kv in own(names).items() for x in kv]) if own(names) else F.create_map(F.lit(""), F.lit(0))
            return seen.where(flag).withColumn("col_ord", F.element_at(at, F.col("column")))
        null = seen.withColumn("null_ratio", ratios("nulls"))
        outlier = placed("is_numeric", settings.numeric_columns).withColumn("outlier_ratio", ratios("outliers"))
        unique = placed("is_categorical", settings.categorical_columns).withColumn("unique_ratio", ratios("n_unique"))
    nulls = (null
             .where(F.col("null_ratio") > settings.max_null_ratio)
             .select(batch_col, F.col("col_ord").alias("issue_ord"), F.lit("high_null_ratio").alias("type"),
                     "column", F.col("null_ratio").alias("value"),
                     F.lit(settings.max_null_ratio).alias("threshold")))
    outl = (outlier
            .where(F.col("outlier_ratio") > settings.max_outlier_ratio)
            .select(batch_col, (F.col("col_ord") + step).alias("issue_ord"), F.lit("high_outlier_ratio").alias("type"),
                    "column", F.col("outlier_ratio").alias("value"),
                    F.lit(settings.max_outlier_ratio).alias("threshold")))
    card = (unique
            .where(F.col("unique_ratio") < settings.min_unique_ratio)
            .select(batch_col, (F.col("col_ord") + 2 * step).alias("issue_ord"), F.lit("low_cardinality").alias("type"),
                    "column", F.col("unique_ratio").alias("value"),
                    F.lit(settings.min_unique_ratio).alias("threshold")))
    return nulls.unionByName(outl).unionByName(card)


def quality_summary(df: DataFrame, batch_col: str = B, settings: Settings = DEFAULTS,
                    issues: DataFrame | None = None) -> DataFrame:
    """A5 score: ``batch_id, total_rows, total_columns, issue_count, quality_score``.

    Batches without issues score 100.
    """
    from claimlens.settings import SCORE_PENALTY
    issues = issues if issues is not None else stored(quality_issues(df, batch_col, settings), "issues")
    n_cols = len(data_columns(df))
    totals = df.groupBy(batch_col).agg(F.count(F.lit(1)).alias("total_rows"))
    counts = issues.groupBy(batch_col).agg(F.count(F.lit(1)).alias("issue_count"))
    return (totals.join(counts, batch_col, "left")
                  .select(batch_col, "total_rows", F.lit(n_cols).alias("total_columns"),
                          F.coalesce("issue_count", F.lit(0)).alias("issue_count"))
                  .withColumn("quality_score",
                              F.greatest(F.lit(0), 100 - SCORE_PENALTY * F.col("issue_count")).cast("double")))


def quality_report_rows(df: DataFrame, batch_col: str = B, settings: Settings = DEFAULTS,
                        issues: DataFrame | None = None) -> DataFrame:
    """One line per batch with the issues as ``type: column (value=0.000)``
    joined by ``<br>`` in report order. ``issues``: the gates' rows where they are
    stored already; else they are evaluated once."""
    issues = issues if issues is not None else stored(quality_issues(df, batch_col, settings), "issues")
    summary = quality_summary(df, batch_col, settings, issues)
    text = (issues.groupBy(batch_col)
                  .agg(F.sort_array(F.collect_list(F.struct(
                      "issue_ord", F.format_string("%s: %s (value=%.3f)", "type", "column", "value").alias("t"))))
                      .alias("_l"))
                  .select(batch_col, F.array_join(F.transform("_l", lambda s: s["t"]), "<br>").alias("issues")))
    return (summary.join(text, batch_col, "left")
                   .select(batch_col, "quality_score", "issue_count",
                           F.coalesce("issues", F.lit("")).alias("issues")))
