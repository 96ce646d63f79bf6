"""Per-batch numeric profile (EDA): describe (A7), pairwise correlations
(A8), top correlations (O3), missing counts (A9), IQR outliers, histograms
(A11) and the per-batch EDA record (A10).

Column count does not change the plan shape: numeric columns are unpivoted
once and grouped by (batch, column); correlations are a few wide aggregates.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimlens.operators.quality import fences, missing_counts, outlier_profile
from claimlens.operators.stats import bounded_broadcast, group_quantiles, numeric_columns, unpivot
from claimlens.session import stored
from claimlens.settings import DEFAULTS, HISTOGRAM_BINS, HISTOGRAM_COLUMNS, TOP_CORRELATIONS, Settings

B = "batch_id"


def describe_numeric(df: DataFrame, columns: list[str] | None = None, batch_col: str = B,
                     settings: Settings = DEFAULTS) -> DataFrame:
    """Count, mean, sample std, min, 25/50/75 %, max per (batch, column)."""
    cols = columns or numeric_columns(df)
    long = unpivot(df, [batch_col], cols)
    keys = [batch_col, "col_ord", "column"]
    moments = long.groupBy(*keys).agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max"))
    q = group_quantiles(long, keys, "value", [0.25, 0.5, 0.75], method=settings.quantile_method,
                        names=["q25", "q50", "q75"])
    return (moments.join(q, keys, "left")
                   .select(*keys, "count", "mean", "std", "min", "q25", "q50", "q75", "max"))


#: Pairs of one correlation aggregate: ten buffer fields each, and Spark compiles no operator of over 100 fields.
PAIRS_AT_ONCE = 9


def correlation_pairs(df: DataFrame, columns: list[str] | None = None, batch_col: str = B) -> DataFrame:
    """Pearson r for every pair i < j on pairwise-complete rows.

    r = covar_samp / (stddev_samp * stddev_samp) over the rows where both are
    present; a constant column gives NULL (never bare ``corr``, which raises
    under ANSI). A grouped aggregate holds ``PAIRS_AT_ONCE`` pairs.
    """
    cols = columns or numeric_columns(df)
    pairs = [(i, j) for i in range(len(cols)) for j in range(i + 1, len(cols))]
    if not pairs:
        return df.sparkSession.createDataFrame([], f"{batch_col} int, pair_ord int, col1 string, col2 string, correlation double")

    def part(own):
        aggs = []
        for k, (i, j) in own:
            x, y = F.col(cols[i]).cast("double"), F.col(cols[j]).cast("double")
            xm, ym = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
            aggs += [F.covar_samp(xm, ym).alias(f"_c{k}"), F.stddev_samp(xm).alias(f"_sx{k}"),
                     F.stddev_samp(ym).alias(f"_sy{k}")]
        items = [F.struct(F.lit(k).alias("pair_ord"), F.lit(cols[i]).alias("col1"), F.lit(cols[j]).alias("col2"),
                          F.try_divide(F.col(f"_c{k}"), F.col(f"_sx{k}") * F.col(f"_sy{k}")).alias("correlation"))
                 for k, (i, j) in own]
        return df.groupBy(batch_col).agg(*aggs).select(batch_col, F.inline(F.array(*items)))
    all_ = list(enumerate(pairs))
    return reduce(DataFrame.unionByName, [part(all_[k : k + PAIRS_AT_ONCE]) for k in range(0, len(all_), PAIRS_AT_ONCE)])


def top_correlations(pairs: DataFrame, k: int = TOP_CORRELATIONS, batch_col: str = B) -> DataFrame:
    """O3: the ``k`` largest |r| per batch; ties keep pair order, NULL last.

    |r| is compared at 9 decimals so that floating-point noise (|r| = 1 may
    come out as 0.9999999999 or 1.0000000001) does not break ties."""
    w = Window.partitionBy(batch_col).orderBy(F.round(F.abs("correlation"), 9).desc_nulls_last(), "pair_ord")
    return pairs.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def histogram(df: DataFrame, columns: list[str] | None = None, bins: int = HISTOGRAM_BINS,
              batch_col: str = B, max_cols: int = HISTOGRAM_COLUMNS) -> DataFrame:
    """Equal-width histogram over [min, max] per (batch, column), last
    bin closed, empty bins included (a constant column spans min-0.5..max+0.5).

    Without ``columns``, the first ``max_cols`` numeric ones are taken.
    Returns ``batch_id, col_ord, column, bin, bin_lo, bin_hi, count``.
    """
    cols = columns or numeric_columns(df)[:max_cols]
    long = unpivot(df, [batch_col], cols).where(F.col("value").isNotNull())
    keys = [batch_col, "col_ord", "column"]
    rng = (long.groupBy(*keys).agg(F.min("value").alias("_mn"), F.max("value").alias("_mx"))
               .withColumn("lo", F.when(F.col("_mn") == F.col("_mx"), F.col("_mn") - 0.5).otherwise(F.col("_mn")))
               .withColumn("hi", F.when(F.col("_mn") == F.col("_mx"), F.col("_mx") + 0.5).otherwise(F.col("_mx")))
               .drop("_mn", "_mx"))
    return bin_counts(long, rng, keys, bins, clamp=False)


def bin_counts(long: DataFrame, edges: DataFrame, keys: list[str], bins: int, clamp: bool,
               value: str = "value", drop_outside: bool = False) -> DataFrame:
    """Counts per equal-width bin of ``[lo, hi]`` (from ``edges`` joined on
    ``keys``), every bin present. ``clamp`` puts out-of-range values into the
    outer bins; ``drop_outside`` ignores them."""
    edges = stored(edges.select(*keys, "lo", "hi"), "edges")   # one row per key, read three times
    w = (F.col("hi") - F.col("lo")) / bins
    raw_bin = F.floor((F.col(value) - F.col("lo")) / w)
    b = F.least(F.greatest(raw_bin, F.lit(0)), F.lit(bins - 1)) if clamp else F.least(raw_bin, F.lit(bins - 1))
    j = long.join(bounded_broadcast(edges), keys)
    if drop_outside:
        j = j.where((F.col(value) >= F.col("lo")) & (F.col(value) <= F.col("hi")))
    counts = j.groupBy(*keys, b.cast("long").alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    grid = edges.select(*keys, "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    width = (F.col("hi") - F.col("lo")) / bins
    return (grid.withColumn("bin", F.col("bin").cast("long"))
                .join(counts, [*keys, "bin"], "left")
                .select(*keys, "bin", (F.col("lo") + F.col("bin") * width).alias("bin_lo"),
                        F.when(F.col("bin") == bins - 1, F.col("hi"))
                         .otherwise(F.col("lo") + (F.col("bin") + 1) * width).alias("bin_hi"),
                        F.coalesce("count", F.lit(0)).cast("long").alias("count"),
                        "lo", "hi"))


def eda(df: DataFrame, batch_col: str = B, settings: Settings = DEFAULTS) -> DataFrame:
    """A10: per batch one record of describe + top correlations + missing
    counts + outlier summary, each as JSON text."""
    cols = numeric_columns(df)
    described = stored(describe_numeric(df, cols, batch_col, settings), "described")   # quartiles reused below
    desc = (described
            .groupBy(batch_col).agg(F.to_json(F.map_from_entries(F.sort_array(F.collect_list(F.struct(
                "column", F.struct("count", "mean", "std", "min", "q25", "q50", "q75", "max")))))).alias("basic_stats")))
    corr = (top_correlations(correlation_pairs(df, cols, batch_col), batch_col=batch_col)
            .groupBy(batch_col).agg(F.to_json(F.transform(F.sort_array(F.collect_list(F.struct(
                "rank", "col1", "col2", "correlation"))), lambda s: s.dropFields("rank"))).alias("correlations")))
    miss = (missing_counts(df, batch_col=batch_col)
            .groupBy(batch_col).agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("column", "nulls"))))
                                    .alias("missing_patterns")))
    bounds = fences(described.select(batch_col, "col_ord", "column", "q25", "q75"), settings)
    outl = (outlier_profile(df, cols, batch_col, settings, bounds=bounds)
            .groupBy(batch_col).agg(F.to_json(F.map_from_entries(F.collect_list(F.struct(
                "column", F.struct(F.col("outliers").alias("count"), F.col("outlier_ratio").alias("ratio"),
                                   "lower_bound", "upper_bound"))))).alias("outliers_summary")))
    return desc.join(corr, batch_col, "left").join(miss, batch_col, "left").join(outl, batch_col, "left")
