"""Population-stability drift against a reference window.

The reference window is the first ``reference_batches`` batches pooled.
Numeric columns are compared on the reference's 10 equal-width bins,
categorical columns on the reference's category shares.

PSI modes for numeric columns:

* ``density`` - reference parity: densities count / (n_in * width), values
  outside the reference range ignored, no in-range value -> NULL;
* ``proportion`` - shares of the in-range values;
* ``clamp`` (default) - shares of all values, out-of-range values counted in
  the outer bins (open-ended edge bins).

All steps are grouped aggregates and joins against tables of size
(batches x columns x bins); nothing is gathered on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.functions.features import drift_severity
from claimlens.operators.profile import bin_counts
from claimlens.operators.stats import unpivot
from claimlens.session import stored
from claimlens.settings import DEFAULTS, DRIFT_BINS, PSI_EPSILON, Settings
from pyspark.sql.types import NumericType

B = "batch_id"
EPS = PSI_EPSILON


def split_monitored(df: DataFrame, settings: Settings = DEFAULTS):
    cols = [c for c in settings.monitor_columns if c in df.columns]
    num = [c for c in cols if isinstance(df.schema[c].dataType, NumericType)]
    cat = [c for c in cols if c not in num]
    return num, cat


def reference_rows(df: DataFrame, settings: Settings = DEFAULTS, batch_col: str = B) -> DataFrame:
    return df.where(F.col(batch_col) < settings.reference_batches)


def reference_histogram(df: DataFrame, columns: list[str], bins: int = DRIFT_BINS,
                        settings: Settings = DEFAULTS, batch_col: str = B) -> DataFrame:
    """Pooled reference bins per column with counts, shares and densities.

    Returns ``column, bin, bin_lo, bin_hi, count, n, share, density, lo, hi``.
    """
    ref = reference_rows(df, settings, batch_col)
    long = unpivot(ref, [], columns).where(F.col("value").isNotNull()).drop("col_ord")
    rng = (long.groupBy("column").agg(F.min("value").alias("_mn"), F.max("value").alias("_mx"),
                                      F.count(F.lit(1)).alias("n"))
               .withColumn("lo", F.when(F.col("_mn") == F.col("_mx"), F.col("_mn") - 0.5).otherwise(F.col("_mn")))
               .withColumn("hi", F.when(F.col("_mn") == F.col("_mx"), F.col("_mx") + 0.5).otherwise(F.col("_mx"))))
    h = bin_counts(long, rng, ["column"], bins, clamp=False)
    width = (F.col("hi") - F.col("lo")) / bins
    return (h.join(rng.select("column", "n"), "column")
             .withColumn("share", F.col("count") / F.col("n"))
             .withColumn("density", F.col("count") / (F.col("n") * width)))


def reference_moments(df: DataFrame, columns: list[str], settings: Settings = DEFAULTS,
                      batch_col: str = B) -> DataFrame:
    """Mean and sample std of each monitored numeric column."""
    long = unpivot(reference_rows(df, settings, batch_col), [], columns)
    return long.groupBy("column").agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"))


def category_distribution(df: DataFrame, columns: list[str], keys=(), name: str = "share") -> DataFrame:
    """Share of each value among the non-null values, per ``keys``."""
    long = unpivot(df, list(keys), columns, cast="string").where(F.col("value").isNotNull()).drop("col_ord")
    counts = stored(long.groupBy(*keys, "column", "value").agg(F.count(F.lit(1)).alias("count")), "shares")
    totals = counts.groupBy(*keys, "column").agg(F.sum("count").alias("n"))
    return counts.join(totals, [*keys, "column"]).withColumn(name, F.col("count") / F.col("n"))


def psi_numeric(df: DataFrame, ref_hist: DataFrame, columns: list[str], mode: str = "clamp",
                settings: Settings = DEFAULTS, batch_col: str = B, bins: int = DRIFT_BINS) -> DataFrame:
    """PSI per (batch, column) for batches after the reference window."""
    cur = df.where(F.col(batch_col) >= settings.reference_batches)
    long = unpivot(cur, [batch_col], columns).where(F.col("value").isNotNull()).drop("col_ord")
    edges = ref_hist.select("column", "lo", "hi").distinct()
    # every (batch, column) of the current window, even without values
    pairs = (cur.select(batch_col).distinct()
                .select(batch_col, F.explode(F.array(*[F.lit(c) for c in columns])).alias("column"))
                .join(edges, "column"))
    h = bin_counts(long, pairs, [batch_col, "column"], bins, clamp=(mode == "clamp"),
                   drop_outside=(mode != "clamp"))
    h = stored(h, "binned")            # bins x columns x batches, read twice
    n = h.groupBy(batch_col, "column").agg(F.sum("count").alias("_n"))
    width = (F.col("hi") - F.col("lo")) / bins
    if mode == "density":
        c = F.try_divide(F.col("count"), F.col("_n") * width)
        r = F.col("density")
    else:
        c = F.try_divide(F.col("count"), F.col("_n").cast("double"))
        r = F.col("share")
    c, r = c + EPS, r + EPS
    term = (c - r) * F.ln(c / r)
    j = (h.join(n, [batch_col, "column"])
          .join(ref_hist.select("column", "bin", "share", "density"), ["column", "bin"]))
    return (j.groupBy(batch_col, "column")
             .agg(F.sum(term).alias("psi"), F.count(term).alias("_k"))
             .select(batch_col, "column", F.when(F.col("_k") == bins, F.col("psi")).alias("psi")))


def psi_categorical(df: DataFrame, columns: list[str], settings: Settings = DEFAULTS,
                    batch_col: str = B, ref: DataFrame | None = None) -> DataFrame:
    """Sum over the reference categories of (c - r) ln(c / r); a category
    absent from the batch counts with share 1e-6; new categories are ignored.

    Written without a (batch x category) grid: the sum over absent categories
    is the all-absent total per column minus the terms of the present ones.
    """
    if ref is None:
        ref = category_distribution(reference_rows(df, settings, batch_col), columns, name="r")
    absent = (F.lit(EPS) - F.col("r")) * F.ln(F.lit(EPS) / F.col("r"))
    base = ref.groupBy("column").agg(F.sum(absent).alias("_all_absent"))
    cur_rows = df.where(F.col(batch_col) >= settings.reference_batches)
    cur = category_distribution(cur_rows, columns, keys=(batch_col,), name="c")
    present = (cur.join(ref.select("column", "value", "r"), ["column", "value"])
                  .groupBy(batch_col, "column")
                  .agg(F.sum((F.col("c") - F.col("r")) * F.ln(F.col("c") / F.col("r")) - absent).alias("_p")))
    pairs = (cur_rows.select(batch_col).distinct()
                     .select(batch_col, F.explode(F.array(*[F.lit(c) for c in columns])).alias("column")))
    return (pairs.join(base, "column").join(present, [batch_col, "column"], "left")
                 .select(batch_col, "column", (F.col("_all_absent") + F.coalesce("_p", F.lit(0.0))).alias("psi")))


def fit_reference(df: DataFrame, settings: Settings = DEFAULTS, batch_col: str = B):
    """The stored drift reference: (numeric bins, category shares)."""
    num, cat = split_monitored(df, settings)
    hist = reference_histogram(df, num, settings=settings, batch_col=batch_col) if num else None
    dist = category_distribution(reference_rows(df, settings, batch_col), cat, name="r") if cat else None
    return hist, dist


def detect_drift(df: DataFrame, settings: Settings = DEFAULTS, batch_col: str = B,
                 mode: str | None = None, reference=None) -> DataFrame:
    """Drift table ``batch_id, column, kind, psi, threshold, drifted, severity``
    for every batch after the reference window and every monitored column.
    ``reference`` is a stored (bins, shares) pair; without it the reference is
    fitted from ``df``'s own first batches."""
    mode = mode or settings.psi_mode
    num, cat = split_monitored(df, settings)
    parts = []
    ref_hist, ref_dist = reference if reference is not None else (None, None)
    if num:
        # the fitted reference (columns x bins rows) is read several times
        if ref_hist is None:
            ref_hist = stored(reference_histogram(df, num, settings=settings, batch_col=batch_col), "reference")
        parts.append(psi_numeric(df, ref_hist, num, mode, settings, batch_col).withColumn("kind", F.lit("numeric")))
    if cat:
        parts.append(psi_categorical(df, cat, settings, batch_col, ref=ref_dist)
                     .withColumn("kind", F.lit("categorical")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    drifted = F.coalesce(F.col("psi") > settings.psi_threshold, F.lit(False))
    return (out.withColumn("threshold", F.lit(settings.psi_threshold))
               .withColumn("drifted", drifted)
               .withColumn("severity", F.when(drifted, drift_severity(F.col("psi"))))
               .select(batch_col, "column", "kind", "psi", "threshold", "drifted", "severity"))
