"""Training-table preparation: imputation, encoding, scaling (E1-E9),
time order and split (O1, O2), inflation adjustment (P19, P20, A20).

Fits are aggregates that produce small parameter tables (one row per column
or per category); transforms are projections or joins against them. The
parameter tables are what a serving job reuses.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from claimlens.functions import features as X
from claimlens.functions.dates import parse_mixed_date, parse_policy_date, policy_year
from claimlens.operators.positions import temporal_split, with_row_index
from claimlens.operators.stats import bounded_broadcast, group_quantiles, unpivot
from claimlens.session import freed_shuffles, packed, stored
from claimlens.settings import BOOKKEEPING, DEFAULTS, Settings

MISSING_DATE = "9999-12-31"


# ---- E1 median imputation ------------------------------------------------------
def fit_medians(df: DataFrame, columns: list[str], settings: Settings = DEFAULTS) -> DataFrame:
    """Median of each column over the whole table: ``column, median``.

    Exact by default (distributed bracket-and-count, see stats.group_quantiles),
    so a single huge group never lands in one task; all-NULL -> NULL.
    """
    long = unpivot(df, [], columns)
    med = group_quantiles(long, ["column"], "value", [0.5], method=settings.quantile_method, names=["median"])
    names = df.sparkSession.createDataFrame([(c,) for c in columns], "column string")
    return names.join(med, "column", "left")


def params_dict(params: DataFrame, field: str, key: str = "column") -> dict:
    """A fitted parameter table (one row per column, so bounded by the
    schema, not the data) as a driver-side dict, like any fitted model."""
    return {r[0]: r[1] for r in params.select(key, field).collect()}


def apply_medians(df: DataFrame, medians: DataFrame | dict, columns: list[str]) -> DataFrame:
    """Fill NULLs with the fitted medians (literals: a pure projection)."""
    m = medians if isinstance(medians, dict) else params_dict(medians, "median")
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(m.get(c)).cast("double"))
                           for c in columns})


def impute_median(df: DataFrame, columns: list[str], params: DataFrame | None = None,
                  settings: Settings = DEFAULTS):
    """Returns (imputed frame, parameter table)."""
    params = params if params is not None else fit_medians(df, columns, settings)
    return apply_medians(df, params, columns), params


# ---- E2 mode imputation --------------------------------------------------------
def fit_modes(df: DataFrame, columns: list[str], fallback: str | None = None) -> DataFrame:
    """Most frequent non-null value per column, ties -> smallest value:
    ``column, mode``. Counting is a grouped aggregate (map-side combined);
    the pick is a ``min_by`` per column."""
    long = unpivot(df, [], columns, cast="string").where(F.col("value").isNotNull())
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    modes = counts.groupBy("column").agg(F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode"))
    names = df.sparkSession.createDataFrame([(c,) for c in columns], "column string")
    out = names.join(modes, "column", "left")
    if fallback is not None:
        out = out.withColumn("mode", F.coalesce("mode", F.lit(fallback)))
    return out


def apply_modes(df: DataFrame, modes: DataFrame | dict, columns: list[str]) -> DataFrame:
    m = modes if isinstance(modes, dict) else params_dict(modes, "mode")
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(m.get(c)).cast("string")) for c in columns})


def impute_mode(df: DataFrame, columns: list[str], params: DataFrame | None = None, fallback=None):
    """Returns (imputed frame, parameter table)."""
    params = params if params is not None else fit_modes(df, columns, fallback)
    return apply_modes(df, params, columns), params


# ---- E3, E4 dictionary encoding ------------------------------------------------
def fit_dictionary(df: DataFrame, columns: list[str]) -> DataFrame:
    """``column, value, code``; codes 0..k-1 in sorted value order.

    The window runs over the distinct values of one column (the dictionary
    itself, which is small by definition of a categorical column)."""
    long = unpivot(df, [], columns, cast="string").where(F.col("value").isNotNull()).drop("col_ord")
    distinct = long.distinct()
    w = Window.partitionBy("column").orderBy("value")
    return distinct.withColumn("code", (F.row_number().over(w) - 1).cast("int"))


def encode(df: DataFrame, dictionary: DataFrame, columns: list[str]) -> DataFrame:
    """Value -> code; unseen and missing -> -1. One equi-join per column
    against that column's dictionary, broadcast after a size check."""
    out = df
    small = bounded_broadcast(dictionary)
    for c in columns:
        d = small.where(F.col("column") == c).select(F.col("value").alias(f"_v_{c}"), F.col("code").alias(f"_c_{c}"))
        out = (out.join(d, F.col(c).cast("string") == F.col(f"_v_{c}"), "left")
                  .withColumn(c, F.coalesce(F.col(f"_c_{c}"), F.lit(-1)))
                  .drop(f"_v_{c}", f"_c_{c}"))
    return out


# ---- E5, E6 scaling -------------------------------------------------------------
#: Columns of one scaler aggregate: seven buffer fields each, and Spark compiles no operator of over 100 fields.
SCALED_AT_ONCE = 12


def fit_scalers(df: DataFrame, columns: list[str]) -> DataFrame:
    """Global aggregates of ``SCALED_AT_ONCE`` columns each: ``column, col_ord, mean, std
    (population), min, max``."""
    def part(cols):
        aggs = []
        for i, c in cols:
            x = F.col(c).cast("double")
            aggs += [F.avg(x).alias(f"_m{i}"), F.stddev_pop(x).alias(f"_s{i}"),
                     F.min(x).alias(f"_lo{i}"), F.max(x).alias(f"_hi{i}")]
        items = [F.struct(F.lit(c).alias("column"), F.lit(i).alias("col_ord"), F.col(f"_m{i}").alias("mean"),
                          F.col(f"_s{i}").alias("std"), F.col(f"_lo{i}").alias("min"), F.col(f"_hi{i}").alias("max"))
                 for i, c in cols]
        return df.agg(*aggs).select(F.inline(F.array(*items)))
    all_ = list(enumerate(columns))
    return reduce(DataFrame.unionByName, [part(all_[k : k + SCALED_AT_ONCE]) for k in range(0, len(all_), SCALED_AT_ONCE)])


def scaler_dict(params: DataFrame) -> dict:
    """The fitted scaler table (one row per feature) as {field: {column: value}}."""
    rows = params.select("column", "mean", "std", "min", "max").collect()
    return {f: {r["column"]: r[f] for r in rows} for f in ("mean", "std", "min", "max")}


def _param_row(params: DataFrame | dict, columns: list[str], field: str):
    d = params[field] if isinstance(params, dict) else params_dict(params, field)
    return {c: F.lit(d.get(c)).cast("double") for c in columns}


def scale_standard(df: DataFrame, params: DataFrame, columns: list[str]) -> DataFrame:
    """E5: (x - mean) / std, population std, std 0 -> 1."""
    mean, std = _param_row(params, columns, "mean"), _param_row(params, columns, "std")
    return df.withColumns({c: (F.col(c).cast("double") - mean[c]) /
                              F.coalesce(F.nullif(std[c], F.lit(0.0)), F.lit(1.0)) for c in columns})


def scale_minmax(df: DataFrame, params: DataFrame, columns: list[str]) -> DataFrame:
    """(x - min) / (max - min); constant column -> x - min; no clipping."""
    lo, hi = _param_row(params, columns, "min"), _param_row(params, columns, "max")
    return df.withColumns({c: (F.col(c).cast("double") - lo[c]) /
                              F.coalesce(F.nullif(hi[c] - lo[c], F.lit(0.0)), F.lit(1.0)) for c in columns})


# ---- O1, O2, P19, P20, A20 ------------------------------------------------------
def order_by_start(df: DataFrame, tie_cols=("batch_id", "row_index"), name: str = "position") -> DataFrame:
    """O1 as a position: ascending start date, missing last, ties by ``tie_cols``."""
    keyed = df.withColumn("_begin_key", F.coalesce("INSR_BEGIN", F.lit(MISSING_DATE).cast("date")))
    return with_row_index(keyed, ["_begin_key", *tie_cols], name).drop("_begin_key")


def year_filter(df: DataFrame, year: int, col: str = "INSR_YEAR") -> DataFrame:
    """P19."""
    return df.where(F.col(col) == year)


def inflation_coefficient(old: DataFrame, new: DataFrame, year: int, settings: Settings = DEFAULTS) -> DataFrame:
    """median(PREMIUM) of the new rows of ``year`` / that of the old rows
    (one row; NULL if either side has no rows of that year)."""
    def med(df, tag):
        rows = year_filter(df, year).select(F.lit(1).alias("_k"), "PREMIUM")
        return group_quantiles(rows, ["_k"], "PREMIUM", [0.5], method=settings.quantile_method, names=[tag])
    base = old.sparkSession.range(1).select(F.lit(1).alias("_k"))
    j = base.join(med(new, "new_median"), "_k", "left").join(med(old, "old_median"), "_k", "left")
    return j.select("new_median", "old_median",
                    F.try_divide(F.col("new_median"), F.col("old_median")).alias("coef"))


def apply_inflation(old: DataFrame, new: DataFrame, settings: Settings = DEFAULTS,
                    year: int | None = None) -> DataFrame:
    """P20: multiply the inflation columns of ``old`` by the coefficient
    (1.0 when it cannot be computed). The coefficient is a scalar subquery."""
    year = settings.inflation_year if year is None else year
    coef = inflation_coefficient(old, new, year, settings).select(
        F.coalesce("coef", F.lit(1.0))).scalar()
    cols = [c for c in settings.inflation_columns if c in old.columns]
    return old.withColumns({c: F.col(c) * coef for c in cols})


# ---- E7 full preparation ---------------------------------------------------------
@dataclass
class Prepared:
    table_a: DataFrame
    table_b: DataFrame
    medians: DataFrame
    modes: DataFrame
    dictionary: DataFrame
    scalers: DataFrame
    feature_cols: list
    numeric_cols: list
    categorical_cols: list
    #: the rows in time order (``row_index``) before anything is dropped or fitted; not stored with the rest
    ordered: DataFrame | None = None


def _base(cleaned: DataFrame, settings: Settings, tie_cols) -> DataFrame:
    """P12 -> P3 -> target features recomputed after the fill -> P11 -> O1 -> P14.
    With ``claim_ratio_fill="median"`` the target features come before the fill, so
    those of rows without a claim are missing and imputed like any other column."""
    df = cleaned.drop(*[c for c in ("claim_ratio", "is_claim") if c in cleaned.columns])
    # ordered first: what follows from a row alone is neither shuffled nor stored with it
    df = order_by_start(df, tie_cols, "_pos").withColumn("INSR_YEAR", policy_year("INSR_BEGIN"))
    steps = [lambda d: X.fill_target(d, settings), lambda d: X.add_missing_features(d, settings)]
    for step in reversed(steps) if settings.claim_ratio_fill == "median" else steps:
        df = step(df)
    return df.select(*[c for c in df.columns if c not in ("row_index", "_pos")], F.col("_pos").alias("row_index"))


def _fitted_on(df: DataFrame, settings: Settings) -> DataFrame:
    """The rows that parameters are fitted on: all, or the training rows alone."""
    if settings.fit_on == "all":
        return df
    return temporal_split(df, settings.train_split).where("is_train").select(*df.columns)


def prepare(cleaned: DataFrame, settings: Settings = DEFAULTS, tie_cols=("batch_id", "row_index")) -> Prepared:
    """Cleaned batches -> scaled tables A (standard) and B (min-max) plus
    every fitted parameter table. ``row_index`` is the time-order position.

    What several fits read lies in the shared folder: the positions' table, the
    encoded rows, and each small parameter table. Nothing is cached."""
    t = settings.target
    ordered = _base(cleaned, settings, tie_cols)
    base = X.drop_columns(ordered, settings.drop_columns)
    num = [f.name for f in base.schema.fields
           if isinstance(f.dataType, NumericType) and f.name not in BOOKKEEPING and f.name != t]
    cat = [f.name for f in base.schema.fields
           if isinstance(f.dataType, StringType) and f.name not in BOOKKEEPING]
    medians = stored(fit_medians(_fitted_on(base, settings), num, settings), "medians")
    modes = stored(fit_modes(_fitted_on(base, settings), cat), "modes")
    base = apply_modes(apply_medians(base, medians, num), modes, cat)
    dictionary = stored(fit_dictionary(_fitted_on(base, settings), cat), "dictionary")
    base = encode(base, dictionary, cat)
    feats = [c for c in base.columns if c not in BOOKKEEPING and c != t]
    scalers = stored(fit_scalers(_fitted_on(base, settings), feats), "scalers")
    sd = scaler_dict(scalers)
    a = scale_standard(base, sd, feats)
    b = scale_minmax(base, sd, feats)
    return Prepared(a, b, medians, modes, dictionary, scalers, feats, num, cat, ordered)


# ---- S13 storage of what was fitted ---------------------------------------------------
_FITTED = ("table_a", "table_b", "medians", "modes", "dictionary", "scalers")


def save_prepared(p: Prepared, root: str, csv: str | None = None) -> None:
    """Write both tables, every fitted parameter table and the column lists; with ``csv``,
    also both tables as CSV with header below that folder."""
    with freed_shuffles(p.table_a.sparkSession), packed(p.table_a.sparkSession):
        for name in _FITTED:
            getattr(p, name).write.mode("overwrite").parquet(f"{root}/{name}")
    for name in ("table_a", "table_b") if csv else ():
        p.table_a.sparkSession.read.parquet(f"{root}/{name}").write.mode("overwrite").option("header", True).csv(f"{csv}/{name}")
    rows = [(kind, k, c) for kind, cols in (("feature", p.feature_cols), ("numeric", p.numeric_cols), ("categorical", p.categorical_cols))
            for k, c in enumerate(cols)]
    p.table_a.sparkSession.createDataFrame(rows, "kind string, ord int, column string").coalesce(1).write.mode("overwrite").parquet(f"{root}/columns")


def load_prepared(spark, root: str) -> Prepared:
    """What ``save_prepared`` wrote, with nothing kept from the session that fitted it."""
    t = [spark.read.parquet(f"{root}/{n}") for n in _FITTED]
    cols: dict = {"feature": [], "numeric": [], "categorical": []}
    for r in spark.read.parquet(f"{root}/columns").orderBy("kind", "ord").collect():
        cols[r["kind"]].append(r["column"])
    return Prepared(*t, cols["feature"], cols["numeric"], cols["categorical"])


# ---- E8 serving preprocessing ------------------------------------------------------
def prepare_for_serving(raw: DataFrame, prepared: Prepared, settings: Settings = DEFAULTS,
                        impute_from_input: bool = False, variant: str = "A", carry: tuple = ()) -> DataFrame:
    """Raw policy rows (dates as text or dates) -> feature table in the
    scaler's column order, keyed by ``row_index``. Imputation uses the stored
    training parameters unless ``impute_from_input`` (reference parity). Columns
    named in ``carry`` are taken along."""
    t = settings.target
    df = raw
    for c in ("INSR_BEGIN", "INSR_END"):
        if c in df.columns and isinstance(df.schema[c].dataType, StringType):
            df = df.withColumn(c, parse_mixed_date(c))
    if "INSR_BEGIN" in df.columns:
        df = df.withColumn("INSR_YEAR", policy_year("INSR_BEGIN"))
    if t in df.columns:
        df = X.fill_target(df, settings)
    df = X.add_missing_features(df.drop(*[c for c in ("claim_ratio", "is_claim") if c in df.columns]), settings)
    df = X.target_free_defaults(df, settings)
    df = X.drop_columns(df.drop(t) if t in df.columns else df, settings.drop_columns)
    num = [c for c in prepared.numeric_cols if c in df.columns]
    cat = [c for c in prepared.categorical_cols if c in df.columns]
    if impute_from_input:
        df, _ = impute_median(df, num, settings=settings)
        df, _ = impute_mode(df, cat, fallback="unknown")
    else:
        df = apply_medians(df, prepared.medians, num)
        df = apply_modes(df, prepared.modes, cat)
    df = encode(df, prepared.dictionary, cat)
    missing = [c for c in prepared.feature_cols if c not in df.columns]
    if missing:
        raise ValueError(f"serving input lacks feature columns {missing}")
    scaler = scale_standard if variant == "A" else scale_minmax
    df = scaler(df, prepared.scalers, prepared.feature_cols)
    keep = [c for c in ("row_index", "batch_id", *carry) if c in df.columns]
    return df.select(*keep, *prepared.feature_cols)


# ---- E9 retrain preprocessing -------------------------------------------------------
def prepare_retrain(old_raw: DataFrame, new_raw: DataFrame, prepared: Prepared,
                    settings: Settings = DEFAULTS, variant: str = "A", year: int | None = None,
                    tie_cols=("batch_id", "row_index")) -> DataFrame:
    """An older raw table made compatible with the current training table:
    P12, P1 (text dates), P3-P9, P14 on both sides, P20 on the old side, then
    the stored imputation, E4, P15 and the variant's scaler."""
    def dated(df):
        df = X.fill_target(df, settings)
        for c in ("INSR_BEGIN", "INSR_END"):
            if c in df.columns and isinstance(df.schema[c].dataType, StringType):
                df = df.withColumn(c, parse_policy_date(c, settings.date_format))
        return df.drop(*[c for c in ("claim_ratio", "is_claim") if c in df.columns])

    def pre(df):
        return X.add_missing_features(df.withColumn("INSR_YEAR", policy_year("INSR_BEGIN")), settings)
    # positions need a total order: start date, then ``tie_cols``; ordered first, as in ``_base``
    old, new = pre(order_by_start(dated(old_raw), tuple(tie_cols), "_pos")), pre(dated(new_raw))
    old = apply_inflation(old, new, settings, year)
    # features that depend on the rescaled columns are recomputed (Q10 fix)
    old = X.add_missing_features(old.drop("premium_per_seat", "insured_value_per_ton", "claim_ratio",
                                          "is_claim", "premium_log"), settings)
    old = old.drop("row_index").withColumnRenamed("_pos", "row_index")
    old = X.drop_columns(old, settings.drop_columns)
    old = apply_medians(old, prepared.medians, [c for c in prepared.numeric_cols if c in old.columns])
    old = apply_modes(old, prepared.modes, [c for c in prepared.categorical_cols if c in old.columns])
    old = encode(old, prepared.dictionary, [c for c in prepared.categorical_cols if c in old.columns])
    cols = ["row_index", *prepared.feature_cols, settings.target]
    old = X.align_columns(old, cols, 0)
    scaler = scale_standard if variant == "A" else scale_minmax
    return scaler(old, prepared.scalers, prepared.feature_cols)
