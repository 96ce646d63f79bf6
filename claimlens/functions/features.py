"""Derived policy features (P4-P13, P21) as Column expressions.

Null rules follow pandas: missing stays missing unless the reference fills
it; division is ``try_divide`` (ANSI mode stays on).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlens.settings import (CLAIM_RATIO_CLIP, DEFAULTS, DURATION_DEFAULT_DAYS, FEATURE_EPSILON,
                                PSI_HIGH, Settings)

EPS = FEATURE_EPSILON


def policy_duration_days(begin="INSR_BEGIN", end="INSR_END") -> Column:
    """Whole days end - begin; missing -> 365."""
    return F.coalesce(F.datediff(F.col(end), F.col(begin)), F.lit(DURATION_DEFAULT_DAYS)).cast("int")


def premium_per_seat() -> Column:
    """P5."""
    return F.try_divide(F.col("PREMIUM"), F.col("SEATS_NUM") + F.lit(EPS))


def insured_value_per_ton() -> Column:
    """P6."""
    return F.try_divide(F.col("INSURED_VALUE"), F.col("CCM_TON") + F.lit(EPS))


def claim_ratio(target: str = "CLAIM_PAID") -> Column:
    """Target / premium clipped to [0, 10]; missing stays missing."""
    x = F.try_divide(F.col(target), F.col("PREMIUM") + F.lit(EPS))
    lo, hi = CLAIM_RATIO_CLIP
    return F.when(x.isNotNull(), F.least(F.lit(hi), F.greatest(F.lit(lo), x)))


def is_claim(target: str = "CLAIM_PAID") -> Column:
    """1 if the target is positive, else 0 (missing -> 0)."""
    return F.coalesce((F.col(target) > 0).cast("int"), F.lit(0))


def premium_log() -> Column:
    """ln(premium + 1e-6); non-positive argument -> NULL."""
    return F.ln(F.col("PREMIUM") + F.lit(EPS))


_BUILDERS = {
    "policy_duration_days": lambda t: policy_duration_days(),
    "premium_per_seat": lambda t: premium_per_seat(),
    "insured_value_per_ton": lambda t: insured_value_per_ton(),
    "claim_ratio": lambda t: claim_ratio(t),
    "is_claim": lambda t: is_claim(t),
    "premium_log": lambda t: premium_log(),
}


def create_features(df: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """P10: the configured features, in configuration order, in one projection."""
    return df.withColumns({f: _BUILDERS[f](settings.target) for f in settings.features})


def add_missing_features(df: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Add each feature only if absent; target features only if the target exists."""
    t = settings.target
    needs_target = {"claim_ratio", "is_claim"}
    todo = {f: _BUILDERS[f](t) for f in _BUILDERS
            if f not in df.columns and (f not in needs_target or t in df.columns)}
    return df.withColumns(todo) if todo else df


def fill_target(df: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Missing target -> 0."""
    return df.fillna({settings.target: 0.0}) if settings.target in df.columns else df


def target_free_defaults(df: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Serving input without a target gets claim_ratio = is_claim = 0."""
    out = df
    if "claim_ratio" not in df.columns:
        out = out.withColumn("claim_ratio", claim_ratio(settings.target) if settings.target in df.columns
                             else F.lit(0.0))
    if "is_claim" not in df.columns:
        out = out.withColumn("is_claim", is_claim(settings.target) if settings.target in df.columns
                             else F.lit(0))
    return out


def drop_columns(df: DataFrame, cols) -> DataFrame:
    """Drop, ignoring absent columns."""
    return df.drop(*[c for c in cols if c in df.columns])


def align_columns(df: DataFrame, columns: list[str], fill=0) -> DataFrame:
    """Same columns, same order as ``columns``; absent -> ``fill``; extra dropped."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(fill).alias(c) for c in columns])


def drift_severity(psi: Column) -> Column:
    """P21."""
    return F.when(psi > PSI_HIGH, F.lit("high")).otherwise(F.lit("moderate"))
