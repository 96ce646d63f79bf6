"""Parameters of the operators, as one immutable value passed around.

The reference reads these from a global YAML file; here they are plain
arguments with the same defaults.
"""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------
# These must equal the reference's for the same results.
# Thresholds, column roles, feature names and model settings, in the order
# the reference configuration lists them.
# ---------------------------------------------------------------------------
BATCH_SIZE = 50000
MAX_NULL_RATIO = 0.3
MAX_OUTLIER_RATIO = 0.05
MIN_UNIQUE_RATIO = 0.01
NUMERIC_COLUMNS = ("INSURED_VALUE", "PREMIUM", "PROD_YEAR", "SEATS_NUM", "CARRYING_CAPACITY", "CCM_TON")
CATEGORICAL_COLUMNS = ("SEX", "INSR_TYPE", "TYPE_VEHICLE", "MAKE", "USAGE")
FEATURES = ("policy_duration_days", "premium_per_seat", "insured_value_per_ton",
            "claim_ratio", "is_claim", "premium_log")
REFERENCE_BATCHES = 5
PSI_THRESHOLD = 0.2
MONITOR_COLUMNS = ("INSURED_VALUE", "PREMIUM", "CLAIM_PAID", "SEATS_NUM", "TYPE_VEHICLE", "USAGE")
TARGET = "CLAIM_PAID"
DATE_FORMAT = "d-MMM-yy"          # Python "%d-%b-%y"
DROP_COLUMNS = ("INSR_BEGIN", "INSR_END", "OBJECT_ID")
TRAIN_SPLIT = 0.8
INFLATION_YEAR = 2014
INFLATION_COLUMNS = ("CLAIM_PAID", "INSURED_VALUE", "PREMIUM")
TREE_MAX_DEPTH = 10
SEED = 42
KNN_NEIGHBOURS = 5
SGD_MAX_ITER = 1000
DEDUP_KEYS = ("INSR_BEGIN", "OBJECT_ID")
IQR_FACTOR = 1.5                  # hard-coded in the reference's outlier rule
SCORE_PENALTY = 2                 # quality score = max(0, 100 - 2 * issues)
PSI_HIGH = 0.3                    # severity "high" above, "moderate" otherwise
PSI_EPSILON = 1e-6                # added to both densities / missing category share
FEATURE_EPSILON = 1e-6            # denominator guard in the derived features
DURATION_DEFAULT_DAYS = 365
CLAIM_RATIO_CLIP = (0.0, 10.0)
HISTOGRAM_BINS = 30               # EDA charts
HISTOGRAM_COLUMNS = 4             # EDA charts show the first four numeric columns
DRIFT_BINS = 10
TOP_CORRELATIONS = 5
# ---------------------------------------------------------------------------

# Columns that carry bookkeeping, never data.
BOOKKEEPING = ("batch_id", "row_index", "source_ord", "tie1", "tie2", "tie3", "part_ord")


@dataclass(frozen=True)
class Settings:
    batch_size: int = BATCH_SIZE
    max_null_ratio: float = MAX_NULL_RATIO
    max_outlier_ratio: float = MAX_OUTLIER_RATIO
    min_unique_ratio: float = MIN_UNIQUE_RATIO
    numeric_columns: tuple = NUMERIC_COLUMNS
    categorical_columns: tuple = CATEGORICAL_COLUMNS
    features: tuple = FEATURES
    reference_batches: int = REFERENCE_BATCHES
    psi_threshold: float = PSI_THRESHOLD
    monitor_columns: tuple = MONITOR_COLUMNS
    target: str = TARGET
    date_format: str = DATE_FORMAT
    drop_columns: tuple = DROP_COLUMNS
    train_split: float = TRAIN_SPLIT
    inflation_year: int = INFLATION_YEAR
    inflation_columns: tuple = INFLATION_COLUMNS
    tree_max_depth: int = TREE_MAX_DEPTH
    seed: int = SEED
    knn_neighbours: int = KNN_NEIGHBOURS
    sgd_max_iter: int = SGD_MAX_ITER
    dedup_keys: tuple = DEDUP_KEYS
    iqr_factor: float = IQR_FACTOR
    # drift mode: "clamp" (default), "proportion" or "density" (reference parity)
    psi_mode: str = "clamp"
    # rows that preparation fits its parameters on: "all" (reference parity) or "train"
    fit_on: str = "all"
    # claim_ratio / is_claim of rows without a claim: from the filled target ("target") or imputed ("median")
    claim_ratio_fill: str = "target"
    # quality gates from two scans of the rows instead of about seven (pays where reading dominates)
    few_scans: bool = False
    # quantiles: "exact" (distributed exact, interpolated) or "approx"
    quantile_method: str = "exact"

    def with_(self, **kw) -> "Settings":
        from dataclasses import replace
        return replace(self, **kw)


DEFAULTS = Settings()
