"""Run configuration: thresholds, segment rules and model settings.

Everything tunable lives in two frozen dataclasses that are passed to the
operators explicitly, so a run is fully described by its config values.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

# ---------------------------------------------------------------------------
# Fixed values (must equal the analysed pipeline's for identical results)
# ---------------------------------------------------------------------------
# Default definition: strictly more than this many days delinquent.
OVERDUE_DAYS = 270
FOLD_COUNT = 5
DEALING_SEED = 42
LEVEL_CODES = ("UG", "GR")
SMALLEST_GROUP = 5
SMALLEST_PROGRAM = 10
SMALLEST_STATE = 10
# Income-driven repayment plans, matched on the lower-cased plan name.
IDR_PATTERN = (
    r"income.based repayment"
    r"|pay as you earn"
    r"|revised pay as you earn"
    r"|income contingent"
    r"|saving on a valuable education"
)
RF_TREES = 300
RF_DEPTH = 8
GBT_STAGES = 300
GBT_DEPTH = 4
GBT_LEARNING_RATE = 0.05
LR_MAX_ITER = 1000
# Rows shown when no group of a segment reaches min_n.
FALLBACK_TOP = 15
# Above/below band around the overall rate.
NEAR_BAND = 0.03
# Subgroup AUC needs at least this many rows (and both classes).
SMALLEST_SUBGROUP = 10


@dataclass(frozen=True)
class RiskConfig:
    """Parameters of ETL, profiling and segmentation."""

    as_of: str = "2026-01-01"              # reference date for age (ISO date)
    threshold_days: int = OVERDUE_DAYS
    # order of the numbers in dates that end with the year; a full run votes on it (operators.dates)
    day_first: bool = False
    level_codes: tuple[str, ...] = LEVEL_CODES
    min_n_default: int = SMALLEST_GROUP
    min_n_overrides: tuple[tuple[str, int], ...] = (
        ("state", SMALLEST_STATE), ("program", SMALLEST_PROGRAM))
    fallback_top: int = FALLBACK_TOP
    near_band: float = NEAR_BAND
    idr_pattern: str = IDR_PATTERN
    # show every segment's largest groups, as if none reached its min_n
    always_fallback: bool = False
    # percentiles are exact; this asks for the fixed-memory sketch instead
    approx_quantiles: bool = False
    approx_accuracy: int = 100_000

    def min_n(self, segment_key: str) -> int:
        return dict(self.min_n_overrides).get(segment_key, self.min_n_default)

    def fallback_only(self) -> "RiskConfig":
        """Same config, but every segment shows its largest groups."""
        return replace(self, always_fallback=True)


@dataclass(frozen=True)
class ModelConfig:
    """Cross-validation and classifier settings (defaults = full settings)."""

    folds: int = FOLD_COUNT
    seed: int = DEALING_SEED
    rf_trees: int = RF_TREES
    rf_depth: int = RF_DEPTH
    gbt_stages: int = GBT_STAGES
    gbt_depth: int = GBT_DEPTH
    gbt_learning_rate: float = GBT_LEARNING_RATE
    lr_max_iter: int = LR_MAX_ITER
    max_bins: int = 32
    models: tuple[str, ...] = (
        "Logistic Regression", "Random Forest", "Gradient Boosting")
    include_current_balance: bool = True
    # fold assignment: 16**hex_digits ranges of the dealing hash per class; a
    # range is one window partition (65,536 of them hold 10**11 rows easily)
    fold_hex_digits: int = 4
    # concurrent fits submitted from the driver (like CrossValidator)
    parallelism: int = 8
    checkpoint_interval: int = 10
    # statistics memory of one tree-growing pass (more nodes per pass, fewer jobs)
    tree_memory_mb: int = 1024
    subgroup_min_n: int = SMALLEST_SUBGROUP
    level_codes: tuple[str, ...] = LEVEL_CODES
