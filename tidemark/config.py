"""Column names, fixed values and the tunables shared by every operator."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

CLIENT = "client_name"
DATE = "event_date"
ACTUAL = "actual_volume"
BASELINE = "rolling_4w_median"
TARGET = "target"
#: Folder column of histories that are partitioned by month, as year * 100 + month.
MONTH = "history_month"
FLAGS = ("is_china", "is_domestic")
EVENT_PREFIX = "event_"

# Accepted source names per canonical column, tried in order after
# the canonical name itself.
ALIASES = {
    DATE: ("preadvice_date", "DATE_DATE"),
    ACTUAL: ("parcel_volume",),
    BASELINE: ("median_4wk_volume",),
    TARGET: (),
    "is_china": ("china_flag",),
    "is_domestic": ("domestic_flag",),
}

# Workflow zones, cohort names and gate statuses.
ZONE_NOMINAL = "ZONE_1_NOMINAL"
ZONE_WARNING = "ZONE_2_DEVIATION_WARNING"
ZONE_CRITICAL = "ZONE_3_CRITICAL_REJECTION"
ANCHORS = "The Anchors"
DIALS = "The Dials"
SPIKERS = "The Spikers"
PHANTOMS = "The Phantoms"

# Fixed values: (prefix, calendar column, period) of the cyclical features.
CYCLES = (
    ("month", "month", 12),
    ("dow", "day_of_week", 7),
    ("doy", "day_of_year", 365),
    ("woy", "week_of_year", 52),
    ("dom", "day_of_month", 31),
)


@dataclass(frozen=True)
class Cohort:
    """One row of the cohort gate: a hard cohort blocks promotion when it breaches."""

    name: str
    max_smape: float
    hard: bool
    reason: str


COHORTS = (
    Cohort(ANCHORS, 7.5, True, "CRITICAL: AnchorToleranceBreach"),
    Cohort(DIALS, 13.0, True, "CRITICAL: DialToleranceBreach"),
    Cohort(SPIKERS, 24.0, False, "WARNING: SpikerVolatility"),
    Cohort(PHANTOMS, 32.0, True, "CRITICAL: PhantomToleranceBreach"),
)
OVERALL_BREACH = "CRITICAL: OverallSmapeBreach"


@dataclass(frozen=True)
class Settings:
    """Tunables of one run; the defaults are the reference's operating values."""

    # refinement
    as_of: date | None = None  # None: the session's current date
    lookback_days: int = 730
    min_baseline: float = 10.0
    bound_above: bool = True
    positive_actual_only: bool = True
    require_target: bool = False
    default_missing_flags: bool = True
    date_formats: tuple[str, ...] = ("yyyyMMdd", "M/d/yyyy")
    min_client_median: float = 10.0

    # volumetric guardrail
    expected_rows: int = 1_100_000
    min_row_fraction: float = 0.50
    max_drop_fraction: float = 0.92
    nominal_drop_fraction: float = 0.02

    # target and split
    clip_floor: float = 1e-6
    baseline_window_days: int = 28
    test_days: int = 42
    val_days: int = 42
    feature_columns: tuple[str, ...] = ()

    # cohorts and quality gate
    cohorts: tuple[Cohort, ...] = field(default=COHORTS)
    high_volume_quantile: float = 0.75
    low_volume_quantile: float = 0.35
    low_predictability_quantile: float = 0.65
    high_predictability_quantile: float = 0.35
    max_smape: float = 40.0

    # process gates
    max_baseline_hours: float = 2.0
    max_eval_hours: float = 24.0

    # model
    trees: int = 600
    depth: int = 8
    learning_rate: float = 0.03
    row_sample: float = 0.85
    column_sample: float = 0.85
    seed: int = 42
    max_bins: int = 256
    fit_partitions: int | None = None  # None: by the number of training rows
    fit_rows_per_partition: int = 250_000

    # report
    report_name: str = "Demand uplift run report"
    report_phase: str = "Phase 0"
    report_objective: str = "Check that a training run repeats and that its evidence is complete."

    # identity
    model_name: str = "multi_client_uplift_trees"
    dataset_version: str = "v1"

    def snapshot(self) -> dict[str, float]:
        """The thresholds recorded with every run, under their published names."""
        limits = {cohort.name: cohort.max_smape for cohort in self.cohorts}
        return {
            "MAX_SMAPE_THRESHOLD": self.max_smape,
            "REFINERY_EXPECTED_ROW_COUNT": float(self.expected_rows),
            "MAX_ANCHOR_SMAPE": limits[ANCHORS],
            "MAX_DIAL_SMAPE": limits[DIALS],
            "MAX_SPIKER_SMAPE": limits[SPIKERS],
            "MAX_PHANTOM_SMAPE": limits[PHANTOMS],
            "ARCHETYPE_HIGH_VOLUME_QUANTILE": self.high_volume_quantile,
            "ARCHETYPE_LOW_VOLUME_QUANTILE": self.low_volume_quantile,
            "ARCHETYPE_LOW_PREDICTABILITY_QUANTILE": self.low_predictability_quantile,
            "ARCHETYPE_HIGH_PREDICTABILITY_QUANTILE": self.high_predictability_quantile,
        }
