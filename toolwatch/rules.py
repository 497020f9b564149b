"""One immutable rule object carrying every threshold, weight and retention setting.

The transforms read their parameters from a ``Rules`` instance instead of a
config file so a job is a pure function of (input tables, rules, as-of date).
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class Rules:
    # Fixed values (defaults of the original rule set).
    # Service timing, percent deviation of actual life from target life.
    early_threshold: float = -15.0
    on_time_min: float = -15.0
    on_time_max: float = 15.0
    late_threshold: float = 15.0
    overdue_threshold: float = 30.0

    # Chronic tool detection.
    unscheduled_rate_threshold: float = 0.30
    life_cv_threshold: float = 0.40
    min_pm_events: int = 5

    # Chronic score weights and normalisers.
    weight_unscheduled: float = 0.35
    weight_cv: float = 0.25
    weight_downtime: float = 0.20
    weight_reclean: float = 0.10
    weight_sympathy: float = 0.10
    downtime_hours_scale: float = 10.0

    # Severity cut points on the chronic score (``severity_low`` is carried but,
    # as in the original rules, a flagged tool below ``medium`` is always Low).
    severity_low: float = 25.0
    severity_medium: float = 50.0
    severity_high: float = 75.0
    severity_critical: float = 90.0

    # Retention in weeks per layer.
    retention_weeks_raw: int = 26
    retention_weeks_enriched: int = 104
    retention_weeks_facts: int = 156

    # Rolling window length in weeks and week-over-week row-count tolerance.
    rolling_window_weeks: int = 4
    rowcount_tolerance: float = 0.20

    # Null-profile warning threshold in percent.
    null_pct_warning: float = 50.0

    # Columns that make up the data-quality score.
    quality_columns: tuple[str, ...] = field(
        default=(
            "entity",
            "facility",
            "ceid",
            "work_week",
            "event_ts",
            "downtime_type",
            "actual_life",
            "target_life",
        )
    )

    def __post_init__(self) -> None:
        """Reject rule sets that cannot be applied (the original validator's error checks)."""
        errors = []
        if not (
            self.early_threshold
            <= self.on_time_min
            <= self.on_time_max
            <= self.late_threshold
            < self.overdue_threshold
        ):
            errors.append("timing thresholds must satisfy early <= min <= max <= late < overdue")
        if not 0 <= self.unscheduled_rate_threshold <= 1:
            errors.append("unscheduled rate threshold must be in [0, 1]")
        if not 0 < self.life_cv_threshold <= 2:
            errors.append("life CV threshold must be in (0, 2] (it also normalises the score)")
        if self.min_pm_events < 1:
            errors.append("min_pm_events must be >= 1")
        weights = (
            self.weight_unscheduled,
            self.weight_cv,
            self.weight_downtime,
            self.weight_reclean,
            self.weight_sympathy,
        )
        if any(w < 0 for w in weights) or abs(sum(weights) - 1.0) > 0.01:
            errors.append("chronic score weights must be non-negative and sum to 1 (+-0.01)")
        if not (0 < self.severity_low < self.severity_medium < self.severity_high < self.severity_critical <= 100):
            errors.append("severity thresholds must satisfy 0 < low < medium < high < critical <= 100")
        if min(self.retention_weeks_raw, self.retention_weeks_enriched, self.retention_weeks_facts) < 1:
            errors.append("retention weeks must be >= 1")
        if not 0 <= self.null_pct_warning <= 100:
            errors.append("null percentage threshold must be in [0, 100]")
        if not 0 <= self.rowcount_tolerance <= 1:
            errors.append("row-count tolerance must be in [0, 1]")
        if self.rolling_window_weeks < 1 or self.downtime_hours_scale <= 0:
            errors.append("rolling window must be >= 1 week and the downtime scale positive")
        if errors:
            raise ValueError("; ".join(errors))

    def warnings(self) -> list[str]:
        """Settings that are valid but unusual (the original validator's warnings)."""
        out = []
        if self.early_threshold != self.on_time_min:
            out.append("gap between early threshold and on-time minimum (values in it count as On-Time)")
        if self.on_time_max != self.late_threshold:
            out.append("gap between on-time maximum and late threshold (values in it count as On-Time)")
        if self.unscheduled_rate_threshold > 0.5 or self.unscheduled_rate_threshold < 0.2:
            out.append("unscheduled rate threshold outside the usual 0.2-0.5")
        if self.life_cv_threshold > 1 or self.life_cv_threshold < 0.2:
            out.append("life CV threshold outside the usual 0.2-1")
        if self.min_pm_events < 3 or self.min_pm_events > 20:
            out.append("min_pm_events outside the usual 3-20")
        if not (self.retention_weeks_raw <= self.retention_weeks_enriched <= self.retention_weeks_facts):
            out.append("retention usually grows from raw to enriched to facts")
        return out

    def with_(self, **changes) -> "Rules":
        return replace(self, **changes)


DEFAULT_RULES = Rules()
