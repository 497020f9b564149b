"""Rule-driven classifiers as native column expressions.

Each function returns a ``Column``; thresholds come from a ``Rules`` object so the
same plan serves any rule set.  Null handling follows the original row rules:
a missing percentage is Unknown, a flag column that is not exactly 1 is 0, a
clipped null stays null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from toolwatch.rules import DEFAULT_RULES, Rules

# Category labels.
EARLY, ON_TIME, LATE, OVERDUE, UNKNOWN = "Early", "On-Time", "Late", "Overdue", "Unknown"
SCHEDULED, UNSCHEDULED = "Scheduled", "Unscheduled"
LOW, MEDIUM, HIGH, CRITICAL = "Low", "Medium", "High", "Critical"
TIMING_CLASSES = (EARLY, ON_TIME, LATE, OVERDUE)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def round_half_even(x, digits: int) -> Column:
    """Round like numpy: scale in binary, round half to even, scale back.

    ``bround`` rounds the decimal text of the double instead and disagrees on
    values such as 52.355 whose binary product lands exactly on .5.
    """
    f = float(10**digits)
    return F.rint(_c(x) * f) / f


def nan_to_null(x) -> Column:
    """Doubles never carry NaN into a table: NaN compares greater than any number in Spark."""
    return F.nanvl(_c(x), F.lit(None).cast("double"))


def life_vs_target(actual, target) -> Column:
    return _c(actual) - _c(target)


def life_vs_target_pct(actual, target) -> Column:
    t = _c(target)
    return F.when(t > 0, (_c(actual) - t) / t * 100.0)


def timing_class(pct, rules: Rules = DEFAULT_RULES) -> Column:
    """Early / On-Time / Late / Overdue / Unknown, tested in this order.

    A value in no band (possible only with custom thresholds) is On-Time.
    """
    p = _c(pct)
    return (
        F.when(p.isNull(), F.lit(UNKNOWN))
        .when(p < rules.early_threshold, F.lit(EARLY))
        .when((p >= rules.on_time_min) & (p <= rules.on_time_max), F.lit(ON_TIME))
        .when((p > rules.late_threshold) & (p <= rules.overdue_threshold), F.lit(LATE))
        .when(p > rules.overdue_threshold, F.lit(OVERDUE))
        .otherwise(F.lit(ON_TIME))
    )


def scheduled_flag(downtime_type) -> Column:
    """1 when the type is 'scheduled' in any letter case (no trimming), else 0 (null -> 0)."""
    return F.when(F.lower(_c(downtime_type)) == "scheduled", 1).otherwise(0)


def scheduled_category(downtime_type) -> Column:
    t = F.lower(_c(downtime_type))
    return (
        F.when(t == "scheduled", F.lit(SCHEDULED))
        .when(t == "unscheduled", F.lit(UNSCHEDULED))
        .otherwise(F.lit(UNKNOWN))
    )


def flag_is_one(x) -> Column:
    """0/1 flag from a double label: exactly 1 -> 1, anything else (null too) -> 0."""
    return F.when(_c(x) == 1, 1).otherwise(0)


def downtime_category(downtime_type, downtime_class) -> Column:
    return F.concat_ws(
        " - ",
        F.coalesce(_c(downtime_type), F.lit(UNKNOWN)),
        F.coalesce(_c(downtime_class), F.lit(UNKNOWN)),
    )


def safe_rate(num, den) -> Column:
    """num/den with 0 for a zero or null denominator."""
    return F.coalesce(F.try_divide(_c(num).cast("double"), _c(den)), F.lit(0.0))


def clip_pct(x) -> Column:
    """Clip to [0, 100] keeping null as null (least/greatest alone would turn null into 0)."""
    v = _c(x)
    return F.when(v.isNotNull(), F.least(F.greatest(v, F.lit(0.0)), F.lit(100.0)))


def life_cv(std, mean) -> Column:
    """Coefficient of variation; 0 when the mean is not positive or missing."""
    m = _c(mean)
    return F.when(m > 0, _c(std) / m).otherwise(F.lit(0.0))


def chronic_score(unsched_rate, cv, hours_per_pm, reclean_rate, sympathy_rate, rules: Rules = DEFAULT_RULES) -> Column:
    """Weighted 0-100 score, rounded half-even to 2 places (see ``round_half_even``).

    The first three factors are normalised by their thresholds and clipped; the
    reclean and sympathy rates enter as plain percentages.
    """
    s = (
        clip_pct(_c(unsched_rate) / rules.unscheduled_rate_threshold * 100.0) * rules.weight_unscheduled
        + clip_pct(_c(cv) / rules.life_cv_threshold * 100.0) * rules.weight_cv
        + clip_pct(_c(hours_per_pm) / rules.downtime_hours_scale * 100.0) * rules.weight_downtime
        + _c(reclean_rate) * 100.0 * rules.weight_reclean
        + _c(sympathy_rate) * 100.0 * rules.weight_sympathy
    )
    return round_half_even(s, 2)


def chronic_flag(n_events, unsched_rate, cv, rules: Rules = DEFAULT_RULES) -> Column:
    cond = (_c(n_events) >= rules.min_pm_events) & (
        (_c(unsched_rate) > rules.unscheduled_rate_threshold) | (_c(cv) > rules.life_cv_threshold)
    )
    return F.when(F.coalesce(cond, F.lit(False)), 1).otherwise(0)


def severity(flag, score, rules: Rules = DEFAULT_RULES) -> Column:
    """Null for unflagged tools; a flagged tool with a null score falls through to Low."""
    s = _c(score)
    return (
        F.when(_c(flag) == 0, F.lit(None).cast("string"))
        .when(s >= rules.severity_critical, F.lit(CRITICAL))
        .when(s >= rules.severity_high, F.lit(HIGH))
        .when(s >= rules.severity_medium, F.lit(MEDIUM))
        .otherwise(F.lit(LOW))
    )
