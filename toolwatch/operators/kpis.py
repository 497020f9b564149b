"""Gold layer: weekly KPI facts.

Plan shape for every fact (checked with ``explain``):

* the main aggregate uses only partial-aggregatable functions (count, sum,
  avg, stddev, min/max, ``min_by``) plus exact ``median`` whose buffer is a
  value->count map per group (bounded by distinct values, merged map-side);
* distinct tool counts come from a second, pre-deduplicated aggregate of
  (keys, entity) tuples joined to the chronic entity set; this replaces the
  per-group IN-list lookups and keeps ``count(DISTINCT ...)`` (an Expand that
  multiplies rows) out of the main aggregate;
* both aggregates are hash-partitioned on the same keys, so the final join of
  the two is partition-aligned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from toolwatch.functions import classify as cls
from toolwatch.functions.agg import count_if as _count_if
from toolwatch.functions.agg import exact_avg, exact_sum0
from toolwatch.operators.chronic import _not_null

WEEK_KEYS = ("ww_year", "ww_number", "work_week")
SITE_KEYS = ("facility", *WEEK_KEYS)
CEID_KEYS = ("ceid", "facility", "process_class", *WEEK_KEYS)
PART_KEYS = ("part_name", "entity", "facility", "ceid", *WEEK_KEYS)
SUMMARY_KEYS = ("facility", "ceid", *WEEK_KEYS, "process_class")


def _timing_counts() -> list[Column]:
    t = F.col("timing_class")
    return [
        _count_if(t == cls.EARLY).alias("early_pm_count"),
        _count_if(t == cls.ON_TIME).alias("on_time_pm_count"),
        _count_if(t == cls.LATE).alias("late_pm_count"),
        _count_if(t == cls.OVERDUE).alias("overdue_pm_count"),
    ]


def first_target(target="target_life", ts="event_ts") -> Column:
    """Target life of the group's earliest event that has one (ties: smallest target)."""
    t = F.col(target)
    return F.min_by(t, F.when(t.isNotNull(), F.struct(F.col(ts), t)))


def tool_counts(enriched: DataFrame, keys, chronic_entities: DataFrame | None) -> DataFrame:
    """Distinct tools and distinct chronic tools per group.

    ``(keys, entity)`` is deduplicated first (map-side partial aggregation), so
    only distinct tuples are shuffled and joined to the chronic entity set.
    """
    tuples = _not_null(enriched, (*keys, "entity")).select(*keys, "entity").distinct()
    if chronic_entities is None:
        return tuples.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("total_tools"), F.lit(0).cast("long").alias("chronic_tools")
        )
    flagged = chronic_entities.select("entity").distinct().withColumn("_chronic", F.lit(1))
    return (
        tuples.join(flagged, "entity", "left")
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("total_tools"), F.count("_chronic").alias("chronic_tools"))
    )


def site_week_kpis(enriched: DataFrame, chronic_entities: DataFrame | None = None) -> DataFrame:
    """Facility x work-week KPI fact."""
    ev = _not_null(enriched, SITE_KEYS)
    base = ev.groupBy(*SITE_KEYS).agg(
        F.count(F.lit(1)).alias("total_pm_events"),
        _count_if(F.col("scheduled_flag") == 1).alias("scheduled_pm_events"),
        _count_if(F.col("scheduled_flag") == 0).alias("unscheduled_pm_events"),
        *_timing_counts(),
        exact_sum0("down_hours").alias("total_downtime_hours"),
        exact_avg("down_hours").alias("avg_downtime_per_pm"),
        F.avg("actual_life").alias("avg_pm_life"),
        F.median("actual_life").alias("median_pm_life"),
        first_target().alias("target_pm_life"),
        F.avg("life_vs_target").alias("avg_life_vs_target"),
    )
    tools = tool_counts(ev, SITE_KEYS, chronic_entities)
    n = F.col("total_pm_events")
    out = base.join(tools, list(SITE_KEYS), "left")
    sched_hours = F.coalesce(F.col("total_downtime_hours") * F.try_divide(F.col("scheduled_pm_events"), n), F.lit(0.0))
    return out.select(
        *SITE_KEYS,
        "total_pm_events",
        "scheduled_pm_events",
        "unscheduled_pm_events",
        "early_pm_count",
        "on_time_pm_count",
        "late_pm_count",
        "overdue_pm_count",
        "total_downtime_hours",
        "avg_downtime_per_pm",
        "avg_pm_life",
        "median_pm_life",
        "target_pm_life",
        "avg_life_vs_target",
        F.coalesce(F.col("total_tools"), F.lit(0)).cast("long").alias("total_tools_count"),
        F.coalesce(F.col("chronic_tools"), F.lit(0)).cast("long").alias("chronic_tools_count"),
        cls.safe_rate(F.coalesce(F.col("chronic_tools"), F.lit(0)), F.col("total_tools")).alias("chronic_tools_pct"),
        cls.safe_rate("unscheduled_pm_events", n).alias("unscheduled_pm_rate"),
        cls.safe_rate("early_pm_count", n).alias("early_pm_rate"),
        cls.safe_rate("on_time_pm_count", n).alias("on_time_pm_rate"),
        cls.safe_rate("overdue_pm_count", n).alias("overdue_pm_rate"),
        sched_hours.alias("scheduled_downtime_hours"),
        (F.col("total_downtime_hours") - sched_hours).alias("unscheduled_downtime_hours"),
    )


def ceid_week_kpis(enriched: DataFrame, chronic_entities: DataFrame | None = None) -> DataFrame:
    """Chamber type x facility x class x work-week KPI fact.

    Early/overdue rates are computed from the timing counts (the original left
    them at a constant 0).
    """
    ev = _not_null(enriched, CEID_KEYS)
    base = ev.groupBy(*CEID_KEYS).agg(
        F.count(F.lit(1)).alias("total_pm_events"),
        _count_if(F.col("scheduled_flag") == 1).alias("scheduled_pm_events"),
        _count_if(F.col("scheduled_flag") == 0).alias("unscheduled_pm_events"),
        _count_if(F.col("timing_class") == cls.EARLY).alias("early_pm_count"),
        _count_if(F.col("timing_class") == cls.OVERDUE).alias("overdue_pm_count"),
        exact_sum0("down_hours").alias("total_downtime_hours"),
        F.avg("actual_life").alias("avg_pm_life"),
        F.median("actual_life").alias("median_pm_life"),
        F.stddev_samp("actual_life").alias("life_stddev"),
    )
    tools = tool_counts(ev, CEID_KEYS, chronic_entities)
    n = F.col("total_pm_events")
    return base.join(tools, list(CEID_KEYS), "left").select(
        *CEID_KEYS,
        "total_pm_events",
        "scheduled_pm_events",
        "unscheduled_pm_events",
        "total_downtime_hours",
        F.coalesce(F.col("total_downtime_hours") * F.try_divide(F.col("unscheduled_pm_events"), n), F.lit(0.0)).alias(
            "unscheduled_downtime_hours"
        ),
        "avg_pm_life",
        "median_pm_life",
        "life_stddev",
        F.coalesce(F.col("total_tools"), F.lit(0)).cast("long").alias("total_chambers"),
        F.coalesce(F.col("chronic_tools"), F.lit(0)).cast("long").alias("chronic_chambers"),
        cls.safe_rate("unscheduled_pm_events", n).alias("unscheduled_pm_rate"),
        cls.safe_rate("early_pm_count", n).alias("early_pm_rate"),
        cls.safe_rate("overdue_pm_count", n).alias("overdue_pm_rate"),
    )


def part_week_summary(enriched: DataFrame, life_saved: bool = False) -> DataFrame:
    """Part x tool x work-week replacement summary (events with a part name only).

    ``life_saved`` adds the summed life run beyond target, for ``unified_roi``.
    """
    ev = _not_null(enriched, PART_KEYS)
    t = F.col("timing_class")
    span_seconds = F.timestamp_diff("SECOND", F.min("event_ts"), F.max("event_ts"))
    return ev.groupBy(*PART_KEYS).agg(
        F.count(F.lit(1)).alias("replacement_count"),
        F.avg("actual_life").alias("avg_life_at_replacement"),
        F.median("actual_life").alias("median_life_at_replacement"),
        F.min("actual_life").alias("min_life_at_replacement"),
        F.max("actual_life").alias("max_life_at_replacement"),
        F.floor(span_seconds / 86400).cast("long").alias("life_span_days"),
        _count_if(t == cls.EARLY).alias("early_replacement_count"),
        _count_if(t.isin(cls.LATE, cls.OVERDUE)).alias("late_replacement_count"),
        F.stddev_samp("actual_life").alias("life_stddev"),
        *([F.coalesce(F.sum(F.greatest(F.col("life_vs_target"), F.lit(0.0))), F.lit(0.0)).alias("life_saved")] if life_saved else []),
    )


def chronic_by_group(enriched: DataFrame, keys, chronic: DataFrame) -> DataFrame:
    """Per group: tools flagged chronic and their mean chronic score.

    Distinct (keys, entity) tuples are joined to the chronic rows of the same
    tool (entity, facility, ceid); both sides are deduplicated, so the join is
    one row per tool and group.
    """
    tuples = _not_null(enriched, (*keys, "entity")).select(*keys, "entity").distinct()
    tools = chronic.select("entity", "facility", "ceid", "chronic_flag", "chronic_score")
    return (
        tuples.join(tools, ["entity", "facility", "ceid"], "left")
        .groupBy(*keys)
        .agg(
            _count_if(F.col("chronic_flag") == 1).alias("chronic_tools_count"),
            F.avg("chronic_score").alias("avg_chronic_score"),
        )
    )


def downtime_summary(enriched: DataFrame, chronic: DataFrame | None = None) -> DataFrame:
    """Facility x ceid x work-week x class downtime summary.

    With a chronic snapshot, also the number of chronic tools and their mean
    score per group (tool grain: entity, facility, ceid).
    """
    ev = _not_null(enriched, SUMMARY_KEYS)
    base = ev.groupBy(*SUMMARY_KEYS).agg(
        F.count(F.lit(1)).alias("total_pm_events"),
        _count_if(F.col("scheduled_flag") == 1).alias("scheduled_pm_count"),
        _count_if(F.col("scheduled_flag") == 0).alias("unscheduled_pm_count"),
        *_timing_counts(),
        exact_sum0("down_hours").alias("total_downtime_hours"),
        exact_avg("down_hours").alias("avg_downtime_hours"),
        F.avg("actual_life").alias("avg_pm_life"),
        F.median("actual_life").alias("median_pm_life"),
        F.stddev_samp("actual_life").alias("life_stddev"),
    )
    n = F.col("total_pm_events")
    sched_hours = F.coalesce(F.col("total_downtime_hours") * F.try_divide(F.col("scheduled_pm_count"), n), F.lit(0.0))
    out = base.withColumns(
        {
            "unscheduled_pm_rate": cls.safe_rate("unscheduled_pm_count", n),
            "early_pm_rate": cls.safe_rate("early_pm_count", n),
            "overdue_pm_rate": cls.safe_rate("overdue_pm_count", n),
            "scheduled_downtime_hours": sched_hours,
            "unscheduled_downtime_hours": F.col("total_downtime_hours") - sched_hours,
            "life_variance": F.pow(F.col("life_stddev"), 2),
            "record_count": n,
        }
    )
    if chronic is None:
        return out
    return out.join(chronic_by_group(ev, SUMMARY_KEYS, chronic), list(SUMMARY_KEYS), "left").withColumn(
        "chronic_tools_count", F.coalesce(F.col("chronic_tools_count"), F.lit(0)).cast("long")
    )


def cost_summary(enriched: DataFrame, part_costs: DataFrame | None = None) -> DataFrame:
    """Facility x ceid x work-week part cost totals.

    Without ``part_costs`` the events' own ``part_cost`` (from the file) is taken, of
    events that have one.  ``part_costs`` is keyed by (entity, part_name) and is joined without a hint:
    its size grows with the fleet, so the planner (and AQE's measured threshold)
    decides between broadcast and shuffle.  Savings credit the part cost for life
    run beyond target: ``cost * (actual - target) / target`` when positive.
    """
    keys = ("facility", "ceid", *WEEK_KEYS)
    ev = _not_null(enriched, (*keys, "entity", "part_name"))
    if part_costs is None:
        ev = ev.filter(F.col("part_cost").isNotNull()).withColumn("part_cost", F.col("part_cost").cast("double"))
    else:
        ev = ev.drop("part_cost").join(part_costs, ["entity", "part_name"], "inner")
    saving = F.when(
        (F.col("target_life") > 0) & (F.col("actual_life") > F.col("target_life")),
        F.col("part_cost") * (F.col("actual_life") - F.col("target_life")) / F.col("target_life"),
    ).otherwise(F.lit(0.0))
    return ev.groupBy(*keys).agg(
        F.sum("part_cost").alias("total_part_cost"),
        F.avg("part_cost").alias("avg_part_cost"),
        F.count(F.lit(1)).alias("part_replacement_count"),
        F.sum(saving).alias("total_part_savings"),
    )


def unified_roi(part_summary: DataFrame, part_costs: DataFrame, labour_costs: DataFrame, unit_value: float = 1.0) -> DataFrame:
    """Part-week facts joined to part costs (entity, part) and labour costs (facility, ceid).

    ``roi = life_saved * unit_value - part_cost * replacements - labour_cost * replacements``
    where ``life_saved`` is the summed life run beyond target in the group
    (``part_week_summary(events, life_saved=True)``).
    """
    j = (
        part_summary
        .join(part_costs, ["entity", "part_name"], "inner")
        .join(labour_costs, ["facility", "ceid"], "inner")
    )
    n = F.col("replacement_count")
    return j.select(
        *PART_KEYS,
        "replacement_count",
        F.col("life_saved"),
        (F.col("part_cost") * n).alias("part_cost_total"),
        (F.col("labour_cost") * n).alias("labour_cost_total"),
        (F.col("life_saved") * unit_value - F.col("part_cost") * n - F.col("labour_cost") * n).alias("roi"),
        ((F.col("life_saved") * unit_value - F.col("part_cost") * n - F.col("labour_cost") * n) / n).alias("roi_per_pm"),
    )


def extra_measures(enriched: DataFrame, keys=SITE_KEYS) -> DataFrame:
    """Alternative gold measures: median downtime, reclean count/rate, sympathy count per group."""
    ev = _not_null(enriched, keys)
    return ev.groupBy(*keys).agg(
        F.median("down_hours").alias("median_downtime_hours"),
        F.sum("reclean_flag").cast("long").alias("reclean_count"),
        F.avg("reclean_flag").alias("reclean_rate"),
        F.sum("sympathy_flag").cast("long").alias("sympathy_count"),
    )
