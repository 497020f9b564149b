"""Report operators: distributions, profiles, dashboard measures, top-k lists, views."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from toolwatch.functions import classify as cls
from toolwatch.functions.agg import count_if, exact_avg, exact_sum0
from toolwatch.operators.joins import scalar
from toolwatch.operators.quantiles import global_median
from toolwatch.rules import DEFAULT_RULES, Rules


def distribution(df: DataFrame, col: str) -> DataFrame:
    """Value counts with percent of total.

    The total is a window over the already-grouped rows (one row per distinct
    value), so the single-partition window only ever sees the category list.
    """
    g = df.groupBy(col).agg(F.count(F.lit(1)).alias("row_count"))
    total = F.sum("row_count").over(Window.partitionBy())
    return g.withColumn("pct_of_total", F.col("row_count") * 100.0 / total)


def severity_counts(chronic: DataFrame) -> DataFrame:
    return (
        chronic.filter(F.col("chronic_flag") == 1)
        .groupBy("chronic_severity")
        .agg(F.count(F.lit(1)).alias("tool_count"), F.avg("chronic_score").alias("avg_score"))
    )


def chronic_share(chronic: DataFrame) -> DataFrame:
    """Flagged tools / all tools x 100 (0 for an empty table)."""
    return chronic.agg(
        F.count(F.lit(1)).alias("total_tools"),
        count_if(F.col("chronic_flag") == 1).alias("chronic_tools"),
    ).withColumn("chronic_pct", cls.safe_rate("chronic_tools", "total_tools") * 100.0)


def null_profile(df: DataFrame, columns, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Null count and percent per column in one pass, one output row per column.

    A single aggregate computes every count (one scan); ``stack`` turns the one
    wide row into rows.  ``warning`` marks columns above the rule threshold.
    """
    cols = list(columns)
    agg = df.agg(
        F.count(F.lit(1)).alias("_n"),
        *[count_if(F.col(c).isNull()).alias(f"_null_{i}") for i, c in enumerate(cols)],
    )
    pairs = ", ".join(f"'{c}', _null_{i}" for i, c in enumerate(cols))
    long = agg.selectExpr("_n AS total_rows", f"stack({len(cols)}, {pairs}) AS (column_name, null_count)")
    pct = F.coalesce(F.try_divide(F.col("null_count") * 100.0, F.col("total_rows")), F.lit(0.0))
    return long.withColumn("null_pct", pct).withColumn(
        "warning", F.when(F.col("null_pct") > rules.null_pct_warning, 1).otherwise(0)
    )


def overall_null_pct(df: DataFrame, columns) -> DataFrame:
    cols = list(columns)
    nulls = sum(F.col(c).isNull().cast("long") for c in cols)
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.coalesce(F.sum(nulls), F.lit(0)).cast("long").alias("null_cells"),
    ).withColumn("overall_null_pct", F.coalesce(F.try_divide(F.col("null_cells") * 100.0, F.col("total_rows") * len(cols)), F.lit(0.0)))


def loads_per_week(df: DataFrame, week_col: str, ts_col: str) -> DataFrame:
    """Rows, first and last timestamp per source week."""
    return df.groupBy(week_col).agg(
        F.count(F.lit(1)).alias("row_count"), F.min(ts_col).alias("first_ts"), F.max(ts_col).alias("last_ts")
    )


def dashboard_measures(enriched: DataFrame) -> DataFrame:
    """Global dashboard measures: one aggregate, and the median by counts.

    Unscheduled here counts only rows typed 'unscheduled' (any case); early and
    late use the per-event lower/upper limits; on-time is the remainder.
    """
    life = F.col("actual_life")
    m = enriched.agg(
        F.count(F.lit(1)).alias("total_pm_events"),
        count_if(F.lower(F.col("downtime_type")) == "unscheduled").alias("unscheduled_pm_count"),
        F.avg(life).alias("avg_pm_life"),
        (F.avg(life) - F.avg("target_life")).alias("life_vs_target"),
        count_if(life < F.col("lower_limit")).alias("early_pm_count"),
        count_if(life > F.col("upper_limit")).alias("late_pm_count"),
        exact_sum0("down_hours").alias("total_downtime_hours"),
    )
    return m.withColumns(
        {
            "median_pm_life": global_median(enriched, "actual_life").scalar(),
            "unscheduled_pm_rate": cls.safe_rate("unscheduled_pm_count", "total_pm_events"),
            "on_time_pm_count": F.col("total_pm_events") - F.col("early_pm_count") - F.col("late_pm_count"),
        }
    )


def life_histogram(enriched: DataFrame, bin_width: float) -> DataFrame:
    """Counts of actual life per fixed-width bin, with the global median as a reference line."""
    life = F.col("actual_life")
    med = global_median(enriched, "actual_life").scalar()
    return (
        enriched.filter(life.isNotNull())
        .groupBy((F.floor(life / bin_width) * bin_width).alias("bin_start"))
        .agg(F.count(F.lit(1)).alias("event_count"))
        .withColumns({"bin_end": F.col("bin_start") + bin_width, "median_life": med})
    )


def downtime_trend_pivot(enriched: DataFrame) -> DataFrame:
    """Weekly event counts pivoted by scheduled category (fixed value list: no extra job)."""
    cats = [cls.SCHEDULED, cls.UNSCHEDULED, cls.UNKNOWN]
    p = (
        enriched.filter(F.col("work_week").isNotNull())
        .groupBy("ww_year", "ww_number", "work_week")
        .pivot("scheduled_category", cats)
        .agg(F.count(F.lit(1)))
    )
    return p.select(
        "ww_year", "ww_number", "work_week",
        *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(f"{c.lower()}_count") for c in cats],
    )


def events_by_site(enriched: DataFrame) -> DataFrame:
    return enriched.groupBy("facility").agg(
        F.count(F.lit(1)).alias("event_count"), exact_avg("down_hours").alias("avg_downtime_hours")
    )


def distinct_weeks(df: DataFrame) -> DataFrame:
    return df.select("ww_year", "ww_number", "work_week").distinct()


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """Key values that occur more than once, with their multiplicity."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("dup_count")).filter(F.col("dup_count") > 1)


def drop_duplicate_keys(df: DataFrame, keys, order_col: str) -> DataFrame:
    """Keep the latest row per key (ties: the largest row), as an aggregate.

    ``max_by`` keeps one candidate row per key in each map task, so a key that
    holds a large share of the rows is reduced map-side instead of being sorted
    whole in one task (which a per-key window would do).
    """
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(c) for c in rest])
    order = F.struct(F.col(order_col), row)
    picked = df.groupBy(*keys).agg(F.max_by(row, order).alias("_row"))
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


# ---- top-k (each with a unique tie-break so the answer is deterministic)


def top_chronic(chronic: DataFrame, k: int = 10) -> DataFrame:
    return (
        chronic.filter(F.col("chronic_flag") == 1)
        .orderBy(F.col("chronic_score").desc_nulls_last(), "entity", "facility", "ceid", "process_class")
        .limit(k)
    )


def top_unscheduled_ceids(ceid_fact: DataFrame, k: int = 10, min_events: int = 10) -> DataFrame:
    return (
        ceid_fact.filter(F.col("total_pm_events") >= min_events)
        .orderBy(F.col("unscheduled_pm_rate").desc(), "ceid", "facility", "process_class", "ww_year", "ww_number")
        .limit(k)
        .select(
            "ceid", "facility", "process_class", "work_week", "total_pm_events",
            (F.col("unscheduled_pm_rate") * 100.0).alias("unscheduled_pct"),
            "chronic_chambers", "total_chambers",
        )
    )


def parts_needing_attention(part_fact: DataFrame, k: int = 20, min_replacements: int = 3) -> DataFrame:
    return (
        part_fact.filter(F.col("replacement_count") >= min_replacements)
        .orderBy(F.col("avg_life_at_replacement").asc_nulls_last(), "part_name", "entity", "facility", "ceid", "ww_year", "ww_number")
        .limit(k)
        .select(
            "part_name", "ceid", "entity", "work_week", "replacement_count",
            F.col("avg_life_at_replacement").cast("int").alias("avg_life"),
            "early_replacement_count", "late_replacement_count",
        )
    )


def latest_site_kpis(site: DataFrame, k: int = 10) -> DataFrame:
    """Most recent weeks first (the week stands in for the calculation time)."""
    return (
        site.orderBy(F.col("ww_year").desc(), F.col("ww_number").desc(), "facility")
        .limit(k)
        .select(
            "facility", "work_week", "total_pm_events",
            (F.col("unscheduled_pm_rate") * 100.0).alias("unscheduled_pct"),
            "chronic_tools_count",
            (F.col("chronic_tools_pct") * 100.0).alias("chronic_pct"),
        )
    )


def latest_summaries(summary: DataFrame, k: int = 10) -> DataFrame:
    """Downtime-summary rows of the most recent weeks."""
    return (
        summary.orderBy(F.col("ww_year").desc(), F.col("ww_number").desc(), "facility", "ceid", "process_class")
        .limit(k)
        .select("facility", "ceid", "process_class", "work_week", "total_pm_events", "total_downtime_hours")
    )


def latest_loads(load_log: DataFrame, k: int = 10) -> DataFrame:
    """The most recent rows of the load log."""
    return load_log.orderBy(F.col("load_ts").desc(), "layer", "source_file").limit(k)


def executive_view(site_rolled: DataFrame) -> DataFrame:
    """Projection of the site fact plus rolling measures and average life vs target in percent."""
    t = F.col("target_pm_life")
    return site_rolled.select(
        "facility", "work_week", "ww_year", "ww_number",
        "total_pm_events", "scheduled_pm_events", "unscheduled_pm_events",
        "unscheduled_pm_rate", "on_time_pm_rate", "chronic_tools_pct",
        "total_downtime_hours", "avg_downtime_per_pm",
        "avg_pm_life", "target_pm_life",
        F.when(t > 0, (F.col("avg_pm_life") - t) / t * 100.0).alias("life_vs_target_pct"),
        "rolling_4wk_avg_pm_life", "rolling_4wk_pm_count",
        "chronic_tools_count", "total_tools_count",
    )
