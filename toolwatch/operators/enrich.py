"""Silver layer: derive the classification columns on each event.

One projection over the raw events (plus one left join to the per-tool class
dimension).  All derived columns are native expressions, so the whole layer is
a single whole-stage-codegen span after the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from toolwatch.functions import calendar as cal
from toolwatch.functions import classify as cls
from toolwatch.functions.literals import ts_lit
from toolwatch.rules import DEFAULT_RULES, Rules

# Fill for tools absent from the class dimension.
UNKNOWN_CLASS = "UNKNOWN"

# Optional raw columns: absent ones are added as typed nulls so downstream
# expressions always resolve.
OPTIONAL_COLUMNS = {
    "downtime_class": "string",
    "reason_primary": "string",
    "reason_detail": "string",
    "outlier_label": "double",
    "cycle_utilization": "double",
    "reclean": "double",
    "sympathy": "double",
    "part_name": "string",
    "lower_limit": "double",
    "upper_limit": "double",
}

def with_optional_columns(df: DataFrame) -> DataFrame:
    missing = {c: F.lit(None).cast(t) for c, t in OPTIONAL_COLUMNS.items() if c not in df.columns}
    return df.withColumns(missing) if missing else df


def dedupe_class_dimension(dim: DataFrame) -> DataFrame:
    """One row per entity: a duplicated key would fan events out in the join."""
    return (
        dim.filter(F.col("entity").isNotNull())
        .groupBy("entity")
        .agg(F.min("process_class").alias("process_class"))
    )


def with_process_class(events: DataFrame, class_dim: DataFrame | None) -> DataFrame:
    """Left join events to the per-tool class; tools without a class get UNKNOWN."""
    if class_dim is None:
        return events.withColumn("process_class", F.lit(UNKNOWN_CLASS))
    return events.join(dedupe_class_dimension(class_dim), "entity", "left").withColumn(
        "process_class", F.coalesce(F.col("process_class"), F.lit(UNKNOWN_CLASS))
    )


def enrich(events: DataFrame, rules: Rules = DEFAULT_RULES, class_dim: DataFrame | None = None, as_of=None) -> DataFrame:
    """Raw events -> enriched events.

    ``as_of`` stamps ``enriched_at`` (a literal, so reruns are repeatable);
    when omitted the column is null.
    """
    ev = with_optional_columns(events)
    if "process_class" not in ev.columns:
        ev = with_process_class(ev, class_dim)
    year, week = cal.parse_work_week(F.col("work_week"))
    pct = cls.life_vs_target_pct("actual_life", "target_life")
    quality_hits = sum(F.col(c).isNotNull().cast("int") for c in rules.quality_columns)
    derived = {
        "ww_year": year,
        "ww_number": week,
        "life_vs_target": cls.life_vs_target("actual_life", "target_life"),
        "life_vs_target_pct": pct,
    }
    ev = ev.withColumns(derived)
    return ev.withColumns(
        {
            "fiscal_quarter": cal.fiscal_quarter("ww_number"),
            "fiscal_month": cal.fiscal_month("ww_number"),
            "timing_class": cls.timing_class("life_vs_target_pct", rules),
            "scheduled_flag": cls.scheduled_flag("downtime_type"),
            "scheduled_category": cls.scheduled_category("downtime_type"),
            "cycle_efficiency": F.col("cycle_utilization"),
            "duration_outlier_flag": cls.flag_is_one("outlier_label"),
            "reclean_flag": cls.flag_is_one("reclean"),
            "sympathy_flag": cls.flag_is_one("sympathy"),
            "downtime_category": cls.downtime_category("downtime_type", "downtime_class"),
            "primary_reason": F.coalesce(F.col("reason_primary"), F.col("reason_detail")),
            "quality_score": quality_hits / F.lit(float(len(rules.quality_columns))) * 100.0,
            "enriched_at": ts_lit(as_of) if as_of is not None else F.lit(None).cast("timestamp_ntz"),
        }
    )


# Column set written to the enriched table (source columns + derived columns).
ENRICHED_COLUMNS = (
    "entity", "facility", "ceid", "part_name", "event_ts", "work_week", "process_class",
    "actual_life", "target_life", "downtime_type", "downtime_class", "down_hours", "reclean", "sympathy",
    "lower_limit", "upper_limit", "unique_entity_id", "toolset", "pm_name", "downtime_subclass", "pm_frequency",
    "part_cost", "part_cost_saving", "labour_hours",
    "ww_year", "ww_number", "fiscal_quarter", "fiscal_month", "timing_class", "life_vs_target",
    "life_vs_target_pct", "scheduled_flag", "scheduled_category", "cycle_efficiency",
    "duration_outlier_flag", "reclean_flag", "sympathy_flag", "downtime_category", "primary_reason",
    "quality_score", "enriched_at",
)


def project_enriched(df: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Keep only the enriched-table columns that exist (plus ``extra``)."""
    want = [c for c in (*extra, *ENRICHED_COLUMNS) if c in df.columns]
    return df.select(*want)


def with_chronic_status(enriched: DataFrame, chronic_snapshot: DataFrame) -> DataFrame:
    """Left-join each event to its tool's chronic flag and score from one chronic snapshot.

    The snapshot has one row per (entity, facility, ceid); its size follows the
    fleet, so Spark chooses the join by its measured bytes.
    """
    keys = ["entity", "facility", "ceid"]
    snap = chronic_snapshot.select(*keys, "chronic_flag", "chronic_score")
    out = enriched.join(snap, keys, "left")
    return out.withColumn("chronic_flag", F.coalesce(F.col("chronic_flag"), F.lit(0)))
