"""Registered queries: each is ``(spark, sf_dir) -> DataFrame`` over the whole tables.

The builders only assemble library operators; the oracle for each key lives in
``oracle_sql.py`` at the repository root.  Output doubles are quantised
to 6 places (see ``finish``) so the value hash does not depend on summation order.
"""

from __future__ import annotations

import dataclasses
import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from toolwatch import sinks
from toolwatch.functions import calendar as cal
from toolwatch.functions import coerce
from toolwatch.functions.literals import ts_lit
from toolwatch.operators import chronic as chr_
from toolwatch.operators import dims, kpis, reports, rolling
from toolwatch.operators.enrich import enrich, with_chronic_status, with_process_class
from toolwatch.operators.joins import scalar
from toolwatch.rules import DEFAULT_RULES
from toolwatch.sources import scans, testbed

OUTPUT_DIGITS = 6

# Parameters of the registered report queries.
HISTOGRAM_BIN_WIDTH = 50.0
RANGE_START, RANGE_END = _dt.datetime(1997, 1, 1), _dt.datetime(1998, 1, 1)
WEEK_RANGE = ("1997WW10", "1997WW30")
EVENTS_PROCESSED_BEFORE = _dt.datetime(2024, 1, 15)
LOW_BAR = dataclasses.replace(DEFAULT_RULES, min_pm_events=1)
SITE_FACT_BUILT_BEFORE = _dt.datetime(1999, 1, 1)


# Quantisation cut placed at 0.618.. of a step instead of 0.5: a value with at
# most 7 decimals (prices, hours, their exact sums and halves) can never sit on
# the cut, so last-bit differences between engines cannot flip the result.
QUANT_SHIFT = 0.5 - 0.6180339887498949


def finish(df: DataFrame) -> DataFrame:
    """Quantise every double column to 6 places for order-insensitive comparison."""
    f = float(10**OUTPUT_DIGITS)
    cols = {
        fld.name: F.rint(F.col(fld.name) * f + QUANT_SHIFT) / f
        for fld in df.schema.fields
        if isinstance(fld.dataType, DoubleType)
    }
    return df.withColumns(cols) if cols else df


def enriched_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich(testbed.pm_events(spark, sf_dir), DEFAULT_RULES, testbed.class_dimension(spark, sf_dir))


def _chronic(ev: DataFrame) -> DataFrame:
    return chr_.chronic_tools(ev, DEFAULT_RULES)


def _site(ev: DataFrame) -> DataFrame:
    return kpis.site_week_kpis(ev, chr_.chronic_entities(_chronic(ev)))


def _ceid(ev: DataFrame) -> DataFrame:
    return kpis.ceid_week_kpis(ev, chr_.chronic_entities(_chronic(ev)))


# ---- facts


def q_site_week_kpis(spark, d):
    return finish(_site(enriched_events(spark, d)))


def q_ceid_week_kpis(spark, d):
    return finish(_ceid(enriched_events(spark, d)))


def q_part_week_summary(spark, d):
    return finish(kpis.part_week_summary(enriched_events(spark, d)))


def q_downtime_summary(spark, d):
    ev = enriched_events(spark, d)
    return finish(kpis.downtime_summary(ev, _chronic(ev)))


def q_cost_summary(spark, d):
    return finish(kpis.cost_summary(enriched_events(spark, d), testbed.part_costs(spark, d)))


def q_site_week_extra_measures(spark, d):
    return finish(kpis.extra_measures(enriched_events(spark, d)))


def q_unified_roi(spark, d):
    ev = enriched_events(spark, d)
    return finish(
        kpis.unified_roi(kpis.part_week_summary(ev, life_saved=True), testbed.part_costs(spark, d), testbed.labour_costs(spark, d))
    )


# ---- chronic


def q_chronic_tools(spark, d):
    ev = enriched_events(spark, d)
    return finish(chr_.with_analysis_period(_chronic(ev), ev))


def q_chronic_current(spark, d):
    return finish(chr_.chronic_current(chr_.chronic_snapshots(enriched_events(spark, d))))


def q_chronic_weekly_change(spark, d):
    return finish(chr_.chronic_weekly(enriched_events(spark, d)))


def q_chronic_weekly_change_low_bar(spark, d):
    """One event a week suffices for a flag, so that weekly statuses change."""
    return finish(chr_.chronic_weekly(enriched_events(spark, d), LOW_BAR))


def q_severity_counts(spark, d):
    return finish(reports.severity_counts(_chronic(enriched_events(spark, d))))


def q_chronic_share(spark, d):
    return finish(reports.chronic_share(_chronic(enriched_events(spark, d))))


def q_top_chronic(spark, d):
    c = _chronic(enriched_events(spark, d))
    return finish(
        reports.top_chronic(c).select(
            "entity", "facility", "ceid", "process_class", "chronic_score", "chronic_severity",
            "unscheduled_pm_rate", "life_cv", "total_pm_events",
        )
    )


# ---- row-level enrichment and calendar


def q_enriched_events(spark, d):
    ev = enriched_events(spark, d)
    return finish(
        ev.select(
            "order_key", "line_number", "entity", "facility", "ceid", "part_name", "event_ts", "work_week",
            "process_class", "ww_year", "ww_number", "fiscal_quarter", "fiscal_month", "life_vs_target",
            "life_vs_target_pct", "timing_class", "scheduled_flag", "scheduled_category", "cycle_efficiency",
            "duration_outlier_flag", "reclean_flag", "sympathy_flag", "downtime_category", "primary_reason",
            "quality_score",
        )
    )


def q_enriched_with_chronic(spark, d):
    ev = enriched_events(spark, d)
    snap = _chronic(ev)
    out = with_chronic_status(ev, snap)
    return finish(out.select("order_key", "line_number", "entity", "facility", "ceid", "chronic_flag", "chronic_score"))


def q_class_left_join(spark, d):
    ev = with_process_class(testbed.pm_events(spark, d), testbed.class_dimension(spark, d))
    return ev.select("order_key", "line_number", "entity", "process_class")


def q_event_calendar(spark, d):
    dates = testbed.pm_events(spark, d).select(F.to_date("event_ts").alias("event_date")).distinct()
    return dates.select(
        "event_date",
        cal.fiscal_year("event_date").alias("fiscal_year"),
        cal.fiscal_day_of_year("event_date").alias("day_of_year"),
        cal.fiscal_week("event_date").alias("fiscal_week"),
        cal.work_week("event_date").alias("work_week"),
    )


def _fy_bounds(spark, d):
    """First and last fiscal year of the events, as one struct-valued scalar subquery."""
    ev = testbed.pm_events(spark, d)
    fy = cal.fiscal_year("event_ts")
    return scalar(ev, F.struct(F.min(fy).alias("lo"), F.max(fy).alias("hi")))


def q_date_dimension(spark, d):
    return dims.date_dimension(spark, _fy_bounds(spark, d))


def q_calendar_days(spark, d):
    return dims.calendar(spark, _fy_bounds(spark, d))


def q_week_dimension(spark, d):
    return dims.week_dimension(spark, _fy_bounds(spark, d))


def q_distinct_weeks(spark, d):
    return reports.distinct_weeks(enriched_events(spark, d))


def q_chronic_snapshots(spark, d):
    return finish(chr_.chronic_snapshots(enriched_events(spark, d)))


def q_week_date_range(spark, d):
    weeks = testbed.pm_events(spark, d).select("work_week").distinct()
    y, w = cal.parse_work_week("work_week")
    return weeks.select("work_week", cal.week_start(y, w).alias("week_start"), cal.week_end(y, w).alias("week_end"))


def q_parse_work_week(spark, d):
    labels = testbed.pm_events(spark, d).select("work_week").distinct()
    variants = labels.select(
        F.explode(
            F.array(F.col("work_week"), F.concat("work_week", F.lit("nn")), F.substring("work_week", 3, 6))
        ).alias("label")
    ).distinct()
    y, w = cal.parse_work_week("label")
    return variants.select(
        "label", y.alias("ww_year"), w.alias("ww_number"),
        cal.fiscal_quarter(w).alias("fiscal_quarter"), cal.fiscal_month(w).alias("fiscal_month"),
    )


def q_calendar_star_join(spark, d):
    ev = enriched_events(spark, d)
    site = _site(ev).select("facility", "work_week", "total_pm_events", "total_downtime_hours")
    return finish(dims.calendar_star_join(site, dims.week_dimension(spark, _fy_bounds(spark, d))))


def q_entity_dimension(spark, d):
    return dims.entity_dimension(enriched_events(spark, d))


# ---- rolling


def q_rolling_range(spark, d):
    s = rolling.rolling_range(_site(enriched_events(spark, d)))
    return finish(
        s.select("facility", "ww_year", "ww_number", "work_week", "rolling_4wk_avg_pm_life", "rolling_4wk_pm_count", "rolling_4wk_downtime_hours")
    )


def q_rolling_rows(spark, d):
    s = rolling.rolling_rows(_site(enriched_events(spark, d)))
    return finish(
        s.select("facility", "ww_year", "ww_number", "work_week", "rolling_4wk_avg_pm_life", "rolling_4wk_pm_count", "rolling_4wk_downtime_hours")
    )


def q_rowcount_tolerance(spark, d):
    ev = enriched_events(spark, d)
    return finish(rolling.rowcount_tolerance(rolling.weekly_counts(ev)))


def q_executive_view(spark, d):
    return finish(reports.executive_view(rolling.rolling_range(_site(enriched_events(spark, d)))))


# ---- distributions, profiles, measures


def q_timing_distribution(spark, d):
    return finish(reports.distribution(enriched_events(spark, d), "timing_class"))


def q_scheduled_distribution(spark, d):
    return finish(reports.distribution(enriched_events(spark, d), "scheduled_category"))


def q_class_distribution(spark, d):
    return finish(reports.distribution(enriched_events(spark, d), "process_class"))


NULL_PROFILE_COLUMNS = ("entity", "facility", "ceid", "work_week", "event_ts", "downtime_type", "actual_life", "target_life", "sympathy", "downtime_class", "reason_primary")


def q_null_profile(spark, d):
    return finish(reports.null_profile(testbed.pm_events(spark, d), NULL_PROFILE_COLUMNS))


def q_overall_null_pct(spark, d):
    return finish(reports.overall_null_pct(testbed.pm_events(spark, d), NULL_PROFILE_COLUMNS))


def q_loads_per_week(spark, d):
    ev = testbed.raw_events(spark, d).withColumn("source_week", cal.work_week("ts"))
    return reports.loads_per_week(ev, "source_week", "ts")


def q_dashboard_measures(spark, d):
    return finish(reports.dashboard_measures(enriched_events(spark, d)))


def q_life_histogram(spark, d):
    return finish(reports.life_histogram(enriched_events(spark, d), HISTOGRAM_BIN_WIDTH))


def q_downtime_trend_pivot(spark, d):
    return reports.downtime_trend_pivot(enriched_events(spark, d))


def q_events_by_site(spark, d):
    return finish(reports.events_by_site(enriched_events(spark, d)))


def q_duplicate_keys(spark, d):
    return reports.duplicate_keys(testbed.pm_events(spark, d), ["order_key", "line_number"])


def q_coerce_types(spark, d):
    """Events rendered as CSV-like strings (with NA tokens and junk) and coerced back."""
    ev = testbed.pm_events(spark, d)
    lnum = F.col("line_number")
    raw = ev.select(
        "order_key",
        "line_number",
        F.when(lnum == 7, F.lit("nan"))
        .when(lnum == 6, F.lit("None"))
        .when(lnum == 5, F.lit("N/A"))
        .when(lnum == 4, F.concat(F.lit("x"), F.col("actual_life").cast("string")))
        .otherwise(F.col("actual_life").cast("string"))
        .alias("actual_life_txt"),
        F.when(lnum == 3, F.lit("not a date"))
        .when(lnum == 2, F.lit(""))
        .otherwise(F.date_format("event_ts", "yyyy-MM-dd HH:mm:ss"))
        .alias("event_ts_txt"),
        F.when(lnum == 1, F.lit("NULL")).otherwise(F.col("downtime_type")).alias("downtime_type_txt"),
    )
    return finish(
        raw.select(
            "order_key",
            "line_number",
            coerce.to_double("actual_life_txt").alias("actual_life"),
            coerce.to_timestamp("event_ts_txt").cast("timestamp_ntz").alias("event_ts"),
            coerce.null_tokens("downtime_type_txt").alias("downtime_type"),
        )
    )


# ---- scans / increments / retention


def q_incremental_events(spark, d):
    raw = testbed.raw_events(spark, d)
    processed = raw.filter(F.col("ts") < ts_lit(EVENTS_PROCESSED_BEFORE))
    return finish(scans.new_by_id(raw, processed, "event_id", "event_id"))


def q_incremental_site_weeks(spark, d):
    ev = enriched_events(spark, d)
    built = _site(scans.date_range(ev, "event_ts", end=SITE_FACT_BUILT_BEFORE))
    new = scans.new_by_keys(ev, built, ["facility", "work_week"])
    return new.groupBy("facility", "work_week").agg(F.count(F.lit(1)).alias("new_events"))


def q_date_range_scan(spark, d):
    ev = scans.date_range(testbed.pm_events(spark, d), "event_ts", RANGE_START, RANGE_END)
    return finish(ev.select("order_key", "line_number", "entity", "event_ts", "down_hours"))


def q_week_range_scan(spark, d):
    ev = scans.week_range(testbed.pm_events(spark, d), *WEEK_RANGE)
    return ev.groupBy("work_week").agg(F.count(F.lit(1)).alias("row_count"))


def q_last_7_days(spark, d):
    ev = testbed.pm_events(spark, d)
    as_of = scalar(ev, F.max("event_ts"))
    return finish(scans.last_days(ev, "event_ts", as_of, 7).select("order_key", "line_number", "entity", "event_ts"))


def q_retention_filter(spark, d):
    ev = testbed.pm_events(spark, d)
    as_of = scalar(ev, F.max("event_ts"))
    kept = scans.retention(ev, "event_ts", as_of, DEFAULT_RULES.retention_weeks_raw)
    return kept.groupBy("work_week").agg(F.count(F.lit(1)).alias("row_count"))


# ---- top-k


def q_top_unscheduled_ceids(spark, d):
    return finish(reports.top_unscheduled_ceids(_ceid(enriched_events(spark, d))))


def q_top_unscheduled_ceids_low_bar(spark, d):
    return finish(reports.top_unscheduled_ceids(_ceid(enriched_events(spark, d)), min_events=2))


def q_parts_needing_attention_low_bar(spark, d):
    return finish(reports.parts_needing_attention(kpis.part_week_summary(enriched_events(spark, d)), min_replacements=1))


def q_parts_needing_attention(spark, d):
    return finish(reports.parts_needing_attention(kpis.part_week_summary(enriched_events(spark, d))))


def q_latest_summaries(spark, d):
    return finish(reports.latest_summaries(kpis.downtime_summary(enriched_events(spark, d))))


def q_latest_site_kpis(spark, d):
    return finish(reports.latest_site_kpis(_site(enriched_events(spark, d))))


# ---- end to end: files -> jobs / streams -> facts (each run in a fresh scratch folder)

PIPELINE_AS_OF = _dt.datetime(2024, 6, 1)
SITE_OUTPUT = (
    "facility", "ww_year", "ww_number", "work_week", "total_pm_events", "scheduled_pm_events",
    "unscheduled_pm_events", "early_pm_count", "on_time_pm_count", "late_pm_count", "overdue_pm_count",
    "total_downtime_hours", "avg_downtime_per_pm", "avg_pm_life", "median_pm_life", "target_pm_life",
    "avg_life_vs_target", "total_tools_count", "chronic_tools_count", "chronic_tools_pct", "unscheduled_pm_rate",
    "early_pm_rate", "on_time_pm_rate", "overdue_pm_rate", "scheduled_downtime_hours", "unscheduled_downtime_hours",
)


def _scratch(spark: SparkSession, tag: str) -> str:
    import uuid

    from toolwatch.session import checkpoint_dir

    return f"{checkpoint_dir(spark).rstrip('/')}/toolwatch-{tag}-{uuid.uuid4().hex}"


def q_pipeline_site_week(spark, d):
    """Whole tables rendered as weekly files, then bronze -> silver -> gold; the stored site fact."""
    from toolwatch.plans import jobs
    from toolwatch.sources import files

    run = _scratch(spark, "pipeline")
    testbed.render_weekly_files(testbed.pm_events(spark, d), f"{run}/source")
    layout = jobs.Layout(f"{run}/warehouse")
    paths = [r.path for r in files.list_week_files(spark, f"{run}/source").select("path").collect()]
    jobs.ingest_files(spark, paths, layout, class_dim=testbed.class_dimension(spark, d), as_of=PIPELINE_AS_OF)
    sinks.drop_table(spark, f"{run}/source")  # loaded: no later step reads the files
    jobs.silver(spark, layout, as_of=PIPELINE_AS_OF)
    jobs.gold(spark, layout, as_of=PIPELINE_AS_OF)
    return finish(spark.read.parquet(layout.site).select(*SITE_OUTPUT))


def _ingested(spark, d, tag, parts=1):
    """Files of the whole table in a fresh warehouse, loaded in ``parts`` loads dealt by a hash of the tool."""
    from toolwatch.plans import jobs
    from toolwatch.sources import files

    run = _scratch(spark, tag)
    layout = jobs.Layout(f"{run}/warehouse")
    dim = testbed.class_dimension(spark, d)

    def load(k):
        ev = testbed.pm_events(spark, d)
        if parts > 1:
            ev = ev.filter(F.pmod(F.xxhash64("entity", "facility", "work_week"), F.lit(parts)) == k)
        testbed.render_weekly_files(ev, f"{run}/source{k}")
        paths = [r.path for r in files.list_week_files(spark, f"{run}/source{k}").select("path").collect()]
        jobs.ingest_files(spark, paths, layout, class_dim=dim, as_of=PIPELINE_AS_OF)
        sinks.drop_table(spark, f"{run}/source{k}")  # loaded: no later step reads the files

    return jobs, layout, load


def q_pipeline_recovery(spark, d):
    """A gold run that dies after its first fact, then a rerun without new data: the pending weeks are built."""
    jobs, layout, load = _ingested(spark, d, "recovery")
    load(0)
    jobs.silver(spark, layout, as_of=PIPELINE_AS_OF)
    jobs.gold(spark, layout, as_of=PIPELINE_AS_OF, facts=("part",), weeks=jobs.silver(spark, layout, as_of=PIPELINE_AS_OF)["weeks"][:5])
    again = jobs.silver(spark, layout, as_of=PIPELINE_AS_OF)
    jobs.gold(spark, layout, as_of=PIPELINE_AS_OF, weeks=again["weeks"])
    return finish(spark.read.parquet(layout.site).select(*SITE_OUTPUT))


#: The site fact without what depends on the chronic tools of the run that built a week.
LASTING_SITE_OUTPUT = tuple(c for c in SITE_OUTPUT if c not in ("chronic_tools_count", "chronic_tools_pct"))


def q_pipeline_partial_week(spark, d):
    """Half of each week's tools arrive after gold has built the weeks; the site fact as the incremental runs leave it."""
    jobs, layout, load = _ingested(spark, d, "partial", parts=2)
    for k in (0, 1):
        load(k)
        s = jobs.silver(spark, layout, as_of=PIPELINE_AS_OF + _dt.timedelta(days=k))
        jobs.gold(spark, layout, as_of=PIPELINE_AS_OF + _dt.timedelta(days=k), weeks=s["weeks"])
    return finish(spark.read.parquet(layout.site).select(*LASTING_SITE_OUTPUT))


def q_pipeline_chronic(spark, d):
    """The chronic snapshot after two loads, the second scored from the stored partials of tools and weeks."""
    jobs, layout, load = _ingested(spark, d, "chronic", parts=2)
    for k in (0, 1):
        load(k)
        jobs.silver(spark, layout, as_of=PIPELINE_AS_OF + _dt.timedelta(days=k), build_summary=False)
    snapshots = spark.read.parquet(layout.chronic)
    latest = snapshots.filter(F.col("snapshot") == f"s{PIPELINE_AS_OF + _dt.timedelta(days=1):%Y%m%dT%H%M%S}")
    return finish(latest.drop("snapshot", "calculation_ts"))


ROLLED_OUTPUT = ("facility", "ww_year", "ww_number", "work_week", "rolling_4wk_avg_pm_life", "rolling_4wk_pm_count", "rolling_4wk_downtime_hours")


def q_pipeline_rolled(spark, d):
    """The rolled site fact after a second load of a fifth of the weeks, of which only their windows are rolled anew."""
    from toolwatch.plans import jobs
    from toolwatch.sources import files

    run = _scratch(spark, "rolled")
    layout, dim = jobs.Layout(f"{run}/warehouse"), testbed.class_dimension(spark, d)
    late = F.pmod(F.xxhash64("work_week"), F.lit(5)) == 0
    for k, own in enumerate((~late, late)):
        testbed.render_weekly_files(testbed.pm_events(spark, d).filter(own), f"{run}/source{k}")
        paths = [r.path for r in files.list_week_files(spark, f"{run}/source{k}").select("path").collect()]
        at = PIPELINE_AS_OF + _dt.timedelta(days=k)
        jobs.ingest_files(spark, paths, layout, class_dim=dim, as_of=at)
        sinks.drop_table(spark, f"{run}/source{k}")  # loaded: no later step reads the files
        s = jobs.silver(spark, layout, as_of=at, build_summary=False)
        jobs.gold(spark, layout, as_of=at, weeks=s["weeks"], facts=("site",))
    return finish(spark.read.parquet(layout.site_rolled).select(*ROLLED_OUTPUT))


def _deliver_anew(spark, old_root, new_root):
    """Replace each week's files under ``old_root`` by those under ``new_root``, under the old names."""
    from toolwatch.sources import files

    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    by_week: dict[str, tuple[list, list]] = {}
    for k, root in enumerate((old_root, new_root)):
        for r in files.list_week_files(spark, root).select("work_week", "path").collect():  # a row per file
            by_week.setdefault(r.work_week, ([], []))[k].append(r.path)
    for old, new in by_week.values():
        old, new = sorted(old), sorted(new)
        if len(old) > len(new) > 0:
            raise ValueError(f"{len(new)} files cannot take the place of {len(old)}")
        for i, source in enumerate(map(path, new)):
            target = path(old[i]) if i < len(old) else path(path(old[0]).getParent(), source.getName())
            fs = source.getFileSystem(conf)
            jvm.org.apache.hadoop.fs.FileUtil.copy(fs, source, fs, target, False, True, conf)


def q_pipeline_corrected_file(spark, d):
    """A third of the weeks is first delivered wrong (rows missing, hours and sites altered), then again under the same names."""
    from toolwatch.plans import jobs
    from toolwatch.sources import files

    run = _scratch(spark, "corrected")
    layout, dim = jobs.Layout(f"{run}/warehouse"), testbed.class_dimension(spark, d)
    right = testbed.pm_events(spark, d)
    affected = F.pmod(F.xxhash64("work_week"), F.lit(3)) == 0
    kind = F.pmod(F.xxhash64("entity"), F.lit(4))
    wrong = right.filter(~(affected & (kind == 0))).withColumns(
        {"down_hours": F.when(affected, F.col("down_hours") * 10).otherwise(F.col("down_hours")),
         "facility": F.when(affected & (kind == 1), F.concat(F.lit("X"), "facility")).otherwise(F.col("facility"))}
    )
    testbed.render_weekly_files(wrong, f"{run}/source")
    testbed.render_weekly_files(right.filter(affected), f"{run}/corrected")
    for k in (0, 1):
        if k:
            _deliver_anew(spark, f"{run}/source", f"{run}/corrected")
            sinks.drop_table(spark, f"{run}/corrected")
        at = PIPELINE_AS_OF + _dt.timedelta(days=k)
        paths = [r.path for r in files.list_week_files(spark, f"{run}/source").select("path").collect()]
        found = jobs.changed_files(spark, paths, layout)
        jobs.ingest_files(spark, [p for p, _, _ in found], layout, class_dim=dim, as_of=at, identities=found)
        if k:
            sinks.drop_table(spark, f"{run}/source")  # the last load: no later step reads the files
        jobs.gold(spark, layout, as_of=at, weeks=jobs.silver(spark, layout, as_of=at)["weeks"])
    return finish(spark.read.parquet(layout.site).select(*LASTING_SITE_OUTPUT))


def q_pipeline_history(spark, d):
    """The chronic history, built from two loads of which the second holds late events of every week."""
    jobs, layout, load = _ingested(spark, d, "history", parts=2)
    for k in (0, 1):
        load(k)
        s = jobs.silver(spark, layout, as_of=PIPELINE_AS_OF + _dt.timedelta(days=k), build_summary=False, rules=LOW_BAR)
        jobs.gold(spark, layout, as_of=PIPELINE_AS_OF + _dt.timedelta(days=k), weeks=s["weeks"], facts=("history",), rules=LOW_BAR)
    return finish(spark.read.parquet(layout.history).drop("calculated_at"))


def q_stream_site_week(spark, d):
    """Whole tables rendered as weekly files, then ingest / enrich / gold streams; the site fact."""
    from toolwatch.streaming import incremental

    run = _scratch(spark, "stream")
    testbed.render_weekly_files(testbed.pm_events(spark, d), f"{run}/source")
    incremental.ingest_stream(spark, f"{run}/source", f"{run}/raw", f"{run}/_ckpt/ingest", PIPELINE_AS_OF).awaitTermination()
    sinks.drop_table(spark, f"{run}/source")  # loaded: no later step reads the files
    incremental.enrich_stream(
        spark, f"{run}/raw", f"{run}/enriched", f"{run}/_ckpt/enrich",
        class_dim=testbed.class_dimension(spark, d), as_of=PIPELINE_AS_OF,
    ).awaitTermination()
    snapshot = _chronic(spark.read.parquet(f"{run}/enriched")).withColumn("calculation_ts", ts_lit(PIPELINE_AS_OF))
    snapshot.write.parquet(f"{run}/chronic")
    incremental.gold_stream(spark, f"{run}/enriched", f"{run}/site", f"{run}/_ckpt/gold", chronic_path=f"{run}/chronic").awaitTermination()
    return finish(spark.read.parquet(f"{run}/site").select(*SITE_OUTPUT))


def q_stream_recovery(spark, d):
    """A stream of files that is lost after the rows of its second epoch are written, and is started again; the site fact."""
    from pyspark.errors import StreamingQueryException

    from toolwatch.plans import jobs
    from toolwatch.streaming import incremental

    run = _scratch(spark, "recovery")
    layout = jobs.Layout(f"{run}/warehouse")
    events = testbed.pm_events(spark, d)
    testbed.render_weekly_files(events, f"{run}/source")
    weeks = events.select("work_week").distinct().count()
    epochs: list[int] = []

    def lost() -> None:
        epochs.append(1)
        if len(epochs) == 2:
            raise RuntimeError("lost between write and commit")

    def start() -> None:
        incremental.ingest_files_stream(
            spark, f"{run}/source", layout, f"{run}/_ckpt/files", PIPELINE_AS_OF, class_dim=testbed.class_dimension(spark, d),
            max_files_per_trigger=max(1, -(-weeks // 3)), before_commit=lost,
        ).awaitTermination()

    try:
        start()
    except StreamingQueryException:
        start()
    sinks.drop_table(spark, f"{run}/source")  # loaded: no later step reads the files
    s = jobs.silver(spark, layout, as_of=PIPELINE_AS_OF)
    jobs.gold(spark, layout, as_of=PIPELINE_AS_OF, weeks=s["weeks"])
    return finish(spark.read.parquet(layout.site).select(*SITE_OUTPUT))


def q_csv_roundtrip(spark, d):
    """The events rendered as weekly files and read back through the file contract."""
    from toolwatch.sources import files

    run = _scratch(spark, "roundtrip")
    testbed.render_weekly_files(testbed.pm_events(spark, d), f"{run}/source")
    paths = [r.path for r in files.list_week_files(spark, f"{run}/source").select("path").collect()]
    raw = files.add_load_metadata(files.rename_special(files.read_event_csv(spark, paths)), PIPELINE_AS_OF)
    back = files.to_events(files.coerce_raw(raw))
    return finish(back.select(*ROUNDTRIP_OUTPUT))


ROUNDTRIP_OUTPUT = ("entity", "facility", "ceid", "part_name", "work_week", "downtime_type", "down_hours", "actual_life", "target_life")


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "site_week_kpis": q_site_week_kpis,
    "ceid_week_kpis": q_ceid_week_kpis,
    "part_week_summary": q_part_week_summary,
    "downtime_summary": q_downtime_summary,
    "cost_summary": q_cost_summary,
    "unified_roi": q_unified_roi,
    "site_week_extra_measures": q_site_week_extra_measures,
    "chronic_tools": q_chronic_tools,
    "chronic_current": q_chronic_current,
    "chronic_weekly_change": q_chronic_weekly_change,
    "chronic_weekly_change_low_bar": q_chronic_weekly_change_low_bar,
    "severity_counts": q_severity_counts,
    "chronic_share": q_chronic_share,
    "top_chronic": q_top_chronic,
    "enriched_events": q_enriched_events,
    "class_left_join": q_class_left_join,
    "enriched_with_chronic": q_enriched_with_chronic,
    "event_calendar": q_event_calendar,
    "date_dimension": q_date_dimension,
    "calendar_days": q_calendar_days,
    "week_dimension": q_week_dimension,
    "distinct_weeks": q_distinct_weeks,
    "chronic_snapshots": q_chronic_snapshots,
    "week_date_range": q_week_date_range,
    "parse_work_week": q_parse_work_week,
    "calendar_star_join": q_calendar_star_join,
    "entity_dimension": q_entity_dimension,
    "rolling_range": q_rolling_range,
    "rolling_rows": q_rolling_rows,
    "rowcount_tolerance": q_rowcount_tolerance,
    "executive_view": q_executive_view,
    "timing_distribution": q_timing_distribution,
    "scheduled_distribution": q_scheduled_distribution,
    "class_distribution": q_class_distribution,
    "null_profile": q_null_profile,
    "overall_null_pct": q_overall_null_pct,
    "loads_per_week": q_loads_per_week,
    "dashboard_measures": q_dashboard_measures,
    "life_histogram": q_life_histogram,
    "downtime_trend_pivot": q_downtime_trend_pivot,
    "events_by_site": q_events_by_site,
    "duplicate_keys": q_duplicate_keys,
    "coerce_types": q_coerce_types,
    "incremental_events": q_incremental_events,
    "incremental_site_weeks": q_incremental_site_weeks,
    "date_range_scan": q_date_range_scan,
    "week_range_scan": q_week_range_scan,
    "last_7_days": q_last_7_days,
    "retention_filter": q_retention_filter,
    "top_unscheduled_ceids": q_top_unscheduled_ceids,
    "parts_needing_attention": q_parts_needing_attention,
    "top_unscheduled_ceids_low_bar": q_top_unscheduled_ceids_low_bar,
    "parts_needing_attention_low_bar": q_parts_needing_attention_low_bar,
    "latest_site_kpis": q_latest_site_kpis,
    "latest_summaries": q_latest_summaries,
    "pipeline_recovery": q_pipeline_recovery,
    "pipeline_partial_week": q_pipeline_partial_week,
    "pipeline_history": q_pipeline_history,
    "pipeline_chronic": q_pipeline_chronic,
    "pipeline_rolled": q_pipeline_rolled,
    "pipeline_corrected_file": q_pipeline_corrected_file,
    "stream_recovery": q_stream_recovery,
    "csv_roundtrip": q_csv_roundtrip,
    "pipeline_site_week": q_pipeline_site_week,
    "stream_site_week": q_stream_site_week,
}

# Backwards-compatible name used by the entry point.
site_week_kpis = q_site_week_kpis
