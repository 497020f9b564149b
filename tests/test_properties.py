"""Invariants over whole fact tables built from the driver tables."""

from pyspark.sql import functions as F

from toolwatch.operators import rolling
from toolwatch.plans import catalog
from toolwatch.rules import Rules

from conftest import SF_SMALL


def test_site_fact_invariants(spark):
    site = catalog.q_site_week_kpis(spark, SF_SMALL)
    bad = site.filter(
        (F.col("scheduled_pm_events") + F.col("unscheduled_pm_events") != F.col("total_pm_events"))
        | (F.col("early_pm_count") + F.col("on_time_pm_count") + F.col("late_pm_count") + F.col("overdue_pm_count") > F.col("total_pm_events"))
        | (F.col("unscheduled_pm_rate") < 0) | (F.col("unscheduled_pm_rate") > 1)
        | (F.col("chronic_tools_count") > F.col("total_tools_count"))
    )
    assert bad.count() == 0
    ev = catalog.enriched_events(spark, SF_SMALL)
    assert site.agg(F.sum("total_pm_events")).first()[0] == ev.count()


def test_timing_buckets_plus_unknown_is_total(spark):
    ev = catalog.enriched_events(spark, SF_SMALL)
    counts = {r.timing_class: r["count"] for r in ev.groupBy("timing_class").count().collect()}
    assert sum(counts.values()) == ev.count() and set(counts) <= {"Early", "On-Time", "Late", "Overdue", "Unknown"}


def test_one_week_window_equals_base(spark):
    ev = catalog.enriched_events(spark, SF_SMALL)
    site = catalog._site(ev)
    r = rolling.rolling_range(site, Rules(rolling_window_weeks=1))
    assert r.filter(F.col("rolling_4wk_pm_count") != F.col("total_pm_events")).count() == 0
