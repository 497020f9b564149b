"""Driver contract: entry runs, every registered query has an oracle, queries resolve their schema."""

import __spark_entry__ as E
from toolwatch.plans import catalog

from conftest import SF_SMALL


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "total_pm_events" in df.columns


def test_every_query_of_the_catalog_has_oracle():
    assert set(catalog.REGISTRY) <= set(E.queries())
    assert set(catalog.REGISTRY) <= set(E.oracle_sql()) <= set(E.queries())


#: Queries that run whole jobs while they are built; test_pipeline.py and test_recovery.py run such jobs.
JOBS = ("pipeline_", "stream_", "csv_roundtrip")


def test_queries_resolve(spark):
    for name, fn in catalog.REGISTRY.items():
        if name.startswith(JOBS):
            continue
        df = fn(spark, SF_SMALL)
        assert df.columns, name


def test_results_do_not_depend_on_session_time_zone(spark):
    """Cut-offs are wall-clock literals: the same rows under any session zone."""
    q = E.queries()["incremental_events"]
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    utc = sorted(r.event_id for r in q(spark, SF_SMALL).select("event_id").collect())
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        la = sorted(r.event_id for r in q(spark, SF_SMALL).select("event_id").collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert utc == la and utc
