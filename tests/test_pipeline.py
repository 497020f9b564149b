"""Bronze -> silver -> gold jobs and their streaming twins on files rendered from the driver tables."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from toolwatch.operators import chronic as chr_
from toolwatch.operators import kpis, reports
from toolwatch.operators.enrich import enrich
from toolwatch.rules import Rules
from toolwatch.plans import jobs
from toolwatch.sources import testbed
from toolwatch.streaming import incremental

from conftest import SF_SMALL

WEEKS = ["1996WW10", "1996WW11", "1996WW12"]
AS_OF = dt.datetime(2024, 6, 1, 12, 0, 0)
KEYS = ["facility", "ww_year", "ww_number", "work_week"]
COMPARE = ["total_pm_events", "scheduled_pm_events", "early_pm_count", "overdue_pm_count", "total_downtime_hours",
           "avg_pm_life", "median_pm_life", "target_pm_life", "total_tools_count", "chronic_tools_count"]


@pytest.fixture(scope="module")
def rendered(spark):
    import tempfile

    root = tempfile.mkdtemp(prefix="toolwatch-src-")
    ev = testbed.pm_events(spark, SF_SMALL).filter(F.col("work_week").isin(WEEKS))
    testbed.render_weekly_files(ev, root)
    return root, ev


def _direct_site(spark, ev):
    en = enrich(ev, class_dim=testbed.class_dimension(spark, SF_SMALL))
    return kpis.site_week_kpis(en, chr_.chronic_entities(chr_.chronic_tools(en)))


def _rows(df):
    return sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.select(*KEYS, *COMPARE).collect())


def test_batch_pipeline_matches_direct(spark, rendered, tmpdir_path):
    root, ev = rendered
    layout = jobs.Layout(tmpdir_path)
    dim = testbed.class_dimension(spark, SF_SMALL)
    loaded = 0
    for ww in WEEKS:
        st = jobs.bronze(spark, root, layout, work_week=ww, class_dim=dim, as_of=AS_OF)
        assert st["status"] == "SUCCESS"
        loaded += st["rows_loaded"]
    assert loaded == ev.count()
    again = jobs.bronze(spark, root, layout, work_week=WEEKS[0], class_dim=dim, as_of=AS_OF)
    assert again["status"] == "SKIPPED"
    assert spark.read.parquet(layout.raw).count() == loaded

    s = jobs.silver(spark, layout, as_of=AS_OF)
    assert s["status"] == "SUCCESS" and s["rows_enriched"] == loaded
    assert jobs.silver(spark, layout, as_of=AS_OF + dt.timedelta(hours=1))["status"] == "NO_DATA"

    g = jobs.gold(spark, layout, as_of=AS_OF)
    assert g["status"] == "SUCCESS"
    got = spark.read.parquet(layout.site)
    assert _rows(got) == _rows(_direct_site(spark, ev))
    rolled = spark.read.parquet(layout.site_rolled)
    assert rolled.count() == got.count()
    log = spark.read.parquet(layout.load_log)
    assert sorted(r.load_status for r in log.collect()) == ["SKIPPED", "SUCCESS", "SUCCESS", "SUCCESS"]


def test_stream_matches_batch_and_folds_late_events(spark, rendered, tmpdir_path):
    _, ev = rendered
    # Own copy of the source: this test adds a late file, which must not leak into other tests.
    root = os.path.join(tmpdir_path, "source")
    testbed.render_weekly_files(ev, root)
    raw, enr, site = (os.path.join(tmpdir_path, n) for n in ("raw", "enriched", "site"))
    ck = os.path.join(tmpdir_path, "_ckpt")
    dim = testbed.class_dimension(spark, SF_SMALL)
    q = incremental.ingest_stream(spark, root, raw, f"{ck}/ingest", AS_OF)
    q.awaitTermination()
    assert spark.read.parquet(raw).count() == ev.count()
    incremental.enrich_stream(spark, raw, enr, f"{ck}/enrich", class_dim=dim, as_of=AS_OF).awaitTermination()
    incremental.gold_stream(spark, enr, site, f"{ck}/gold").awaitTermination()
    direct = kpis.site_week_kpis(enrich(ev, class_dim=dim), None)
    assert _rows(spark.read.parquet(site)) == _rows(direct)

    # A late event for an already processed week arrives in a new file.
    late = ev.filter(F.col("work_week") == WEEKS[0]).limit(1)
    late_root = os.path.join(root, f"work_week={WEEKS[0]}", "late")
    testbed.render_weekly_files(late, late_root)
    before = {(r.facility, r.work_week): r.total_pm_events for r in spark.read.parquet(site).collect()}
    q = incremental.ingest_stream(spark, root, raw, f"{ck}/ingest", AS_OF)
    q.awaitTermination()
    incremental.enrich_stream(spark, raw, enr, f"{ck}/enrich", class_dim=dim, as_of=AS_OF).awaitTermination()
    more = {f"{n}_path": os.path.join(tmpdir_path, n) for n in ("ceid", "part", "history")}
    incremental.gold_stream(spark, enr, site, f"{ck}/gold").awaitTermination()
    incremental.gold_stream(spark, enr, os.path.join(tmpdir_path, "site2"), f"{ck}/gold2", **more).awaitTermination()
    whole = spark.read.parquet(enr)
    for path, fact in ((more["ceid_path"], kpis.ceid_week_kpis(whole, None)), (more["part_path"], kpis.part_week_summary(whole)), (more["history_path"], chr_.chronic_weekly(whole))):
        assert spark.read.parquet(path).count() == fact.count() > 0
    after = {(r.facility, r.work_week): r.total_pm_events for r in spark.read.parquet(site).collect()}
    fac = late.first().facility
    assert after[(fac, WEEKS[0])] == before[(fac, WEEKS[0])] + 1
    assert sum(after.values()) == sum(before.values()) + 1


def test_full_pipeline_and_incremental_gold_modes(spark, rendered, tmpdir_path):
    root, ev = rendered
    layout = jobs.Layout(tmpdir_path)
    dim = testbed.class_dimension(spark, SF_SMALL)
    # Nothing loaded yet: gold is the last layer, so its failure surfaces.
    with pytest.raises(Exception):
        jobs.full_pipeline(spark, root, layout, work_week="1990WW01", class_dim=dim, as_of=AS_OF)
    res = jobs.full_pipeline(spark, root, layout, work_week=WEEKS[0], class_dim=dim, as_of=AS_OF)
    assert res["bronze"]["status"] == "SUCCESS" and res["silver"]["status"] == "SUCCESS" and res["gold"]["status"] == "SUCCESS"
    first = {r.work_week for r in spark.read.parquet(layout.site).select("work_week").distinct().collect()}
    assert first == {WEEKS[0]}
    # A bronze failure (no file for this week) is tolerated because later layers still run.
    res = jobs.full_pipeline(spark, root, layout, work_week="1990WW01", class_dim=dim, as_of=AS_OF + dt.timedelta(days=1))
    assert res["bronze"]["status"] == "FAILED" and res["silver"]["status"] == "NO_DATA" and res["gold"]["status"] == "SUCCESS"
    layers = [(r.layer, r.source_file, r.load_status) for r in spark.read.parquet(layout.load_log).collect()]
    assert ("SILVER", "ENRICHMENT", "FAILED") in layers and ("GOLD", "KPI_FACTS", "FAILED") in layers
    assert ("GOLD", "ROLLING_AVERAGES", "SUCCESS") in layers and ("SILVER", "ENRICHMENT", "NO_DATA") in layers

    # Second week arrives; a late event for the first week is appended to the enriched table too.
    later = AS_OF + dt.timedelta(days=7)
    jobs.bronze(spark, root, layout, work_week=WEEKS[1], class_dim=dim, as_of=later)
    jobs.silver(spark, layout, as_of=later)
    late = spark.read.parquet(layout.enriched).filter(F.col("work_week") == WEEKS[0]).limit(1) \
        .withColumn("pm_raw_id", F.lit("late-1")).withColumn("enriched_at", F.lit(later + dt.timedelta(hours=1)))
    late.write.mode("append").partitionBy("ww_year", "ww_number").parquet(layout.enriched)
    n0 = {r.work_week: r.n for r in spark.read.parquet(layout.site).groupBy("work_week").agg(F.sum("total_pm_events").alias("n")).collect()}

    # skip_done: weeks already in the site fact are left alone (the late event is ignored) ...
    jobs.gold(spark, layout, skip_done=True, as_of=later)
    n1 = {r.work_week: r.n for r in spark.read.parquet(layout.site).groupBy("work_week").agg(F.sum("total_pm_events").alias("n")).collect()}
    assert n1[WEEKS[0]] == n0[WEEKS[0]] and WEEKS[1] in n1
    # ... while since= recomputes every week that received rows, folding the late event in.
    jobs.gold(spark, layout, since=later, as_of=later)
    n2 = {r.work_week: r.n for r in spark.read.parquet(layout.site).groupBy("work_week").agg(F.sum("total_pm_events").alias("n")).collect()}
    assert n2[WEEKS[0]] == n0[WEEKS[0]] + 1 and n2[WEEKS[1]] == n1[WEEKS[1]]


def test_file_stream_uses_batch_ingest_and_skips_replayed_files(spark, tmpdir_path):
    """Latin-1 and UTF-8 files through the stream; a rerun with a fresh checkpoint loads nothing twice."""
    cols = ",".join(f'"{c}"' if "," in c else c for c in __import__("toolwatch.sources.schemas", fromlist=["x"]).EXPECTED_COLUMNS)
    n = cols.count(",") + 1
    row = ["" for _ in range(n)]
    row[0], row[1], row[6], row[12] = "T1", "Fab Ü", "C1", "2024WW01"
    src = os.path.join(tmpdir_path, "src")
    for ww, enc in (("2024WW01", "latin-1"), ("2024WW02", "utf-8")):
        os.makedirs(os.path.join(src, ww))
        r = list(row)
        r[12] = ww
        with open(os.path.join(src, ww, "e.csv"), "wb") as f:
            f.write((cols + "\n" + ",".join(r) + "\n").encode(enc))
    layout = jobs.Layout(os.path.join(tmpdir_path, "wh"))
    incremental.ingest_files_stream(spark, src, layout, os.path.join(tmpdir_path, "ck1"), AS_OF).awaitTermination()
    got = spark.read.parquet(layout.raw).select("FACILITY", "source_week").collect()
    assert sorted((r.FACILITY, r.source_week) for r in got) == [("Fab Ü", "2024WW01"), ("Fab Ü", "2024WW02")]
    # Same files, new checkpoint (as after a lost checkpoint): nothing is appended twice.
    incremental.ingest_files_stream(spark, src, layout, os.path.join(tmpdir_path, "ck2"), AS_OF).awaitTermination()
    assert spark.read.parquet(layout.raw).count() == 2


def test_pipeline_watermark_processes_only_new_loads(spark, rendered, tmpdir_path):
    root, ev = rendered
    layout = jobs.Layout(tmpdir_path)
    dim = testbed.class_dimension(spark, SF_SMALL)
    t1, t2 = AS_OF, AS_OF + dt.timedelta(days=7)
    r1 = jobs.full_pipeline(spark, root, layout, work_week=WEEKS[0], class_dim=dim, as_of=t1)
    r2 = jobs.full_pipeline(spark, root, layout, work_week=WEEKS[1], class_dim=dim, as_of=t2)
    n0 = ev.filter(F.col("work_week") == WEEKS[0]).count()
    n1 = ev.filter(F.col("work_week") == WEEKS[1]).count()
    assert r1["silver"]["rows_enriched"] == n0 and r2["silver"]["rows_enriched"] == n1
    y, w = (int(x) for x in WEEKS[1].split("WW"))
    assert r2["silver"]["weeks"] == [(y, w)]
    assert spark.read.parquet(layout.enriched).count() == n0 + n1
    assert jobs.last_success(spark, layout, "SILVER") == t2
    weeks = {r.work_week for r in spark.read.parquet(layout.site).select("work_week").distinct().collect()}
    assert weeks == {WEEKS[0], WEEKS[1]}


def test_apply_retention_drops_old_weeks(spark, rendered, tmpdir_path):
    root, ev = rendered
    layout = jobs.Layout(tmpdir_path)
    dim = testbed.class_dimension(spark, SF_SMALL)
    for ww in WEEKS:
        jobs.bronze(spark, root, layout, work_week=ww, class_dim=dim, as_of=AS_OF)
    jobs.silver(spark, layout, as_of=AS_OF)
    # as_of such that only the last week is inside a 1-week retention on every layer
    r = Rules(retention_weeks_raw=1, retention_weeks_enriched=1, retention_weeks_facts=1)
    start_last, _ = __import__("toolwatch.functions.calendar", fromlist=["x"]).week_range_of(WEEKS[-1])
    out = jobs.apply_retention(spark, layout, r, as_of=dt.datetime.combine(start_last + dt.timedelta(days=7), dt.time()))
    assert out["enriched"]["cutoff_week"] == WEEKS[-1]
    assert reports.latest_loads(spark.read.parquet(layout.load_log), 2).count() == 2
    old = spark.read.parquet(layout.chronic).drop("snapshot")
    jobs.sinks.write_table(old.withColumn("snapshot", F.lit("s20240701T000000")), layout.chronic, "replace", ("snapshot",))
    assert len(jobs.sinks.drop_snapshots_before(spark, layout.chronic, AS_OF + dt.timedelta(days=1))) == 1
    assert {r.snapshot for r in spark.read.parquet(layout.chronic).select("snapshot").distinct().collect()} == {"s20240701T000000"}
    left = {r.work_week for r in spark.read.parquet(layout.enriched).select("work_week").distinct().collect()}
    assert left == {WEEKS[-1]}
    assert {r.source_week for r in spark.read.parquet(layout.raw).select("source_week").distinct().collect()} == {WEEKS[-1]}


def _site(spark, layout):
    return {(r.facility, r.work_week): r.total_pm_events for r in spark.read.parquet(layout.site).collect()}


def _loaded(spark, ev, layout, root, weeks, at):
    dim = testbed.class_dimension(spark, SF_SMALL)
    for ww in weeks:
        jobs.bronze(spark, root, layout, work_week=ww, class_dim=dim, as_of=at)


def test_weeks_left_by_a_failed_gold_run_are_built_by_the_next(spark, rendered, tmpdir_path, monkeypatch):
    root, ev = rendered
    layout = jobs.Layout(tmpdir_path)
    dim = testbed.class_dimension(spark, SF_SMALL)
    jobs.full_pipeline(spark, root, layout, work_week=WEEKS[0], class_dim=dim, as_of=AS_OF)

    def broken(*a, **k):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(jobs.kpis, "part_week_summary", broken)
        with pytest.raises(RuntimeError):
            jobs.full_pipeline(spark, root, layout, work_week=WEEKS[1], class_dim=dim, as_of=AS_OF + dt.timedelta(days=7))
    res = jobs.full_pipeline(spark, root, layout, work_week=WEEKS[1], class_dim=dim, as_of=AS_OF + dt.timedelta(days=8))
    assert res["bronze"]["status"] == "SKIPPED" and res["silver"]["status"] == "NO_DATA" and res["gold"]["part_rows"] > 0
    for path in (layout.part, layout.site, layout.history, layout.summary):
        assert {r.work_week for r in spark.read.parquet(path).select("work_week").distinct().collect()} == set(WEEKS[:2])
    assert jobs.sinks.pending_weeks(spark, layout.pending, "GOLD") == []


def test_silver_that_dies_after_its_write_is_finished(spark, rendered, tmpdir_path, monkeypatch):
    root, ev = rendered
    layout = jobs.Layout(tmpdir_path)
    _loaded(spark, ev, layout, root, WEEKS[:2], AS_OF)

    def broken(*a, **k):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(jobs.kpis, "downtime_summary", broken)
        with pytest.raises(RuntimeError):
            jobs.silver(spark, layout, as_of=AS_OF)
    s = jobs.silver(spark, layout, as_of=AS_OF + dt.timedelta(hours=1))
    assert s["status"] == "NO_DATA" and s["summary_rows"] > 0 and len(s["weeks"]) == 2
    assert {r.work_week for r in spark.read.parquet(layout.summary).select("work_week").distinct().collect()} == set(WEEKS[:2])
    assert spark.read.parquet(layout.enriched).count() == ev.filter(F.col("work_week").isin(WEEKS[:2])).count()


def test_rows_loaded_under_an_older_stamp_are_taken(spark, rendered, tmpdir_path):
    root, ev = rendered
    layout = jobs.Layout(tmpdir_path)
    dim = testbed.class_dimension(spark, SF_SMALL)
    jobs.full_pipeline(spark, root, layout, work_week=WEEKS[0], class_dim=dim, as_of=AS_OF)
    _loaded(spark, ev, layout, root, [WEEKS[1]], AS_OF - dt.timedelta(days=30))
    s = jobs.silver(spark, layout, as_of=AS_OF + dt.timedelta(days=1))
    assert s["rows_enriched"] == ev.filter(F.col("work_week") == WEEKS[1]).count()


def test_load_that_was_not_committed_is_no_data_and_loaded_again(spark, rendered, tmpdir_path, monkeypatch):
    root, ev = rendered
    layout = jobs.Layout(tmpdir_path)
    dim = testbed.class_dimension(spark, SF_SMALL)
    path = jobs.files.find_files_for_week(spark, root, WEEKS[0])

    def broken(*a, **k):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(jobs.sinks, "commit_loads", broken)
        with pytest.raises(RuntimeError):
            jobs.ingest_files(spark, path, layout, WEEKS[0], dim, AS_OF)
    assert spark.read.parquet(layout.raw).count() > 0
    assert jobs.silver(spark, layout, as_of=AS_OF)["status"] == "NO_DATA"
    assert jobs.bronze(spark, root, layout, work_week=WEEKS[0], class_dim=dim, as_of=AS_OF)["status"] == "SUCCESS"
    assert jobs.silver(spark, layout, as_of=AS_OF)["rows_enriched"] == ev.filter(F.col("work_week") == WEEKS[0]).count()


def test_every_file_of_a_week_is_loaded_once(spark, rendered, tmpdir_path):
    _, ev = rendered
    one = ev.filter(F.col("work_week") == WEEKS[0])
    src, layout = os.path.join(tmpdir_path, "src"), jobs.Layout(os.path.join(tmpdir_path, "wh"))
    for name, part in (("a", 0), ("b", 1)):
        testbed.render_weekly_files(one.filter(F.abs(F.hash("entity")) % 2 == part), os.path.join(tmpdir_path, name))
        os.makedirs(os.path.join(src, WEEKS[0]), exist_ok=True)
        folder = os.path.join(tmpdir_path, name, f"work_week={WEEKS[0]}")
        for f in os.listdir(folder):
            if f.endswith(".csv"):
                os.rename(os.path.join(folder, f), os.path.join(src, WEEKS[0], f"{name}{f}"))
    first = jobs.bronze(spark, src, layout, work_week=WEEKS[0], as_of=AS_OF)
    assert first["rows_loaded"] == one.count() and len(first["files"]) >= 2
    assert jobs.bronze(spark, src, layout, work_week=WEEKS[0], as_of=AS_OF)["status"] == "SKIPPED"


def test_skip_done_builds_whole_weeks(spark, rendered, tmpdir_path):
    root, ev = rendered
    layout = jobs.Layout(tmpdir_path)
    _loaded(spark, ev, layout, root, [WEEKS[0]], AS_OF)
    jobs.silver(spark, layout, as_of=AS_OF)
    jobs.gold(spark, layout, as_of=AS_OF)
    before = _site(spark, layout)
    new = spark.read.parquet(layout.enriched).limit(1).withColumn("facility", F.lit("NEWFAB")).withColumn("pm_raw_id", F.lit("n1"))
    new.write.mode("append").partitionBy("ww_year", "ww_number").parquet(layout.enriched)
    out = jobs.gold(spark, layout, skip_done=True, as_of=AS_OF)
    after = _site(spark, layout)
    assert out["ceid_rows"] > 0 and after == {**before, ("NEWFAB", WEEKS[0]): 1}


def test_full_refresh_drops_stale_weeks_and_reruns_replace_snapshots(spark, rendered, tmpdir_path):
    root, ev = rendered
    layout = jobs.Layout(tmpdir_path)
    _loaded(spark, ev, layout, root, WEEKS[:2], AS_OF)
    jobs.silver(spark, layout, as_of=AS_OF)
    n = spark.read.parquet(layout.chronic).count()
    jobs.gold(spark, layout, as_of=AS_OF)
    _loaded(spark, ev, layout, root, [WEEKS[2]], AS_OF)
    jobs.silver(spark, layout, as_of=AS_OF)  # same stamp: one snapshot
    snaps = spark.read.parquet(layout.chronic)
    assert snaps.select("snapshot").distinct().count() == 1 and snaps.count() == snaps.select("entity", "facility", "ceid").distinct().count() >= n
    y, w = (int(x) for x in WEEKS[0].split("WW"))
    jobs.sinks.drop_partitions_before(spark, layout.raw, y, w + 1)
    jobs.silver(spark, layout, as_of=AS_OF, full_refresh=True)
    jobs.gold(spark, layout, as_of=AS_OF, full_refresh=True)
    for path in (layout.enriched, layout.summary, layout.site, layout.ceid, layout.part, layout.history):
        assert {r.work_week for r in spark.read.parquet(path).select("work_week").distinct().collect()} == set(WEEKS[1:])
