"""Runs that die on the way, corrected files, stored partials: the tables equal those of one clean run."""

import datetime as dt
import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from toolwatch import sinks
from toolwatch.operators import chronic as chr_
from toolwatch.operators.enrich import enrich
from toolwatch.plans import jobs
from toolwatch.sources import files, testbed
from toolwatch.streaming import incremental

from conftest import SF_SMALL

WEEKS = ["1996WW10", "1996WW11", "1996WW12"]
AS_OF = dt.datetime(2024, 6, 1, 12, 0, 0)


@pytest.fixture(scope="module")
def events(spark):
    return testbed.pm_events(spark, SF_SMALL).filter(F.col("work_week").isin(WEEKS)).cache()


def _rounded(df, drop=()):
    cols = sorted(c for c in df.columns if c not in drop)
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.select(cols).collect()), key=repr)


def _paths(spark, root):
    return [r.path for r in files.list_week_files(spark, root).select("path").collect()]


# ---- stored partials


def test_merged_partials_equal_metrics_of_all_events(spark, events):
    ev = enrich(events, class_dim=testbed.class_dimension(spark, SF_SMALL))
    odd = ev.limit(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) if f.name in ("actual_life", "entity", "ww_year", "ww_number") else F.col(f.name) for f in ev.schema])
    far = ev.limit(3).withColumns({"down_hours": F.lit(2e15), "actual_life": F.col("actual_life") + F.lit(1e9)})
    whole = ev.unionByName(odd).unionByName(far).unionByName(ev.limit(2).withColumn("down_hours", F.lit(float("nan"))))
    got = chr_.merged_metrics(chr_.tool_week_partials(whole.repartition(5)))
    want = chr_.tool_metrics(whole)
    assert _rounded(got) == _rounded(want) and got.count() > 5
    one = chr_.chronic_from_partials(chr_.tool_week_partials(whole))
    assert _rounded(one) == _rounded(chr_.with_analysis_period(chr_.chronic_tools(whole), whole))
    assert chr_.merged_metrics(chr_.tool_week_partials(whole.limit(0))).collect() == []


def test_an_increment_reads_the_events_of_its_own_weeks_only(spark, events, tmpdir_path):
    root, layout = os.path.join(tmpdir_path, "source"), jobs.Layout(os.path.join(tmpdir_path, "wh"))
    testbed.render_weekly_files(events, root)
    for ww in WEEKS[:2]:
        jobs.bronze(spark, root, layout, work_week=ww, as_of=AS_OF)
    jobs.silver(spark, layout, as_of=AS_OF)
    jobs.bronze(spark, root, layout, work_week=WEEKS[2], as_of=AS_OF)
    y, w = (int(x) for x in WEEKS[0].split("WW"))
    kept = spark.createDataFrame(spark.read.parquet(layout.enriched).collect(), spark.read.parquet(layout.enriched).schema)
    sinks.drop_week(spark, layout.enriched, y, w)  # an increment that read this week would miss it
    later = AS_OF + dt.timedelta(days=1)
    jobs.silver(spark, layout, as_of=later)
    now = spark.read.parquet(layout.enriched)
    whole = now.unionByName(kept.filter((F.col("ww_year") == y) & (F.col("ww_number") == w)))
    snap = spark.read.parquet(layout.chronic).filter(F.col("snapshot") == f"s{later:%Y%m%dT%H%M%S}")
    want = chr_.with_analysis_period(chr_.chronic_tools(whole), whole)
    assert _rounded(snap, ("snapshot", "calculation_ts")) == _rounded(want)
    assert sinks.pending_weeks(spark, layout.pending, "TOOLS") == []


# ---- tables replaced aside


def test_a_refresh_that_dies_leaves_the_old_table(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "t")
    old = spark.createDataFrame([(1, 2020, 1), (2, 2020, 2)], "v int, ww_year int, ww_number int")
    new = spark.createDataFrame([(3, 2021, 3)], old.schema)
    sinks.replace_all(old, path)
    with pytest.raises(Exception):
        sinks.replace_all(new.withColumn("v", F.raise_error(F.lit("lost")).cast("int")), path)
    assert {r.v for r in spark.read.parquet(path).collect()} == {1, 2}
    # Dies between the two renames: the next look at the table puts the new one in place.
    aside = sinks._beside(path, "new-x")
    new.write.partitionBy("ww_year", "ww_number").parquet(aside)
    real, sinks.finish = sinks.finish, lambda *a: None
    try:
        sinks._publish(spark, path, {"kind": "all", "aside": aside})
    finally:
        sinks.finish = real
    os.rename(path, sinks._beside(path, "old"))
    assert sinks.table_exists(spark, path)
    assert {r.v for r in spark.read.parquet(path).collect()} == {3}
    assert [n for n in os.listdir(tmpdir_path) if n.startswith("_")] == []
    # A note that was cut short says nothing.
    with open(sinks._beside(path, "note"), "w") as f:
        f.write('{"kind": "a')
    assert sinks.table_exists(spark, path) and spark.read.parquet(path).count() == 1


def test_weeks_replaced_from_the_table_itself_survive_a_death(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "t")
    rows = spark.createDataFrame([(i, 2020, i % 3) for i in range(9)], "v int, ww_year int, ww_number int")
    sinks.write_table(rows, path, "replace")
    own = spark.read.parquet(path).filter("ww_number = 1 and v < 5")
    write, calls = sinks.write_table, []

    def dies(df, *a, **k):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return write(df, *a, **k)

    sinks.write_table = dies
    try:
        with pytest.raises(RuntimeError):
            sinks.replace_weeks(own, path, [(2020, 1), (2020, 2)])
    finally:
        sinks.write_table = write
    sinks.finish(spark, path)
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [0, 1, 3, 4, 6]  # week 2 has no row left
    sinks.replace_weeks(spark.read.parquet(path).limit(0), path, [(2020, 1)])
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [0, 3, 6]


def test_a_full_refresh_is_not_limited_to_weeks(spark, tmpdir_path):
    layout = jobs.Layout(tmpdir_path)
    with pytest.raises(ValueError):
        jobs.gold(spark, layout, full_refresh=True, weeks=[(2020, 1)])
    with pytest.raises(ValueError):
        jobs.silver(spark, layout, full_refresh=True, start=AS_OF)


# ---- streams


def test_stream_lost_between_write_and_commit_loads_its_rows_once(spark, events, tmpdir_path):
    root, layout = os.path.join(tmpdir_path, "source"), jobs.Layout(os.path.join(tmpdir_path, "wh"))
    testbed.render_weekly_files(events, root)

    def lost():
        raise RuntimeError("lost")

    def run(**k):
        incremental.ingest_files_stream(spark, root, layout, os.path.join(tmpdir_path, "ck"), AS_OF, **k).awaitTermination()

    with pytest.raises(StreamingQueryException):
        run(before_commit=lost)
    assert spark.read.parquet(layout.raw).count() == events.count()
    assert jobs.silver(spark, layout, as_of=AS_OF)["status"] == "NO_DATA"
    run()
    run()
    assert jobs.silver(spark, layout, as_of=AS_OF)["rows_enriched"] == events.count()
    assert len(sinks.committed_loads(spark, layout.loads, "RAW")) == 1


def test_a_replayed_batch_appends_only_what_is_missing(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "t")
    rows = spark.createDataFrame([("a", 1), ("b", 1), ("b", 1), ("b", 1), ("c", 2)], "pm_raw_id string, source_week int")
    append = lambda df: incremental.append_missing(df, path, lambda t: t, ("source_week",))
    assert append(rows) == 5 and append(rows) == 0
    part = os.path.join(tmpdir_path, "part")
    rows.filter("pm_raw_id = 'a'").unionByName(rows.filter("pm_raw_id = 'b'").limit(1)).write.partitionBy("source_week").parquet(part)
    assert incremental.append_missing(rows, part, lambda t: t, ("source_week",)) == 3
    assert sorted(r.pm_raw_id for r in spark.read.parquet(part).collect()) == ["a", "b", "b", "b", "c"]


def test_batch_appends_to_a_streamed_table_are_seen(spark, events, tmpdir_path):
    root, raw = os.path.join(tmpdir_path, "source"), os.path.join(tmpdir_path, "raw")
    testbed.render_weekly_files(events, root)
    incremental.ingest_stream(spark, root, raw, os.path.join(tmpdir_path, "ck"), AS_OF).awaitTermination()
    more = spark.read.parquet(raw).limit(1).withColumn("pm_raw_id", F.lit("by hand"))
    sinks.write_table(more, raw, "append", ("source_week",))
    assert spark.read.parquet(raw).count() == events.count() + 1


# ---- versions of a file


def test_a_corrected_file_takes_the_place_of_its_first_version(spark, events, tmpdir_path):
    root, layout = os.path.join(tmpdir_path, "source"), jobs.Layout(os.path.join(tmpdir_path, "wh"))
    testbed.render_weekly_files(events, root)
    jobs.full_pipeline(spark, root, layout, work_week=WEEKS[0], as_of=AS_OF)
    (path,) = files.find_files_for_week(spark, root, WEEKS[0])
    local = path.removeprefix("file:")
    with open(local) as f:
        head, *lines = f.read().splitlines()
    # Half of the rows go, and the others move to a week that nothing else has.
    moved = [line.replace(WEEKS[0], WEEKS[1]) for line in lines[: len(lines) // 2]]
    with open(local, "w") as f:
        f.write("\n".join([head, *moved]) + "\n")
    folder, name = os.path.split(local)
    os.remove(os.path.join(folder, f".{name}.crc"))  # the checksum of the first version
    later = AS_OF + dt.timedelta(days=1)
    res = jobs.full_pipeline(spark, root, layout, work_week=WEEKS[0], as_of=later)
    assert res["bronze"]["status"] == "SUCCESS" and res["bronze"]["rows_loaded"] == len(moved)
    assert res["silver"]["weeks"] == [tuple(map(int, w.split("WW"))) for w in WEEKS[:2]]
    for table in (layout.enriched, layout.site, layout.ceid, layout.part, layout.history, layout.summary):
        assert {r.work_week for r in spark.read.parquet(table).select("work_week").distinct().collect()} == {WEEKS[1]}, table
    assert spark.read.parquet(layout.enriched).count() == len(moved)
    total = spark.read.parquet(layout.chronic).filter(F.col("snapshot") == f"s{later:%Y%m%dT%H%M%S}").agg(F.sum("total_pm_events")).first()[0]
    assert total == len(moved)
    again = jobs.full_pipeline(spark, root, layout, work_week=WEEKS[0], as_of=later + dt.timedelta(days=1))
    assert again["bronze"]["status"] == "SKIPPED" and again["silver"]["status"] == "NO_DATA"
    assert layout.missing(spark) == [] and jobs.Layout(os.path.join(tmpdir_path, "none")).missing(spark) == list(jobs.Layout.EXPECTED)
    # A refresh of all layers from the raw table, whose superseded rows stay out.
    before = _rounded(spark.read.parquet(layout.site), ("calculated_at",))
    res = jobs.full_pipeline(spark, root, layout, work_week=WEEKS[0], as_of=later + dt.timedelta(days=2), full_refresh=True)
    assert res["silver"]["rows_enriched"] == len(moved) and _rounded(spark.read.parquet(layout.site), ("calculated_at",)) == before


def test_history_without_the_rows_of_a_retired_week(spark):
    cols = "entity string, facility string, ceid string, ww_year int, ww_number int, work_week string, chronic_score double, chronic_flag int"
    rows = [("t", "f", "c", 2020, w, f"2020WW{w:02d}", float(w * w), w % 2) for w in (1, 3, 6)] + [("u", "f", "c", 2020, 6, "2020WW06", 5.0, 1)]
    scores = spark.createDataFrame(rows, cols)
    stored = chr_.with_changes(scores)
    left, touched = chr_.chronic_weekly_update(scores.limit(0), stored, [(2020, 3)])
    want = chr_.with_changes(scores.filter("ww_number <> 3"))
    assert touched == [(2020, 3), (2020, 6)]
    assert _rounded(left) == _rounded(want.filter("ww_number = 6"))


# ---- rolled fact


def test_only_windows_of_changed_weeks_are_rolled_anew(spark, tmpdir_path):
    layout = jobs.Layout(tmpdir_path)
    cols = "facility string, ww_year int, ww_number int, work_week string, avg_pm_life double, total_pm_events long, total_downtime_hours double"
    site = spark.createDataFrame([(f, 2020, w, f"2020WW{w:02d}", float(w * w), w, w / 4) for f in "ab" for w in (1, 2, 5, 6, 8, 9, 20, 53)] + [("a", 2021, 1, "2021WW01", 1.0, 1, 1.0)], cols)
    sinks.write_table(site, layout.site, "replace")
    rules = jobs.DEFAULT_RULES
    jobs._roll(spark, layout, None, rules)
    names = lambda w: os.listdir(sinks._week_dir(layout.site_rolled, 2020, w))
    before = {w: names(w) for w in (1, 2, 5, 20, 53)}
    # Week 6 changes, week 9 goes: windows up to week 12 are rolled again, others stay as they are.
    more = site.filter("ww_number = 6").withColumn("total_pm_events", F.lit(100).cast("long"))
    sinks.write_table(more, layout.site, "replace", covering=[(2020, 6), (2020, 9)])
    jobs._roll(spark, layout, [(2020, 6), (2020, 9)], rules)
    from toolwatch.operators.rolling import rolling_range

    want = rolling_range(spark.read.parquet(layout.site), rules)
    got = spark.read.parquet(layout.site_rolled)
    assert _rounded(got) == _rounded(want)
    assert {w: names(w) for w in before} == before


def test_write_settings_are_the_sessions_own_afterwards(spark, tmpdir_path):
    spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", "3")
    before = spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    try:
        with pytest.raises(RuntimeError), sinks.write_settings(spark):
            assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
            assert int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")) == sinks.OPEN_PARTITIONS
            # Wide rows are not sorted by the week they go to, and no method is too long to be compiled.
            rows = spark.range(100).select((F.col("id") % 40).cast("string").alias("week"), *[F.col("id").alias(f"c{i}") for i in range(90)])
            rows.write.partitionBy("week").parquet(tmpdir_path + "/t")
            raise RuntimeError
        assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "3"
        assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == before
    finally:
        spark.conf.unset("spark.sql.maxConcurrentOutputFileWriters")
    assert spark.read.parquet(tmpdir_path + "/t").groupBy("week").count().count() == 40
