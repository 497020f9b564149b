"""Disk and time of the jobs: what a write leaves behind, what a load shuffles, what runs side by side."""

import datetime as dt
import os
import threading
import time

import pytest
from pyspark.sql import functions as F

from toolwatch import sinks
from toolwatch.operators import chronic as chr_
from toolwatch.plans import catalog, jobs

AS_OF = dt.datetime(2024, 6, 1)


def shuffle_files(spark):
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for n in (found.apply(i).getName() for i in range(found.size())) if n.startswith("shuffle_")}


def left_after(spark, before, seconds=30):
    """Shuffle files that are still there some time after a write; they are removed in the background."""
    until = time.time() + seconds
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    return left


def test_writes_leave_no_shuffle_files(spark, tmpdir_path):
    rows = spark.range(2000).select((F.col("id") % 7).cast("int").alias("ww_number"), F.lit(2024).alias("ww_year"), "id")
    held = rows.groupBy("ww_year", "ww_number").agg(F.max("id").alias("id"))
    before = shuffle_files(spark)
    assert sinks.write_table(held, f"{tmpdir_path}/a", "append", cluster=True) == 7
    assert sinks.replace_all(held, f"{tmpdir_path}/b", cluster=True) == 7
    assert not left_after(spark, before, 10)
    assert spark.read.parquet(f"{tmpdir_path}/a").count() == spark.read.parquet(f"{tmpdir_path}/b").count() == 7


def star_tables(spark, root):
    """A few rows of the tables that events are made of."""
    day = lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(days=n)
    spark.createDataFrame([(0, "HERE"), (1, "THERE")], "n_nationkey int, n_name string").write.parquet(f"{root}/nation.parquet")
    spark.createDataFrame([(i, i % 2, 100.0 * i) for i in range(6)], "s_suppkey long, s_nationkey int, s_acctbal double").write.parquet(f"{root}/supplier.parquet")
    spark.createDataFrame([(i, f"B{i}", f"P{i}", i + 1, 1.0) for i in range(3)], "p_partkey long, p_brand string, p_type string, p_size int, p_retailprice double").write.parquet(f"{root}/part.parquet")
    spark.createDataFrame(
        [(i, i % 3, i % 6, i % 7 + 1, float(i % 50), 1000.0 + i, 0.05, 0.02, "ANR"[i % 3], "OF"[i % 2], day(i % 28)) for i in range(120)],
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double,"
        " l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    ).write.parquet(f"{root}/lineitem.parquet")


def test_rendered_files_go_when_they_are_loaded(spark, tmpdir_path):
    star_tables(spark, tmpdir_path)
    _, layout, load = catalog._ingested(spark, tmpdir_path, "scale", parts=2)
    load(0)
    load(1)
    run = os.path.dirname(layout.root)
    assert os.listdir(run) == ["warehouse"]
    assert spark.read.parquet(layout.raw).count() == 120


EVENTS = "pm_raw_id string, v int"


def test_a_load_of_new_files_is_not_shuffled_to_meet_enriched_ids(spark):
    raw = spark.createDataFrame([("f1#1", 1), ("f1#1", 2), (None, 3), ("noname", 4)], EVENTS).repartition(3)
    done = spark.createDataFrame([("f0#1", 9), ("f0#2", 9), (None, 9)], EVENTS).repartition(3)
    out = jobs._not_enriched(raw, done)
    assert sorted(r.v for r in out.collect()) == [1, 2, 3, 4]
    assert "hashpartitioning(pm_raw_id" not in out._jdf.queryExecution().executedPlan().toString()


def test_rows_of_a_load_that_died_half_way_are_taken_once(spark, monkeypatch):
    raw = spark.createDataFrame([("f1#1", 1), ("f1#2", 2), ("f1#-3", 3), ("f2#1", 4), (None, 5), ("noname", 6), ("7", 7)], EVENTS)
    done = spark.createDataFrame([("f1#1", 0), ("f1#-3", 0), ("f3#1", 0), (None, 0), ("noname", 0)], EVENTS)
    for most in (jobs.FILES_BY_NAME, 1, 0):  # also with more files on both sides than are searched by name
        monkeypatch.setattr(jobs, "FILES_BY_NAME", most)
        assert sorted(r.v for r in jobs._not_enriched(raw, done).collect()) == [2, 4, 5, 7]


@pytest.fixture(scope="module")
def silver_layout(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("scale"))
    star_tables(spark, root)
    _, layout, load = catalog._ingested(spark, root, "gold")
    load(0)
    jobs.silver(spark, layout, as_of=AS_OF)
    return layout


def test_two_facts_are_built_at_once(spark, silver_layout, monkeypatch):
    met, write = threading.Barrier(2, timeout=60), sinks.write_table
    first = {silver_layout.site, silver_layout.ceid}

    def together(df, path, *a, **k):
        if path in first:
            met.wait()
        return write(df, path, *a, **k)

    key = "spark.sql.maxConcurrentOutputFileWriters"
    own = spark.conf.get(key, None)
    monkeypatch.setattr(sinks, "write_table", together)
    out = jobs.gold(spark, silver_layout, as_of=AS_OF)
    assert out["site_rows"] == spark.read.parquet(silver_layout.site).count() > 0
    assert spark.conf.get(key, None) == own


def test_a_fact_that_fails_is_told_and_settings_come_back(spark, silver_layout, monkeypatch):
    key = "spark.sql.maxConcurrentOutputFileWriters"
    own = spark.conf.get(key, None)

    def broken(*a, **k):
        raise RuntimeError("lost")

    monkeypatch.setattr(jobs.kpis, "ceid_week_kpis", broken)
    with pytest.raises(RuntimeError, match="lost"):
        jobs.gold(spark, silver_layout, as_of=AS_OF)
    assert spark.conf.get(key, None) == own


def test_a_history_of_these_weeks_alone_is_scored_once(spark, monkeypatch):
    rows = [("T1", "A", "C", 2024, w, float(w), w % 2) for w in (1, 2, 3)] + [("T2", "A", "C", 2024, 2, 5.0, 1)]
    scores = spark.createDataFrame(rows, "entity string, facility string, ceid string, ww_year int, ww_number int, chronic_score double, chronic_flag int")
    whole = chr_.with_changes(scores)
    weeks = [(2024, 3), (2024, 1), (2024, 2)]
    runs = spark.sparkContext.accumulator(0)

    def counted(batches):
        runs.add(1)
        yield from batches

    once = scores.coalesce(1).mapInArrow(counted, scores.schema)
    out, touched = chr_.chronic_weekly_update(once, whole, weeks)
    assert sorted(out.collect()) == sorted(whole.collect()) and touched == sorted(weeks)
    assert runs.value == 1
    # With another week stored, the next week of a tool is found and mended as before.
    out, touched = chr_.chronic_weekly_update(scores.filter("ww_number = 1"), whole, [(2024, 1)])
    assert touched == [(2024, 1), (2024, 2)]
    assert sorted(out.collect()) == sorted(whole.filter("ww_number < 3").collect())
