"""Rolling windows, dimensions, reports, scans and sinks on small hand-written rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from toolwatch import sinks
from toolwatch.functions.agg import exact_sum, exact_sum0
from toolwatch.operators import chronic, dims, kpis, reports, rolling
from toolwatch.operators.enrich import enrich as enrich_events
from toolwatch.operators.enrich import with_chronic_status
from toolwatch.rules import Rules
from toolwatch.sources import scans


def _site(spark, rows):
    return spark.createDataFrame(
        rows, "facility string, ww_year int, ww_number int, work_week string, avg_pm_life double, "
              "total_pm_events long, total_downtime_hours double")


def test_rolling_range_vs_rows(spark):
    s = _site(spark, [("F", 2024, 51, "2024WW51", 1.0, 1, 1.0), ("F", 2024, 52, "2024WW52", 2.0, 2, 2.0),
                      ("F", 2025, 1, "2025WW01", 3.0, 3, 3.0)])
    rng = {r.work_week: r.rolling_4wk_pm_count for r in rolling.rolling_range(s).collect()}
    rows = {r.work_week: r.rolling_4wk_pm_count for r in rolling.rolling_rows(s).collect()}
    assert [rng[k] for k in ("2024WW51", "2024WW52", "2025WW01")] == [1, 3, 3]
    assert [rows[k] for k in ("2024WW51", "2024WW52", "2025WW01")] == [1, 3, 6]


def test_rolling_gap_and_single_week(spark):
    s = _site(spark, [("F", 2024, 1, "2024WW01", 10.0, 1, 1.5), ("F", 2024, 5, "2024WW05", 20.0, 2, 2.5)])
    r = {x.work_week: x for x in rolling.rolling_range(s).collect()}
    # week 5 window is weeks 2..5: week 1 is outside
    assert r["2024WW05"].rolling_4wk_pm_count == 2 and r["2024WW05"].rolling_4wk_avg_pm_life == 20.0
    assert r["2024WW01"].rolling_4wk_downtime_hours == 1.5


def test_rowcount_tolerance(spark):
    w = spark.createDataFrame([("F", 2024, 1, "2024WW01", 100), ("F", 2024, 2, "2024WW02", 115), ("F", 2024, 3, "2024WW03", 150)],
                              "facility string, ww_year int, ww_number int, work_week string, row_count long")
    got = [r.within_tolerance for r in rolling.rowcount_tolerance(w).orderBy("ww_number").collect()]
    assert got == [None, 1, 0]


def test_calendar_generator_years(spark):
    c = dims.calendar(spark, 2020, 1)
    ys = sorted(r.fiscal_year for r in c.select("fiscal_year").distinct().collect())
    assert ys == [2020, 2021]  # num_years + 1 fiscal years
    first = c.orderBy("date_value").first()
    assert first.date_value == dt.date(2019, 12, 29) and first.work_week == "2020WW01" and first.day_of_week == 6


def test_date_dimension_columns(spark):
    d = dims.date_dimension(spark, 2022, 0)
    r = d.filter(F.col("date_value") == dt.date(2022, 12, 31)).first()
    assert (r.date_key, r.fiscal_week, r.work_week, r.fiscal_quarter, r.fiscal_month, r.day_name, r.is_weekend) == \
        (20221231, 53, "2022WW53", 5, 14, "Saturday", 1)
    assert d.count() == 371


def test_week_dimension_star_join_no_fanout(spark):
    wk = dims.week_dimension(spark, 2022, 2023)
    assert wk.count() == 53 + 52
    fact = spark.createDataFrame([("F", "2022WW53", 1), ("F", "2023WW01", 2)], "facility string, work_week string, n int")
    j = dims.calendar_star_join(fact, wk)
    assert j.count() == 2
    assert {r.work_week: r.week_start for r in j.collect()} == {"2022WW53": dt.date(2022, 12, 25), "2023WW01": dt.date(2023, 1, 1)}


def test_sequential_key_is_dense_rank(spark):
    df = spark.range(0, 500).select((F.col("id") * 7 % 500).cast("string").alias("k"))
    out = dims.sequential_key(df, ["k"], "key", num_partitions=7).collect()
    ordered = sorted(out, key=lambda r: r.k)
    assert [r.key for r in ordered] == list(range(1, 501))


def test_distribution_and_null_profile(spark):
    df = spark.createDataFrame([("a", None), ("a", 1.0), ("b", None), (None, None)], "c string, x double")
    dist = {r.c: (r.row_count, r.pct_of_total) for r in reports.distribution(df, "c").collect()}
    assert dist == {"a": (2, 50.0), "b": (1, 25.0), None: (1, 25.0)}
    prof = {r.column_name: (r.null_count, r.null_pct, r.warning) for r in reports.null_profile(df, ["c", "x"]).collect()}
    assert prof == {"c": (1, 25.0, 0), "x": (3, 75.0, 1)}


def test_duplicates_and_dedupe(spark):
    df = spark.createDataFrame([(1, 1, 5), (1, 1, 7), (2, 1, 1)], "a int, b int, ts int")
    assert [(r.a, r.b, r.dup_count) for r in reports.duplicate_keys(df, ["a", "b"]).collect()] == [(1, 1, 2)]
    kept = reports.drop_duplicate_keys(df, ["a", "b"], "ts").orderBy("a").collect()
    assert [(r.a, r.ts) for r in kept] == [(1, 7), (2, 1)]


def test_scans(spark):
    ev = spark.createDataFrame([(1, dt.datetime(2024, 1, 1), "2024WW01"), (2, dt.datetime(2024, 1, 8), "2024WW02"),
                                (3, dt.datetime(2024, 2, 1), "2024WW05")], "id long, ts timestamp, work_week string")
    assert [r.id for r in scans.date_range(ev, "ts", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 8)).collect()] == [1]
    assert [r.id for r in scans.week_range(ev, "2024WW02", "2024WW05").orderBy("id").collect()] == [2, 3]
    done = ev.filter("id < 3")
    assert [r.id for r in scans.new_by_id(ev, done, "id", "id").collect()] == [3]
    assert [r.id for r in scans.new_by_keys(ev, done, ["work_week"]).collect()] == [3]
    assert [r.id for r in scans.last_days(ev, "ts", dt.datetime(2024, 1, 9), 7).collect()] == [2]
    assert [r.id for r in scans.retention(ev, "ts", dt.datetime(2024, 2, 1), 4).orderBy("id").collect()] == [2, 3]


def test_sums_show_infinite_and_huge_values(spark):
    df = spark.createDataFrame(
        [("a", 0.1), ("a", 0.2), ("a", float("nan")), ("a", None), ("b", float("inf")), ("b", 1.0), ("c", 1e30), ("c", 2.0), ("d", None), ("e", -1e15), ("e", 0.5)],
        "k string, v double")
    got = {r.k: (r.s, r.z) for r in df.groupBy("k").agg(exact_sum("v").alias("s"), exact_sum0("v").alias("z")).collect()}
    assert got == {"a": (0.3, 0.3), "b": (float("inf"),) * 2, "c": (1e30 + 2.0,) * 2, "d": (None, 0.0), "e": (-1e15 + 0.5,) * 2}


def test_sinks_modes_and_retention(spark, tmpdir_path):
    p = f"{tmpdir_path}/t"
    df = spark.createDataFrame([(2024, 1, "a"), (2024, 2, "b")], "ww_year int, ww_number int, v string")
    assert sinks.write_table(df, p, "append") == 2
    assert sinks.write_table(df.filter("ww_number = 2").withColumn("v", F.lit("c")), p, "replace") == 1
    got = sorted((r.ww_number, r.v) for r in spark.read.parquet(p).collect())
    assert got == [(1, "a"), (2, "c")]  # only week 2 replaced
    with pytest.raises(Exception):
        sinks.write_table(df, p, "fail")
    assert sinks.row_count(spark, p) == 2 and not sinks.table_exists(spark, f"{tmpdir_path}/missing")
    ts = spark.createDataFrame([(dt.datetime(2024, 1, 1),), (dt.datetime(2024, 6, 1),)], "ts timestamp")
    ts.write.parquet(f"{tmpdir_path}/r")
    res = sinks.retention_rewrite(spark, f"{tmpdir_path}/r", "ts", dt.datetime(2024, 6, 2), 10, f"{tmpdir_path}/r2")
    assert (res["kept"], res["deleted"]) == (1, 1)


def test_weeks_filter_prunes_partitions(spark, tmpdir_path):
    df = spark.createDataFrame([(2024, w, w) for w in range(1, 11)] + [(2025, 1, 99)], "ww_year int, ww_number int, v int")
    df.write.partitionBy("ww_year", "ww_number").parquet(f"{tmpdir_path}/t")
    t = spark.read.parquet(f"{tmpdir_path}/t")
    got = scans.weeks_filter(t, [(2024, 3), (2024, 5), (2025, 1)])
    assert sorted(r.v for r in got.collect()) == [3, 5, 99]
    import contextlib, io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        got.explain()
    assert "PartitionFilters: [" in buf.getvalue() and "ww_number" in buf.getvalue().split("PartitionFilters")[1][:300]
    assert scans.weeks_filter(t, []).count() == 0


def test_partition_drop_retention(spark, tmpdir_path):
    weekly = spark.createDataFrame([(y, w, 1) for y in (2023, 2024) for w in (1, 20, 40)], "ww_year int, ww_number int, v int")
    weekly.write.partitionBy("ww_year", "ww_number").parquet(f"{tmpdir_path}/facts")
    raw = spark.createDataFrame([("2024WW01", 1), ("2024WW30", 2), ("2023WW52", 3)], "source_week string, v int")
    raw.write.partitionBy("source_week").parquet(f"{tmpdir_path}/raw")
    # whole expired years go as one directory: ww_year=2023 and ww_year=2024/ww_number=1
    assert len(sinks.drop_partitions_before(spark, f"{tmpdir_path}/facts", 2024, 20, dry_run=True)) == 2
    sinks.drop_partitions_before(spark, f"{tmpdir_path}/facts", 2024, 20)
    left = sorted((r.ww_year, r.ww_number) for r in spark.read.parquet(f"{tmpdir_path}/facts").collect())
    assert left == [(2024, 20), (2024, 40)]
    sinks.drop_partitions_before(spark, f"{tmpdir_path}/raw", 2024, 2)
    assert sorted(r.source_week for r in spark.read.parquet(f"{tmpdir_path}/raw").collect()) == ["2024WW30"]


def test_tool_that_changes_class_is_one_tool(spark):
    """The class is the latest one; joins on the tool do not fan events out."""
    rows = [("T1", "F", "C", "old" if i < 6 else "new", dt.datetime(2024, 1, 1 + i), 1.0 + i, 10.0, "Unscheduled Downtime", "2024WW01", 2.0) for i in range(12)]
    ev = spark.createDataFrame(rows, "entity string, facility string, ceid string, process_class string, event_ts timestamp_ntz, actual_life double, target_life double, downtime_type string, work_week string, down_hours double")
    en = enrich_events(ev)
    tools = chronic.chronic_tools(en)
    got = tools.collect()
    assert len(got) == 1 and got[0].process_class == "new" and got[0].total_pm_events == 12 and got[0].chronic_flag == 1
    assert with_chronic_status(en, tools).count() == 12
    assert [r.chronic_tools_count for r in kpis.downtime_summary(en, tools).filter("process_class = 'new'").collect()] == [1]


def test_history_built_in_parts_equals_one_pass(spark):
    import random

    r = random.Random(8)
    rows = []
    for t in range(12):
        for w in sorted(r.sample(range(1, 30), 9)):
            for _ in range(r.randint(1, 3)):
                kind = r.choice(["Unscheduled", "Scheduled"])
                rows.append((f"T{t}", "F", "C", "x", dt.datetime(2024, 1, 1), r.uniform(1, 50), 10.0, kind, f"2024WW{w:02d}", r.uniform(0, 9)))
    ev = spark.createDataFrame(rows, "entity string, facility string, ceid string, process_class string, event_ts timestamp_ntz, actual_life double, target_life double, downtime_type string, work_week string, down_hours double")
    en, rules = enrich_events(ev), Rules(min_pm_events=1)
    whole = chronic.chronic_weekly(en, rules)
    key = lambda df: {(x.entity, x.ww_number): (x.chronic_score, round(x.chronic_score_change, 9) if x.chronic_score_change is not None else None, x.status_changed) for x in df.collect()}
    want = key(whole)
    stored = chronic.chronic_weekly(en.filter("ww_number % 3 <> 1"), rules)
    new = [(2024, w) for w in range(1, 30) if w % 3 == 1]
    changed, touched = chronic.chronic_weekly_update(chronic.weekly_scores(en.filter("ww_number % 3 = 1"), rules), stored, new)
    merged = {k: v for k, v in key(stored).items() if (2024, k[1]) not in touched} | key(changed)
    assert merged == want and any(v[2] for v in want.values())


def test_global_median_is_exact(spark):
    import random
    import statistics

    from toolwatch.operators.quantiles import global_median

    r = random.Random(3)
    for values in ([], [4.0], [1.0, 2.0], [-5.0, 0.0, 0.0, 1e-9], [7.0] * 50 + [8.0] * 50, [r.gauss(0, 1) * 10 ** r.randint(-3, 9) for _ in range(801)], [r.uniform(10, 10.01) for _ in range(500)], [float("-inf"), 1.0, 2.0]):
        df = spark.createDataFrame([(v,) for v in [*values, None, float("nan")]], "v double")
        got = global_median(df, "v").first()["median"]
        assert got == (statistics.median(values) if values else None)


def test_weekly_scores_parse_a_week_once_and_drop_rows_without_one(spark):
    ev = spark.range(40).select(
        F.when(F.col("id") != 3, F.concat(F.lit("T"), (F.col("id") % 2).cast("string"))).alias("entity"),
        F.lit("S").alias("facility"),
        F.lit("C").alias("ceid"),
        (F.lit(dt.datetime(2024, 1, 1)) + F.make_dt_interval(days=F.col("id").cast("int") % 10)).alias("event_ts"),
        F.when(F.col("id") % 8 == 0, F.lit(None)).when(F.col("id") % 8 == 1, F.lit("no week"))
        .otherwise(F.concat(F.lit("2024WW0"), (1 + F.col("id") % 4).cast("string"))).alias("work_week"),
        F.lit("Scheduled").alias("downtime_type"),
        F.col("id").cast("double").alias("actual_life"),
        F.lit(50.0).alias("target_life"),
        F.lit(1.5).alias("down_hours"),
    )
    scores = chronic.weekly_scores(enrich_events(ev))
    plan = scores._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if line.lstrip(" :+-").startswith("Filter")]
    assert not [line for line in filters if "regexp_extract" in line]
    want: dict = {}
    for i in range(40):
        if i != 3 and i % 8 > 1:
            k = (f"T{i % 2}", 2024, 1 + i % 4, f"2024WW0{1 + i % 4}")
            want[k] = want.get(k, 0) + 1
    got = {(r.entity, r.ww_year, r.ww_number, r.work_week): r.total_pm_events for r in scores.collect()}
    assert got == want
    assert "_placed" not in scores.columns
