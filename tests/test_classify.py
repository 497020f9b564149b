"""Rule classifiers on hand-written rows (golden values and every boundary)."""

import math

import pytest
from pyspark.sql import functions as F

from toolwatch.functions import classify as cls
from toolwatch.operators import chronic as chr_
from toolwatch.rules import Rules


def _timing(spark, rows):
    df = spark.createDataFrame(rows, "actual double, target double")
    pct = cls.life_vs_target_pct("actual", "target")
    return [r.t for r in df.select(cls.timing_class(pct).alias("t")).collect()]


def test_timing_golden(spark):
    rows = [(8000.0, 10000.0), (9000.0, 10000.0), (10500.0, 10000.0), (11800.0, 10000.0), (13500.0, 10000.0)]
    assert _timing(spark, rows) == ["Early", "On-Time", "On-Time", "Late", "Overdue"]


def test_timing_edges(spark):
    rows = [(85.0, 100.0), (115.0, 100.0), (130.0, 100.0), (130.0001, 100.0)]
    assert _timing(spark, rows) == ["On-Time", "On-Time", "Late", "Overdue"]


def test_timing_unknown(spark):
    rows = [(10.0, 0.0), (10.0, None), (10.0, -5.0), (None, 100.0)]
    assert _timing(spark, rows) == ["Unknown"] * 4


def test_timing_gap_defaults_on_time(spark):
    r = Rules(early_threshold=-20, on_time_min=-10, on_time_max=10, late_threshold=20, overdue_threshold=30)
    df = spark.createDataFrame([(-15.0,), (15.0,)], "p double")
    assert [x.t for x in df.select(cls.timing_class("p", r).alias("t")).collect()] == ["On-Time", "On-Time"]


def test_scheduled(spark):
    df = spark.createDataFrame([("SCHEDULED",), (" scheduled",), (None,), ("Unscheduled",)], "t string")
    got = df.select(cls.scheduled_flag("t").alias("f"), cls.scheduled_category("t").alias("c")).collect()
    assert [(r.f, r.c) for r in got] == [(1, "Scheduled"), (0, "Unknown"), (0, "Unknown"), (0, "Unscheduled")]


def _tools(spark, events):
    """events: list of (entity, unscheduled 0/1, life, hours) -> scored tool rows keyed by entity."""
    rows = [(e, "F1", "C1", "A", 0 if u else 1, life, h, 0.0, 0.0) for e, u, life, h in events]
    df = spark.createDataFrame(
        rows, "entity string, facility string, ceid string, process_class string, scheduled_flag int, "
              "actual_life double, down_hours double, reclean double, sympathy double")
    return {r.entity: r for r in chr_.chronic_tools(df).collect()}


def test_chronic_abc(spark):
    ev = []
    # A: 10 events, 4 unscheduled, steady life -> chronic by unscheduled rate
    ev += [("A", i < 4, 100.0, 1.0) for i in range(10)]
    # B: 10 events, 2 unscheduled, life CV 0.5 -> chronic by variance
    lives = [50.0, 150.0] * 5
    ev += [("B", i < 2, lives[i], 1.0) for i in range(10)]
    # C: 3 events, 2 unscheduled -> too few events
    ev += [("C", i < 2, 100.0, 1.0) for i in range(3)]
    # D: exactly 0.30 unscheduled, CV 0 -> not chronic (strictly greater required)
    ev += [("D", i < 3, 100.0, 1.0) for i in range(10)]
    t = _tools(spark, ev)
    assert (t["A"].chronic_flag, t["B"].chronic_flag, t["C"].chronic_flag, t["D"].chronic_flag) == (1, 1, 0, 0)
    assert t["B"].life_cv == pytest.approx(50.0 * math.sqrt(10 / 9) / 100.0)


def test_one_event_tool(spark):
    t = _tools(spark, [("S", False, 100.0, 2.0)])["S"]
    assert t.life_stddev is None and t.life_cv is None and t.chronic_score is None
    assert t.chronic_flag == 0 and t.chronic_severity is None


def test_severity(spark):
    df = spark.createDataFrame([(1, 45.0), (1, 65.0), (1, 80.0), (1, 95.0), (1, None), (0, 99.0)], "f int, s double")
    got = [r.v for r in df.select(cls.severity("f", "s").alias("v")).collect()]
    assert got == ["Low", "Medium", "High", "Critical", "Low", None]


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(None,), (-5.0,), (50.0,), (150.0,)], "x double")
    assert [r.v for r in df.select(cls.clip_pct("x").alias("v")).collect()] == [None, 0.0, 50.0, 100.0]


def test_round_half_even_like_numpy(spark):
    import numpy as np

    vals = [0.125, 52.355, 2.675, 1.005, 0.375, -0.125]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r.v for r in df.select(cls.round_half_even("x", 2).alias("v")).collect()]
    assert got == [float(np.round(v, 2)) for v in vals]


def test_nan_to_null(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "x double")
    assert [r.v for r in df.select(cls.nan_to_null("x").alias("v")).collect()] == [None, 1.0]


def test_score_formula(spark):
    df = spark.createDataFrame([(0.6, 0.2, 5.0, 0.1, 0.2)], "u double, cv double, h double, r double, s double")
    v = df.select(cls.chronic_score("u", "cv", "h", "r", "s").alias("v")).first().v
    # 100*.35 + 50*.25 + 50*.2 + 10*.1 + 20*.1
    assert v == pytest.approx(35 + 12.5 + 10 + 1 + 2)


def test_rules_validation():
    with pytest.raises(ValueError):
        Rules(weight_cv=0.5)
    with pytest.raises(ValueError):
        Rules(late_threshold=40)
    with pytest.raises(ValueError):
        Rules(severity_critical=120)
    with pytest.raises(ValueError):
        Rules(unscheduled_rate_threshold=1.5)
    with pytest.raises(ValueError):
        Rules(retention_weeks_raw=0)
    assert Rules().warnings() == []
    assert any("min_pm_events" in w for w in Rules(min_pm_events=2).warnings())
    # the shipped defaults are valid (the original validator rejected its own -15 < -15 defaults)
    Rules(early_threshold=-15, on_time_min=-15)
