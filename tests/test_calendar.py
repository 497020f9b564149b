"""Work-week calendar: golden dates, parser cases, 53-week years, closed form vs day-by-day walk."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from toolwatch.functions import calendar as cal


def _one(spark, col):
    return spark.range(1).select(col.alias("v")).first().v


@pytest.mark.parametrize(
    "d,label",
    [(dt.date(2019, 12, 28), "2019WW52"), (dt.date(2019, 12, 29), "2020WW01"), (dt.date(2022, 12, 31), "2022WW53"),
     (dt.date(2000, 12, 30), "2000WW53"), (dt.date(2000, 12, 31), "2001WW01")],
)
def test_golden_labels(spark, d, label):
    assert _one(spark, cal.work_week(F.lit(d))) == label
    assert cal.work_week_of(d) == label


def test_day_by_day_walk_matches_closed_form(spark):
    """Walk days from a known year start, counting weeks by hand, for 1994..2030."""
    start = dt.date(1993, 12, 26)  # Sunday after the last Saturday of December 1993
    expected, d, fy, doy = {}, start, 1994, 1
    while fy <= 2030:
        expected[d] = (fy, doy, f"{fy}WW{(doy - 1) // 7 + 1:02d}")
        nxt = d + dt.timedelta(days=1)
        # the year closes on the last Saturday of December
        if d.weekday() == 5 and d.month == 12 and (d + dt.timedelta(days=7)).year != d.year:
            fy, doy = fy + 1, 1
        else:
            doy += 1
        d = nxt
    df = spark.createDataFrame([(k,) for k in expected], "d date")
    got = df.select("d", cal.fiscal_year("d").alias("fy"), cal.fiscal_day_of_year("d").alias("doy"), cal.work_week("d").alias("ww")).collect()
    bad = [r for r in got if expected[r.d] != (r.fy, r.doy, r.ww)]
    assert not bad, bad[:5]


def test_53_week_years():
    years = [y for y in range(1994, 2031) if cal.week_range_of(f"{y}WW01") and _weeks(y) == 53]
    assert years == [1994, 2000, 2005, 2011, 2016, 2022, 2028]


def _weeks(y):
    try:
        cal.week_range_of(f"{y}WW53")
        return 53
    except ValueError:
        return 52


@pytest.mark.parametrize(
    "s,expected",
    [("2025WW22", (2025, 22)), ("2025WW22nn", (2025, 22)), ("25WW1", (None, None)), (None, (None, None)), ("xx", (None, None))],
)
def test_parse_column(spark, s, expected):
    y, w = cal.parse_work_week(F.lit(s).cast("string"))
    r = spark.range(1).select(y.alias("y"), w.alias("w")).first()
    assert (r.y, r.w) == expected


def test_parse_scalar_raises():
    assert cal.parse_week_label("2025WW22") == (2025, 22)
    with pytest.raises(ValueError):
        cal.parse_week_label("25WW1")


def test_quarter_month_week53(spark):
    r = spark.range(1).select(cal.fiscal_quarter(F.lit(53)).alias("q"), cal.fiscal_month(F.lit(53)).alias("m"),
                              cal.fiscal_month(F.lit(49)).alias("m49"), cal.fiscal_quarter(F.lit(13)).alias("q13")).first()
    assert (r.q, r.m, r.m49, r.q13) == (5, 14, 13, 1)


def test_week_range_and_shift(spark):
    assert cal.week_range_of("2020WW01") == (dt.date(2019, 12, 29), dt.date(2020, 1, 4))
    with pytest.raises(ValueError):
        cal.week_range_of("2021WW53")
    assert cal.shift_week("2023WW01", -1) == "2022WW53"
    assert cal.shift_week("2022WW52", 2) == "2023WW01"
    r = spark.range(1).select(cal.week_start(F.lit(2020), F.lit(1)).alias("s"), cal.week_end(F.lit(2020), F.lit(1)).alias("e"),
                              cal.week_start(F.lit(2021), F.lit(53)).alias("none")).first()
    assert (r.s, r.e, r.none) == (dt.date(2019, 12, 29), dt.date(2020, 1, 4), None)
