"""Property tests on random inputs: Spark expressions vs plain-Python statements of the rules."""

import datetime as dt
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from toolwatch.functions import calendar as cal
from toolwatch.functions import classify as cls


def _python_week(d: dt.date) -> str:
    # The fiscal year ends on the last Saturday of December; weeks run Sunday..Saturday.
    def last_saturday(y):
        x = dt.date(y, 12, 31)
        while x.weekday() != 5:
            x -= dt.timedelta(days=1)
        return x

    fy = d.year + 1 if d > last_saturday(d.year) else d.year
    doy = (d - last_saturday(fy - 1)).days
    return f"{fy}WW{(doy - 1) // 7 + 1:02d}"


@settings(max_examples=60, deadline=None)
@given(st.lists(st.dates(min_value=dt.date(1901, 1, 1), max_value=dt.date(2199, 12, 31)), min_size=1, max_size=40))
def test_week_label_random_dates(spark, dates):
    df = spark.createDataFrame([(d,) for d in dates], "d date")
    got = [r.w for r in df.select(cal.work_week("d").alias("w")).collect()]
    assert got == [_python_week(d) for d in dates]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="0123456789Wwn x", min_size=0, max_size=12), min_size=1, max_size=30))
def test_parse_random_strings(spark, labels):
    df = spark.createDataFrame([(s,) for s in labels], "s string")
    y, w = cal.parse_work_week("s")
    got = [(r.y, r.w) for r in df.select(y.alias("y"), w.alias("w")).collect()]
    exp = []
    for s in labels:
        m = re.match(r"^(\d{4})WW(\d{2})", s)
        exp.append((int(m.group(1)), int(m.group(2))) if m else (None, None))
    assert got == exp


def _python_timing(actual, target):
    if actual is None or target is None or target <= 0:
        return "Unknown"
    p = (actual - target) / target * 100.0
    if p < -15:
        return "Early"
    if -15 <= p <= 15:
        return "On-Time"
    if 15 < p <= 30:
        return "Late"
    if p > 30:
        return "Overdue"
    return "On-Time"


finite = st.one_of(st.none(), st.floats(min_value=-1e6, max_value=1e6, allow_nan=False))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(finite, finite), min_size=1, max_size=40))
def test_timing_random(spark, pairs):
    df = spark.createDataFrame(pairs, "a double, t double")
    got = [r.c for r in df.select(cls.timing_class(cls.life_vs_target_pct("a", "t")).alias("c")).collect()]
    assert got == [_python_timing(a, t) for a, t in pairs]
