"""Work-week calendar as pure column expressions.

The fiscal year ends on the last Saturday of December; the next fiscal year
starts on the following Sunday.  Equivalently: a date belongs to the week that
closes on the next Saturday (inclusive), and that Saturday's calendar year and
Saturday count are the fiscal year and week.  Weeks run Sunday..Saturday, week number is
``(day_of_fiscal_year - 1) div 7 + 1`` (1..53) and the label is ``YYYYWWnn``.

Everything is a short closed form over ``date_add``/``dayofweek``/``dayofyear``
so it stays small inside whole-stage codegen even when Catalyst inlines it into
pushed-down filters; no calendar table is needed to label events
(the date dimension in ``operators.dims`` is built from the same expressions).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Label format and the work-week pattern accepted by the parser.
WEEK_SEPARATOR = "WW"
WORK_WEEK_PATTERN = r"^(\d{4})WW(\d{2})"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def fy_end(year) -> Column:
    """Last Saturday of December of ``year`` (a DATE)."""
    y = _c(year)
    dec31 = F.make_date(y, F.lit(12), F.lit(31))
    # dayofweek: Sunday=1 .. Saturday=7, so pmod(dow, 7) = days since Saturday.
    return F.date_sub(dec31, F.pmod(F.dayofweek(dec31), F.lit(7)))


def week_saturday(d) -> Column:
    """The Saturday that closes the Sunday..Saturday week containing ``d``."""
    d = F.to_date(_c(d))
    return F.date_add(d, 7 - F.dayofweek(d))


def fiscal_year(d) -> Column:
    """Fiscal year of ``d``.

    Every Saturday of calendar year Y lies in fiscal year Y (the year ends on
    the last Saturday of December and weeks never straddle years), so the
    fiscal year is the calendar year of the week's closing Saturday.
    """
    return F.year(week_saturday(d)).cast("int")


def fiscal_week(d) -> Column:
    """Week number 1..53: the closing Saturday is the k-th Saturday of its year."""
    return F.floor((F.dayofyear(week_saturday(d)) + 6) / 7).cast("int")


def fiscal_day_of_year(d) -> Column:
    """Day 1 is the Sunday the fiscal year starts on."""
    return ((fiscal_week(d) - 1) * 7 + F.dayofweek(F.to_date(_c(d)))).cast("int")


def week_label(year, week) -> Column:
    return F.concat(_c(year).cast("string"), F.lit(WEEK_SEPARATOR), F.lpad(_c(week).cast("string"), 2, "0"))


def work_week(d) -> Column:
    """``YYYYWWnn`` label of the fiscal week containing ``d``."""
    return week_label(fiscal_year(d), fiscal_week(d))


def parse_work_week(ww) -> tuple[Column, Column]:
    """(year, week) from the leading ``YYYYWWnn`` of a string; null when absent.

    Trailing characters are ignored (``2025WW22nn`` parses), short years do not.
    """
    s = _c(ww)
    year = F.nullif(F.regexp_extract(s, WORK_WEEK_PATTERN, 1), F.lit("")).try_cast("int")
    week = F.nullif(F.regexp_extract(s, WORK_WEEK_PATTERN, 2), F.lit("")).try_cast("int")
    return year, week


def fiscal_quarter(week) -> Column:
    """13 weeks per quarter; week 53 falls in quarter 5 (kept from the original rule)."""
    return (F.floor((_c(week) - 1) / 13) + 1).cast("int")


def fiscal_month(week) -> Column:
    """4 weeks per month; weeks 49-52 give month 13 and week 53 month 14."""
    return (F.floor((_c(week) - 1) / 4) + 1).cast("int")


def weeks_in_year(year) -> Column:
    y = _c(year)
    return (F.datediff(fy_end(y), fy_end(y - 1)) / 7).cast("int")


def week_start(year, week) -> Column:
    """First day (Sunday) of a fiscal week; null for weeks the year does not have."""
    y, w = _c(year), _c(week)
    start = F.date_add(fy_end(y - 1), ((w - 1) * 7 + 1).cast("int"))
    return F.when((w >= 1) & (w <= weeks_in_year(y)), start)


def week_end(year, week) -> Column:
    return F.date_add(week_start(year, week), 6)


# ---- driver-side scalar helpers (used to build literal parameters, never per row)


def _fy_end_py(y: int) -> _dt.date:
    dec31 = _dt.date(y, 12, 31)
    # Python weekday: Monday=0 .. Sunday=6; Saturday=5.
    return dec31 - _dt.timedelta(days=(dec31.weekday() - 5) % 7)


def work_week_of(d: _dt.date) -> str:
    """Label for one date (the scalar twin of ``work_week``)."""
    if isinstance(d, _dt.datetime):
        d = d.date()
    fy = d.year + 1 if d > _fy_end_py(d.year) else d.year
    doy = (d - _fy_end_py(fy - 1)).days
    return f"{fy}{WEEK_SEPARATOR}{(doy - 1) // 7 + 1:02d}"


def parse_week_label(ww: str) -> tuple[int, int]:
    """Strict scalar parser: raises on a malformed label (the column form returns null)."""
    import re

    m = re.match(WORK_WEEK_PATTERN, ww or "")
    if not m:
        raise ValueError(f"invalid work week: {ww!r}")
    return int(m.group(1)), int(m.group(2))


def week_range_of(ww: str) -> tuple[_dt.date, _dt.date]:
    """(first day, last day) of a labelled week; raises for a week the year lacks."""
    y, w = parse_week_label(ww)
    n = (_fy_end_py(y) - _fy_end_py(y - 1)).days // 7
    if not 1 <= w <= n:
        raise ValueError(f"week {ww} not in fiscal year {y} ({n} weeks)")
    start = _fy_end_py(y - 1) + _dt.timedelta(days=(w - 1) * 7 + 1)
    return start, start + _dt.timedelta(days=6)


def shift_week(ww: str, weeks: int) -> str:
    """Label ``weeks`` weeks after (negative: before) ``ww``; correct across 53-week years."""
    start, _ = week_range_of(ww)
    return work_week_of(start + _dt.timedelta(days=7 * weeks))
