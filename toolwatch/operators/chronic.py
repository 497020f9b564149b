"""Chronic-tool scoring.

A tool is (entity, facility, ceid); its class is an attribute, that of its latest
event (a class changes between loads, the tool does not).  Metrics are one ``groupBy().agg()`` with
only algebraic aggregates (count/sum/avg/stddev), so the map side pre-aggregates
and a hot tool costs one partial buffer per task, never a gathered group.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from toolwatch.functions import calendar as cal
from toolwatch.functions import classify as cls
from toolwatch.functions.agg import EXACT, MOST, exact_sum0
from toolwatch.operators.joins import scalar
from toolwatch.rules import DEFAULT_RULES, Rules

TOOL_KEYS = ("entity", "facility", "ceid")
WEEK_KEYS = ("ww_year", "ww_number")


def _not_null(df: DataFrame, keys) -> DataFrame:
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return df.filter(cond) if cond is not None else df


def tool_metrics(enriched: DataFrame, keys=TOOL_KEYS) -> DataFrame:
    """Per-group class, event counts, downtime, life spread and label rates (null keys dropped).

    Events without times have no latest one: the class is then the last by name.
    Groups without a week are told by a count and dropped afterwards: a filter of events by
    the parsed week goes below the parsing, which every event then goes through twice and more.
    """
    latest = F.struct(*[c for c in ("event_ts", "process_class") if c in enriched.columns])
    weeks = [k for k in keys if k in (*WEEK_KEYS, "work_week")]
    placed = [F.col(k).isNotNull() for k in weeks]
    metrics = _not_null(enriched, [k for k in keys if k not in weeks]).groupBy(*keys).agg(
        F.max_by("process_class", latest).alias("process_class"),
        F.count(F.lit(1)).alias("total_pm_events"),
        F.sum(F.when(F.col("scheduled_flag") == 0, 1).otherwise(0)).cast("long").alias("unscheduled_pm_count"),
        exact_sum0("down_hours").alias("total_downtime_hours"),
        F.stddev_samp("actual_life").alias("life_stddev"),
        F.avg("actual_life").alias("avg_pm_life"),
        F.avg("reclean").alias("reclean_rate"),
        F.avg("sympathy").alias("sympathy_pm_rate"),
        *([F.count(F.when(functools.reduce(Column.__and__, placed), 1)).alias("_placed")] if weeks else []),
    )
    return metrics.filter(F.col("_placed") > 0).drop("_placed") if weeks else metrics


def tool_week_partials(enriched: DataFrame, keys=TOOL_KEYS) -> DataFrame:
    """One row per tool and week that can be added up to the tool's metrics over any weeks.

    Counts and exact sums add; a spread is kept as number, mean and sum of squared
    differences from the mean, which merge without cancellation.  Rows without a tool or a
    week have rows of their own, so that the first and last dates are those of all events.
    """
    v = F.nanvl(F.col("down_hours").cast("double"), F.lit(None).cast("double"))
    small = F.abs(v) < MOST
    day = F.to_date("event_ts")
    return enriched.groupBy(*keys, *WEEK_KEYS).agg(
        F.max(F.struct("event_ts", "process_class")).alias("last"),
        F.count(F.lit(1)).alias("events"),
        F.sum(F.when(F.col("scheduled_flag") == 0, 1).otherwise(0)).cast("long").alias("unscheduled"),
        F.sum(F.when(small, v).cast(EXACT)).alias("hours"),
        F.sum(F.when(~small, v)).alias("hours_beyond"),
        F.count("actual_life").alias("life_n"),
        F.avg("actual_life").alias("life_mean"),
        (F.var_pop("actual_life") * F.count("actual_life")).alias("life_m2"),
        *[f(c).alias(f"{c}_{n}") for c in ("reclean", "sympathy") for n, f in (("n", F.count), ("sum", F.sum))],
        F.min(day).alias("first_date"),
        F.max(day).alias("last_date"),
    )


def _merged_spread(parts: Column) -> Column:
    """(n, mean, m2) of an array of such parts, added in the order of their weeks."""

    def add(a: Column, x: Column) -> Column:
        n = a["n"] + x["life_n"]
        d = x["life_mean"] - a["mean"]
        mean = a["mean"] + d * x["life_n"] / n
        return F.struct(n.alias("n"), mean.alias("mean"), (a["m2"] + x["life_m2"] + d * d * a["n"] * x["life_n"] / n).alias("m2"))

    none = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))
    return F.aggregate(F.array_sort(parts), none, add)


def merged_metrics(partials: DataFrame, keys=TOOL_KEYS) -> DataFrame:
    """``tool_metrics`` of the events behind the partials: a row per week and tool is read, no event.

    The parts of a tool's spread are gathered, one for each week it was active in.
    """
    part = F.struct(*WEEK_KEYS, "life_n", "life_mean", "life_m2")
    whole = _not_null(partials, keys).groupBy(*keys).agg(
        F.max("last").alias("last"),
        F.sum("events").alias("total_pm_events"),
        F.sum("unscheduled").alias("unscheduled_pm_count"),
        F.sum("hours").cast("double").alias("hours"),
        F.sum("hours_beyond").alias("hours_beyond"),
        _merged_spread(F.collect_list(F.when(F.col("life_n") > 0, part))).alias("life"),
        *[F.try_divide(F.sum(f"{c}_sum"), F.sum(f"{c}_n")).cast("double").alias(f"{c}_rate") for c in ("reclean", "sympathy")],
    )
    return whole.select(
        *keys,
        F.col("last.process_class").alias("process_class"),
        "total_pm_events",
        "unscheduled_pm_count",
        F.coalesce(F.col("hours") + F.col("hours_beyond"), "hours", "hours_beyond", F.lit(0.0)).alias("total_downtime_hours"),
        F.when(F.col("life.n") > 1, F.sqrt(F.col("life.m2") / (F.col("life.n") - 1))).alias("life_stddev"),
        F.when(F.col("life.n") > 0, F.col("life.mean")).alias("avg_pm_life"),
        "reclean_rate",
        F.col("sympathy_rate").alias("sympathy_pm_rate"),
    )


def chronic_from_partials(partials: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """``chronic_tools`` with the analysis period, from stored partials."""
    return _with_period(score_tools(merged_metrics(partials), rules), partials, F.col("first_date"), F.col("last_date"))


def score_tools(metrics: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    m = metrics.withColumns(
        {
            "unscheduled_pm_rate": F.col("unscheduled_pm_count") / F.col("total_pm_events"),
            "avg_downtime_hours_per_pm": F.col("total_downtime_hours") / F.col("total_pm_events"),
            "life_cv": cls.life_cv("life_stddev", "avg_pm_life"),
        }
    )
    m = m.withColumn(
        "chronic_score",
        cls.chronic_score(
            "unscheduled_pm_rate", "life_cv", "avg_downtime_hours_per_pm", "reclean_rate", "sympathy_pm_rate", rules
        ),
    ).withColumn("chronic_flag", cls.chronic_flag("total_pm_events", "unscheduled_pm_rate", "life_cv", rules))
    return m.withColumn("chronic_severity", cls.severity("chronic_flag", "chronic_score", rules))


def chronic_tools(enriched: DataFrame, rules: Rules = DEFAULT_RULES, keys=TOOL_KEYS) -> DataFrame:
    """One scored row per tool over all the events given."""
    return score_tools(tool_metrics(enriched, keys), rules)


def with_analysis_period(chronic: DataFrame, enriched: DataFrame) -> DataFrame:
    """Stamp the global first/last event date and whole weeks between them.

    Both dates come from one scalar subquery over the events (a one-row job),
    not a join, so the chronic table keeps its partitioning.
    """
    return _with_period(chronic, enriched, F.to_date("event_ts"), F.to_date("event_ts"))


def _with_period(chronic: DataFrame, rows: DataFrame, first: Column, last: Column) -> DataFrame:
    period = scalar(rows, F.struct(F.min(first).alias("lo"), F.max(last).alias("hi")))
    # Attach the subquery once and derive from the column: each textual use of
    # a scalar subquery would otherwise be planned (and run) separately.
    start, end = F.col("_period.lo"), F.col("_period.hi")
    return (
        chronic.withColumn("_period", period)
        .withColumns(
            {
                "analysis_start_date": start,
                "analysis_end_date": end,
                "weeks_analyzed": F.floor(F.datediff(end, start) / 7).cast("int"),
            }
        )
        .drop("_period")
    )


def chronic_snapshots(enriched: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Chronic table computed once per fiscal year, stamped with the year's last day.

    Models a table appended to by yearly runs; ``chronic_current`` reads back the
    latest snapshot.
    """
    keys = (*TOOL_KEYS, "ww_year")
    s = chronic_tools(enriched, rules, keys)
    return s.withColumn("calculation_date", cal.fy_end(F.col("ww_year")))


def chronic_current(snapshots: DataFrame) -> DataFrame:
    """Flagged tools of the latest snapshot (max taken as a scalar subquery)."""
    latest = scalar(snapshots, F.max("calculation_date"))
    return snapshots.filter((F.col("calculation_date") == latest) & (F.col("chronic_flag") == 1))


def weekly_scores(enriched: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """One scored row per tool and week."""
    return score_tools(tool_metrics(enriched, (*TOOL_KEYS, *WEEK_KEYS, "work_week")), rules)


def with_changes(scores: DataFrame) -> DataFrame:
    """Add the change of score and status from the tool's previous row (0 at its first).

    The window is partitioned by tool over already-aggregated weekly rows, so a
    partition holds at most one row per week the tool was serviced.
    """
    win = Window.partitionBy(*TOOL_KEYS).orderBy(*WEEK_KEYS)
    prev_score = F.lag("chronic_score").over(win)
    prev_flag = F.lag("chronic_flag").over(win)
    first = F.row_number().over(win) == 1
    return scores.withColumns(
        {
            "chronic_score_change": F.when(first, F.lit(0.0)).otherwise(F.col("chronic_score") - prev_score),
            "status_changed": F.when(first, F.lit(0)).when(F.col("chronic_flag") != prev_flag, F.lit(1)).otherwise(F.lit(0)),
        }
    )


def chronic_weekly(enriched: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Week-by-week chronic status per tool with the change from its previous active week."""
    return with_changes(weekly_scores(enriched, rules))


def chronic_weekly_update(scores: DataFrame, stored: DataFrame, weeks: list[tuple[int, int]]) -> tuple[DataFrame, list[tuple[int, int]]]:
    """Rows of every week of a stored history that new ``scores`` of ``weeks`` change, and those weeks.

    A rebuilt week changes itself and, for each tool it has or had, the next week the tool
    was active in.  Of the stored rows only those tools' are compared; other tools'
    rows of a next week are carried over.  The result is all rows of the weeks returned,
    equal to what a run over the whole history gives; a week without rows is to be emptied.
    """
    if not weeks:
        return with_changes(scores.limit(0)), []
    columns = scores.columns
    keys = [*TOOL_KEYS, *WEEK_KEYS]
    in_weeks = F.struct(*[F.col(k).cast("int") for k in WEEK_KEYS]).isin([F.struct(F.lit(int(y)), F.lit(int(w))) for y, w in weeks])
    others, before = stored.filter(~in_weeks), stored.filter(in_weeks)
    if others.isEmpty():
        # No week is stored beside these: none can follow them, and the events need not be scored twice.
        return with_changes(scores).filter(in_weeks), sorted({(int(y), int(w)) for y, w in weeks})
    places = scores.select(keys).union(before.select(keys)).distinct()
    tools = places.select(*TOOL_KEYS).distinct()
    own = others.join(tools, list(TOOL_KEYS), "left_semi").select(columns)
    win = Window.partitionBy(*TOOL_KEYS).orderBy(*WEEK_KEYS)
    follows = places.union(own.select(keys)).withColumn("_prev", F.lag(in_weeks).over(win))
    after = follows.filter(F.col("_prev") & ~in_weeks).select(*WEEK_KEYS).distinct()
    next_weeks = [(r.ww_year, r.ww_number) for r in after.collect()]  # bounded by the calendar
    touched = sorted({(int(y), int(w)) for y, w in [*weeks, *next_weeks]})
    in_touched = F.struct(*[F.col(k).cast("int") for k in WEEK_KEYS]).isin([F.struct(F.lit(y), F.lit(w)) for y, w in touched])
    rows = with_changes(scores.unionByName(own)).filter(in_touched)
    carried = others.filter(in_touched).join(tools, list(TOOL_KEYS), "left_anti").select(rows.columns)
    return rows.unionByName(carried), touched


def chronic_entities(chronic: DataFrame) -> DataFrame:
    """Distinct entities flagged chronic in a chronic table."""
    return chronic.filter(F.col("chronic_flag") == 1).select("entity").distinct()
