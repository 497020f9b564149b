"""Batch jobs: bronze (ingest), silver (enrich + summaries), gold (facts), full pipeline.

Each job is a handful of lazy plans and one write per table.  The driver
only lists files, picks paths and collects per-job statistics; all row work
runs in tasks.  What a layer has still to do is written down before the rows that
cause it (``pending_weeks``) and crossed out after it is done, and a load counts only
once its rows are complete (``loads``): a run that dies is finished by the next one.  Tables are parquet partitioned by week, so reruns rewrite
only the weeks they touch.
"""

from __future__ import annotations

import datetime as _dt
import logging
import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from toolwatch import sinks
from toolwatch.functions import calendar as cal
from toolwatch.functions.agg import count_if
from toolwatch.functions.literals import ts_lit
from toolwatch.operators import chronic as chr_
from toolwatch.operators import dims, kpis, rolling
from toolwatch.operators.enrich import dedupe_class_dimension, enrich, project_enriched
from toolwatch.rules import DEFAULT_RULES, Rules
from toolwatch.sources import files, scans

log = logging.getLogger(__name__)

WEEK_PARTS = ("ww_year", "ww_number")
# Minimum writers per week partition for fine-grained facts (tool/part x week
# grain); AQE splits larger weeks further through the rebalance hint.
FACT_SPREAD = 1
FACT_ORDER = ("facility", "ww_year", "ww_number")
# Facts that gold builds side by side.
FACTS_AT_ONCE = 2
# Columns whose null share is reported after ingest.
CRITICAL_RAW_COLUMNS = ("ENTITY", "FACILITY", "CEID", "YEARWW", "TXN_DATE", "DOWNTIME_TYPE", "CUSTOM_DELTA", "Median_Delta")


@dataclass(frozen=True)
class Layout:
    """Table locations under one warehouse folder (shared storage on a cluster)."""

    root: str

    def _p(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    raw = property(lambda s: s._p("raw_events"))
    load_log = property(lambda s: s._p("load_log"))
    loads = property(lambda s: s._p("loads"))
    load_files = property(lambda s: s._p("load_files"))
    pending = property(lambda s: s._p("pending_weeks"))
    enriched = property(lambda s: s._p("enriched_events"))
    summary = property(lambda s: s._p("downtime_summary"))
    tool_weeks = property(lambda s: s._p("tool_week_partials"))
    chronic = property(lambda s: s._p("chronic_tools"))
    date_dim = property(lambda s: s._p("dim_date"))
    site = property(lambda s: s._p("fact_site_week"))
    site_rolled = property(lambda s: s._p("fact_site_week_rolled"))
    ceid = property(lambda s: s._p("fact_ceid_week"))
    part = property(lambda s: s._p("fact_part_week"))
    history = property(lambda s: s._p("fact_chronic_history"))

    #: Tables that a complete run of all layers leaves.
    EXPECTED = ("raw", "load_log", "loads", "load_files", "pending", "enriched", "summary", "tool_weeks", "chronic", "date_dim",
                "site", "site_rolled", "ceid", "part", "history")

    def missing(self, spark: SparkSession) -> list[str]:
        """Expected tables that are not there."""
        return [name for name in self.EXPECTED if not sinks.table_exists(spark, getattr(self, name))]

    def finish(self, spark: SparkSession) -> None:
        """Complete replacements of tables that an earlier run has left half done."""
        for path in (self.enriched, self.summary, self.tool_weeks, self.chronic, self.site, self.site_rolled, self.ceid, self.part, self.history):
            sinks.finish(spark, path)


# ---------------------------------------------------------------- bronze


def bronze(
    spark: SparkSession,
    source_root: str,
    layout: Layout,
    work_week: str | None = None,
    max_weeks_back: int = 4,
    class_dim: DataFrame | None = None,
    as_of: _dt.datetime | None = None,
    validate: bool = True,
    rules: Rules = DEFAULT_RULES,
) -> dict:
    """Find the week's files, clean and type them, tag them, append each once.

    Every non-empty file of the week (default: of the newest week that has one) is
    taken.  Files already in the raw table through a completed load are left out, so
    rerunning the job does not duplicate rows; a file whose load died is loaded again, and
    one delivered anew under its old name takes the place of what was loaded before.
    A failure is logged and raised.
    """
    t0 = time.perf_counter()
    as_of = as_of or _dt.datetime.now()

    def logged(path: str | None, week: str | None, rows: int, status: str, error: str | None = None) -> None:
        sinks.append_load_log(spark, layout.load_log, source_file=path, source_week=week, rows_loaded=rows, status=status,
                              error=error, seconds=time.perf_counter() - t0, layer="BRONZE", at=as_of)

    paths: list[str] = []
    week = work_week
    try:
        if work_week:
            paths = files.find_files_for_week(spark, source_root, work_week)
        else:
            paths, week = files.find_latest_files(spark, source_root, max_weeks_back=max_weeks_back)
        found = changed_files(spark, paths, layout)
        new = [p for p, n, t in found]
        for p in paths:
            if p not in new:
                logged(p, week, 0, "SKIPPED")
        if not new:
            return {"status": "SKIPPED", "file": paths[0], "files": paths, "work_week": week, "rows_loaded": 0}
        stats = ingest_files(spark, new, layout, week, class_dim, as_of, validate, rules, identities=found)
    except Exception as e:
        logged(paths[0] if paths else None, week, 0, "FAILED", str(e)[:2000])
        raise
    stats["seconds"] = time.perf_counter() - t0
    logged(new[0] if len(new) == 1 else f"{new[0]} and {len(new) - 1} more", week, stats["rows_loaded"], "SUCCESS")
    return {"status": "SUCCESS", "file": new[0], "files": new, "work_week": week, **stats}


def changed_files(spark: SparkSession, paths: list[str], layout: Layout) -> list[tuple[str, int, _dt.datetime]]:
    """(path, length, modification time) of the files that no completed load holds in this version.

    A file loaded before versions were noted counts as loaded.
    """
    found = files.identities(spark, paths)
    committed = sinks.committed_loads(spark, layout.loads, "RAW")
    versions = sinks.file_versions(spark, layout.load_files, committed)
    held = {}
    if versions is not None:
        rows = versions.filter("current").filter(F.col("path").isin(paths)).collect()
        held = {r.path: (r.length, r.modified) for r in rows}
    unknown = [p for p, _, _ in found if p not in held]
    if unknown and sinks.has_files(spark, layout.raw):
        raw = spark.read.parquet(layout.raw)
        if "load_id" in raw.columns:
            # Only loads from before versions were noted are searched by their rows.
            known = set() if versions is None else {r.load_id for r in versions.select("load_id").distinct().collect()}
            old = sorted(committed - known)
            raw = raw.filter(F.col("load_id").isin(old)) if old else None
        if raw is not None:
            noted = {p: (n, t) for p, n, t in found}
            rows = raw.filter(F.col("source_file").isin(unknown)).select("source_file").distinct()
            held |= {r.source_file: noted[r.source_file] for r in rows.collect()}
    return [(p, n, t) for p, n, t in found if held.get(p) != (n, t)]


def _committed_rows(spark: SparkSession, layout: Layout) -> DataFrame:
    """Raw rows of completed loads, without those of files that a later load holds in another version.

    All rows, of a table written before loads had ids.
    """
    raw = spark.read.parquet(layout.raw)
    if "load_id" not in raw.columns:
        return raw
    committed = sinks.committed_loads(spark, layout.loads, "RAW")
    raw = raw.filter(F.col("load_id").isin(sorted(committed)))
    versions = sinks.file_versions(spark, layout.load_files, committed)
    if versions is None:
        return raw
    old = versions.filter(~F.col("current")).select(F.col("path").alias("source_file"), "load_id")
    return raw.join(old, ["source_file", "load_id"], "left_anti")


def _retired(spark: SparkSession, layout: Layout, loads: set[str]) -> list[tuple[str, str]]:
    """(path, load) of the versions that files of these loads take the place of: as many as files were corrected."""
    versions = sinks.file_versions(spark, layout.load_files, sinks.committed_loads(spark, layout.loads, "RAW"))
    if versions is None:
        return []
    own = versions.filter("current").filter(F.col("load_id").isin(sorted(loads))).select("path")
    return sorted((r.path, r.load_id) for r in versions.filter(~F.col("current")).join(own, "path", "left_semi").select("path", "load_id").collect())


def ingest_files(
    spark: SparkSession,
    paths: list[str],
    layout: Layout,
    work_week: str | None = None,
    class_dim: DataFrame | None = None,
    as_of: _dt.datetime | None = None,
    validate: bool = True,
    rules: Rules = DEFAULT_RULES,
    null_action: str = "warn",
    encoding: str | None = None,
    identities: list[tuple[str, int, _dt.datetime]] | None = None,
    load_id: str | None = None,
    before_commit: Callable[[], None] | None = None,
) -> dict:
    """Read, validate, type, tag and append weekly files in one distributed job.

    The rows count from the commit on; from then on they also take the place of rows of
    the same files in earlier loads.  ``identities``: the files' versions, if they are
    known.  ``load_id``: a name for the load that no other attempt has.
    ``before_commit`` is called when the rows are written and not yet committed.

    ``null_action``: what a critical column with more than the rule's null
    share does -- ``warn`` (log and report) or ``fail`` (raise before the load is
    committed: its rows stay in the table for inspection, but no layer takes them).

    ``work_week`` stamps every row; when omitted each row takes the week from
    its file's folder.
    """
    as_of = as_of or _dt.datetime.now()
    raw = files.read_event_csv(spark, paths, encoding)
    if validate:
        files.validate_columns(raw)  # names as delivered, before renaming
    raw = files.rename_special(raw)
    raw = files.add_load_metadata(raw, as_of, work_week)
    raw = files.coerce_raw(raw)
    if class_dim is not None:
        raw = raw.join(dedupe_class_dimension(class_dim).withColumnRenamed("entity", "ENTITY"), "ENTITY", "left")
    raw = raw.withColumn("process_class", F.coalesce(F.col("process_class") if "process_class" in raw.columns else F.lit(None), F.lit("UNKNOWN")))
    load_id = load_id or uuid.uuid4().hex
    raw = files.with_row_id(raw).withColumn("load_id", F.lit(load_id))
    # Null profile of the critical columns measured by the write job itself (no second scan).
    crit = [c for c in CRITICAL_RAW_COLUMNS if c in raw.columns]
    prof = Observation("null_profile")
    raw = raw.observe(prof, F.count(F.lit(1)).alias("_n"), *[count_if(F.col(c).isNull()).alias(c) for c in crit])
    rows = sinks.write_table(raw, layout.raw, "append", partition_by=("source_week",))
    if rows == 0:
        raise ValueError(f"empty input: {paths[:3]}")
    m = prof.get
    warn = [c for c in crit if m.get("_n") and (m.get(c) or 0) * 100.0 / m["_n"] > rules.null_pct_warning]
    if warn:
        log.warning("columns more than half null: %s", warn)
        if null_action == "fail":
            raise ValueError(f"columns above the null threshold: {warn}")
    if before_commit is not None:
        before_commit()
    sinks.record_files(spark, layout.load_files, load_id, identities or files.identities(spark, paths))
    sinks.commit_loads(spark, layout.loads, "RAW", [load_id], as_of)
    return {"rows_loaded": rows, "null_warnings": warn, "load_id": load_id}


# ---------------------------------------------------------------- silver


def silver(
    spark: SparkSession,
    layout: Layout,
    start: _dt.datetime | None = None,
    end: _dt.datetime | None = None,
    incremental: bool = True,
    full_refresh: bool = False,
    rules: Rules = DEFAULT_RULES,
    as_of: _dt.datetime | None = None,
    build_summary: bool = True,
    since: _dt.datetime | None = None,
) -> dict:
    """Enrich new raw rows, then recompute the summary for touched weeks and the chronic snapshot.

    New are the rows of loads that are complete in the raw table and not yet here;
    their weeks are recorded as pending for the summary and for gold before they are
    written.  The ids already enriched are read only from those weeks, so that a rerun
    after a failure adds nothing twice.  The summary and the snapshot are built for all
    pending weeks, also when no row is new.  ``weeks`` of the result are those gold has
    still to build.  ``since``: only raw rows loaded after this time.  With ``start`` or
    ``end`` loads count as unfinished, and later runs look at them again.
    ``full_refresh`` rewrites the enriched table, the snapshots and the summary whole.
    """
    if full_refresh and (start is not None or end is not None):
        raise ValueError("full_refresh rewrites whole tables: it cannot be limited to a date range")
    t0 = time.perf_counter()
    as_of = as_of or _dt.datetime.now()
    run = uuid.uuid4().hex
    layout.finish(spark)
    table = _committed_rows(spark, layout)
    has_ids = "load_id" in table.columns
    loads = sinks.committed_loads(spark, layout.loads, "RAW")
    fresh = incremental and not full_refresh and sinks.has_files(spark, layout.enriched)
    if has_ids and fresh:
        loads -= sinks.committed_loads(spark, layout.loads, "ENRICHED")
        table = table.filter(F.col("load_id").isin(sorted(loads)))
    raw = scans.date_range(files.to_events(table), "event_ts", start, end)
    if since is not None and not full_refresh:
        raw = raw.filter(F.col("load_ts") > ts_lit(since))
    y, w = cal.parse_work_week("work_week")
    # Labels are parsed once each, not once a row; both sets are bounded by the calendar.
    in_weeks = lambda rows: {(r.y, r.w) for r in rows.select("work_week").distinct().select(y.alias("y"), w.alias("w")).distinct().collect()}
    found = in_weeks(raw)
    retired = _retired(spark, layout, loads) if has_ids and fresh and loads else []
    left: set = set()
    if retired:
        gone = spark.read.parquet(layout.raw).filter(F.struct("source_file", "load_id").isin([F.struct(F.lit(p), F.lit(i)) for p, i in retired]))
        left = in_weeks(files.to_events(gone))
    weeks = sorted((int(a), int(b)) for a, b in found | left if a is not None and b is not None)
    sinks.add_pending(spark, layout.pending, run, ("SUMMARY", "GOLD"), weeks)
    # Weeks that could not be told are week 0 of year 0 here.
    sinks.add_pending(spark, layout.pending, run, ("TOOLS",), sorted({(a or 0, b or 0) if a and b else (0, 0) for a, b in found | left}))
    n = 0
    if retired:
        # Rows of the replaced versions go from the weeks they stood in; the new versions' rows follow like any other.
        paths = sorted({p for p, _ in retired})
        whole = scans.weeks_filter(spark.read.parquet(layout.enriched), left)
        path_of = F.regexp_replace("pm_raw_id", "#-?[0-9]+$", "")
        sinks.replace_weeks(whole.filter(~F.coalesce(path_of.isin(paths), F.lit(False))), layout.enriched, sorted(left, key=str))
    if found:
        if fresh and sinks.has_files(spark, layout.enriched):
            processed = scans.weeks_filter(spark.read.parquet(layout.enriched), found)
            raw = _not_enriched(raw, processed)
        enriched = project_enriched(enrich(raw, rules, None, as_of), extra=("pm_raw_id",))
        if full_refresh:
            n = sinks.replace_all(enriched, layout.enriched, partition_by=WEEK_PARTS)
        else:
            n = sinks.write_table(enriched, layout.enriched, "append", partition_by=WEEK_PARTS)
    if has_ids and start is None and end is None and since is None:
        sinks.commit_loads(spark, layout.loads, "ENRICHED", sorted(loads), as_of)

    todo = sinks.pending_weeks(spark, layout.pending, "SUMMARY")
    changed = sinks.pending_weeks(spark, layout.pending, "TOOLS")
    n_chr = n_sum = 0
    if sinks.has_files(spark, layout.enriched) and (n or todo or changed or full_refresh):
        all_ev = spark.read.parquet(layout.enriched)
        snapshot = f"s{as_of:%Y%m%dT%H%M%S}"
        _refresh_partials(spark, layout, changed, full_refresh)
        if start is None and end is None:
            chronic = chr_.chronic_from_partials(spark.read.parquet(layout.tool_weeks), rules)
        else:
            scope = scans.date_range(all_ev, "event_ts", start, end)
            chronic = chr_.with_analysis_period(chr_.chronic_tools(scope, rules), scope)
        chronic = chronic.withColumns({"calculation_ts": ts_lit(as_of), "snapshot": F.lit(snapshot)})
        if full_refresh:
            n_chr = sinks.replace_all(chronic, layout.chronic, partition_by=("snapshot",))
        else:
            # A rerun under the same stamp replaces its snapshot.
            n_chr = sinks.write_table(chronic, layout.chronic, "replace", partition_by=("snapshot",))
        if build_summary:
            current = spark.read.parquet(layout.chronic).filter(F.col("snapshot") == snapshot)
            own = sorted({(a, b) for _, a, b in todo})
            touched = all_ev if full_refresh else scans.weeks_filter(all_ev, own)
            summary = kpis.downtime_summary(touched, current).withColumn("calculated_at", ts_lit(as_of))
            if full_refresh:
                n_sum = sinks.replace_all(summary, layout.summary, WEEK_PARTS, cluster=True, spread=FACT_SPREAD)
            else:
                n_sum = sinks.write_table(summary, layout.summary, "replace", partition_by=WEEK_PARTS, cluster=True, spread=FACT_SPREAD, covering=own)
            sinks.clear_pending(spark, layout.pending, "SUMMARY", todo)

    if n and not sinks.table_exists(spark, layout.date_dim):
        year = as_of.year
        sinks.write_table(dims.date_dimension(spark, year - 2, 5), layout.date_dim, "fail", partition_by=("fiscal_year",))
    waiting = sorted({(a, b) for _, a, b in sinks.pending_weeks(spark, layout.pending, "GOLD")})
    return {"status": "SUCCESS" if n else "NO_DATA", "rows_enriched": n, "summary_rows": n_sum, "chronic_rows": n_chr,
            "weeks": waiting, "seconds": time.perf_counter() - t0}


#: Files whose ids are searched by name; of more, all ids of the weeks are.
FILES_BY_NAME = 1000


def _not_enriched(raw: DataFrame, processed: DataFrame) -> DataFrame:
    """Raw rows whose id is not among the enriched ones.

    An id begins with its file.  Enriched rows of the files to be taken are there only after a run
    that died between its write and its commit, so only the files are compared first, and
    the ids of those that are on both sides are searched.
    """
    file_of = F.substring_index("pm_raw_id", "#", 1)
    begun = raw.select(file_of.alias("f")).intersect(processed.select(file_of.alias("f")))
    both = [r.f for r in begun.filter("f IS NOT NULL").limit(FILES_BY_NAME + 1).collect()]
    if len(both) <= FILES_BY_NAME:
        processed = processed.filter(file_of.isin(both))
    return scans.new_by_id(raw, processed, "pm_raw_id", "pm_raw_id", few=not both)


def _refresh_partials(spark: SparkSession, layout: Layout, changed: list[tuple[str, int, int]], whole: bool) -> None:
    """Bring the stored partials of each tool and week up to date, from the changed weeks' events alone.

    All events are read once, when the table is not there yet or is to be rewritten whole.
    """
    events = spark.read.parquet(layout.enriched)
    if whole or not sinks.has_files(spark, layout.tool_weeks):
        sinks.replace_all(chr_.tool_week_partials(events), layout.tool_weeks, WEEK_PARTS, cluster=True)
    elif changed:
        weeks = sorted({(a, b) if a else (None, None) for _, a, b in changed}, key=str)
        rows = chr_.tool_week_partials(scans.weeks_filter(events, weeks))
        sinks.write_table(rows, layout.tool_weeks, "replace", WEEK_PARTS, cluster=True, covering=weeks)
    sinks.clear_pending(spark, layout.pending, "TOOLS", changed)


# ---------------------------------------------------------------- gold


def latest_chronic_entities(spark: SparkSession, layout: Layout) -> DataFrame | None:
    if not sinks.table_exists(spark, layout.chronic):
        return None
    snaps = spark.read.parquet(layout.chronic).withColumnRenamed("calculation_ts", "calculation_date")
    return chr_.chronic_entities(chr_.chronic_current(snaps))


def gold(
    spark: SparkSession,
    layout: Layout,
    start_ww: str | None = None,
    end_ww: str | None = None,
    since: _dt.datetime | None = None,
    skip_done: bool = False,
    rules: Rules = DEFAULT_RULES,
    as_of: _dt.datetime | None = None,
    facts: tuple[str, ...] = ("site", "ceid", "part", "history"),
    weeks: list[tuple[int, int]] | None = None,
    full_refresh: bool = False,
) -> dict:
    """Weekly facts for the weeks in range, sorted by facility, year and week within their files.

    ``since``: recompute only weeks that received enriched rows at/after it
    (late events are included: the whole week is recomputed from all its rows).
    ``skip_done``: only weeks with a facility that the site fact lacks; each is built
    whole, from all its rows (late events for weeks that are complete are ignored).
    ``weeks``: recompute exactly these (year, week) pairs, e.g. the ``weeks``
    reported by ``silver``; the scan is then pruned to those partitions.
    ``full_refresh``: the facts are rewritten whole, so that weeks no longer there go.
    Pending weeks are crossed out once all four facts have them.
    """
    if full_refresh and any(x is not None for x in (start_ww, end_ww, since, weeks)):
        raise ValueError("full_refresh rewrites whole facts: it cannot be limited to some weeks")
    t0 = time.perf_counter()
    as_of = as_of or _dt.datetime.now()
    layout.finish(spark)
    pending = sinks.pending_weeks(spark, layout.pending, "GOLD")
    ev = scans.week_range(spark.read.parquet(layout.enriched), start_ww, end_ww)
    if skip_done and sinks.table_exists(spark, layout.site):
        own = ev.select("facility", "work_week", *WEEK_PARTS).filter("facility IS NOT NULL").distinct()
        lacking = scans.new_by_keys(own, spark.read.parquet(layout.site), ["facility", "work_week"])
        weeks = _weeks_of(lacking)
    elif weeks is None and since is not None:
        weeks = _weeks_of(ev.filter(F.col("enriched_at") >= ts_lit(since)))
    if weeks is not None:
        ev = scans.weeks_filter(ev, weeks)
    chronic_e = latest_chronic_entities(spark, layout)
    stamp = ts_lit(as_of)

    def put(df: DataFrame, path: str, spread: int) -> int:
        df = df.withColumn("calculated_at", stamp)
        if full_refresh:
            return sinks.replace_all(df, path, WEEK_PARTS, cluster=True, spread=spread, sort_by=FACT_ORDER)
        covering = weeks if sinks.table_exists(spark, path) else None
        return sinks.write_table(df, path, "replace", WEEK_PARTS, cluster=True, spread=spread, sort_by=FACT_ORDER, covering=covering)

    def history() -> int:
        if weeks == []:
            return 0
        if full_refresh or weeks is None or not sinks.has_files(spark, layout.history):
            return put(chr_.chronic_weekly(ev, rules), layout.history, FACT_SPREAD)
        stored = spark.read.parquet(layout.history).drop("calculated_at")
        rows, touched = chr_.chronic_weekly_update(chr_.weekly_scores(ev, rules), stored, weeks)
        # The rows come from partitions that they replace.
        return sinks.replace_weeks(rows.withColumn("calculated_at", stamp), layout.history, touched, WEEK_PARTS, cluster=True, spread=FACT_SPREAD, sort_by=FACT_ORDER)

    builders = {
        "site": lambda: put(kpis.site_week_kpis(ev, chronic_e), layout.site, 1),
        "ceid": lambda: put(kpis.ceid_week_kpis(ev, chronic_e), layout.ceid, FACT_SPREAD),
        "part": lambda: put(kpis.part_week_summary(ev), layout.part, FACT_SPREAD),
        "history": history,
    }
    # The facts do not depend on each other: two are built side by side, so that the tail of one's
    # stages does not leave the cores idle.  No more than two, for the disk their shuffles take.
    # The settings of the session are put here, before the threads, and not changed by them.
    with sinks.write_settings(spark), ThreadPoolExecutor(FACTS_AT_ONCE) as pool:
        running = {name: pool.submit(inheritable_thread_target(spark)(builders[name])) for name in facts}
        try:
            out = {f"{name}_rows": job.result() for name, job in running.items()}
        except BaseException:
            for job in running.values():
                job.cancel()
            raise
    if "site" in facts:
        out["rolled_rows"] = _roll(spark, layout, None if full_refresh else weeks, rules)
    if set(facts) == set(builders):
        label = lambda y, w: f"{y}WW{w:02d}"
        built = [
            (run, y, w) for run, y, w in pending
            if (weeks is None or (y, w) in set(weeks))
            and (start_ww is None or label(y, w) >= start_ww) and (end_ww is None or label(y, w) <= end_ww)
        ]
        sinks.clear_pending(spark, layout.pending, "GOLD", built)
    out["status"] = "SUCCESS"
    out["seconds"] = time.perf_counter() - t0
    return out


def _roll(spark: SparkSession, layout: Layout, weeks: list[tuple[int, int]] | None, rules: Rules) -> int:
    """Rolling measures of the site fact; returns the rows written.

    A changed week changes itself and the weeks whose window reaches back to it, which end
    with its year; they are computed from the weeks their windows hold, and nothing else
    is read or rewritten.  Without ``weeks``, or a table by weeks, all is rolled anew.
    """
    site = spark.read.parquet(layout.site)
    if weeks is None or not sinks.is_by_week(spark, layout.site_rolled):
        return sinks.replace_all(rolling.rolling_range(site, rules), layout.site_rolled, WEEK_PARTS, cluster=True, sort_by=FACT_ORDER)
    k = rules.rolling_window_weeks
    near = lambda first, last: sorted({(y, w + i) for y, w in weeks for i in range(first, last) if 1 <= w + i <= 53})
    changed = near(0, k)
    rows = scans.weeks_filter(rolling.rolling_range(scans.weeks_filter(site, near(1 - k, k)), rules), changed)
    return sinks.write_table(rows, layout.site_rolled, "replace", WEEK_PARTS, cluster=True, sort_by=FACT_ORDER, covering=changed)


def _weeks_of(rows: DataFrame) -> list[tuple[int, int]]:
    """Distinct (year, week) pairs: bounded by the calendar."""
    found = rows.select(*WEEK_PARTS).filter("ww_year IS NOT NULL AND ww_number IS NOT NULL").distinct().collect()
    return sorted((int(r[0]), int(r[1])) for r in found)


# ---------------------------------------------------------------- pipeline


def apply_retention(spark: SparkSession, layout: Layout, rules: Rules = DEFAULT_RULES,
                    as_of: _dt.datetime | None = None, dry_run: bool = False) -> dict:
    """Drop week partitions past each layer's retention (raw / enriched / facts), and log it.

    The cut-off is the fiscal week containing ``as_of - retention weeks``; whole
    weeks older than it are dropped as partitions, never rewritten.
    """
    as_of = as_of or _dt.datetime.now()
    out = {}
    plan = {
        "raw": (rules.retention_weeks_raw, [layout.raw]),
        "enriched": (rules.retention_weeks_enriched, [layout.enriched, layout.summary, layout.tool_weeks]),
        "facts": (rules.retention_weeks_facts, [layout.site, layout.ceid, layout.part, layout.history]),
    }
    for layer, (weeks, paths) in plan.items():
        y, w = cal.parse_week_label(cal.work_week_of(as_of - _dt.timedelta(weeks=weeks)))
        dropped = [d for p in paths for d in sinks.drop_partitions_before(spark, p, y, w, dry_run)]
        if layer == "facts":
            dropped += sinks.drop_snapshots_before(spark, layout.chronic, as_of - _dt.timedelta(weeks=weeks), dry_run)
        out[layer] = {"cutoff_week": f"{y}WW{w:02d}", "dropped_partitions": len(dropped)}
        if not dry_run:
            sinks.append_load_log(spark, layout.load_log, source_file="RETENTION", source_week=f"{y}WW{w:02d}",
                                  rows_loaded=len(dropped), status="SUCCESS", error=None, seconds=0.0,
                                  layer=layer.upper(), at=as_of)
    return out


def last_success(spark: SparkSession, layout: Layout, layer: str) -> _dt.datetime | None:
    """Time of the last successful run of a layer, from the load log (for reports; increments go by load ids)."""
    if not sinks.table_exists(spark, layout.load_log):
        return None
    row = (
        spark.read.parquet(layout.load_log)
        .filter((F.col("layer") == layer) & F.col("load_status").isin("SUCCESS", "NO_DATA"))
        .agg(F.max("load_ts").alias("t"))
        .first()
    )
    return row.t if row is not None else None


def full_pipeline(
    spark: SparkSession,
    source_root: str,
    layout: Layout,
    work_week: str | None = None,
    skip_bronze: bool = False,
    skip_silver: bool = False,
    skip_gold: bool = False,
    class_dim: DataFrame | None = None,
    rules: Rules = DEFAULT_RULES,
    as_of: _dt.datetime | None = None,
    full_refresh: bool = False,
) -> dict:
    """Run the layers in order.

    ``full_refresh``: silver and gold rewrite their tables from all that is loaded.

    A bronze failure is tolerated when a later layer still runs (it works on
    what is already loaded); a silver failure is tolerated when gold runs.
    Silver and gold append one load-log row each (status, rows, seconds); the
    rolling refresh inside gold is logged under its own source name.
    """
    as_of = as_of or _dt.datetime.now()
    res: dict = {}

    def _log(layer: str, source: str, stats: dict) -> None:
        rows = stats.get("rows_enriched", stats.get("site_rows", stats.get("rolled_rows", 0))) or 0
        sinks.append_load_log(spark, layout.load_log, source_file=source, source_week=None, rows_loaded=rows,
                              status=stats.get("status", "FAILED"), error=stats.get("error"),
                              seconds=stats.get("seconds", 0.0) or 0.0, layer=layer, at=as_of)

    if not skip_bronze:
        try:
            res["bronze"] = bronze(spark, source_root, layout, work_week, class_dim=class_dim, as_of=as_of)
        except Exception as e:  # noqa: BLE001
            res["bronze"] = {"status": "FAILED", "error": str(e)}
            if skip_silver and skip_gold:
                raise
    if not skip_silver:
        try:
            res["silver"] = silver(spark, layout, rules=rules, as_of=as_of, full_refresh=full_refresh)
        except Exception as e:  # noqa: BLE001
            res["silver"] = {"status": "FAILED", "error": str(e)}
            _log("SILVER", "ENRICHMENT", res["silver"])
            if skip_gold:
                raise
        else:
            _log("SILVER", "ENRICHMENT", res["silver"])
    if not skip_gold:
        try:
            # Every week some run has left to do, this one or one that died.
            waiting = sorted({(y, w) for _, y, w in sinks.pending_weeks(spark, layout.pending, "GOLD")})
            whole = full_refresh or (skip_silver and not waiting)
            res["gold"] = gold(spark, layout, weeks=None if whole else waiting, rules=rules, as_of=as_of, full_refresh=full_refresh)
        except Exception as e:
            _log("GOLD", "KPI_FACTS", {"status": "FAILED", "error": str(e)})
            raise
        _log("GOLD", "KPI_FACTS", res["gold"])
        _log("GOLD", "ROLLING_AVERAGES", {"status": "SUCCESS", "rolled_rows": res["gold"].get("rolled_rows", 0)})
    return res
