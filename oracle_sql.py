"""Independent DuckDB SQL for every registered query.

Written from the rule text, not generated from the Spark code: each query
re-derives the event view from the base tables (``lineitem part supplier
nation ...`` are pre-registered views) with CTEs, then applies the rule in
plain SQL.  Doubles are quantised to 6 places on both sides with the cut
moved off the decimal midpoint (``round_even(x * 1e6 - 0.118.., 0) / 1e6`` here,
``rint(x * 1e6 - 0.118..) / 1e6`` in Spark) so summation order cannot change
the value hash.
"""

from __future__ import annotations

SCALE = "1000000.0"
# Quantisation cut at 0.618.. of a step (not at .5), see toolwatch.plans.catalog.finish.
SHIFT = "CAST(-0.1180339887498949 AS DOUBLE)"
DEC = "DECIMAL(38,9)"


def XSUM(x: str) -> str:
    """Exact (decimal) sum converted to double, as the Spark side accumulates measured quantities."""
    return f"CAST(sum(CAST({x} AS {DEC})) AS DOUBLE)"


def R(col: str, alias: str | None = None) -> str:
    return f"round_even(({col}) * {SCALE} + {SHIFT}, 0) / {SCALE} AS {alias or col}"


def FY_END(y: str) -> str:
    """Last Saturday of December of year ``y`` (DuckDB dayofweek: Sunday=0)."""
    return f"(make_date({y}, 12, 31) - CAST((dayofweek(make_date({y}, 12, 31)) + 1) % 7 AS INTEGER))"


# Event view over the driver tables (one row per lineitem row).
PM = f"""
pm0 AS (
  SELECT l_orderkey AS order_key, l_linenumber AS line_number, l_partkey AS part_key,
         'T' || l_suppkey AS entity, n_name AS facility, p_brand AS ceid, p_type AS part_name,
         l_shipdate AS event_ts, CAST(l_shipdate AS DATE) AS d, year(l_shipdate) AS y,
         CASE WHEN l_linenumber = 7 THEN NULL WHEN l_suppkey % 10 <= 3 THEN 1000 + l_quantity * 2
              ELSE l_quantity END AS actual_life,
         CASE WHEN l_suppkey % 10 <= 3 THEN CAST(1000.0 AS DOUBLE) ELSE CAST(p_size AS DOUBLE) - 1 END AS target_life,
         CASE WHEN l_suppkey % 10 <= 2 THEN 'Scheduled' WHEN l_suppkey % 10 = 9 THEN 'Unscheduled'
              WHEN l_returnflag = 'A' THEN 'scheduled' WHEN l_returnflag = 'R' THEN 'UNSCHEDULED' END AS downtime_type,
         CASE WHEN l_returnflag = 'R' THEN 'Repair' WHEN l_returnflag = 'A' THEN 'Adjust' END AS downtime_class,
         CASE WHEN l_suppkey % 10 <= 3 THEN l_extendedprice / 100000 WHEN l_suppkey % 10 = 9 THEN l_extendedprice / 1000
              ELSE l_extendedprice / 10000 END AS down_hours,
         CAST(CASE WHEN l_suppkey % 10 = 9 THEN 1 WHEN l_linestatus = 'O' AND l_linenumber <= 2 THEN 1 ELSE 0 END AS DOUBLE) AS reclean,
         CAST(CASE WHEN l_suppkey % 10 = 9 THEN 1 WHEN l_linenumber = 1 THEN 1 WHEN l_linenumber = 6 THEN NULL ELSE 0 END AS DOUBLE) AS sympathy,
         CAST(CASE WHEN l_quantity >= 48 THEN 1 ELSE 0 END AS DOUBLE) AS outlier_label,
         l_discount * 10 AS cycle_utilization,
         CASE WHEN l_tax >= 0.06 THEN 'Wear' END AS reason_primary,
         CASE WHEN l_discount >= 0.05 THEN 'Drift' END AS reason_detail,
         CASE WHEN l_suppkey % 10 <= 3 THEN CAST(900.0 AS DOUBLE) ELSE CAST(p_size AS DOUBLE) * 0.8 END AS lower_limit,
         CASE WHEN l_suppkey % 10 <= 3 THEN CAST(1080.0 AS DOUBLE) ELSE CAST(p_size AS DOUBLE) * 1.2 END AS upper_limit
  FROM lineitem JOIN part ON l_partkey = p_partkey
       JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
),
pm1 AS (SELECT *, CASE WHEN d > {FY_END('y')} THEN y + 1 ELSE y END AS fy FROM pm0),
pm2 AS (SELECT *, date_diff('day', {FY_END('fy - 1')}, d) AS fdoy FROM pm1),
pm AS (
  SELECT * EXCLUDE (d, y, fy, fdoy),
         CAST(fy AS VARCHAR) || 'WW' || lpad(CAST((fdoy - 1) // 7 + 1 AS VARCHAR), 2, '0') AS work_week
  FROM pm2
)"""

CLASSDIM = """
classdim AS (
  SELECT 'T' || s_suppkey AS entity,
         CASE WHEN s_acctbal < 3000 THEN 'Restricted' WHEN s_acctbal < 6500 THEN 'Limited' ELSE 'Allowed' END AS process_class
  FROM supplier WHERE s_acctbal >= 0
)"""

# Enriched events: every derived column written out again from the rules.
EV = f"""{PM},{CLASSDIM},
ev0 AS (
  SELECT pm.*, COALESCE(c.process_class, 'UNKNOWN') AS process_class,
         TRY_CAST(NULLIF(regexp_extract(work_week, '^(\\d{{4}})WW(\\d{{2}})', 1), '') AS INTEGER) AS ww_year,
         TRY_CAST(NULLIF(regexp_extract(work_week, '^(\\d{{4}})WW(\\d{{2}})', 2), '') AS INTEGER) AS ww_number,
         actual_life - target_life AS life_vs_target,
         CASE WHEN target_life > 0 THEN (actual_life - target_life) / target_life * 100.0 END AS life_vs_target_pct
  FROM pm LEFT JOIN (SELECT entity, min(process_class) AS process_class FROM classdim GROUP BY entity) c USING (entity)
),
ev AS (
  SELECT *,
         CAST((ww_number - 1) // 13 + 1 AS INTEGER) AS fiscal_quarter,
         CAST((ww_number - 1) // 4 + 1 AS INTEGER) AS fiscal_month,
         CASE WHEN life_vs_target_pct IS NULL THEN 'Unknown'
              WHEN life_vs_target_pct < -15 THEN 'Early'
              WHEN life_vs_target_pct >= -15 AND life_vs_target_pct <= 15 THEN 'On-Time'
              WHEN life_vs_target_pct > 15 AND life_vs_target_pct <= 30 THEN 'Late'
              WHEN life_vs_target_pct > 30 THEN 'Overdue'
              ELSE 'On-Time' END AS timing_class,
         CASE WHEN lower(downtime_type) = 'scheduled' THEN 1 ELSE 0 END AS scheduled_flag,
         CASE WHEN lower(downtime_type) = 'scheduled' THEN 'Scheduled'
              WHEN lower(downtime_type) = 'unscheduled' THEN 'Unscheduled' ELSE 'Unknown' END AS scheduled_category,
         cycle_utilization AS cycle_efficiency,
         CASE WHEN outlier_label = 1 THEN 1 ELSE 0 END AS duration_outlier_flag,
         CASE WHEN reclean = 1 THEN 1 ELSE 0 END AS reclean_flag,
         CASE WHEN sympathy = 1 THEN 1 ELSE 0 END AS sympathy_flag,
         COALESCE(downtime_type, 'Unknown') || ' - ' || COALESCE(downtime_class, 'Unknown') AS downtime_category,
         COALESCE(reason_primary, reason_detail) AS primary_reason,
         ((entity IS NOT NULL)::INT + (facility IS NOT NULL)::INT + (ceid IS NOT NULL)::INT + (work_week IS NOT NULL)::INT
          + (event_ts IS NOT NULL)::INT + (downtime_type IS NOT NULL)::INT + (actual_life IS NOT NULL)::INT
          + (target_life IS NOT NULL)::INT) / 8.0 * 100.0 AS quality_score
  FROM ev0
)"""


def _clip(x: str) -> str:
    return f"CASE WHEN ({x}) IS NOT NULL THEN least(greatest(({x}), 0.0), 100.0) END"


def _tool_scored(keys: str, src: str = "ev", name: str = "scored", min_events: int = 5) -> str:
    """Chronic metrics + score/flag/severity at the grain ``keys`` (CTE named ``name``); the class is that of the last event."""
    return f"""
{name}_m AS (
  SELECT {keys},
         arg_max(process_class, {{'t': event_ts, 'c': process_class}}) AS process_class,
         count(*) AS total_pm_events,
         CAST(sum(CASE WHEN scheduled_flag = 0 THEN 1 ELSE 0 END) AS BIGINT) AS unscheduled_pm_count,
         COALESCE(CAST(sum(CAST(down_hours AS DECIMAL(38,9))) AS DOUBLE), 0.0) AS total_downtime_hours,
         stddev_samp(actual_life) AS life_stddev,
         avg(actual_life) AS avg_pm_life,
         avg(reclean) AS reclean_rate,
         avg(sympathy) AS sympathy_pm_rate
  FROM {src}
  WHERE {' AND '.join(k.strip() + ' IS NOT NULL' for k in keys.split(','))}
  GROUP BY {keys}
),
{name}_r AS (
  SELECT *, unscheduled_pm_count / total_pm_events AS unscheduled_pm_rate,
         total_downtime_hours / total_pm_events AS avg_downtime_hours_per_pm,
         CASE WHEN avg_pm_life > 0 THEN life_stddev / avg_pm_life ELSE 0.0 END AS life_cv
  FROM {name}_m
),
{name}_s AS (
  SELECT *,
         round_even((({_clip('unscheduled_pm_rate / 0.3 * 100.0')}) * 0.35
           + ({_clip('life_cv / 0.4 * 100.0')}) * 0.25
           + ({_clip('avg_downtime_hours_per_pm / 10.0 * 100.0')}) * 0.2
           + reclean_rate * 100.0 * 0.1
           + sympathy_pm_rate * 100.0 * 0.1) * 100.0, 0) / 100.0 AS chronic_score,
         CASE WHEN total_pm_events >= {min_events} AND (unscheduled_pm_rate > 0.3 OR life_cv > 0.4) THEN 1 ELSE 0 END AS chronic_flag
  FROM {name}_r
),
{name} AS (
  SELECT *, CASE WHEN chronic_flag = 0 THEN NULL WHEN chronic_score >= 90 THEN 'Critical'
                 WHEN chronic_score >= 75 THEN 'High' WHEN chronic_score >= 50 THEN 'Medium' ELSE 'Low' END AS chronic_severity
  FROM {name}_s
)"""


TOOLS = _tool_scored("entity, facility, ceid")
CHRONIC_E = "chronic_e AS (SELECT DISTINCT entity FROM scored WHERE chronic_flag = 1)"


def _tool_counts(keys: str, name: str = "tc") -> str:
    return f"""
{name} AS (
  SELECT {keys}, count(*) AS total_tools, count(c) AS chronic_tools
  FROM (SELECT DISTINCT {keys}, entity FROM ev WHERE entity IS NOT NULL AND {' AND '.join(k.strip() + ' IS NOT NULL' for k in keys.split(','))}) t
       LEFT JOIN (SELECT entity, 1 AS c FROM chronic_e) ce USING (entity)
  GROUP BY {keys}
)"""


SITE_KEYS = "facility, ww_year, ww_number, work_week"
SITE_FACT = f"""{TOOLS},{CHRONIC_E},{_tool_counts(SITE_KEYS)},
sb AS (
  SELECT {SITE_KEYS}, count(*) AS total_pm_events,
         CAST(sum(CASE WHEN scheduled_flag = 1 THEN 1 ELSE 0 END) AS BIGINT) AS scheduled_pm_events,
         CAST(sum(CASE WHEN scheduled_flag = 0 THEN 1 ELSE 0 END) AS BIGINT) AS unscheduled_pm_events,
         CAST(sum(CASE WHEN timing_class = 'Early' THEN 1 ELSE 0 END) AS BIGINT) AS early_pm_count,
         CAST(sum(CASE WHEN timing_class = 'On-Time' THEN 1 ELSE 0 END) AS BIGINT) AS on_time_pm_count,
         CAST(sum(CASE WHEN timing_class = 'Late' THEN 1 ELSE 0 END) AS BIGINT) AS late_pm_count,
         CAST(sum(CASE WHEN timing_class = 'Overdue' THEN 1 ELSE 0 END) AS BIGINT) AS overdue_pm_count,
         COALESCE(CAST(sum(CAST(down_hours AS DECIMAL(38,9))) AS DOUBLE), 0.0) AS total_downtime_hours,
         CAST(sum(CAST(down_hours AS DECIMAL(38,9))) AS DOUBLE) / count(down_hours) AS avg_downtime_per_pm,
         avg(actual_life) AS avg_pm_life,
         median(actual_life) AS median_pm_life,
         arg_min(target_life, {{'t': event_ts, 'v': target_life}}) FILTER (WHERE target_life IS NOT NULL) AS target_pm_life,
         avg(life_vs_target) AS avg_life_vs_target
  FROM ev
  WHERE facility IS NOT NULL AND ww_year IS NOT NULL AND ww_number IS NOT NULL AND work_week IS NOT NULL
  GROUP BY {SITE_KEYS}
),
site AS (
  SELECT sb.*, COALESCE(total_tools, 0) AS total_tools_count, COALESCE(chronic_tools, 0) AS chronic_tools_count,
         COALESCE(COALESCE(chronic_tools, 0) / total_tools, 0.0) AS chronic_tools_pct,
         unscheduled_pm_events / total_pm_events AS unscheduled_pm_rate,
         early_pm_count / total_pm_events AS early_pm_rate,
         on_time_pm_count / total_pm_events AS on_time_pm_rate,
         overdue_pm_count / total_pm_events AS overdue_pm_rate,
         COALESCE(total_downtime_hours * (scheduled_pm_events / total_pm_events), 0.0) AS scheduled_downtime_hours,
         total_downtime_hours - COALESCE(total_downtime_hours * (scheduled_pm_events / total_pm_events), 0.0) AS unscheduled_downtime_hours
  FROM sb LEFT JOIN tc USING ({SITE_KEYS})
)"""



def WW(ts: str) -> str:
    """Inline work-week label of a timestamp/date expression."""
    d = f"CAST({ts} AS DATE)"
    y = f"year({ts})"
    fy = f"(CASE WHEN {d} > {FY_END(y)} THEN {y} + 1 ELSE {y} END)"
    doy = f"date_diff('day', {FY_END(fy + ' - 1')}, {d})"
    return f"(CAST({fy} AS VARCHAR) || 'WW' || lpad(CAST(({doy} - 1) // 7 + 1 AS VARCHAR), 2, '0'))"


def FY(ts: str) -> str:
    d = f"CAST({ts} AS DATE)"
    y = f"year({ts})"
    return f"CAST(CASE WHEN {d} > {FY_END(y)} THEN {y} + 1 ELSE {y} END AS INTEGER)"


def NN(keys: str) -> str:
    return " AND ".join(k.strip() + " IS NOT NULL" for k in keys.split(","))


def CNT(cond: str) -> str:
    return f"CAST(sum(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT)"


def rounded(body: str, doubles, tail: str = "") -> str:
    """``body`` is a full WITH ... SELECT; wrap it so listed double columns are rounded."""
    if not doubles:
        return f"SELECT * FROM ({body}) q {tail}"
    return f"SELECT * REPLACE ({', '.join(R(c) for c in doubles)}) FROM ({body}) q {tail}"


SITE_DOUBLES = (
    "total_downtime_hours", "avg_downtime_per_pm", "avg_pm_life", "median_pm_life", "target_pm_life",
    "avg_life_vs_target", "chronic_tools_pct", "unscheduled_pm_rate", "early_pm_rate", "on_time_pm_rate",
    "overdue_pm_rate", "scheduled_downtime_hours", "unscheduled_downtime_hours",
)

CEID_KEYS = "ceid, facility, process_class, ww_year, ww_number, work_week"
CEID_FACT = f"""{TOOLS},{CHRONIC_E},{_tool_counts(CEID_KEYS, "tcc")},
cb AS (
  SELECT {CEID_KEYS}, count(*) AS total_pm_events,
         {CNT("scheduled_flag = 1")} AS scheduled_pm_events,
         {CNT("scheduled_flag = 0")} AS unscheduled_pm_events,
         {CNT("timing_class = 'Early'")} AS early_pm_count,
         {CNT("timing_class = 'Overdue'")} AS overdue_pm_count,
         COALESCE({XSUM("down_hours")}, 0.0) AS total_downtime_hours,
         avg(actual_life) AS avg_pm_life, median(actual_life) AS median_pm_life, stddev_samp(actual_life) AS life_stddev
  FROM ev WHERE {NN(CEID_KEYS)}
  GROUP BY {CEID_KEYS}
),
ceidf AS (
  SELECT {CEID_KEYS}, total_pm_events, scheduled_pm_events, unscheduled_pm_events, total_downtime_hours,
         COALESCE(total_downtime_hours * (unscheduled_pm_events / total_pm_events), 0.0) AS unscheduled_downtime_hours,
         avg_pm_life, median_pm_life, life_stddev,
         COALESCE(total_tools, 0) AS total_chambers, COALESCE(chronic_tools, 0) AS chronic_chambers,
         unscheduled_pm_events / total_pm_events AS unscheduled_pm_rate,
         early_pm_count / total_pm_events AS early_pm_rate,
         overdue_pm_count / total_pm_events AS overdue_pm_rate
  FROM cb LEFT JOIN tcc USING ({CEID_KEYS})
)"""
CEID_DOUBLES = ("total_downtime_hours", "unscheduled_downtime_hours", "avg_pm_life", "median_pm_life", "life_stddev",
                "unscheduled_pm_rate", "early_pm_rate", "overdue_pm_rate")

PART_KEYS = "part_name, entity, facility, ceid, ww_year, ww_number, work_week"
PART = f"""
partf AS (
  SELECT {PART_KEYS}, count(*) AS replacement_count,
         avg(actual_life) AS avg_life_at_replacement, median(actual_life) AS median_life_at_replacement,
         min(actual_life) AS min_life_at_replacement, max(actual_life) AS max_life_at_replacement,
         CAST(floor(date_diff('second', min(event_ts), max(event_ts)) / 86400) AS BIGINT) AS life_span_days,
         {CNT("timing_class = 'Early'")} AS early_replacement_count,
         {CNT("timing_class IN ('Late', 'Overdue')")} AS late_replacement_count,
         stddev_samp(actual_life) AS life_stddev
  FROM ev WHERE {NN(PART_KEYS)}
  GROUP BY {PART_KEYS}
)"""
PART_DOUBLES = ("avg_life_at_replacement", "median_life_at_replacement", "min_life_at_replacement",
                "max_life_at_replacement", "life_stddev")

SUM_KEYS = "facility, ceid, ww_year, ww_number, work_week, process_class"
DOWNTIME = f"""
dsb AS (
  SELECT {SUM_KEYS}, count(*) AS total_pm_events,
         {CNT("scheduled_flag = 1")} AS scheduled_pm_count, {CNT("scheduled_flag = 0")} AS unscheduled_pm_count,
         {CNT("timing_class = 'Early'")} AS early_pm_count, {CNT("timing_class = 'On-Time'")} AS on_time_pm_count,
         {CNT("timing_class = 'Late'")} AS late_pm_count, {CNT("timing_class = 'Overdue'")} AS overdue_pm_count,
         COALESCE({XSUM("down_hours")}, 0.0) AS total_downtime_hours,
         {XSUM("down_hours")} / count(down_hours) AS avg_downtime_hours,
         avg(actual_life) AS avg_pm_life, median(actual_life) AS median_pm_life, stddev_samp(actual_life) AS life_stddev
  FROM ev WHERE {NN(SUM_KEYS)}
  GROUP BY {SUM_KEYS}
),
dsum AS (
  SELECT *, unscheduled_pm_count / total_pm_events AS unscheduled_pm_rate,
         early_pm_count / total_pm_events AS early_pm_rate, overdue_pm_count / total_pm_events AS overdue_pm_rate,
         COALESCE(total_downtime_hours * (scheduled_pm_count / total_pm_events), 0.0) AS scheduled_downtime_hours,
         total_downtime_hours - COALESCE(total_downtime_hours * (scheduled_pm_count / total_pm_events), 0.0) AS unscheduled_downtime_hours,
         pow(life_stddev, 2) AS life_variance, total_pm_events AS record_count
  FROM dsb
)"""
DOWNTIME_DOUBLES = ("total_downtime_hours", "avg_downtime_hours", "avg_pm_life", "median_pm_life", "life_stddev",
                    "unscheduled_pm_rate", "early_pm_rate", "overdue_pm_rate", "scheduled_downtime_hours",
                    "unscheduled_downtime_hours", "life_variance")

PART_COSTS = f"""
pcost AS (
  SELECT 'T' || l_suppkey AS entity, p_type AS part_name, {XSUM("p_retailprice")} / count(p_retailprice) AS part_cost
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL
)"""
LABOUR_COSTS = f"""
lcost AS (SELECT facility, ceid, {XSUM("down_hours")} / count(down_hours) * 40.0 AS labour_cost FROM pm GROUP BY ALL)"""

TOOL_DOUBLES = ("total_downtime_hours", "life_stddev", "avg_pm_life", "reclean_rate", "sympathy_pm_rate",
                "unscheduled_pm_rate", "avg_downtime_hours_per_pm", "life_cv", "chronic_score")

ROLL_COLS = "facility, ww_year, ww_number, work_week"


def _rolling(frame: str, part: str) -> str:
    return f"""WITH {EV},{SITE_FACT}
SELECT {ROLL_COLS},
       avg(avg_pm_life) OVER w AS rolling_4wk_avg_pm_life,
       CAST(sum(total_pm_events) OVER w AS BIGINT) AS rolling_4wk_pm_count,
       CAST(sum(CAST(total_downtime_hours AS {DEC})) OVER w AS DOUBLE) AS rolling_4wk_downtime_hours
FROM site WINDOW w AS (PARTITION BY {part} {frame})"""


def _distribution(col: str) -> str:
    return rounded(
        f"""WITH {EV}
SELECT {col}, count(*) AS row_count, CAST(count(*) AS DOUBLE) * 100.0 / sum(count(*)) OVER () AS pct_of_total
FROM ev GROUP BY {col}""",
        ("pct_of_total",),
    )


NULL_COLS = ("entity", "facility", "ceid", "work_week", "event_ts", "downtime_type", "actual_life", "target_life",
             "sympathy", "downtime_class", "reason_primary")

NA_TOKENS_SQL = ", ".join("'" + t.replace("'", "''") + "'" for t in (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null"))

FY_BOUNDS = f"fyb AS (SELECT min({FY('event_ts')}) AS lo, max({FY('event_ts')}) AS hi FROM pm)"
WEEKS_DIM = f"""{FY_BOUNDS},
fys AS (SELECT unnest(generate_series(lo, hi)) AS fiscal_year FROM fyb),
wks AS (SELECT fiscal_year, unnest(generate_series(1, CAST(({FY_END('fiscal_year')} - {FY_END('fiscal_year - 1')}) / 7 AS INTEGER))) AS fiscal_week FROM fys),
weekdim AS (
  SELECT CAST(fiscal_year AS VARCHAR) || 'WW' || lpad(CAST(fiscal_week AS VARCHAR), 2, '0') AS work_week,
         CAST(fiscal_year AS INTEGER) AS fiscal_year, CAST(fiscal_week AS INTEGER) AS fiscal_week,
         CAST((fiscal_week - 1) // 13 + 1 AS INTEGER) AS fiscal_quarter, CAST((fiscal_week - 1) // 4 + 1 AS INTEGER) AS fiscal_month,
         {FY_END('fiscal_year - 1')} + CAST((fiscal_week - 1) * 7 + 1 AS INTEGER) AS week_start,
         {FY_END('fiscal_year - 1')} + CAST((fiscal_week - 1) * 7 + 7 AS INTEGER) AS week_end
  FROM wks
)"""


def queries_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["site_week_kpis"] = rounded(f"WITH {EV},{SITE_FACT} SELECT * FROM site", SITE_DOUBLES)
    # End-to-end runs: pipeline and stream must reproduce the site fact exactly.
    q["pipeline_site_week"] = q["pipeline_recovery"] = q["stream_site_week"] = q["stream_recovery"] = q["site_week_kpis"]
    # Without the columns that depend on the chronic tools of the run that built a week.
    lasting = rounded(
        f"WITH {EV},{SITE_FACT} SELECT * EXCLUDE (chronic_tools_count, chronic_tools_pct) FROM site",
        tuple(c for c in SITE_DOUBLES if c != "chronic_tools_pct"),
    )
    q["pipeline_partial_week"] = q["pipeline_corrected_file"] = lasting
    q["csv_roundtrip"] = rounded(
        f"WITH {EV} SELECT entity, facility, ceid, part_name, work_week, downtime_type, down_hours, actual_life, target_life FROM ev",
        ("down_hours", "actual_life", "target_life"),
    )
    q["ceid_week_kpis"] = rounded(f"WITH {EV},{CEID_FACT} SELECT * FROM ceidf", CEID_DOUBLES)
    q["part_week_summary"] = rounded(f"WITH {EV},{PART} SELECT * FROM partf", PART_DOUBLES)
    q["downtime_summary"] = rounded(
        f"""WITH {EV},{DOWNTIME},{TOOLS},
dct AS (
  SELECT t.facility, t.ceid, t.ww_year, t.ww_number, t.work_week, t.process_class,
         {CNT("s.chronic_flag = 1")} AS chronic_tools_count, avg(s.chronic_score) AS avg_chronic_score
  FROM (SELECT DISTINCT {SUM_KEYS}, entity FROM ev WHERE {NN(SUM_KEYS)} AND entity IS NOT NULL) t
       LEFT JOIN scored s ON t.entity = s.entity AND t.facility = s.facility AND t.ceid = s.ceid
  GROUP BY t.facility, t.ceid, t.ww_year, t.ww_number, t.work_week, t.process_class
)
SELECT dsum.*, COALESCE(dct.chronic_tools_count, 0) AS chronic_tools_count, dct.avg_chronic_score
FROM dsum LEFT JOIN dct USING ({SUM_KEYS})""",
        (*DOWNTIME_DOUBLES, "avg_chronic_score"),
    )
    q["cost_summary"] = rounded(
        f"""WITH {EV},{PART_COSTS}
SELECT facility, ceid, ww_year, ww_number, work_week, sum(part_cost) AS total_part_cost, avg(part_cost) AS avg_part_cost,
       count(*) AS part_replacement_count,
       sum(CASE WHEN target_life > 0 AND actual_life > target_life THEN part_cost * (actual_life - target_life) / target_life
                ELSE 0.0 END) AS total_part_savings
FROM ev JOIN pcost USING (entity, part_name)
WHERE facility IS NOT NULL AND ceid IS NOT NULL AND ww_year IS NOT NULL AND ww_number IS NOT NULL AND work_week IS NOT NULL
GROUP BY facility, ceid, ww_year, ww_number, work_week""",
        ("total_part_cost", "avg_part_cost", "total_part_savings"),
    )
    q["unified_roi"] = rounded(
        f"""WITH {EV},{PART},{PART_COSTS},{LABOUR_COSTS},
saved AS (SELECT {PART_KEYS}, COALESCE(sum(greatest(life_vs_target, 0.0)), 0.0) AS life_saved FROM ev WHERE {NN(PART_KEYS)} GROUP BY {PART_KEYS})
SELECT {PART_KEYS}, replacement_count, life_saved,
       part_cost * replacement_count AS part_cost_total, labour_cost * replacement_count AS labour_cost_total,
       life_saved * 1.0 - part_cost * replacement_count - labour_cost * replacement_count AS roi,
       (life_saved * 1.0 - part_cost * replacement_count - labour_cost * replacement_count) / replacement_count AS roi_per_pm
FROM partf LEFT JOIN saved USING ({PART_KEYS}) JOIN pcost USING (entity, part_name) JOIN lcost USING (facility, ceid)""",
        ("life_saved", "part_cost_total", "labour_cost_total", "roi", "roi_per_pm"),
    )
    q["site_week_extra_measures"] = rounded(
        f"""WITH {EV}
SELECT {SITE_KEYS}, median(down_hours) AS median_downtime_hours, CAST(sum(reclean_flag) AS BIGINT) AS reclean_count,
       avg(reclean_flag) AS reclean_rate, CAST(sum(sympathy_flag) AS BIGINT) AS sympathy_count
FROM ev WHERE {NN(SITE_KEYS)} GROUP BY {SITE_KEYS}""",
        ("median_downtime_hours", "reclean_rate"),
    )
    q["chronic_tools"] = rounded(
        f"""WITH {EV},{TOOLS}
SELECT *, (SELECT min(CAST(event_ts AS DATE)) FROM ev) AS analysis_start_date,
          (SELECT max(CAST(event_ts AS DATE)) FROM ev) AS analysis_end_date,
          CAST(floor(date_diff('day', (SELECT min(CAST(event_ts AS DATE)) FROM ev), (SELECT max(CAST(event_ts AS DATE)) FROM ev)) / 7) AS INTEGER) AS weeks_analyzed
FROM scored""",
        TOOL_DOUBLES,
    )
    q["pipeline_chronic"] = q["chronic_tools"]
    q["chronic_current"] = rounded(
        f"""WITH {EV},{_tool_scored("entity, facility, ceid, ww_year", name="snap")},
snapd AS (SELECT *, {FY_END('ww_year')} AS calculation_date FROM snap)
SELECT * FROM snapd WHERE calculation_date = (SELECT max(calculation_date) FROM snapd) AND chronic_flag = 1""",
        TOOL_DOUBLES,
    )
    weekly = lambda n: rounded(
        f"""WITH {EV},{_tool_scored("entity, facility, ceid, ww_year, ww_number, work_week", name="wk", min_events=n)}
SELECT *,
       CASE WHEN row_number() OVER w = 1 THEN 0.0 ELSE chronic_score - lag(chronic_score) OVER w END AS chronic_score_change,
       CASE WHEN row_number() OVER w = 1 THEN 0 WHEN chronic_flag <> lag(chronic_flag) OVER w THEN 1 ELSE 0 END AS status_changed
FROM wk WINDOW w AS (PARTITION BY entity, facility, ceid ORDER BY ww_year, ww_number)""",
        (*TOOL_DOUBLES, "chronic_score_change"),
    )
    q["chronic_weekly_change"] = weekly(5)
    # One event in a week suffices: weeks are flagged and statuses change.
    q["chronic_weekly_change_low_bar"] = q["pipeline_history"] = weekly(1)
    q["severity_counts"] = rounded(
        f"""WITH {EV},{TOOLS}
SELECT chronic_severity, count(*) AS tool_count, avg(chronic_score) AS avg_score FROM scored WHERE chronic_flag = 1 GROUP BY chronic_severity""",
        ("avg_score",),
    )
    q["chronic_share"] = rounded(
        f"""WITH {EV},{TOOLS}
SELECT count(*) AS total_tools, {CNT("chronic_flag = 1")} AS chronic_tools,
       COALESCE(CAST({CNT("chronic_flag = 1")} AS DOUBLE) / count(*), 0.0) * 100.0 AS chronic_pct
FROM scored""",
        ("chronic_pct",),
    )
    q["top_chronic"] = rounded(
        f"""WITH {EV},{TOOLS}
SELECT entity, facility, ceid, process_class, chronic_score, chronic_severity, unscheduled_pm_rate, life_cv, total_pm_events
FROM scored WHERE chronic_flag = 1
ORDER BY chronic_score DESC NULLS LAST, entity, facility, ceid, process_class LIMIT 10""",
        ("chronic_score", "unscheduled_pm_rate", "life_cv"),
    )
    q["enriched_events"] = rounded(
        f"""WITH {EV}
SELECT order_key, line_number, entity, facility, ceid, part_name, event_ts, work_week, process_class, ww_year, ww_number,
       fiscal_quarter, fiscal_month, life_vs_target, life_vs_target_pct, timing_class, scheduled_flag, scheduled_category,
       cycle_efficiency, duration_outlier_flag, reclean_flag, sympathy_flag, downtime_category, primary_reason, quality_score
FROM ev""",
        ("life_vs_target", "life_vs_target_pct", "cycle_efficiency", "quality_score"),
    )
    q["enriched_with_chronic"] = rounded(
        f"""WITH {EV},{TOOLS}
SELECT ev.order_key, ev.line_number, ev.entity, ev.facility, ev.ceid, COALESCE(s.chronic_flag, 0) AS chronic_flag, s.chronic_score
FROM ev LEFT JOIN scored s ON ev.entity = s.entity AND ev.facility = s.facility AND ev.ceid = s.ceid""",
        ("chronic_score",),
    )
    q["class_left_join"] = f"""WITH {PM},{CLASSDIM}
SELECT order_key, line_number, entity, COALESCE(c.process_class, 'UNKNOWN') AS process_class
FROM pm LEFT JOIN (SELECT entity, min(process_class) AS process_class FROM classdim GROUP BY entity) c USING (entity)"""
    q["event_calendar"] = f"""WITH dts AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS event_date FROM lineitem
  JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)
SELECT event_date, {FY('event_date')} AS fiscal_year,
       CAST(date_diff('day', {FY_END(FY('event_date') + ' - 1')}, event_date) AS INTEGER) AS day_of_year,
       CAST((date_diff('day', {FY_END(FY('event_date') + ' - 1')}, event_date) - 1) // 7 + 1 AS INTEGER) AS fiscal_week,
       {WW('event_date')} AS work_week
FROM dts"""
    q["date_dimension"] = f"""WITH {PM},{FY_BOUNDS},
days AS (SELECT CAST(unnest(generate_series(CAST({FY_END('lo - 1')} + 1 AS TIMESTAMP), CAST({FY_END('hi')} AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date_value FROM fyb),
d1 AS (SELECT date_value, {FY('date_value')} AS fiscal_year FROM days),
d2 AS (SELECT *, CAST(date_diff('day', {FY_END('fiscal_year - 1')}, date_value) AS INTEGER) AS day_of_year FROM d1),
d3 AS (SELECT *, CAST((day_of_year - 1) // 7 + 1 AS INTEGER) AS fiscal_week FROM d2)
SELECT CAST(strftime(date_value, '%Y%m%d') AS INTEGER) AS date_key, date_value, day_of_year, fiscal_year,
       CAST((fiscal_week - 1) // 13 + 1 AS INTEGER) AS fiscal_quarter, CAST((fiscal_week - 1) // 4 + 1 AS INTEGER) AS fiscal_month,
       fiscal_week, CAST(fiscal_year AS VARCHAR) || 'WW' || lpad(CAST(fiscal_week AS VARCHAR), 2, '0') AS work_week,
       CAST(isodow(date_value) - 1 AS INTEGER) AS day_of_week, dayname(date_value) AS day_name,
       CASE WHEN isodow(date_value) >= 6 THEN 1 ELSE 0 END AS is_weekend
FROM d3"""
    q["calendar_days"] = f"""WITH {PM},{FY_BOUNDS},
days AS (SELECT CAST(unnest(generate_series(CAST({FY_END('lo - 1')} + 1 AS TIMESTAMP), CAST({FY_END('hi')} AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date_value FROM fyb),
d1 AS (SELECT date_value, {FY('date_value')} AS fiscal_year FROM days),
d2 AS (SELECT *, CAST(date_diff('day', {FY_END('fiscal_year - 1')}, date_value) AS INTEGER) AS day_of_year FROM d1)
SELECT date_value, day_of_year, fiscal_year, CAST((day_of_year - 1) // 7 + 1 AS INTEGER) AS fiscal_week,
       CAST(fiscal_year AS VARCHAR) || 'WW' || lpad(CAST((day_of_year - 1) // 7 + 1 AS VARCHAR), 2, '0') AS work_week,
       CAST(isodow(date_value) - 1 AS INTEGER) AS day_of_week
FROM d2"""
    q["week_dimension"] = f"WITH {PM},{WEEKS_DIM} SELECT * FROM weekdim"
    q["distinct_weeks"] = f"WITH {EV} SELECT DISTINCT ww_year, ww_number, work_week FROM ev"
    q["chronic_snapshots"] = rounded(
        f"""WITH {EV},{_tool_scored("entity, facility, ceid, ww_year", name="snap")}
SELECT *, {FY_END('ww_year')} AS calculation_date FROM snap""",
        TOOL_DOUBLES,
    )
    parse_year = "TRY_CAST(NULLIF(regexp_extract(work_week, '^(\\d{4})WW(\\d{2})', 1), '') AS INTEGER)"
    parse_week = "TRY_CAST(NULLIF(regexp_extract(work_week, '^(\\d{4})WW(\\d{2})', 2), '') AS INTEGER)"
    q["week_date_range"] = f"""WITH {PM}, w AS (SELECT DISTINCT work_week FROM pm),
p AS (SELECT work_week, {parse_year} AS y, {parse_week} AS wk FROM w)
SELECT work_week,
       CASE WHEN wk >= 1 AND wk <= CAST(({FY_END('y')} - {FY_END('y - 1')}) / 7 AS INTEGER)
            THEN {FY_END('y - 1')} + CAST((wk - 1) * 7 + 1 AS INTEGER) END AS week_start,
       CASE WHEN wk >= 1 AND wk <= CAST(({FY_END('y')} - {FY_END('y - 1')}) / 7 AS INTEGER)
            THEN {FY_END('y - 1')} + CAST((wk - 1) * 7 + 7 AS INTEGER) END AS week_end
FROM p"""
    q["parse_work_week"] = f"""WITH {PM}, w AS (SELECT DISTINCT work_week FROM pm),
v AS (SELECT DISTINCT unnest([work_week, work_week || 'nn', substring(work_week, 3, 6)]) AS label FROM w),
p AS (SELECT label, TRY_CAST(NULLIF(regexp_extract(label, '^(\\d{{4}})WW(\\d{{2}})', 1), '') AS INTEGER) AS ww_year,
             TRY_CAST(NULLIF(regexp_extract(label, '^(\\d{{4}})WW(\\d{{2}})', 2), '') AS INTEGER) AS ww_number FROM v)
SELECT label, ww_year, ww_number, CAST((ww_number - 1) // 13 + 1 AS INTEGER) AS fiscal_quarter,
       CAST((ww_number - 1) // 4 + 1 AS INTEGER) AS fiscal_month
FROM p"""
    q["calendar_star_join"] = rounded(
        f"""WITH {EV},{SITE_FACT},{WEEKS_DIM}
SELECT facility, work_week, total_pm_events, total_downtime_hours, fiscal_week, fiscal_quarter, fiscal_month, week_start, week_end
FROM site LEFT JOIN weekdim USING (work_week)""",
        ("total_downtime_hours",),
    )
    q["entity_dimension"] = f"""WITH {EV},
g AS (
  SELECT entity, facility,
         arg_max(ceid, {{'t': event_ts, 'c': ceid}}) AS ceid,
         arg_max(process_class, {{'t': event_ts, 'c': process_class}}) AS process_class,
         min(CAST(event_ts AS DATE)) AS created_date, max(CAST(event_ts AS DATE)) AS last_seen_date
  FROM ev WHERE entity IS NOT NULL AND facility IS NOT NULL GROUP BY entity, facility
)
SELECT *, CASE WHEN last_seen_date >= (SELECT max(CAST(event_ts AS DATE)) FROM ev WHERE entity IS NOT NULL AND facility IS NOT NULL) - 182
               THEN 1 ELSE 0 END AS is_active,
       row_number() OVER (ORDER BY entity, facility) AS entity_key
FROM g"""
    q["rolling_range"] = rounded(
        _rolling("ORDER BY ww_number RANGE BETWEEN 3 PRECEDING AND CURRENT ROW", "facility, ww_year"),
        ("rolling_4wk_avg_pm_life", "rolling_4wk_downtime_hours"),
    )
    q["pipeline_rolled"] = (
        "SELECT facility, ww_year, ww_number, work_week, rolling_4wk_avg_pm_life, rolling_4wk_pm_count, rolling_4wk_downtime_hours "
        f"FROM ({q['rolling_range']}) AS rolled"
    )
    q["rolling_rows"] = rounded(
        _rolling("ORDER BY ww_year, ww_number ROWS BETWEEN 3 PRECEDING AND CURRENT ROW", "facility"),
        ("rolling_4wk_avg_pm_life", "rolling_4wk_downtime_hours"),
    )
    q["rowcount_tolerance"] = rounded(
        f"""WITH {EV},
wc AS (SELECT facility, ww_year, ww_number, work_week, count(*) AS row_count FROM ev WHERE work_week IS NOT NULL
       GROUP BY facility, ww_year, ww_number, work_week),
wl AS (SELECT *, lag(row_count) OVER (PARTITION BY facility ORDER BY ww_year, ww_number) AS prev_row_count FROM wc)
SELECT *, (row_count - prev_row_count) / prev_row_count AS pct_change,
       CASE WHEN prev_row_count IS NULL THEN NULL
            WHEN abs((row_count - prev_row_count) / prev_row_count) <= 0.2 THEN 1 ELSE 0 END AS within_tolerance
FROM wl""",
        ("pct_change",),
    )
    q["executive_view"] = rounded(
        f"""WITH {EV},{SITE_FACT},
r AS (SELECT *, avg(avg_pm_life) OVER w AS rolling_4wk_avg_pm_life, CAST(sum(total_pm_events) OVER w AS BIGINT) AS rolling_4wk_pm_count
      FROM site WINDOW w AS (PARTITION BY facility, ww_year ORDER BY ww_number RANGE BETWEEN 3 PRECEDING AND CURRENT ROW))
SELECT facility, work_week, ww_year, ww_number, total_pm_events, scheduled_pm_events, unscheduled_pm_events,
       unscheduled_pm_rate, on_time_pm_rate, chronic_tools_pct, total_downtime_hours, avg_downtime_per_pm,
       avg_pm_life, target_pm_life,
       CASE WHEN target_pm_life > 0 THEN (avg_pm_life - target_pm_life) / target_pm_life * 100.0 END AS life_vs_target_pct,
       rolling_4wk_avg_pm_life, rolling_4wk_pm_count, chronic_tools_count, total_tools_count
FROM r""",
        ("unscheduled_pm_rate", "on_time_pm_rate", "chronic_tools_pct", "total_downtime_hours", "avg_downtime_per_pm",
         "avg_pm_life", "target_pm_life", "life_vs_target_pct", "rolling_4wk_avg_pm_life"),
    )
    q["timing_distribution"] = _distribution("timing_class")
    q["scheduled_distribution"] = _distribution("scheduled_category")
    q["class_distribution"] = _distribution("process_class")
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS total_rows, {CNT(c + ' IS NULL')} AS null_count FROM pm" for c in NULL_COLS
    )
    q["null_profile"] = rounded(
        f"""WITH {PM}, np AS ({parts})
SELECT *, COALESCE(CAST(null_count AS DOUBLE) * 100.0 / total_rows, 0.0) AS null_pct,
       CASE WHEN COALESCE(CAST(null_count AS DOUBLE) * 100.0 / total_rows, 0.0) > 50 THEN 1 ELSE 0 END AS warning
FROM np""",
        ("null_pct",),
    )
    nulls = " + ".join(f"CAST({c} IS NULL AS BIGINT)" for c in NULL_COLS)
    q["overall_null_pct"] = rounded(
        f"""WITH {PM}, t AS (SELECT count(*) AS total_rows, CAST(COALESCE(sum({nulls}), 0) AS BIGINT) AS null_cells FROM pm)
SELECT *, COALESCE(CAST(null_cells AS DOUBLE) * 100.0 / (total_rows * {len(NULL_COLS)}), 0.0) AS overall_null_pct FROM t""",
        ("overall_null_pct",),
    )
    q["loads_per_week"] = f"""SELECT {WW('ts')} AS source_week, count(*) AS row_count, min(ts) AS first_ts, max(ts) AS last_ts
FROM events GROUP BY 1"""
    q["dashboard_measures"] = rounded(
        f"""WITH {EV},
m AS (SELECT count(*) AS total_pm_events, {CNT("lower(downtime_type) = 'unscheduled'")} AS unscheduled_pm_count,
             avg(actual_life) AS avg_pm_life, median(actual_life) AS median_pm_life,
             avg(actual_life) - avg(target_life) AS life_vs_target,
             {CNT("actual_life < lower_limit")} AS early_pm_count, {CNT("actual_life > upper_limit")} AS late_pm_count,
             COALESCE({XSUM("down_hours")}, 0.0) AS total_downtime_hours
      FROM ev)
SELECT *, COALESCE(unscheduled_pm_count / total_pm_events, 0.0) AS unscheduled_pm_rate,
       total_pm_events - early_pm_count - late_pm_count AS on_time_pm_count
FROM m""",
        ("avg_pm_life", "median_pm_life", "life_vs_target", "total_downtime_hours", "unscheduled_pm_rate"),
    )
    q["life_histogram"] = rounded(
        f"""WITH {EV}
SELECT floor(actual_life / 50.0) * 50.0 AS bin_start, count(*) AS event_count,
       floor(actual_life / 50.0) * 50.0 + 50.0 AS bin_end, (SELECT median(actual_life) FROM ev) AS median_life
FROM ev WHERE actual_life IS NOT NULL GROUP BY 1, 3""",
        ("bin_start", "bin_end", "median_life"),
    )
    q["downtime_trend_pivot"] = f"""WITH {EV}
SELECT ww_year, ww_number, work_week, {CNT("scheduled_category = 'Scheduled'")} AS scheduled_count,
       {CNT("scheduled_category = 'Unscheduled'")} AS unscheduled_count, {CNT("scheduled_category = 'Unknown'")} AS unknown_count
FROM ev WHERE work_week IS NOT NULL GROUP BY ww_year, ww_number, work_week"""
    q["events_by_site"] = rounded(
        f"""WITH {EV}
SELECT facility, count(*) AS event_count, {XSUM("down_hours")} / count(down_hours) AS avg_downtime_hours FROM ev GROUP BY facility""",
        ("avg_downtime_hours",),
    )
    q["duplicate_keys"] = f"""WITH {PM}
SELECT order_key, line_number, count(*) AS dup_count FROM pm GROUP BY order_key, line_number HAVING count(*) > 1"""
    q["coerce_types"] = rounded(
        f"""WITH {PM},
raw AS (
  SELECT order_key, line_number,
         CASE WHEN line_number = 7 THEN 'nan' WHEN line_number = 6 THEN 'None' WHEN line_number = 5 THEN 'N/A'
              WHEN line_number = 4 THEN 'x' || CAST(actual_life AS VARCHAR) ELSE CAST(actual_life AS VARCHAR) END AS a,
         CASE WHEN line_number = 3 THEN 'not a date' WHEN line_number = 2 THEN ''
              ELSE strftime(event_ts, '%Y-%m-%d %H:%M:%S') END AS t,
         CASE WHEN line_number = 1 THEN 'NULL' ELSE downtime_type END AS dt
  FROM pm
)
SELECT order_key, line_number,
       TRY_CAST(CASE WHEN trim(a) IN ({NA_TOKENS_SQL}) THEN NULL ELSE a END AS DOUBLE) AS actual_life,
       try_strptime(CASE WHEN trim(t) IN ({NA_TOKENS_SQL}) THEN NULL ELSE t END, '%Y-%m-%d %H:%M:%S') AS event_ts,
       CASE WHEN trim(dt) IN ({NA_TOKENS_SQL}) THEN NULL ELSE dt END AS downtime_type
FROM raw""",
        ("actual_life",),
    )
    q["incremental_events"] = rounded(
        """SELECT * FROM events e
WHERE NOT EXISTS (SELECT 1 FROM events p WHERE p.ts < TIMESTAMP '2024-01-15 00:00:00' AND p.event_id = e.event_id)""",
        ("value",),
    )
    q["incremental_site_weeks"] = f"""WITH {EV},
built AS (SELECT DISTINCT facility, work_week FROM ev
          WHERE event_ts < TIMESTAMP '1999-01-01 00:00:00' AND facility IS NOT NULL AND ww_year IS NOT NULL
            AND ww_number IS NOT NULL AND work_week IS NOT NULL)
SELECT facility, work_week, count(*) AS new_events FROM ev
WHERE NOT EXISTS (SELECT 1 FROM built b WHERE b.facility = ev.facility AND b.work_week = ev.work_week)
GROUP BY facility, work_week"""
    q["date_range_scan"] = rounded(
        f"""WITH {PM}
SELECT order_key, line_number, entity, event_ts, down_hours FROM pm
WHERE event_ts >= TIMESTAMP '1997-01-01 00:00:00' AND event_ts < TIMESTAMP '1998-01-01 00:00:00'""",
        ("down_hours",),
    )
    q["week_range_scan"] = f"""WITH {PM}
SELECT work_week, count(*) AS row_count FROM pm WHERE work_week >= '1997WW10' AND work_week <= '1997WW30' GROUP BY work_week"""
    q["last_7_days"] = f"""WITH {PM}, mx AS (SELECT CAST(max(event_ts) AS DATE) AS d FROM pm)
SELECT order_key, line_number, entity, event_ts FROM pm, mx
WHERE event_ts >= CAST(mx.d - 7 AS TIMESTAMP) AND event_ts < CAST(mx.d AS TIMESTAMP)"""
    q["retention_filter"] = f"""WITH {PM}
SELECT work_week, count(*) AS row_count FROM pm WHERE event_ts >= (SELECT max(event_ts) FROM pm) - INTERVAL 182 DAY GROUP BY work_week"""
    unscheduled = lambda n: rounded(
        f"""WITH {EV},{CEID_FACT}
SELECT ceid, facility, process_class, work_week, total_pm_events, unscheduled_pm_rate * 100.0 AS unscheduled_pct,
       chronic_chambers, total_chambers
FROM ceidf WHERE total_pm_events >= {n}
ORDER BY unscheduled_pm_rate DESC, ceid, facility, process_class, ww_year, ww_number LIMIT 10""",
        ("unscheduled_pct",),
    )
    q["top_unscheduled_ceids"] = unscheduled(10)
    q["top_unscheduled_ceids_low_bar"] = unscheduled(2)
    attention = lambda n: f"""WITH {EV},{PART}
SELECT part_name, ceid, entity, work_week, replacement_count, CAST(trunc(avg_life_at_replacement) AS INTEGER) AS avg_life,
       early_replacement_count, late_replacement_count
FROM partf WHERE replacement_count >= {n}
ORDER BY avg_life_at_replacement ASC NULLS LAST, part_name, entity, facility, ceid, ww_year, ww_number LIMIT 20"""  # noqa: E731
    q["parts_needing_attention"] = attention(3)
    q["parts_needing_attention_low_bar"] = attention(1)
    q["latest_summaries"] = rounded(
        f"""WITH {EV},{DOWNTIME}
SELECT facility, ceid, process_class, work_week, total_pm_events, total_downtime_hours
FROM dsum ORDER BY ww_year DESC, ww_number DESC, facility, ceid, process_class LIMIT 10""",
        ("total_downtime_hours",),
    )
    q["latest_site_kpis"] = rounded(
        f"""WITH {EV},{SITE_FACT}
SELECT facility, work_week, total_pm_events, unscheduled_pm_rate * 100.0 AS unscheduled_pct, chronic_tools_count,
       chronic_tools_pct * 100.0 AS chronic_pct
FROM site ORDER BY ww_year DESC, ww_number DESC, facility LIMIT 10""",
        ("unscheduled_pct", "chronic_pct"),
    )
    return q
