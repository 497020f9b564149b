"""Maintenance events derived from the driver's star-schema tables.

The driver ships TPC-H-like tables, not maintenance events, so every registered
query runs over a deterministic mapping (one event per ``lineitem`` row):

    entity      <- 'T' || l_suppkey            facility    <- n_name (supplier nation)
    ceid        <- p_brand                     part_name   <- p_type
    event_ts    <- l_shipdate                  work_week   <- fiscal week of event_ts
    actual_life, target_life, downtime_type, down_hours, reclean, sympathy and
    the auxiliary columns  <- fixed arithmetic on lineitem/part columns

The same mapping is written as DuckDB SQL in ``oracle_sql.py``; both sides must
stay in step.  On real data the event file carries these columns directly and
none of the joins below exist.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from toolwatch.functions.agg import exact_avg
from toolwatch.functions.calendar import work_week


# Fixed value: the folder of rows without a week, as Spark's writers name it.
NO_WEEK = "__HIVE_DEFAULT_PARTITION__"


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _bucket(suppkey: Column) -> Column:
    return F.pmod(suppkey, F.lit(10))


def pm_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw-layer maintenance events (neutral column names, native types)."""
    li = _read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
    )
    part = _read(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_size")
    supp = _read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    # nation is 25 rows by definition of the schema: a fixed-size broadcast.
    nation = F.broadcast(_read(spark, sf_dir, "nation").select("n_nationkey", "n_name"))
    supp_site = supp.join(nation, supp.s_nationkey == nation.n_nationkey).select("s_suppkey", "n_name")

    # Large-large joins are left to the planner: sort-merge on the key at scale,
    # converted to broadcast by AQE only after the small side has been measured.
    j = li.join(part, li.l_partkey == part.p_partkey).join(supp_site, li.l_suppkey == supp_site.s_suppkey)

    b = _bucket(F.col("l_suppkey"))
    qty, price, lnum = F.col("l_quantity"), F.col("l_extendedprice"), F.col("l_linenumber")
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    size = F.col("p_size").cast("double")
    high_volume = b <= 3
    return j.select(
        F.col("l_orderkey").alias("order_key"),
        lnum.alias("line_number"),
        F.col("l_partkey").alias("part_key"),
        F.concat(F.lit("T"), F.col("l_suppkey").cast("string")).alias("entity"),
        F.col("n_name").alias("facility"),
        F.col("p_brand").alias("ceid"),
        F.col("p_type").alias("part_name"),
        F.col("l_shipdate").alias("event_ts"),
        work_week(F.col("l_shipdate")).alias("work_week"),
        F.when(lnum == 7, F.lit(None).cast("double"))
        .when(high_volume, 1000 + qty * 2)
        .otherwise(qty)
        .alias("actual_life"),
        F.when(high_volume, F.lit(1000.0)).otherwise(size - 1).alias("target_life"),
        F.when(b <= 2, F.lit("Scheduled"))
        .when(b == 9, F.lit("Unscheduled"))
        .when(flag == "A", F.lit("scheduled"))
        .when(flag == "R", F.lit("UNSCHEDULED"))
        .alias("downtime_type"),
        F.when(flag == "R", F.lit("Repair")).when(flag == "A", F.lit("Adjust")).alias("downtime_class"),
        F.when(high_volume, price / 100000).when(b == 9, price / 1000).otherwise(price / 10000).alias("down_hours"),
        F.when(b == 9, F.lit(1.0)).when((status == "O") & (lnum <= 2), F.lit(1.0)).otherwise(F.lit(0.0)).alias("reclean"),
        F.when(b == 9, F.lit(1.0))
        .when(lnum == 1, F.lit(1.0))
        .when(lnum == 6, F.lit(None).cast("double"))
        .otherwise(F.lit(0.0))
        .alias("sympathy"),
        F.when(qty >= 48, F.lit(1.0)).otherwise(F.lit(0.0)).alias("outlier_label"),
        (F.col("l_discount") * 10).alias("cycle_utilization"),
        F.when(F.col("l_tax") >= 0.06, F.lit("Wear")).alias("reason_primary"),
        F.when(F.col("l_discount") >= 0.05, F.lit("Drift")).alias("reason_detail"),
        F.when(high_volume, F.lit(900.0)).otherwise(size * 0.8).alias("lower_limit"),
        F.when(high_volume, F.lit(1080.0)).otherwise(size * 1.2).alias("upper_limit"),
    )


def class_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tool -> process class (three values); suppliers with a negative balance have no row.

    Stands in for the small per-tool class file; tools without a row are UNKNOWN
    after the left join.
    """
    s = _read(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal")
    bal = F.col("s_acctbal")
    return s.filter(bal >= 0).select(
        F.concat(F.lit("T"), F.col("s_suppkey").cast("string")).alias("entity"),
        F.when(bal < 3000, F.lit("Restricted")).when(bal < 6500, F.lit("Limited")).otherwise(F.lit("Allowed")).alias("process_class"),
    )


def part_costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per (entity, part_name) part cost: mean retail price of the parts that tool used."""
    li = _read(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey")
    part = _read(spark, sf_dir, "part").select("p_partkey", "p_type", "p_retailprice")
    return (
        li.join(part, li.l_partkey == part.p_partkey)
        .groupBy(F.concat(F.lit("T"), F.col("l_suppkey").cast("string")).alias("entity"), F.col("p_type").alias("part_name"))
        .agg(exact_avg("p_retailprice").alias("part_cost"))
    )


def labour_costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per (facility, ceid) labour cost per service: 40 per hour of mean downtime."""
    ev = pm_events(spark, sf_dir)
    return ev.groupBy("facility", "ceid").agg((exact_avg("down_hours") * 40.0).alias("labour_cost"))


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The generic ``events`` table (unique ``event_id``) for id-based increments and load stats."""
    return _read(spark, sf_dir, "events")


def weekly_rows(events: DataFrame, fmt: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """Events as rows of the weekly file (87 columns and the folder), each task's in the order of the folders.

    Shuffled and sorted are the events' own columns, typed; the 87 of the file are made
    of them by the writing task.
    """
    from toolwatch.sources.schemas import EVENT_COLUMN_MAP, EXPECTED_COLUMNS, storage_name

    inverse = {v: k for k, v in EVENT_COLUMN_MAP.items()}
    cols = []
    for c in EXPECTED_COLUMNS:
        src = next((n for n, f in inverse.items() if f == storage_name(c)), None)
        if src == "event_ts":
            cols.append(F.date_format(src, fmt).alias(c))
        elif src is not None and src in events.columns:
            cols.append(F.col(src).cast("string").alias(c))
        else:
            cols.append(F.lit(None).cast("string").alias(c))
    # A week that is null or empty is named as the writer would name it: the writer keeps the order of a column without nulls.
    folder = F.coalesce(F.nullif(F.col("work_week"), F.lit("")), F.lit(NO_WEEK))
    rows = (
        events.select(*[c for c in events.columns if c in inverse], folder.alias("_folder"))
        .hint("rebalance", "_folder")  # a very large week is split over several files
        .sortWithinPartitions("_folder")
    )
    return rows.select(*cols, F.col("_folder").alias("work_week"))


def render_weekly_files(events: DataFrame, root: str, fmt: str = "yyyy-MM-dd HH:mm:ss") -> None:
    """Write events in the weekly file layout (87 columns, header, one folder per week).

    Uses Spark's partitioned CSV writer, so folders are ``work_week=<YYYYWWnn>/``
    and rendering scales with the cluster.  Unmapped columns are left empty.
    """
    from toolwatch import sinks

    w = weekly_rows(events, fmt).write.mode("overwrite").partitionBy("work_week")
    with sinks.write_settings(events.sparkSession):
        w.option("header", "true").option("escape", '"').csv(root)
