"""Results are unchanged when one key holds a large share of rows and AQE splits skewed partitions."""

from pyspark.sql import functions as F

from toolwatch.operators import chronic as chr_
from toolwatch.operators import kpis
from toolwatch.operators.enrich import enrich
from toolwatch.sources import testbed

from conftest import SF_SMALL

FORCED = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1024",
}


def _skewed_events(spark):
    ev = testbed.pm_events(spark, SF_SMALL)
    # line numbers 1-3 are about 3/7 of the rows: they all go to one hot facility
    return ev.withColumn("facility", F.when(F.col("line_number") <= 3, F.lit("HOT")).otherwise(F.col("facility")))


def _rows(df):
    return sorted(
        tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect()
    )


def _run(spark):
    en = enrich(_skewed_events(spark), class_dim=testbed.class_dimension(spark, SF_SMALL))
    site = kpis.site_week_kpis(en, chr_.chronic_entities(chr_.chronic_tools(en)))
    cost = kpis.cost_summary(en, testbed.part_costs(spark, SF_SMALL))
    return _rows(site), _rows(cost)


def test_hot_facility_same_results_under_forced_skew_handling(spark):
    ev = _skewed_events(spark)
    hot = ev.filter(F.col("facility") == "HOT").count() / ev.count()
    assert hot > 1 / 3
    base = _run(spark)
    saved = {k: spark.conf.get(k, None) for k in FORCED}
    try:
        for k, v in FORCED.items():
            spark.conf.set(k, v)
        forced = _run(spark)
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert forced == base
