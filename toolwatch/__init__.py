"""toolwatch: Spark-native analytics for equipment-maintenance events.

Every public function takes and returns lazy DataFrames (or Columns) built from
native ``pyspark.sql.functions`` expressions; nothing is collected to the driver
and no Python UDF is used.  Layout:

* ``toolwatch.rules``       thresholds, weights and retention as one frozen object
* ``toolwatch.functions``   column-expression libraries (calendar, classifiers, coercion)
* ``toolwatch.sources``     file discovery, CSV ingest, incremental scans, the test-bed view
* ``toolwatch.operators``   enrichment, chronic scoring, KPI facts, rolling windows, reports
* ``toolwatch.sinks``       table writes, retention, load log
* ``toolwatch.plans``       bronze / silver / gold / full pipeline jobs
* ``toolwatch.streaming``   file-source and foreachBatch incremental jobs
"""

from toolwatch.rules import Rules

__all__ = ["Rules"]
