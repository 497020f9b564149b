"""Reading tables and parameterised SQL (the session is the only connection)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, name_or_path: str, fmt: str = "parquet") -> DataFrame:
    """A catalog table by name, or a table directory by path."""
    if "/" in name_or_path or ":" in name_or_path:
        return spark.read.format(fmt).load(name_or_path)
    return spark.table(name_or_path)


def fetch(spark: SparkSession, query: str, params: dict | None = None) -> DataFrame:
    """Run SQL with named parameters (``:name`` markers), bound by Spark, never by string formatting."""
    return spark.sql(query, args=params or {})
