"""A representative subset of registered queries against their DuckDB oracles (sf0.001).

The full comparison of every query runs with ``tools/oracle_check.py``.
"""

import os

import duckdb
import pytest

import __spark_entry__ as E
from tools.oracle_check import TABLES, _hash, _norm

from conftest import SF_SMALL

SUBSET = ("site_week_kpis", "chronic_tools", "enriched_events", "downtime_summary", "rolling_range",
          "coerce_types", "date_dimension", "entity_dimension", "dashboard_measures", "incremental_events")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", SUBSET)
def test_matches_oracle(spark, con, name):
    got = _norm(E.queries()[name](spark, SF_SMALL).toPandas())
    want = _norm(con.execute(E.oracle_sql()[name]).df())
    assert list(got.columns) == list(want.columns)
    assert len(got) == len(want)
    assert _hash(got) == _hash(want)
