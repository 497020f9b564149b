"""Summarise the physical plans of registered queries (for review at scale).

usage: python tools/explain_plans.py [sf_dir] [query ...] > PLANS.md

For each query prints: number of shuffles (Exchange), broadcasts, sort-merge
joins, whole-stage-codegen spans, and every parquet scan with its pushed
filters and read schema, taken from ``explain("formatted")``.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

DEFAULT = ("site_week_kpis", "chronic_tools", "part_week_summary", "rolling_range", "date_range_scan",
           "incremental_events", "entity_dimension", "dashboard_measures")


def formatted(df, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def summarise(text: str) -> dict:
    head = text.split("\n\n")[0]
    scans = []
    for block in re.split(r"\n\(\d+\) ", text):
        if block.startswith("Scan parquet"):
            loc = re.search(r"Location: .*\[(.*?)\]", block)
            pf = re.search(r"PushedFilters: (\[.*?\])", block)
            rs = re.search(r"ReadSchema: (struct<.*?>)", block)
            scans.append({
                "table": os.path.basename(loc.group(1)) if loc else "?",
                "pushed": pf.group(1) if pf else "[]",
                "schema": rs.group(1) if rs else "?",
            })
    return {
        "exchanges": len(re.findall(r"(?<!Broadcast)Exchange \(\d+\)", head)),
        "broadcasts": head.count("BroadcastExchange"),
        "smj": head.count("SortMergeJoin"),
        "bhj": head.count("BroadcastHashJoin"),
        "codegen": 0,
        "scans": scans,
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    names = sys.argv[2:] or DEFAULT
    from toolwatch.plans import catalog
    from toolwatch.session import get_spark

    spark = get_spark("toolwatch-explain", master="local[8]", shuffle_partitions=16)
    print(f"# Physical plans (initial AQE plans, {sf_dir})\n")
    print("Counts are from `explain('formatted')` before AQE re-planning; AQE may still turn a")
    print("sort-merge join into a broadcast after measuring a shuffled side.\n")
    for n in names:
        df = catalog.REGISTRY[n](spark, sf_dir)
        s = summarise(formatted(df))
        # Codegen stages are only inserted at stage materialisation under AQE;
        # count them on the static plan of the same query.
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        simple = formatted(catalog.REGISTRY[n](spark, sf_dir), "simple")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        s["codegen"] = len(set(re.findall(r"\*\((\d+)\)", simple)))
        nodes = re.findall(r"(?:\+- |^)(\*\(\d+\) )?([A-Z][A-Za-z]+)", simple, re.M)
        s["outside"] = sorted({op for cg, op in nodes if not cg and op not in (
            "Exchange", "BroadcastExchange", "AdaptiveSparkPlan", "Subquery", "ReusedExchange", "ReusedSubquery")})
        print(f"## {n}\n")
        print(f"- shuffles: {s['exchanges']}, broadcast exchanges: {s['broadcasts']}, "
              f"sort-merge joins: {s['smj']}, broadcast hash joins: {s['bhj']}, whole-stage-codegen stages: {s['codegen']}")
        if s["outside"]:
            print(f"- operators outside codegen: {', '.join(s['outside'])}")
        for sc in s["scans"]:
            print(f"- scan `{sc['table']}` pushed {sc['pushed']} reads `{sc['schema']}`")
        print()
    spark.stop()


if __name__ == "__main__":
    main()
