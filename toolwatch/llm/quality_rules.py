"""Quality rules with host verdicts.

Every document gets rule measures from its whole text.  Failures of each rule are
counted by host (partial sums first, so a host with a third of all rows is no
heavier than another), the failure rates are shrunk by a beta prior fitted to all
hosts, and the host's verdict is joined back to its documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from toolwatch.llm.common import SPACES, arrow_map, fresh, written

#: The characters counted as symbols.
SYMBOLS = "#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Limits:
    """Parameters of the rules and of the host verdict."""

    min_words: int = 50
    repeat_percent: int = 50  # words in repeated 3-word windows
    symbols_percent: int = 20  # symbols per word
    dup_lines_percent: int = 30  # repeated lines per 100 words
    word_chars: tuple[float, float] = (2.0, 15.0)  # mean length of a word
    #: A host is rejected when the shrunk failure rate of any rule is above this.
    host_rate: float = 0.5


def measure(text: str) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of a whole text."""
    words = text.encode("utf-8").split()
    n = len(words)
    word_chars = len(text) - sum(map(text.count, SPACES))
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    repeat = 0
    if n > 3:
        h = np.fromiter(map(hash, words), dtype=np.int64, count=n).view(np.uint64)
        # 64-bit sums of 64-bit word hashes with odd factors: equal windows, equal keys.
        key = h[:-2] * np.uint64(0x9E3779B97F4A7C15) + h[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + h[2:]
        order = np.sort(key)
        twice = order[1:][order[1:] == order[:-1]]
        if len(twice):
            at = np.minimum(np.searchsorted(twice, key), len(twice) - 1)
            found = twice[at] == key
            inside = np.zeros(n, dtype=bool)
            inside[:-2] = found
            inside[1:-1] |= found
            inside[2:] |= found
            repeat = int(inside.sum())
    return n, word_chars, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeat


_HOST = "__host"


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` with the measures of ``text`` added (null: no words); columns of those names are replaced."""
    carried = docs.select([c for c in docs.columns if c not in MEASURES])
    schema = StructType([*carried.schema.fields, *(StructField(m, LongType(), False) for m in MEASURES)])
    names = schema.names
    at = carried.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [measure(t or "") for t in b.column(at).to_pylist()]
            cols = [pa.array([r[k] for r in rows], pa.int64()) for k in range(len(MEASURES))]
            yield pa.RecordBatch.from_arrays([*b.columns, *cols], names)

    return arrow_map(carried, run, schema)


def rules(limits: Limits) -> dict[str, Column]:
    """Each rule as a column that is true where a document fails it."""
    n = F.col("n_words")
    mean = F.col("word_chars") / F.greatest(n, F.lit(1))
    return {
        "few_words": n < limits.min_words,
        "repeats": 100 * F.col("n_repeat_words") > limits.repeat_percent * n,
        "symbols": 100 * F.col("n_symbols") > limits.symbols_percent * n,
        "dup_lines": 100 * F.col("n_dup_lines") > limits.dup_lines_percent * n,
        "word_length": (n > 0) & ~mean.between(*limits.word_chars),
    }


def host_verdicts(rows: DataFrame, host: str, limits: Limits) -> DataFrame:
    """One row per non-null host: n_host_docs, host_fail_rate (highest shrunk rate of a rule), host_rejected.

    The prior of a rule is the beta distribution with the mean and the variance of the
    hosts' rates (less what chance adds); a host with few documents stays near the mean.
    """
    fails = rules(limits)
    by_host = rows.filter(F.col(host).isNotNull()).groupBy(F.col(host).alias(_HOST)).agg(
        F.count(F.lit(1)).alias("n_host_docs"), *[F.sum(c.cast("long")).alias(k) for k, c in fails.items()]
    )
    counted = written(by_host, "host-counts")
    n = F.col("n_host_docs")
    stats = []
    for k in fails:
        rate = F.col(k) / n
        stats += [F.avg(rate).alias(f"m_{k}"), F.var_pop(rate).alias(f"v_{k}")]
    prior = counted.agg(F.avg(1 / n).alias("one_by_n"), *stats)
    shrunk = []
    for k in fails:
        m, v = F.col(f"m_{k}"), F.col(f"v_{k}")
        chance = m * (1 - m) * F.col("one_by_n")
        strength = F.least(F.greatest(m * (1 - m) / F.greatest(v - chance, F.lit(1e-9)) - 1, F.lit(2.0)), F.lit(1e4))
        shrunk.append((F.col(k) + strength * m) / (n + strength))
    # One row of means and variances meets every host.
    return counted.join(F.broadcast(prior)).select(_HOST, "n_host_docs", F.greatest(*shrunk).alias("host_fail_rate")).withColumn(
        "host_rejected", F.col("host_fail_rate") > limits.host_rate
    )


def quality_rules(docs: DataFrame, host: str = "source", limits: Limits = Limits(), carry: list[str] | None = None) -> DataFrame:
    """``docs`` with MEASURES, base_failed, n_host_docs, host_fail_rate, host_rejected and kept; a row per input row.

    base_failed: too few words or too much repetition.  kept: not base_failed and the
    host not rejected.  ``carry`` names the columns to return besides these (default
    all); a column of ``docs`` with one of the added names is replaced.  A null text
    has no words and fails.  Documents with a null host are judged by their own text
    alone.  Rows of equal doc_id are judged one by one.  An empty table stays empty.
    """
    added = [*MEASURES, "base_failed", "n_host_docs", "host_fail_rate", "host_rejected", "kept"]
    carry = [c for c in (docs.columns if carry is None else carry) if c not in added]
    slim = docs.select([c for c in docs.columns if c in {*carry, host, "text"}])
    rows = measured(slim).select(*dict.fromkeys([*carry, host]), *MEASURES)
    rows = written(rows, "rule-measures")  # read twice; texts are measured once
    own = fresh(_HOST, rows.columns)
    hosts = written(host_verdicts(rows, host, limits).withColumnRenamed(_HOST, own), "host-verdicts")
    fails = rules(limits)
    return (
        rows.join(hosts, rows[host] == hosts[own], "left")
        .withColumn("base_failed", fails["few_words"] | fails["repeats"])
        .withColumn("host_rejected", F.coalesce("host_rejected", F.lit(False)))
        .withColumn("kept", ~F.col("base_failed") & ~F.col("host_rejected"))
        .select(*carry, *added)
    )
