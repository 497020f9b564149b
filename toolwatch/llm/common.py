"""Helpers shared by the operators: worker set-up, written tables, bounded batches, distributed ranks."""

from __future__ import annotations

import contextlib
import ctypes
import os
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from toolwatch.session import checkpoint_dir

REPO_ROOT = str(Path(__file__).resolve().parents[2])

#: Rows of one Arrow batch sent to a Python worker.  Texts may be long, so a batch
#: is bounded well under Spark's default of 10,000 rows.
ARROW_ROWS = 512

#: ASCII white space, the only word separators of the text rules here.
SPACES = " \t\n\x0b\x0c\r"


def arrow_map(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` with bounded batches and workers that can import this package.

    On a cluster the package reaches the executors by ``--py-files`` or an installed
    wheel; a local session only needs the repository on its workers' path.
    """
    spark = df.sparkSession
    env = spark.sparkContext.environment
    if REPO_ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [REPO_ROOT, env.get("PYTHONPATH", "")]))
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from fn(batches)
        give_back()

    return df.mapInArrow(run, schema)


def give_back() -> None:
    """Return memory that a task has freed to the system: its worker process lives on, often idle."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library can
        ctypes.CDLL(None).malloc_trim(0)


def batches_of(batches: Iterator[pa.RecordBatch], most_bytes: int) -> Iterator[pa.Table]:
    """Join Arrow batches to tables of about ``most_bytes`` (at least one batch each)."""
    held: list[pa.RecordBatch] = []
    size = 0
    for b in batches:
        held.append(b)
        size += b.nbytes
        if size >= most_bytes:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (not created yet)."""
    return f"{checkpoint_dir(spark).rstrip('/')}/toolwatch-{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends at replicated files."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def named(name: str) -> Column:
    """The column of exactly this name, dots and backquotes included."""
    return F.col("`" + name.replace("`", "``") + "`")


def by_ids(rows: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """Semi or anti join of ``rows`` with one column of distinct numbers that has the same name in both.

    The ids are written first, so that Spark knows their bytes: few are broadcast and the
    texts stay where they are, more meet the rows in a shuffle.
    """
    (name,) = ids.columns
    return rows.join(written(ids, "ids"), name, how).select(*map(named, rows.columns))


def fresh(name: str, columns: list[str]) -> str:
    """``name``, made longer until no column has it (column names differ by more than their case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


_HELD = "held"


def held(docs: DataFrame, plain: list[str]) -> DataFrame:
    """``docs`` with the columns ``plain`` as they are and all others out of the way in one struct, ``held``."""
    plain = [c for c in plain if c in docs.columns]
    others = [c for c in docs.columns if c not in plain]
    rest = F.struct(*map(named, others)) if others else F.lit(None).cast("int")
    return docs.select(*map(named, plain), rest.alias(_HELD))


def released(rows: DataFrame, docs: DataFrame, plain: list[str]) -> DataFrame:
    """The columns of ``docs`` again, in their order, from rows that came from ``held``."""
    return rows.select(*[F.col(c) if c in plain else F.col(_HELD)[c].alias(c) for c in docs.columns])


def with_rank(df: DataFrame, keys: list[str], order: list[Column], bucket: Column, out: str, first: int = 0) -> DataFrame:
    """Gapless ``out`` = 0, 1, ... within each key, ordered by (bucket, order), without one task per key.

    Rows of a key are split into ``bucket`` groups (a bounded number of rows each);
    groups are counted with partial aggregation, the counts are summed over the
    buckets before, and only the rows of one (key, bucket) meet in a task.
    """
    b = "__bucket"
    rows = df.withColumn(b, bucket)
    counts = rows.groupBy(*keys, b).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*keys).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    inside = Window.partitionBy(*keys, b).orderBy(*order)
    ranked = rows.withColumn("__at", F.row_number().over(inside))
    return (
        ranked.join(counts, [*keys, b])
        .withColumn(out, (F.col("__before") + F.col("__at") - 1 + F.lit(first)).cast("long"))
        .drop(b, "__at", "__before")
    )
