"""Nearest neighbours by a hash-prefix forest.

Each tree hashes a vector to a long string of sign bits; a tree is the sorted array of
these strings.  A query descends in every tree to its longest matching prefix and then
ascends in all trees at once, one bit at a time: the rows that share the prefix are
neighbours in the sorted array.  It stops when it has met enough different rows, which
are then compared exactly.

Rows are dealt into blocks of bounded size, each with its own forest; blocks of queries
meet blocks of rows and only the nearest few of each pair of blocks are shuffled on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from toolwatch.llm.common import arrow_map, written

TREES, BITS = 32, 48
#: Share of a block's rows that a query compares at least.  The test vectors have hardly
#: any structure, so that a smaller share loses neighbours (see README).
SHARE = 0.5
BLOCK_ROWS, BLOCK_QUERIES = 4096, 8192
#: Rows from which the centre and the median of each hash bit are taken.
SAMPLE_ROWS = 10_000
FOUND = "query_id long, vec_id long, score double"


def usable(vector: Column) -> Column:
    """Not null, not zero, every component there and finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0)


class HashFamily:
    """TREES x BITS hyperplanes through the middle of a sample."""

    def __init__(self, sample: np.ndarray, trees: int = TREES, bits: int = BITS, seed: int = 11):
        self.trees, self.bits = trees, bits
        rng = np.random.default_rng(seed)
        self.planes = rng.standard_normal((sample.shape[1], trees * bits))
        self.middle = np.median(sample @ self.planes, axis=0)

    def strings(self, vectors: np.ndarray) -> np.ndarray:
        """(rows, trees) hash strings as integers, the first bit highest."""
        out = np.empty((len(vectors), self.trees), dtype=np.uint64)
        weights = np.uint64(1) << np.arange(self.bits - 1, -1, -1, dtype=np.uint64)
        for t in range(self.trees):
            part = slice(t * self.bits, (t + 1) * self.bits)
            out[:, t] = ((vectors @ self.planes[:, part] > self.middle[part]) * weights).sum(axis=1, dtype=np.uint64)
        return out


class PrefixForest:
    """Sorted arrays of the hash strings of one block."""

    def __init__(self, strings: np.ndarray, bits: int = BITS):
        self.bits = bits
        self.order = np.argsort(strings, axis=0, kind="stable")
        self.sorted = [strings[self.order[:, t], t] for t in range(strings.shape[1])]

    def ranges(self, queries: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """(trees, queries) bounds in the sorted arrays of the rows that share ``depth`` bits."""
        rest = np.uint64((1 << (self.bits - depth)) - 1)
        low, high = queries & ~rest, queries | rest
        a = np.stack([np.searchsorted(s, low[:, t], "left") for t, s in enumerate(self.sorted)])
        b = np.stack([np.searchsorted(s, high[:, t], "right") for t, s in enumerate(self.sorted)])
        return a, b

    def candidates(self, queries: np.ndarray, enough: int) -> Iterator[np.ndarray]:
        """For each query a mask of at least ``enough`` rows (all, if fewer): the deepest matches of any tree."""
        found = np.zeros((len(queries), len(self.order)), dtype=bool)
        open_ = np.arange(len(queries))
        for depth in range(self.bits, -1, -1):
            a, b = self.ranges(queries[open_], depth)
            # The ranges of a depth hold those of all greater depths; rows are marked once they may suffice.
            for i in np.flatnonzero((b - a).sum(axis=0) >= min(enough, len(self.order))).tolist():
                for t in range(len(self.sorted)):
                    found[open_[i], self.order[a[t, i] : b[t, i], t]] = True
            open_ = open_[found[open_].sum(axis=1) < enough]
            if not len(open_):
                break
        yield from found


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    flat = flat.chunk(0) if isinstance(flat, pa.ChunkedArray) else flat
    return np.asarray(flat.flatten()).astype(np.float64).reshape(len(column), -1)


def _nearest(points: np.ndarray, ids: np.ndarray, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k nearest of the rows, ties to the smaller id, by exact distance."""
    rough = ((points - query) ** 2).sum(axis=1)
    if len(rough) > k:
        near = np.flatnonzero(rough <= np.partition(rough, k - 1)[k - 1])
        points, ids, rough = points[near], ids[near], rough[near]
    order = np.lexsort((ids, rough))[:k]
    return ids[order], np.sqrt(rough[order])


def nearest_neighbours(
    rows: DataFrame, queries: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10,
    share: float = SHARE, trees: int = TREES, bits: int = BITS, sample_rows: int = SAMPLE_ROWS, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The ``k`` nearest other rows found for each row where ``queries`` holds: query_id, rank, vec_id, score.

    score is the Euclidean distance in double precision on the vectors as given (a shorter
    one ends in zeros); ties go to the smaller id.  Every row is indexed; hash planes are fitted on at most
    ``sample_rows`` rows (those with the smallest hash of their id).  Rows with a null
    id, and vectors that are null, zero, or with a null or
    non-finite component take no part.  A query never finds its own id; with repeated
    ids each row counts.  Fewer candidates than ``k`` are all returned.  Extra columns
    are not read.
    """
    spark = rows.sparkSession
    vector = F.col(vector_col).cast("array<double>")
    good = rows.select(F.col(id_col).cast("long").alias("id"), vector.alias("v"), F.coalesce(queries, F.lit(False)).alias("is_query")).filter(
        F.col("id").isNotNull() & usable(F.col("v"))
    )
    good = good.withColumn("row", F.xxhash64("id", "v"))
    size = good.agg(F.max(F.size("v")).alias("dim"), F.count(F.lit(1)).alias("n"), F.sum(F.col("is_query").cast("long")).alias("q")).first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not size["q"]:
        return empty
    dim, n_rows, n_queries = size["dim"], size["n"], size["q"]
    good = good.withColumn("v", F.concat("v", F.array_repeat(F.lit(0.0), dim - F.size("v"))))
    sample = good.select("v").orderBy(F.xxhash64("id"), "id", "row").limit(sample_rows).collect()
    family = HashFamily(np.array([r["v"] for r in sample]), trees, bits)
    n_blocks = -(-n_rows // block_rows)
    n_groups = -(-n_queries // BLOCK_QUERIES)
    schema = "id long, v array<double>, is_query boolean, row long, strings array<long>"

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                strings = family.strings(_matrix(pa.chunked_array([b.column("v")]))).astype(np.int64)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(list(strings), pa.list_(pa.int64()))], [*b.schema.names, "strings"])

    index = written(arrow_map(good.select("id", "v", "is_query", "row"), hashed, schema), "ann-strings")
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    points = index.withColumn("block", F.pmod(F.xxhash64("row", F.lit(1)), F.lit(n_blocks))).withColumn("part", every(n_groups))
    asked = index.filter("is_query").withColumn("part", F.pmod(F.xxhash64("row", F.lit(2)), F.lit(n_groups))).withColumn("block", every(n_blocks))

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out: tuple[list, list, list] = ([], [], [])
        if len(left) and len(right):
            ids, p = np.asarray(left.column("id")), _matrix(left.column("v"))
            forest = PrefixForest(_matrix_long(left.column("strings")), bits)
            q_ids, q = np.asarray(right.column("id")), _matrix(right.column("v"))
            q_strings = _matrix_long(right.column("strings"))
            enough = max(k + 1, int(np.ceil(share * len(ids))))
            for at in range(0, len(q_ids), 256):
                for i, mask in enumerate(forest.candidates(q_strings[at : at + 256], enough), at):
                    mask &= ids != q_ids[i]
                    near, score = _nearest(p[mask], ids[mask], q[i], k)
                    out[0].append(np.full(len(near), q_ids[i]))
                    out[1].append(near)
                    out[2].append(score)
        cat = [np.concatenate(x) if x else np.empty(0) for x in out]
        return pa.table({"query_id": pa.array(cat[0].astype(np.int64)), "vec_id": pa.array(cat[1].astype(np.int64)), "score": pa.array(cat[2].astype(np.float64))})

    found = points.select("block", "part", "id", "v", "strings").groupBy("block", "part").cogroup(
        asked.select("block", "part", "id", "v", "strings").groupBy("block", "part")
    ).applyInArrow(search, FOUND)
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _matrix_long(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    flat = flat.chunk(0) if isinstance(flat, pa.ChunkedArray) else flat
    return np.asarray(flat.flatten()).astype(np.uint64).reshape(len(column), -1)
