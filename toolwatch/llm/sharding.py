"""Shards of nearly equal bytes by a k-d tree over document metadata, with DataFrame functions only.

Each node is split at a weighted median along the dimension that is widest in it,
relative to that dimension's range over the whole table, until a leaf holds the target
bytes.  All nodes of a level are split by the same jobs: histograms over the node's
range (partial sums per task), a running sum over the bins of each node, then a finer
histogram of the one bin that holds the median.  The driver sees one row per node.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType
from pyspark.sql.window import Window

from toolwatch.llm.common import with_rank, written

BINS = 4096
#: Positions along a dimension take the upper bits of a key, a hash the lower ones, so
#: that rows of equal metadata can be divided too.
_PLACE_BITS, _TIE_BITS = 30, 32
#: A median is exact enough when its bin has this share of a shard's bytes.
_TOLERANCE = 0.0005
_BUCKET_ROWS = 50_000
#: A string is several numbers, of so many bytes each, and a last one for all of it.
_PIECES, _PIECE_BYTES = 4, 6


@dataclass
class _Node:
    leaves: int
    first_shard: int
    dim: int = 0
    low: float = 0.0
    high: float = 0.0
    a: int = 0  # the median's key lies in a..b
    b: int = (1 << (_PLACE_BITS + _TIE_BITS)) - 1
    below: int = 0  # bytes with a key under a
    goal: float = 0.0
    cut: int | None = None  # keys up to this one go left

    @property
    def step(self) -> int:
        return (self.b - self.a) // BINS + 1


def coordinates(docs: DataFrame, name: str) -> list[Column]:
    """Numbers for a metadata value: itself, or those of a string; null and NaN count as 0.

    A string gives its first bytes, the bytes after them and so on, and at last a hash of
    the whole.  Where all strings of a node begin alike, the next number tells them apart.
    """
    col = docs[name]
    cols = [col]
    if isinstance(docs.schema[name].dataType, StringType):
        raw = F.encode(col, "utf-8")
        pieces = [F.substring(raw, 1 + k * _PIECE_BYTES, _PIECE_BYTES) for k in range(_PIECES)]
        cols = [F.conv(F.rpad(F.hex(p), 2 * _PIECE_BYTES, "0"), 16, 10) for p in pieces] + [F.xxhash64(col)]
    cols = [c.cast("double") for c in cols]
    return [F.when(c.isNull() | F.isnan(c), F.lit(0.0)).otherwise(F.greatest(F.least(c, F.lit(1e300)), F.lit(-1e300))) for c in cols]


def _pick(values: list, kind: str, node: Column) -> Column:
    """The value for the row's node: a constant array, one entry per node of a level."""
    return F.get(F.array(*[F.lit(v).cast(kind) for v in values]), node)


def _key(nodes: list[_Node], dims: list[str]) -> Column:
    node = F.col("node")
    value = F.get(F.array(*[F.col(d) for d in dims]), _pick([n.dim for n in nodes], "int", node))
    low, high = _pick([n.low for n in nodes], "double", node), _pick([n.high for n in nodes], "double", node)
    share = F.when(high > low, (value / 2 - low / 2) / (high / 2 - low / 2)).otherwise(F.lit(0.0))
    place = F.floor(share * float((1 << _PLACE_BITS) - 1)).cast("long")
    return F.shiftleft(place, _TIE_BITS) + F.col("tie")


def _refine(rows: DataFrame, nodes: list[_Node], dims: list[str], enough: float) -> None:
    """Set ``cut`` of every node that has more than one leaf."""
    keyed = rows.withColumn("key", _key(nodes, dims))
    while any(n.cut is None and n.leaves > 1 for n in nodes):
        a = [n.a if n.cut is None and n.leaves > 1 else 1 for n in nodes]
        b = [n.b if n.cut is None and n.leaves > 1 else 0 for n in nodes]  # an empty range
        node, key = F.col("node"), F.col("key")
        low = _pick(a, "long", node)
        binned = (
            keyed.filter(key.between(low, _pick(b, "long", node)))
            .withColumn("bin", F.floor((key - low) / _pick([n.step for n in nodes], "long", node)).cast("int"))
            .groupBy("node", "bin")
            .agg(F.sum("size").alias("w"), F.min("key").alias("a"), F.max("key").alias("b"))
        )
        upto = Window.partitionBy("node").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
        goal = _pick([n.goal - n.below for n in nodes], "double", node)
        crossing = (
            binned.withColumn("upto", F.sum("w").over(upto))
            .filter((F.col("upto") >= goal) & (F.col("upto") - F.col("w") < goal))
        )
        for r in crossing.collect():  # one row per node
            n = nodes[r["node"]]
            n.a, n.b = r["a"], r["b"]
            before = n.below + r["upto"] - r["w"]
            if n.a == n.b or r["w"] <= enough:
                n.cut = n.b if n.below + r["upto"] - n.goal < n.goal - before else n.a - 1
            n.below = before


def kd_shards(docs: DataFrame, n_shards: int | None = None, dims: list[str] = (), target_bytes: int | None = None) -> DataFrame:
    """Place each row in a shard: doc_id, size, text_crc32, shard, slot, law.

    ``size`` is the UTF-8 bytes of the text plus 8.  Shards are leaves of the k-d tree
    over ``dims`` and have nearly equal bytes (law ``bytes``): each cut lies within
    half a row, or 0.05 % of a shard, of its goal.  Give ``n_shards``, or ``target_bytes``
    from which their number follows.  ``slot`` counts each shard's rows from 0.

    A string counts by its bytes: by the first six in which a node's strings differ (of
    the first 24; those that only differ behind them by a hash of the whole string).

    A null text has size 8 and the checksum of no bytes, 0.  Null or NaN metadata count
    as 0; rows of equal metadata, also repeated rows, are divided by a hash of their
    row number.  Without ``dims`` that hash alone divides.  An empty table gives no
    rows.  Columns other than doc_id, text and ``dims`` are not read.
    """
    groups: list[list[int]] = []  # the numbers of each dimension, in the order in which they count
    coords: list[Column] = []
    for own in [coordinates(docs, d) for d in dims] or [[F.lit(0.0)]]:
        groups.append(list(range(len(coords), len(coords) + len(own))))
        coords += own
    names = [f"d{i}" for i in range(len(coords))]
    slim = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(docs["text"]), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(docs["text"], F.lit(""))).alias("text_crc32"),
        F.monotonically_increasing_id().alias("row"),
        *[c.alias(n) for c, n in zip(coords, names)],
    )
    # Written once: the row number is fixed from here on, and no later pass reads a text.
    base = written(slim, "shard-rows").withColumn("tie", F.pmod(F.xxhash64("row"), F.lit(1 << _TIE_BITS)))
    rows = base.withColumn("node", F.lit(0))
    nodes: list[_Node] = [_Node(1, 0)]
    spans: list[float] = []
    total = n_rows = 0
    while True:
        bounds = rows.groupBy("node").agg(
            F.sum("size").alias("w"), F.count(F.lit(1)).alias("n"),
            *[f(d).alias(f"{f.__name__}_{d}") for d in names for f in (F.min, F.max)],
        ).collect()
        if not spans:
            if not bounds:
                return base.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
            total, n_rows = bounds[0]["w"], bounds[0]["n"]
            spans = [bounds[0][f"max_{d}"] / 2 - bounds[0][f"min_{d}"] / 2 for d in names]
            if n_shards is None:
                n_shards = max(1, round(total / target_bytes))
            nodes[0].leaves = n_shards
        for r in bounds:
            n = nodes[r["node"]]
            width = [(r[f"max_{d}"] / 2 - r[f"min_{d}"] / 2) / s if s else 0.0 for d, s in zip(names, spans)]
            telling = [next((i for i in g if width[i] > 0), g[0]) for g in groups]
            n.dim = max(telling, key=lambda i: width[i])
            n.low, n.high = r[f"min_{names[n.dim]}"], r[f"max_{names[n.dim]}"]
            n.goal = r["w"] * (n.leaves // 2) / n.leaves
        seen = {r["node"] for r in bounds}
        for i, n in enumerate(nodes):
            if i not in seen:  # more shards than rows: nothing to divide
                n.cut = 0
        if all(n.leaves == 1 for n in nodes):
            break
        _refine(rows, nodes, names, _TOLERANCE * total / n_shards)
        children: list[_Node] = []
        left, right = [], []
        for n in nodes:
            left.append(len(children))
            if n.leaves == 1:
                right.append(len(children))
                children.append(_Node(1, n.first_shard))
            else:
                right.append(len(children) + 1)
                half = n.leaves // 2
                children += [_Node(half, n.first_shard), _Node(n.leaves - half, n.first_shard + half)]
        node = F.col("node")
        goes_left = _key(nodes, names) <= _pick([n.cut or 0 for n in nodes], "long", node)
        # Written level by level: the short rows are read several times per level, and plans stay small.
        rows = written(rows.withColumn("node", F.when(goes_left, _pick(left, "int", node)).otherwise(_pick(right, "int", node))), "shard-level")
        nodes = children
    placed = rows.select("doc_id", "size", "text_crc32", "row", _pick([n.first_shard for n in nodes], "int", F.col("node")).alias("shard"))
    spread = F.pmod(F.xxhash64("row"), F.lit(max(16, n_rows // (n_shards * _BUCKET_ROWS))))
    ranked = with_rank(placed, ["shard"], [F.col("doc_id"), F.col("row")], spread, "slot")
    return ranked.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot")
