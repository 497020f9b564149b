"""Near-duplicate documents: an LSH forest over MinHash signatures, completed by an exact join.

Equal shingle sets are one class from the start.  For each tree, the classes' signatures
are sorted; classes with a long common prefix stand next to each other.  Rows that share
a least prefix form a region: small regions are compared whole, and in a crowded one
each class meets its nearest by common prefix plus the region's most central classes, at
the end of the path into the most populous subregion at each depth.  Regions too large for
one task are cut at greater depth.  A short sketch drops hopeless pairs at once; every
remaining pair is confirmed on the full shingle sets.  Links are closed to components.

The forest only joins most of what belongs together at little cost; what it leaves apart is
completed exactly.  All shingles are put in one order, rare ones first.  Two sets that
reach the threshold share a shingle among the first of both, at places that leave enough
shingles behind; so classes of different components that share one there are confirmed
too, and no others need be.  Thousands of copies of one text are one component by then and
make no pairs among themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from toolwatch.llm.common import arrow_map, batches_of, by_ids, written
from toolwatch.llm.components import connected_components

#: Trees, and MinHash values in the signature of each.  At a similarity of 0.8 a pair
#: shares the least prefix of 3 in none of 16 trees once in 10**5 times.
TREES, DEPTH = 16, 8
#: Prefix lengths of regions: the least one, and the next for regions beyond REGION_ROWS.
LEVELS = (3, 5, 8)
REGION_ROWS = 2048
#: Neighbours in sorted order, on either side, that a class is compared with in the first pass.
NEIGHBOURS = 5
#: Central classes of a crowded region that all its rows are compared with.
CENTRES = 2
SKETCH = 64
#: A pair of similarity s agrees in a share of its sketch with a deviation under 0.055; 4.5 deviations are allowed.
SKETCH_SLACK = 0.225
#: All shingles of all documents are counted in so many counters by the first bits of their
#: hashes.  Strangers in a counter add about the same to all, so what stands in few documents
#: sorts before what stands in many.  Any order gives the same links; this one gives few candidates.
COUNTER_BITS, BLOCK_BITS = 21, 14
#: Rows of one shingle that meet in a task; more are dealt in blocks, and each block meets every other.
BLOCK_ROWS = 4096
#: A pair must share a shingle among the first, and one more for each so many shingles of the smaller set.
MORE_EACH = 128
#: Rows of one shingle that are compared by shifts, many shingles at once.
_SHORT = 64
_ROLL = np.uint64(0x9E3779B97F4A7C15)


def shingle_set(text: str, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``size``-word shingles; fewer words are one shingle, none give none."""
    words = text.encode("utf-8").lower().split()  # bytes: only A-Z and ASCII white space count
    n = len(words)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=n)
    width = min(size, n)
    if not width:
        return h
    out = np.zeros(n - width + 1, dtype=np.uint64)
    for i in range(width):
        out = out * _ROLL + h[i : n - width + 1 + i]
    out ^= out >> np.uint64(31)
    return np.unique(out * np.uint64(0xD6E8FEB86659FD93))


def _multipliers(n: int) -> np.ndarray:
    return np.random.default_rng(20).integers(1, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def signature(shingles: np.ndarray, multipliers: np.ndarray) -> np.ndarray:
    """The MinHash values, 32 bits each."""
    low = np.full(len(multipliers), np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(shingles), 1024):
        low = np.minimum(low, (shingles[None, at : at + 1024] * multipliers[:, None]).min(axis=1))
    return (low >> np.uint64(32)).astype(np.uint32)


def sketches(docs: DataFrame, shingle_words: int) -> DataFrame:
    """doc_id, n_shingles, a 128-bit hash of the set (h1, h2), signature and sketch of each row; written.

    Besides there are rows with a ``block``, null in all others: each task's ``counts`` of
    the shingles it has met, a block of counters a row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        multipliers = _multipliers(TREES * DEPTH)
        step = TREES * DEPTH // SKETCH
        counts = np.zeros(1 << COUNTER_BITS, dtype=np.uint32)
        names = ["doc_id", "n_shingles", "h1", "h2", "signature", "sketch", "block", "counts"]
        for b in batches:
            n, h1, h2, sig, sketch = [], [], [], [], []
            for text in b.column("text").to_pylist():
                s = shingle_set(text or "", shingle_words)
                at = (s >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)
                np.add.at(counts, at, np.uint32(1))
                whole = xxhash.xxh3_128_intdigest(s.tobytes())
                values = signature(s, multipliers)
                n.append(len(s))
                h1.append((whole >> 64) - 2**63)
                h2.append((whole & (2**64 - 1)) - 2**63)
                sig.append(values.astype(">u4").tobytes())
                sketch.append((values[::step] & np.uint32(255)).astype(np.uint8).tobytes())
            none = pa.nulls(len(n))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), pa.array(sig, pa.binary()), pa.array(sketch, pa.binary()),
                 none.cast(pa.int32()), none.cast(pa.binary())],
                names,
            )
        blocks = counts.reshape(-1, 1 << BLOCK_BITS)
        held = np.flatnonzero(blocks.any(axis=1))
        none, zero = pa.nulls(len(held)), pa.array(np.zeros(len(held), dtype=np.int64))
        yield pa.RecordBatch.from_arrays(
            [none.cast(pa.int64()), zero, zero, zero, none.cast(pa.binary()), none.cast(pa.binary()),
             pa.array(held.astype(np.int32)), pa.array([zstandard.compress(blocks[k].tobytes(), 1) for k in held], pa.binary())],
            names,
        )

    slim = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"])
    schema = "doc_id long, n_shingles long, h1 long, h2 long, signature binary, sketch binary, block int, counts binary"
    return written(arrow_map(slim, run, schema), "sketches")


def whole_groups(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[pa.Table]:
    """Rows sorted by column ``name`` as tables that never cut a group of equal values."""
    held = None
    for table in batches_of(batches, 1 << 20):
        held = table if held is None else pa.concat_tables([held, table])
        key = np.asarray(held.column(name))
        cut = int(np.searchsorted(key, key[-1], "left")) if len(key) else 0  # the last group may go on
        if cut:
            yield held.slice(0, cut)
            held = held.slice(cut)
    if held is not None and len(held):
        yield held


def _central(order: np.ndarray, depth: int) -> int:
    """The row at the end of the path into the most populous subregion at each depth (rows sorted by ``order``)."""
    a, b = 0, len(order)
    for d in range(depth, order.shape[1]):
        if b - a == 1:
            break
        cuts = np.flatnonzero(np.diff(order[a:b, d].astype(np.int64)) != 0) + 1
        edges = np.concatenate([[0], cuts, [b - a]])
        i = int(np.argmax(np.diff(edges)))
        a, b = a + int(edges[i]), a + int(edges[i + 1])
    return a


def _compare(threshold: float, depth: int):
    """A map function: rows sorted by (region, order) to candidate pairs of each region."""
    agree = int(np.floor((threshold - SKETCH_SLACK) * SKETCH))

    def pairs_of(key, order, ids, n, sketch):
        edges = np.concatenate([[0], np.flatnonzero(np.diff(key) != 0) + 1, [len(key)]])
        crowded = [(int(edges[i]), int(edges[i + 1])) for i in np.flatnonzero(np.diff(edges) > NEIGHBOURS + 1)]
        out = []

        def keep(a, b):
            few, many = np.minimum(n[a], n[b]), np.maximum(n[a], n[b])
            ok = few >= threshold * many - 1e-9
            a, b = a[ok], b[ok]
            ok = (sketch[a] == sketch[b]).sum(axis=1) >= agree
            out.append(np.stack([np.minimum(ids[a[ok]], ids[b[ok]]), np.maximum(ids[a[ok]], ids[b[ok]])]))

        at = np.arange(len(key))
        for d in range(1, NEIGHBOURS + 1):
            at = at[at + d < len(key)]
            at = at[key[at] == key[at + d]]
            if not len(at):
                break
            keep(at, at + d)
        for a, b in crowded:
            rest = np.arange(a, b)
            middle = a + _central(order[a:b], depth)
            for c in range(middle, min(middle + CENTRES, b)):
                keep(np.full(b - a, c), rest)
        return np.concatenate(out, axis=1) if out else np.empty((2, 0), np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "region"):
            def fixed(name, kind, width):
                return np.frombuffer(b"".join(table.column(name).to_pylist()), dtype=kind).reshape(-1, width)

            a, b = pairs_of(
                np.asarray(table.column("region")), fixed("ord", ">u4", DEPTH), np.asarray(table.column("rep")),
                np.asarray(table.column("n")), fixed("sketch", np.uint8, SKETCH),
            )
            ok = a != b
            yield pa.RecordBatch.from_arrays([pa.array(a[ok]), pa.array(b[ok])], ["a", "b"])

    return run


def candidate_pairs(nodes: DataFrame, threshold: float) -> DataFrame:
    """Distinct pairs (a < b) of classes from all trees, after the sketch."""
    trees = F.posexplode(F.array(*[F.substring("signature", t * DEPTH * 4 + 1, DEPTH * 4) for t in range(TREES)]))
    rows = nodes.select("rep", F.col("n_shingles").alias("n"), "sketch", trees.alias("tree", "ord"))
    found = None
    for depth in LEVELS:
        rows = rows.withColumn("region", F.xxhash64("tree", F.substring("ord", 1, depth * 4)))
        crowded = written(rows.groupBy("region").agg(F.count(F.lit(1)).alias("rows"), F.min("rep").alias("first")).filter(F.col("rows") > REGION_ROWS), "crowded-regions")
        any_crowded = not crowded.isEmpty()
        last = depth == LEVELS[-1]
        here = rows
        if any_crowded and not last:
            here = rows.join(crowded, "region", "left_anti")
        elif any_crowded:
            # Classes that share a whole signature: compared in parts, and each with the smallest of all.
            here = rows.join(crowded, "region", "left")
            star = here.filter("first < rep").select(F.col("first").alias("a"), F.col("rep").alias("b"))
            found = star if found is None else found.union(star)
            part = F.pmod(F.xxhash64("rep"), F.ceil(F.col("rows") / REGION_ROWS))
            here = here.withColumn("region", F.when(F.col("rows").isNull(), F.col("region")).otherwise(F.xxhash64("region", part)))
        dealt = here.select("region", "ord", "rep", "n", "sketch").repartition("region").sortWithinPartitions("region", "ord", "rep")
        pairs = arrow_map(dealt, _compare(threshold, depth), "a long, b long")
        found = pairs if found is None else found.union(pairs)
        if not any_crowded or last:
            break
        rows = written(rows.join(crowded.select("region"), "region", "left_semi"), "crowded-rows")
    return found.distinct()


def shingle_counts(parts: DataFrame) -> np.ndarray:
    """The counters of all tasks added up: a table of fixed size (4 bytes each)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for b in batches:
            for block, raw in zip(b.column("block").to_pylist(), b.column("counts").to_pylist()):
                own = np.frombuffer(zstandard.decompress(raw), dtype=np.uint32)
                totals[block] = totals[block] + own if block in totals else own.astype(np.uint64)
        some = [(k, np.minimum(v, 2**32 - 1).astype(np.uint32).tobytes()) for k, v in totals.items()]
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in some], pa.int32()), pa.array([v for _, v in some], pa.binary())], ["block", "counts"])

    out = np.zeros((1 << (COUNTER_BITS - BLOCK_BITS), 1 << BLOCK_BITS), dtype=np.uint32)
    for r in arrow_map(parts.repartition("block"), run, "block int, counts binary").collect():  # a row for each block of counters
        out[r["block"]] = np.frombuffer(r["counts"], dtype=np.uint32)
    return out.reshape(-1)


def first_shingles(shingles: np.ndarray, counts: np.ndarray, threshold: float) -> np.ndarray:
    """The first shingles of a sorted set, rare ones first: enough to hold those a set that reaches the threshold must share."""
    n = len(shingles)
    rank = counts[(shingles >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)]
    return shingles[np.argsort(rank, kind="stable")[: n - int(np.ceil(threshold * n - 1e-9)) + 1 + n // MORE_EACH]]


def _meet(threshold: float):
    """A map function: rows sorted by cell to pairs of different components, how often they meet and must at least.

    Side 0 meets all rows of its cell, 1 those of side 2.  Of the k-th shingle that a
    similar pair shares, all but k - 1 of the shingles it must share are not before it in
    either set; so the first ``need`` shared ones pass the bound below.
    """
    least = threshold / (1 + threshold)

    def pairs_of(cell, side, ids, n, rest, group):
        out = []

        def keep(a, b):
            few, many = np.minimum(n[a], n[b]), np.maximum(n[a], n[b])
            more = few // MORE_EACH
            # The shared shingle and what is left behind it must be enough of both sets.
            ok = (group[a] != group[b]) & (few >= threshold * many - 1e-9) & (np.minimum(rest[a], rest[b]) >= least * (few + many) - more - 1e-9)
            a, b = np.broadcast_arrays(a, b)
            x, y = ids[a[ok]], ids[b[ok]]
            out.append(np.stack([np.minimum(x, y), np.maximum(x, y), 1 + more[ok]], axis=1))

        edges = np.concatenate([[0], np.flatnonzero(np.diff(cell) != 0) + 1, [len(cell)]])
        sizes = np.diff(edges)
        dealt = np.maximum.reduceat(side, edges[:-1]) > 0
        short = (sizes <= _SHORT) & ~dealt
        at = np.flatnonzero(np.repeat(short & (sizes > 1), sizes))
        for d in range(1, _SHORT):
            at = at[at + d < len(cell)]
            at = at[cell[at] == cell[at + d]]
            if not len(at):
                break
            keep(at, at + d)
        for i in np.flatnonzero(~short):
            rows = np.arange(edges[i], edges[i + 1])
            if dealt[i]:
                left, right = rows[side[rows] < 2], rows[side[rows] != 1]
            else:
                names, counts = np.unique(group[rows], return_counts=True)
                left, right = rows[group[rows] != names[counts.argmax()]], rows
            for k in range(0, len(left), 128):
                keep(left[k : k + 128, None], right[None, :])
        return np.concatenate(out) if out else np.empty((0, 3), np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "cell"):
            pairs = pairs_of(*(np.asarray(table.column(c)) for c in ("cell", "side", "id", "n", "rest", "grp")))
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(pairs[:, k])) for k in range(3)], ["a", "b", "need"])

    return run


def missing_pairs(docs: DataFrame, groups: DataFrame, counts: np.ndarray, shingle_words: int, threshold: float) -> DataFrame:
    """Distinct pairs (a < b) of ``groups`` (id, grp) in different groups; none that reaches the threshold is left out.

    Every set sends about a fifth of its shingles, those with the smallest ``counts``.
    """
    groups = written(groups, "groups")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingle_set(t or "", shingle_words) for t in b.column("text").to_pylist()]
            first = [first_shingles(s, counts, threshold).view(np.int64) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(first, pa.list_(pa.int64()))], ["id", "n", "tokens"]
            )

    texts = docs.select(docs["doc_id"].cast("long").alias("id"), docs["text"]).filter("id is not null")
    first = arrow_map(texts, run, "id long, n long, tokens array<long>")
    rows = first.join(groups, "id").select("id", "n", "grp", F.posexplode("tokens").alias("pos", "token"))
    rows = written(rows.select("token", "id", "n", (F.col("n") - F.col("pos")).alias("rest"), "grp"), "shingle-rows")
    # Shingles of many rows, first by the low bits so that few counts travel: at most a row in BLOCK_ROWS.
    low = F.col("token").bitwiseAND(F.lit((1 << 20) - 1)).alias("low")
    many = rows.groupBy(low).agg(F.count(F.lit(1)).alias("m")).filter(F.col("m") > BLOCK_ROWS).select("low")
    parts = rows.withColumn("low", low).join(F.broadcast(many), "low", "left_semi").groupBy("token", "grp").agg(F.count(F.lit(1)).alias("m"))
    hot = parts.groupBy("token").agg(F.sum("m").alias("m"), F.max("m").alias("most"), F.max_by("grp", F.struct("m", "grp")).alias("main"))
    hot = written(hot.filter(F.col("m") > BLOCK_ROWS).select("token", "m", "main", (F.col("m") - F.col("most")).alias("others")), "hot-shingles")
    dealt = rows.join(F.broadcast(hot), "token", "left")
    fields = ["id", "n", "rest", "grp"]
    cells = dealt.filter("m is null").select(F.col("token").alias("cell"), F.lit(0).alias("side"), *fields)
    if not hot.isEmpty():
        # Rows outside the largest component, in blocks, meet all rows, in blocks.
        lefts, rights = F.ceil(F.col("others") / BLOCK_ROWS), F.ceil(F.col("m") / BLOCK_ROWS)
        i, j = F.pmod(F.xxhash64("id"), lefts), F.pmod(F.xxhash64("id"), rights)
        mixed = dealt.filter("others > 0")
        left = mixed.filter("grp <> main").withColumn("i", i).withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), rights - 1)))
        right = mixed.withColumn("j", j).withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), lefts - 1)))
        for side, part in ((1, left), (2, right)):
            cells = cells.union(part.select(F.xxhash64("token", "i", "j").alias("cell"), F.lit(side).alias("side"), *fields))
    met = cells.repartition("cell").sortWithinPartitions("cell", "side", "id")
    pairs = arrow_map(met, _meet(threshold), "a long, b long, need long").groupBy("a", "b")
    return pairs.agg(F.count(F.lit(1)).alias("shared"), F.min("need").alias("need")).filter("shared >= need").select("a", "b")


def confirmed(docs: DataFrame, pairs: DataFrame, shingle_words: int, threshold: float) -> DataFrame:
    """The pairs whose full shingle sets reach the threshold; only candidates' texts are shingled again."""
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
    texts = by_ids(docs.select(docs["doc_id"].cast("long").alias("id"), docs["text"]), ids, "left_semi")

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            # 48 bits of each hash: enough to tell the shingles of two documents apart.
            sets = [np.ascontiguousarray(shingle_set(t or "", shingle_words).astype("<u8").view(np.uint8).reshape(-1, 8)[:, 2:]).tobytes() for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(sets, pa.binary())], ["id", "shingles"])

    sets = written(arrow_map(texts, shingled, "id long, shingles binary"), "candidate-sets")
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def back(raw: bytes) -> np.ndarray:
            out = np.zeros((len(raw) // 6, 8), dtype=np.uint8)
            out[:, 2:] = np.frombuffer(raw, dtype=np.uint8).reshape(-1, 6)
            return out.reshape(-1).view("<u8")

        for b in batches:
            ok = []
            for x, y in zip(b.column("sa").to_pylist(), b.column("sb").to_pylist()):
                s, t = back(x), back(y)
                both = np.concatenate([s, t])
                both.sort(kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                ok.append(common >= threshold * (len(s) + len(t) - common) - 1e-9)
            mask = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column("a").filter(mask), b.column("b").filter(mask)], ["a", "b"])

    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb")
    return arrow_map(joined, confirm, "a long, b long")


def near_duplicates(docs: DataFrame, shingle_words: int = 5, threshold: float = 0.8) -> DataFrame:
    """doc_id, n_shingles, component_id and kept, a row per input row.

    Two documents are linked when their sets of ``shingle_words``-word shingles (A-Z in
    lower case, words between ASCII white space) have a Jaccard similarity of
    ``threshold`` or more; component_id is the smallest doc_id reachable over links and
    kept marks the document that bears it.  A text with fewer words is one shingle; one
    without words, or null, has none and is linked with nothing.  Rows of equal doc_id
    are judged one by one; repeated rows share their class, and all of them are kept if
    one is.  A null doc_id is its own class with a null component_id and is kept; it
    links nothing.  Extra columns are not read.  An empty table gives no rows.
    """
    made = sketches(docs, shingle_words)
    rows = made.filter("block is null")
    counts = shingle_counts(made.filter("block is not null").select("block", "counts"))
    classes = rows.filter("n_shingles > 0 and doc_id is not null").groupBy("h1", "h2").agg(
        F.min("doc_id").alias("rep"), F.max("n_shingles").alias("n_shingles"), F.max("signature").alias("signature"), F.max("sketch").alias("sketch")
    )
    nodes = written(classes, "shingle-classes")
    pairs = written(candidate_pairs(nodes, threshold), "candidate-pairs")
    links = written(confirmed(docs, pairs, shingle_words, threshold), "links")
    found = written(connected_components(links), "first-components")
    reps = nodes.select(F.col("rep").alias("id")).distinct()
    groups = reps.join(found, "id", "left").select("id", F.coalesce("component", "id").alias("grp"))
    more = written(missing_pairs(docs, groups, counts, shingle_words, threshold), "more-pairs")
    more = written(confirmed(docs, more, shingle_words, threshold), "more-links")
    found = connected_components(found.select(F.col("id").alias("a"), F.col("component").alias("b")).union(more))
    named = nodes.select("h1", "h2", "rep").join(found, F.col("rep") == F.col("id"), "left")
    named = written(named.select("h1", "h2", F.coalesce("component", "rep").alias("component_id")), "class-components")
    out = rows.select("doc_id", "n_shingles", "h1", "h2").join(named, ["h1", "h2"], "left")
    alone = (F.col("n_shingles") == 0) | F.col("doc_id").isNull()
    component = F.when(alone, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )
