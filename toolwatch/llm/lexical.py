"""Ranked lexical search by hashed sketches of maxima.

A document's impacts fold into a few rows of coordinates: a term belongs to one coordinate
of every row, and a coordinate keeps the largest impact of its terms.  The smallest of a
term's coordinates is therefore never below the term's own impact, and the weighted sum of
these over a query's terms is an upper bound of the document's score.  Within a document
the impact grows with the number of occurrences and depends on nothing else but its length,
so the sketch holds occurrences, a byte each (255: that many or more), and one index serves
every query set and every weighting.  Sketches grow with their documents.

A search looks a block of queries up in all sketches.  The documents with the highest bounds
are scored exactly first; their scores give each query a threshold.  Every document whose
bound reaches it is then scored exactly, from its whole text.  A document that is not scored
has a bound below a score that enough others reach, so the ranking is exact.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from toolwatch.llm.common import arrow_map, written

#: Rows of a sketch, and its least coordinates per distinct term (rounded up to a power of two).
SKETCH_ROWS, LOAD = 3, 2
#: Queries searched together, and bytes of their texts: about as much is known to each task.
BLOCK_QUERIES, BLOCK_BYTES = 4096, 32 << 20
#: Documents scored exactly for a query's first threshold, for each one asked for.
FIRST = 3

_ODD = np.random.default_rng(31).integers(1, 2**63, SKETCH_ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Bytes that belong to terms: ASCII letters (lower-cased) and digits, and all of any other character.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms(text: str | None) -> list[bytes]:
    """All terms of the text in order, as UTF-8."""
    return (text or "").encode("utf-8").translate(_FOLD).split()


def coordinates(words: list[bytes]) -> np.ndarray:
    """(SKETCH_ROWS, words) hashes of 32 bits; the low ones are the coordinate in a row."""
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    return (h[None, :] * _ODD[:, None]) >> np.uint64(32)


def sketch(counts: Counter) -> bytes:
    """Maxima of the occurrences (at most 255) over the terms of each coordinate, row after row."""
    n = len(counts)
    width = 1 << max(3, (LOAD * n - 1).bit_length())
    out = np.zeros((SKETCH_ROWS, width), dtype=np.uint8)
    at = (coordinates(list(counts)) & np.uint64(width - 1)).astype(np.int64)
    tf = np.minimum(np.fromiter(counts.values(), dtype=np.int64, count=n), 255).astype(np.uint8)
    for r in range(SKETCH_ROWS):
        np.maximum.at(out[r], at[r], tf)
    return out.tobytes()


def index_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, key (hash of the text), n (terms) and sketch of every row with at least one term; written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: tuple[list, list, list, list] = ([], [], [], [])
            for i, key, text in zip(*(b.column(c).to_pylist() for c in ("doc_id", "key", "text"))):
                found = terms(text)
                if found:
                    for column, value in zip(out, (i, key, len(found), sketch(Counter(found)))):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()), pa.array(out[3], pa.binary())],
                ["doc_id", "key", "n", "sketch"],
            )

    return written(arrow_map(_texts(docs, id_col, text_col), run, "doc_id long, key long, n long, sketch binary"), "max-sketches")


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("key"), text.alias("text"))


class Queries:
    """A block of queries: their terms, and the weights and lengths that all documents give."""

    def __init__(self, rows: list[tuple[int, str | None]]):
        self.texts = [terms(t) for _, t in rows]
        self.ids = [i for i, _ in rows]
        self.vocabulary = sorted({t for ts in self.texts for t in ts})

    def weigh(self, df: dict[bytes, int], n_docs: int, n_terms: int) -> None:
        """Keep the terms that some document holds; a term in none adds nothing to any score."""
        self.n_docs, self.n_terms = n_docs, n_terms
        self.known = [t for t in self.vocabulary if df.get(t)]
        self.weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in self.known}
        place = {t: i for i, t in enumerate(self.known)}
        self.words = [[t for t in ts if t in place] for ts in self.texts]
        flat = [place[t] for ts in self.words for t in ts]
        self.flat = np.array(flat, dtype=np.int64)
        self.flat_weight = np.array([self.weight[self.known[i]] for i in flat], dtype=np.int64)
        self.some = np.array([q for q, ts in enumerate(self.words) if ts], dtype=np.int64)
        lengths = np.array([len(self.words[q]) for q in self.some], dtype=np.int64)
        self.edges = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64) if len(lengths) else np.zeros(0, np.int64)
        self.coordinates = coordinates(self.known)

    def length(self, n: int) -> int:
        return 100 - 25 + (25 * n * self.n_docs) // self.n_terms

    def bounds(self, n: int, raw: bytes) -> np.ndarray:
        """Upper bounds of the scores of one document, for the queries in ``some``."""
        table = np.frombuffer(raw, dtype=np.uint8).reshape(SKETCH_ROWS, -1)
        at = (self.coordinates & np.uint64(table.shape[1] - 1)).astype(np.int64)
        tf = table[0][at[0]]
        for r in range(1, SKETCH_ROWS):
            tf = np.minimum(tf, table[r][at[r]])
        seen = np.arange(256, dtype=np.int64)
        impact = (1_000_000_000 * seen) // np.maximum(1000 * seen + 12 * self.length(n), 1)
        impact[255] = 1_000_000  # that many or more: the limit of the impact
        # Weights of terms in nearly every document may be 0, never below.
        return np.add.reduceat(self.flat_weight * impact[tf][self.flat], self.edges)

    def score(self, counts: Counter, n: int, q: int) -> int:
        """Exact score of a document for the query at place ``q``."""
        m = 12 * self.length(n)
        return sum(self.weight[t] * ((1_000_000_000 * counts[t]) // (1000 * counts[t] + m)) for t in self.words[q] if t in counts)


def _document_counts(texts: DataFrame, queries: Queries) -> dict[bytes, int]:
    """Documents that hold each term of the queries, over all documents."""
    wanted = frozenset(queries.vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df: Counter = Counter()
        for b in batches:
            for text in b.column("text").to_pylist():
                df.update(wanted.intersection(terms(text)))
        yield pa.RecordBatch.from_arrays([pa.array(list(df), pa.binary()), pa.array(list(df.values()), pa.int64())], ["term", "n"])

    counts = arrow_map(texts.select("text"), run, "term binary, n long").groupBy("term").agg(F.sum("n").alias("n"))
    return {bytes(r["term"]): r["n"] for r in counts.collect()}  # at most the block's vocabulary


def _highest_bounds(index: DataFrame, queries: Queries, most: int) -> DataFrame:
    """query, doc_id, key and bound of the ``most`` documents with the highest bounds of each query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple]] = [[] for _ in queries.some]
        least = np.zeros(len(queries.some), dtype=np.int64)
        for b in batches:
            for i, key, n, raw in zip(*(b.column(c).to_pylist() for c in ("doc_id", "key", "n", "sketch"))):
                bounds = queries.bounds(n, raw)
                for q in np.flatnonzero(bounds > least).tolist():
                    entry = (int(bounds[q]), i is not None, i or 0, key)
                    if len(best[q]) < most:
                        heapq.heappush(best[q], entry)
                    else:
                        heapq.heapreplace(best[q], entry)
                    if len(best[q]) == most:
                        least[q] = best[q][0][0]
        rows = [(int(queries.some[q]), i if there else None, key, bound) for q, own in enumerate(best) for bound, there, i, key in own]
        yield pa.RecordBatch.from_pylist([dict(zip(("query", "doc_id", "key", "bound"), r)) for r in rows], schema=_BOUNDS)

    found = arrow_map(index, run, "query int, doc_id long, key long, bound long")
    order = Window.partitionBy("query").orderBy(F.desc("bound"), F.asc_nulls_last("doc_id"), "key")
    return found.withColumn("at", F.row_number().over(order)).filter(F.col("at") <= most).drop("at")


_BOUNDS = pa.schema([("query", pa.int32()), ("doc_id", pa.int64()), ("key", pa.int64()), ("bound", pa.int64())])


def _reaching(index: DataFrame, queries: Queries, threshold: np.ndarray) -> DataFrame:
    """query, doc_id, key and bound of all documents whose bound reaches the query's threshold (and is above 0)."""
    least = np.maximum(threshold[queries.some], 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for i, key, n, raw in zip(*(b.column(c).to_pylist() for c in ("doc_id", "key", "n", "sketch"))):
                bounds = queries.bounds(n, raw)
                rows += [(int(queries.some[q]), i, key, int(bounds[q])) for q in np.flatnonzero(bounds >= least).tolist()]
            yield pa.RecordBatch.from_pylist([dict(zip(("query", "doc_id", "key", "bound"), r)) for r in rows], schema=_BOUNDS)

    return arrow_map(index, run, "query int, doc_id long, key long, bound long")


def _exact(texts: DataFrame, candidates: DataFrame, queries: Queries, k: int, threshold: np.ndarray) -> DataFrame:
    """query, doc_id and exact score of the k best candidates of every task.

    A task scores a candidate only while its bound can still reach the k best it has found.
    """
    flags = candidates.select("doc_id", "key", F.struct("query", "bound").alias("one")).groupBy("doc_id", "key").agg(F.collect_set("one").alias("asked"))
    flags = flags.select(F.col("doc_id").alias("id"), F.col("key").alias("same"), "asked")  # at most a block of queries each
    met = texts.join(flags, texts["doc_id"].eqNullSafe(F.col("id")) & (texts["key"] == F.col("same"))).select("doc_id", "text", "asked")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[tuple]] = {}  # per query a heap of (score, -doc_id), the worst first; a null doc_id comes last
        for b in batches:
            ids, texts_, asked = (b.column(c).to_pylist() for c in ("doc_id", "text", "asked"))
            order = sorted(((o["bound"], at, o["query"]) for at, ones in enumerate(asked) for o in ones), reverse=True)
            own: dict[int, tuple[Counter, int]] = {}
            for bound, at, q in order:  # descending bounds
                kept = best.setdefault(q, [])
                if bound < threshold[q] or (len(kept) == k and bound < kept[0][0]):
                    continue
                if at not in own:
                    found = terms(texts_[at])
                    own[at] = Counter(found), len(found)
                score = queries.score(*own[at], q)
                if score > 0:
                    entry = (score, -math.inf if ids[at] is None else -ids[at])
                    (heapq.heappush if len(kept) < k else heapq.heappushpop)(kept, entry)
        rows = [(q, None if i == -math.inf else -i, score) for q, kept in best.items() for score, i in kept]
        q, i, score = zip(*rows) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), pa.array(i, pa.int64()), pa.array(score, pa.int64())], ["query", "doc_id", "score"])

    return arrow_map(met, run, "query int, doc_id long, score long")


def _best(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` highest scores of each query with their ranks (limited in every task before the shuffle)."""
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def lexical_search(
    docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """item_id, rank, doc_id and score of the ``k`` highest-scoring documents of every item.

    Terms are runs of ASCII letters (A-Z lower-cased), digits and all characters beyond
    ASCII.  A term weighs floor(1000 ln((2 N + 2) / (2 df + 1))); occurrences tf count
    (10**9 tf) div (1000 tf + 12 m) with m = 75 + (25 n N) div L.  Only scores above 0 are
    returned, equal ones by ascending doc_id, a null doc_id last.  Null and empty texts
    have no terms: such a document is not counted and such an item has no rows.  Every row
    is a document, and every row an item, of its own, also if ids or texts repeat.  Empty
    tables give no rows.  Extra columns are not read.
    """
    spark = docs.sparkSession
    out = "item_id long, rank int, doc_id long, score long"
    asked = items.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).cast("string").alias("text")).filter("text is not null")
    size = asked.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    index = index_documents(docs, id_col, text_col)
    total = index.agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("terms")).first()
    if not size["n"] or not total["n"]:
        return spark.createDataFrame([], out)
    texts = _texts(docs, id_col, text_col)
    n_blocks = max(-(-size["n"] // BLOCK_QUERIES), -(-size["bytes"] // BLOCK_BYTES))
    parts = []
    for block in range(n_blocks):
        own = asked.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == block) if n_blocks > 1 else asked
        queries = Queries([(r["item_id"], r["text"]) for r in own.orderBy("item_id", "text").collect()])
        queries.weigh(_document_counts(texts, queries), total["n"], total["terms"])
        if not len(queries.some):
            continue
        nothing = np.zeros(len(queries.ids), dtype=np.int64)
        first = written(_highest_bounds(index, queries, FIRST * k), "highest-bounds")
        threshold = nothing.copy()
        for r in _best(_exact(texts, first, queries, k, nothing), k).filter(F.col("rank") == k).collect():  # a number for each query
            threshold[r["query"]] = r["score"]
        reaching = written(_reaching(index, queries, threshold), "reaching-bounds")
        found = _best(_exact(texts, reaching, queries, k, threshold), k)
        names = spark.createDataFrame([(q, i) for q, i in enumerate(queries.ids)], "place int, item_id long")
        found = found.join(names, F.col("query") == F.col("place")).select("item_id", F.col("rank").cast("int"), "doc_id", "score")
        parts.append(written(found, "ranked") if n_blocks > 1 else found)
    if not parts:
        return spark.createDataFrame([], out)
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.union(p)
    return whole
