"""Vector codes: a codebook per part of the vectors, searched by Orchard's method.

For every entry of a codebook the other entries are listed by their distance from it.  A
part starts at one entry and walks that entry's list; an entry that is nearer becomes the
current one and the walk goes on in its list, over entries not yet visited.  It ends at the
first entry further than twice the distance of the part from the current entry: by the
triangle inequality neither that one nor any behind it can be nearer.  So each part finds
its nearest entry exactly, and compares itself with few.

Components are integers, and every sum is exact: the codes do not depend on how the rows
are divided.  A round reads the rows once; what leaves a task is one sum per codebook cell.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from toolwatch.llm.common import arrow_map, written

PARTS, ENTRIES, ROUNDS = 8, 16, 6
SCALE = 4096
#: Scaled components end here on either side, so that sums of squares of 128 of them fit 64 bits.
LIMIT = 2**27
#: Rows that are walked at once.
STEP_ROWS = 8192


def neighbour_lists(book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry all entries by distance from it (ties by index), and these squared distances."""
    square = ((book[:, None, :] - book[None, :, :]) ** 2).sum(axis=2)
    order = np.argsort(square, axis=1, kind="stable")
    return order, np.take_along_axis(square, order, axis=1)


def starts(points: np.ndarray, book: np.ndarray) -> np.ndarray:
    """An entry near each point along the component in which the entries differ most."""
    axis = int(np.argmax(book.max(axis=0) - book.min(axis=0)))
    order = np.argsort(book[:, axis], kind="stable")
    at = np.searchsorted(book[order, axis], points[:, axis]).clip(0, len(book) - 1)
    return order[at]


def orchard(points: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest entry (ties to the lower index) and squared distance of each point, and the distances computed."""
    order, square = neighbour_lists(book)
    current = starts(points, book)
    best = ((points - book[current]) ** 2).sum(axis=1)
    seen = np.zeros((len(points), len(book)), dtype=bool)
    seen[np.arange(len(points)), current] = True
    place = np.zeros(len(points), dtype=np.int64)
    walking = np.arange(len(points))
    computed = len(points)
    while len(walking):
        # Squared: further than twice the current distance is more than four times its square.
        walking = walking[place[walking] < len(book)]
        walking = walking[square[current[walking], place[walking]] <= 4 * best[walking]]
        entry = order[current[walking], place[walking]]
        place[walking] += 1
        new = ~seen[walking, entry]
        who, entry = walking[new], entry[new]
        seen[who, entry] = True
        found = ((points[who] - book[entry]) ** 2).sum(axis=1)
        computed += len(who)
        nearer = (found < best[who]) | ((found == best[who]) & (entry < current[who]))
        jump = who[nearer]
        current[jump], best[jump], place[jump] = entry[nearer], found[nearer], 0
    return current, best, computed


def _scaled(column: pa.Array, width: int) -> np.ndarray:
    """(rows, width) integers floor(SCALE * x); shorter vectors end in zeros."""
    flat = np.asarray(column.flatten().cast(pa.float64()))
    lengths = np.asarray(pa.compute.list_value_length(column)).astype(np.int64)
    out = np.zeros((len(column), width), dtype=np.int64)
    with np.errstate(over="ignore"):
        out[np.arange(width)[None, :] < lengths[:, None]] = np.floor(flat * SCALE).clip(-LIMIT, LIMIT)
    return out


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), width)


def integer_vectors(rows: DataFrame, id_col: str, vector_col: str, label_col: str | None, parts: int) -> tuple[DataFrame, int]:
    """id, label and v (scaled integers) of the rows with a complete, finite vector, and the length of v."""
    label = F.col(label_col).cast("string") if label_col else F.lit(None).cast("string")
    vector = F.col(vector_col).cast("array<double>")
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = rows.select(F.col(id_col).cast("long").alias("id"), label.alias("label"), vector.alias("v")).filter(F.col("v").isNotNull() & ~bad)
    longest = good.agg(F.max(F.size("v")).alias("d")).first()["d"] or 0
    width = max(1, -(-longest // parts)) * parts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                v = pa.FixedSizeListArray.from_arrays(pa.array(_scaled(b.column("v"), width).reshape(-1)), width)
                yield pa.RecordBatch.from_arrays([b.column("id"), b.column("label"), v.cast(pa.list_(pa.int64()))], ["id", "label", "v"])

    return written(arrow_map(good, run, "id long, label string, v array<long>"), "integer-vectors"), width


def first_books(vectors: DataFrame, width: int, parts: int, entries: int) -> np.ndarray:
    """(parts, entries, width / parts): the parts of the vectors with the smallest ids (fewer entries, if there are fewer)."""
    rows = vectors.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    start = np.array([r["v"] for r in rows], dtype=np.int64).reshape(len(rows), parts, width // parts)
    return np.ascontiguousarray(start.transpose(1, 0, 2))


def refined(vectors: DataFrame, books: np.ndarray) -> np.ndarray:
    """One round: every part to its nearest entry, every used entry to the floored mean of its parts."""
    parts, entries, size = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, entries, size + 1), dtype=np.int64)
        for b in batches:
            whole = _matrix(b.column("v"), parts * size)
            for at in range(0, len(whole), STEP_ROWS):
                for p in range(parts):
                    points = np.ascontiguousarray(whole[at : at + STEP_ROWS, p * size : (p + 1) * size])
                    code = orchard(points, books[p])[0]
                    np.add.at(total[p], (code, slice(0, size)), points)
                    total[p, :, size] += np.bincount(code, minlength=entries)
        flat = total.reshape(-1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat)], ["cell", "total"])

    sums = arrow_map(vectors.select("v"), run, "cell long, total long").groupBy("cell").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    flat = np.zeros(parts * entries * (size + 1), dtype=object)
    for r in sums.collect():  # parts x entries x (size + 1) rows, whatever the size of the table
        flat[r["cell"]] = int(r["total"])
    total = flat.reshape(parts, entries, size + 1)
    out = books.copy()
    for p in range(parts):
        for e in range(entries):
            if total[p, e, size]:
                out[p, e] = [x // total[p, e, size] for x in total[p, e, :size]]
    return out


def books_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def vector_codes(
    rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str | None = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
) -> tuple[DataFrame, np.ndarray]:
    """Codes of all vectors, and the codebooks (parts, entries, components).

    The rows are: id, label (as text), codes (the entry of each part), error (squared
    distances summed over the parts).  Rows whose vector is null or holds null, NaN or
    infinite components are left out; all others are coded, one row per input row, zero
    vectors and repeated ids too.  A component is floor(4096 * x), at most 2**27 on either
    side; a vector shorter than the longest (or one whose length ``parts`` does not divide)
    ends in zeros.  The codebooks start from the smallest ids, equal ids in the order of
    their vectors and null ids last; with fewer rows than ``entries`` they have as many
    entries as rows.  An empty table has no codes and no entries.  ``label_col=None``
    leaves all labels null.  Extra columns are not read.
    """
    vectors, width = integer_vectors(rows, id_col, vector_col, label_col, parts)
    books = first_books(vectors, width, parts, entries)
    for _ in range(rounds if books.shape[1] else 0):
        books = refined(vectors, books)
    size = width // parts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            whole = _matrix(b.column("v"), width)
            codes = np.empty((len(whole), parts), dtype=np.int32)
            error = np.zeros(len(whole), dtype=np.int64)
            for p in range(parts if len(whole) else 0):
                codes[:, p], square, _ = orchard(np.ascontiguousarray(whole[:, p * size : (p + 1) * size]), books[p])
                error += square
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("label"), pa.array(list(codes), pa.list_(pa.int32())), pa.array(error)], ["id", "label", "codes", "error"])

    return arrow_map(vectors, run, "id long, label string, codes array<int>, error long"), books


def coded_rows(rows: DataFrame, **options) -> DataFrame:
    """vec_id, code (two hex digits a part), error, label_error and codebooks_sha256 of ``vector_codes``.

    label_error adds up the errors of all rows with the same label, null labels together;
    the sums are made before they meet the rows again.
    """
    codes, books = vector_codes(rows, **options)
    codes = written(codes, "vector-codes")
    by_label = codes.groupBy(F.col("label").alias("same")).agg(F.sum("error").alias("label_error"))
    hexed = F.concat_ws("", F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))))
    return codes.join(by_label, F.col("label").eqNullSafe(F.col("same"))).select(
        F.col("id").alias("vec_id"), hexed.alias("code"), "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256")
    )
