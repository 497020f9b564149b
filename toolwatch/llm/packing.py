"""Pack documents into sequences of a fixed length, shortest pack first over the length histogram.

Only the histogram (one row per length, at most ``max_tokens`` rows) comes to the
driver.  Lengths are placed longest first.  A length goes into the shortest open pack
it fits; all equal packs are extended at once, so the state is a count per pattern.
The patterns then say which ranks of each length stand where; pieces get a distributed
rank within their length and meet the patterns in a join.
"""

from __future__ import annotations

import heapq
import zlib
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from toolwatch.llm.common import arrow_map, batches_of, with_rank, written
from toolwatch.llm.tokens import library_encoder

MAX_TOKENS = 2048
#: Documents longer than this are cut; the default leaves every other document whole.
#: A smaller value cuts more and pads less where most documents fill over half a sequence.
PIECE_TOKENS = MAX_TOKENS
#: Bytes of text encoded at once: their chunks, look-ups and ids take many times that in each worker
#: (a worker's peak on 0.25 GB: 402 MB with 8 MiB, 318 MB with 2 MiB).
_TEXT_BYTES = 2 << 20
#: Rows that one task ranks.
_BUCKET_ROWS = 50_000


def pack_histogram(counts: dict[int, int], most: int) -> list[tuple[tuple[int, ...], int]]:
    """Packing patterns (lengths of one pack, longest first) and how many packs have each."""
    open_packs: dict[int, dict[tuple[int, ...], int]] = defaultdict(dict)  # by room left
    rooms: list[int] = []  # the most room first; stale entries are skipped

    def put(pattern: tuple[int, ...], room: int, n: int) -> None:
        if room not in open_packs or not open_packs[room]:
            heapq.heappush(rooms, -room)
        open_packs[room][pattern] = open_packs[room].get(pattern, 0) + n

    for length in sorted(counts, reverse=True):
        left = counts[length]
        if not 0 < length <= most:
            raise ValueError(f"length {length} is not in 1..{most}")
        made: list[tuple[tuple[int, ...], int, int]] = []
        while left and rooms and -rooms[0] >= length:
            room = -rooms[0]
            if not open_packs.get(room):
                heapq.heappop(rooms)
                continue
            pattern, n = open_packs[room].popitem()
            # As many copies as fit go into each pack while it stays the shortest.
            take = min(n, left)
            if take < n:
                open_packs[room][pattern] = n - take
            elif not open_packs[room]:
                heapq.heappop(rooms)
            put((*pattern, length), room - length, take)
            left -= take
        if left:
            # New packs; several of this length go into one if they fit and no other pack can take them.
            fit = most // length
            full, rest = divmod(left, fit)
            if full:
                made.append(((length,) * fit, most - fit * length, full))
            if rest:
                made.append(((length,) * rest, most - rest * length, 1))
        for pattern, room, n in made:
            put(pattern, room, n)
    return sorted((p, n) for by in open_packs.values() for p, n in by.items())


def pattern_ranges(patterns: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, last rank, times in a pack, first sequence, first offset) for each pattern and length."""
    out = []
    used: dict[int, int] = defaultdict(int)
    sequence = 0
    for pattern, n in patterns:
        at = 0
        for length in sorted(set(pattern), reverse=True):
            times = pattern.count(length)
            first = used[length]
            used[length] += times * n
            out.append((length, first, used[length] - 1, times, sequence, at))
            at += length * times
        sequence += n
    return out


def cut_pieces(docs: DataFrame, vocab_file: str, end_id: int, piece_tokens: int, with_ids: bool = False) -> DataFrame:
    """Encode each whole text (null: empty), append ``end_id`` and cut it: doc_id, start, length, ids_crc32, doc_tokens[, ids]."""
    slim = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"])
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_encoder(vocab_file)
        end = end_id.to_bytes(4, "little")
        step = piece_tokens * 4
        for table in batches_of(batches, _TEXT_BYTES):
            rows = []
            texts = [t or "" for t in table.column("text").to_pylist()]
            for doc_id, raw in zip(table.column("doc_id").to_pylist(), encoder.encode(texts)):
                raw += end
                for at in range(0, len(raw), step):
                    part = raw[at : at + step]
                    row = (doc_id, at // 4, len(part) // 4, zlib.crc32(part), len(raw) // 4)
                    rows.append((*row, memoryview(part).cast("I").tolist()) if with_ids else row)
            cols = [pa.array(c, pa.int64()) for c in list(zip(*rows))[:5]]
            if with_ids:
                cols.append(pa.array([r[5] for r in rows], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(cols, names + ["ids"] * with_ids)

    return arrow_map(slim, run, schema + ", ids array<int>" * with_ids)


def pack(
    docs: DataFrame, vocab_file: str, end_id: int, max_tokens: int = MAX_TOKENS, piece_tokens: int = PIECE_TOKENS, with_ids: bool = False
) -> DataFrame:
    """Pieces of all documents with their place: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids].

    Each id lies in one piece; a piece has at most ``piece_tokens`` ids and a sequence
    at most ``max_tokens``.  A null or empty text is one piece with the end id.  Rows
    with a null or repeated doc_id are packed like any other; extra columns are not
    read.  An empty table gives no rows.
    """
    if not 0 < piece_tokens <= max_tokens:
        raise ValueError("a piece must fit a sequence")
    pieces = written(cut_pieces(docs, vocab_file, end_id, piece_tokens, with_ids), "pack-pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    ranges = pattern_ranges(pack_histogram(counts, max_tokens))
    spark = docs.sparkSession
    table = spark.createDataFrame(ranges, "length long, first long, last long, times long, sequence long, at long")
    buckets = max(16, max(counts.values(), default=0) // _BUCKET_ROWS)
    spread = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(buckets))
    ranked = with_rank(pieces, ["length"], [F.col("doc_id"), F.col("start"), F.col("ids_crc32")], spread, "__rank")
    step = F.col("__rank") - F.col("first")
    # The ranges are bounded by the histogram: some thousand short rows at any size of the corpus.
    return (
        ranked.join(F.broadcast(table), "length")
        .filter(F.col("__rank").between(F.col("first"), F.col("last")))
        .select(
            "doc_id", "start", "length", "ids_crc32", "doc_tokens",
            (F.col("sequence") + F.floor(step / F.col("times"))).alias("sequence_id"),
            (F.col("at") + step % F.col("times") * F.col("length")).alias("offset"),
            *(["ids"] if with_ids else []),
        )
    )
