"""Token counts per document from flat, unindexed files of token ids, by separator scan.

A file is nothing but ids of a fixed width, each document closed by an end id.  It
is read in blocks of a fixed size, in parallel.  In each block one vectorised
comparison finds the end ids.  A document may begin blocks earlier: a prefix scan over
the short block summaries (running maximum of the last end, running sum of ends)
gives each block the start and number of the document that reaches into it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from toolwatch.llm.common import arrow_map, batches_of, written
from toolwatch.llm.tokens import TaskFile, filesystem, library_encoder

BLOCK_BYTES = 4 << 20
#: Tasks of a scan; more blocks than that go several to a task, one after another.
MOST_TASKS = 20_000
_TEXT_BYTES = 8 << 20
SUFFIX = ".tok"


def write_flat(docs: DataFrame, folder: str, vocab_file: str, end_id: int, width: int = 2) -> DataFrame:
    """Write flat token files of the texts (null: empty); returns (file, ordinal, doc_id), a row per document.

    One file per input partition, in the rows' order, without any shuffle.  An id
    that does not fit ``width`` bytes raises.
    """
    slim = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"])
    kind = np.dtype(f"<u{width}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_encoder(vocab_file)
        ctx = TaskContext.get()
        name = f"part-{ctx.partitionId():06d}{SUFFIX}"
        out, n = None, 0
        for table in batches_of(batches, _TEXT_BYTES):
            out = out or TaskFile(folder, name, ctx.taskAttemptId())
            for raw in encoder.encode([t or "" for t in table.column("text").to_pylist()]):
                ids = np.append(np.frombuffer(raw, "<u4"), np.uint32(end_id))
                if ids.max() > np.iinfo(kind).max:
                    raise ValueError(f"an id does not fit {width} bytes")
                out.write(ids.astype(kind).tobytes())
            rows = table.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * rows), pa.array(range(n, n + rows), pa.int64()), table.column("doc_id").combine_chunks()],
                ["file", "ordinal", "doc_id"],
            )
            n += rows
        if out:
            out.commit()

    return written(arrow_map(slim, run, "file string, ordinal long, doc_id long"), "flat-names")


def scan_flat(spark: SparkSession, folder: str, end_id: int, width: int = 2, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Documents of the flat files in ``folder``: file, ordinal, start, n_tokens (without the end id), ended.

    ``start`` is the document's first id in its file.  Ids after the last end id make
    one more document with ``ended`` false.  An empty document has n_tokens 0.  A
    folder without files gives no rows.
    """
    block_bytes -= block_bytes % width
    kind = np.dtype(f"<u{width}")
    blocks = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", f"*{SUFFIX}")
        .load(folder)
        .select("path", "length")
        .filter("length > 0")
        .select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("length") - 1) / block_bytes))).alias("block"))
    )
    n_blocks = blocks.count()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, length, k in zip(*(b.column(c).to_pylist() for c in ("path", "length", "block"))):
                fs, inner = filesystem(path)
                at = k * block_bytes
                with fs.open_input_file(inner) as f:
                    ids = np.frombuffer(f.read_at(min(block_bytes, length - at), at), dtype=kind)
                ends = np.flatnonzero(ids == end_id) + at // width
                last = int(ends[-1]) if len(ends) else None
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path]), pa.array([k], pa.int64()), pa.array([length // width], pa.int64()), pa.array([last], pa.int64()), pa.array([ends], pa.list_(pa.int64()))],
                    ["path", "block", "n_ids", "last_end", "ends"],
                )

    dealt = blocks.repartition(max(1, min(n_blocks, MOST_TASKS)), "path", "block")  # beyond that, several blocks a task
    found = written(arrow_map(dealt, run, "path string, block long, n_ids long, last_end long, ends array<long>"), "flat-ends")
    order = Window.partitionBy("path").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    stitched = found.select(
        "path", "block", "n_ids", "last_end", F.size("ends").alias("n_ends"),
    ).select(
        "path", "block", "n_ids",
        F.coalesce(F.max("last_end").over(before), F.lit(-1)).alias("before_end"),
        F.coalesce(F.sum("n_ends").over(before), F.lit(0)).alias("before_n"),
        F.max("last_end").over(Window.partitionBy("path")).alias("file_end"),
        F.sum("n_ends").over(Window.partitionBy("path")).alias("file_n"),
        F.lead("block").over(order).isNull().alias("is_last"),
    )
    name = F.element_at(F.split("path", "/"), -1).alias("file")
    closed = (
        found.select("path", "block", "ends")
        .join(stitched, ["path", "block"])
        .select(name, "before_end", "before_n", F.posexplode("ends").alias("i", "end"), "ends")
        .select(
            "file",
            (F.col("before_n") + F.col("i")).alias("ordinal"),
            (F.when(F.col("i") > 0, F.col("ends")[F.col("i") - 1]).otherwise(F.col("before_end")) + 1).alias("start"),
            "end",
        )
        .select("file", "ordinal", "start", (F.col("end") - F.col("start")).alias("n_tokens"), F.lit(True).alias("ended"))
    )
    start = F.coalesce("file_end", F.lit(-1)) + 1
    rest = stitched.filter(F.col("is_last") & (start < F.col("n_ids"))).select(
        name, F.col("file_n").alias("ordinal"), start.alias("start"), (F.col("n_ids") - start).alias("n_tokens"), F.lit(False).alias("ended")
    )
    return closed.unionByName(rest)


def token_counts(docs: DataFrame, folder: str, vocab_file: str, end_id: int, width: int = 2) -> DataFrame:
    """Write flat files of ``docs``, scan them, and name the documents found.

    Columns doc_id, n_tokens, start (in its file), file.  A row per input row, also
    for null or repeated doc_id and empty or null texts (0 tokens).  Extra columns
    are not read.  An empty table gives no rows.
    """
    names = write_flat(docs, folder, vocab_file, end_id, width)
    if names.isEmpty():
        return names.select("doc_id", F.lit(0).cast("long").alias("n_tokens"), F.lit(0).cast("long").alias("start"), "file")
    found = scan_flat(docs.sparkSession, folder, end_id, width)
    return names.join(found, ["file", "ordinal"]).select("doc_id", "n_tokens", "start", "file")
