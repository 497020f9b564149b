"""Token ids in files of compressed byte planes, with a chunk index.

A file holds ids of whole documents in ascending doc_id order, cut into blocks of a
fixed number of ids.  A block is transposed: all lowest bytes, all second bytes, and
so on.  Each plane is compressed alone with zstandard (the high bytes, nearly all
equal, shrink to almost nothing).  The footer has the chunk index (per block: number
of ids, file offset, length of each plane) and the document index (doc_id, ids).
The last 16 bytes are the footer's offset and the magic word.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from toolwatch.llm.common import arrow_map, batches_of, written
from toolwatch.llm.tokens import TaskFile, filesystem, library_encoder

MAGIC = b"TWPLANE1"
BLOCK_IDS = 1 << 18
_TEXT_BYTES = 8 << 20
MANIFEST = "part int, file string, n_docs long, n_ids long, n_bytes long"


def pack_block(ids: np.ndarray, level: int = 3) -> list[bytes]:
    """The four compressed byte planes of a block of uint32 ids."""
    planes = ids.astype("<u4").view(np.uint8).reshape(-1, 4).T
    squeeze = zstandard.ZstdCompressor(level=level, write_content_size=True)
    return [squeeze.compress(np.ascontiguousarray(p).tobytes()) for p in planes]


def unpack_block(planes: list[bytes], n: int) -> np.ndarray:
    out = np.empty((n, 4), dtype=np.uint8)
    grow = zstandard.ZstdDecompressor()
    for k, p in enumerate(planes):
        out[:, k] = np.frombuffer(grow.decompress(p, max_output_size=n), dtype=np.uint8)
    return out.reshape(-1).view("<u4")


class PlaneWriter:
    """Takes the ids of one document after another; bounded by one block of ids."""

    def __init__(self, file: TaskFile, block_ids: int = BLOCK_IDS):
        self.file, self.block = file, block_ids
        self.held: list[bytes] = []
        self.n_held = self.n_ids = 0
        self.chunks: list[list[int]] = []
        self.doc_ids: list[int | None] = []
        self.doc_n: list[int] = []

    def add(self, doc_id: int | None, raw: bytes) -> None:
        n = len(raw) // 4
        self.doc_ids.append(doc_id)
        self.doc_n.append(n)
        self.n_ids += n
        self.n_held += n
        self.held.append(raw)
        if self.n_held >= self.block:
            self._flush(False)

    def _flush(self, rest: bool) -> None:
        ids = np.frombuffer(b"".join(self.held), dtype="<u4")
        at = 0
        while len(ids) - at >= self.block or (rest and at < len(ids)):
            block = ids[at : at + self.block]
            planes = pack_block(block)
            offset = self.file.write(b"".join(planes))
            self.chunks.append([len(block), offset, *map(len, planes)])
            at += len(block)
        self.held = [ids[at:].tobytes()]
        self.n_held = len(ids) - at

    def close(self) -> None:
        self._flush(True)
        index = json.dumps({"chunks": self.chunks, "doc_ids": self.doc_ids, "doc_ids_n": self.doc_n}).encode()
        at = self.file.write(zstandard.compress(index))
        self.file.write(struct.pack("<q", at) + MAGIC)
        self.file.commit()


class PlaneReader:
    """Reads blocks in order through the chunk index."""

    def __init__(self, path: str):
        fs, inner = filesystem(path)
        self.file = fs.open_input_file(inner)
        size = self.file.size()
        tail = self.file.read_at(16, size - 16)
        if tail[8:] != MAGIC:
            raise ValueError(f"{path} is no plane file or incomplete")
        (at,) = struct.unpack("<q", tail[:8])
        index = json.loads(zstandard.decompress(self.file.read_at(size - 16 - at, at)))
        self.chunks, self.doc_ids, self.doc_n = index["chunks"], index["doc_ids"], index["doc_ids_n"]

    def block(self, k: int) -> np.ndarray:
        n, at, *lengths = self.chunks[k]
        raw = self.file.read_at(sum(lengths), at)
        planes = [raw[e - m : e] for e, m in zip(np.cumsum(lengths).tolist(), lengths)]
        return unpack_block(planes, n)

    def documents(self) -> Iterator[tuple[int | None, int, int, Iterator[np.ndarray]]]:
        """(doc_id, ids before it in the file, its number of ids, runs of its ids); take the runs before the next."""
        state = {"k": 0, "ids": np.empty(0, "<u4"), "at": 0}

        def runs(n: int) -> Iterator[np.ndarray]:
            while n:
                if state["at"] == len(state["ids"]):
                    state["ids"], state["at"] = self.block(state["k"]), 0
                    state["k"] += 1
                got = state["ids"][state["at"] : state["at"] + n]
                state["at"] += len(got)
                n -= len(got)
                yield got

        start = 0
        for doc_id, n in zip(self.doc_ids, self.doc_n):
            yield doc_id, start, n, runs(n)
            start += n


def write_planes(docs: DataFrame, folder: str, vocab_file: str, end_id: int) -> DataFrame:
    """Encode each whole text (null: empty), append ``end_id``, write plane files; the manifest comes back.

    Documents are dealt out in ranges of doc_id and sorted within each (null first;
    rows with equal doc_id by a hash of their text), so part k holds smaller ids than
    part k + 1.  No part is written for an empty range.  Extra columns are not read.
    """
    slim = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"], F.lit("")).alias("text"))
    ordered = slim.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_encoder(vocab_file)
        end = end_id.to_bytes(4, "little")
        ctx = TaskContext.get()
        name = f"part-{ctx.partitionId():06d}.planes"
        writer = None
        for table in batches_of(batches, _TEXT_BYTES):
            writer = writer or PlaneWriter(TaskFile(folder, name, ctx.taskAttemptId()))
            for doc_id, raw in zip(table.column("doc_id").to_pylist(), encoder.encode(table.column("text").to_pylist())):
                writer.add(doc_id, raw + end)
        if writer:
            writer.close()
            row = [[ctx.partitionId()], [f"{folder}/{name}"], [len(writer.doc_n)], [writer.n_ids], [writer.file.size]]
            kinds = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds)], ["part", "file", "n_docs", "n_ids", "n_bytes"])

    return written(arrow_map(ordered, run, MANIFEST), "planes-manifest")


def read_planes(manifest: DataFrame) -> DataFrame:
    """One row per document of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    A task reads a file block by block; the ids before a file come from the
    manifest, one short row per file.  An empty manifest gives no rows.
    """
    before = F.sum("n_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    files = manifest.select("part", "file", F.coalesce(before, F.lit(0)).alias("before"))
    # One task per file: a plain number keeps the few bytes of names from being merged into one task.
    files = files.repartition(max(1, manifest.count()), "part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, base in zip(b.column("file").to_pylist(), b.column("before").to_pylist()):
                rows = []
                for doc_id, start, n, runs in PlaneReader(path).documents():
                    crc = 0
                    for ids in runs:
                        crc = zlib.crc32(ids.tobytes(), crc)
                    rows.append((doc_id, base + start, n, crc))
                    if len(rows) == 50_000:
                        yield _rows(rows)
                        rows = []
                if rows:
                    yield _rows(rows)

    return arrow_map(files, run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], ["doc_id", "start", "n_tokens", "ids_crc32"])
