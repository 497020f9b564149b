"""Byte-level BPE by a hierarchical-bitmap rank queue.

All pieces of a batch lie in one linked list of tokens (no link crosses a piece).
A bucket per merge rank holds list positions whose pair has that rank.  A bitmap of
three levels tells which buckets have entries; find-first-set on one word per level
gives the lowest rank.  Its positions are merged together; entries whose pair has
changed meanwhile are stale and skipped.  New pairs go to the buckets of their
ranks.  The cost follows the number of merges, so a piece of millions of bytes
needs no quadratic search for its next merge.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from toolwatch.llm.chunks import ChunkEncoder
from toolwatch.llm.common import arrow_map, batches_of

NONE = np.int32(2**31 - 1)
_TEXT_BYTES = 16 << 20


class RankBitmap:
    """A set of ranks below 64**3 with constant-time lowest member."""

    def __init__(self) -> None:
        self.top = 0
        self.mid = [0] * 64
        self.low = [0] * 4096

    def add(self, rank: int) -> None:
        self.low[rank >> 6] |= 1 << (rank & 63)
        self.mid[rank >> 12] |= 1 << (rank >> 6 & 63)
        self.top |= 1 << (rank >> 12)

    def discard(self, rank: int) -> None:
        self.low[rank >> 6] &= ~(1 << (rank & 63))
        if not self.low[rank >> 6]:
            self.mid[rank >> 12] &= ~(1 << (rank >> 6 & 63))
            if not self.mid[rank >> 12]:
                self.top &= ~(1 << (rank >> 12))

    def first(self) -> int:
        """The lowest rank, or -1."""
        if not self.top:
            return -1
        a = (self.top & -self.top).bit_length() - 1
        b = (self.mid[a] & -self.mid[a]).bit_length() - 1
        word = self.low[a << 6 | b]
        return a << 12 | b << 6 | (word & -word).bit_length() - 1


class BpeCodec:
    """Encoder and decoder for one rank file (base64 token and rank per line)."""

    def __init__(self, rank_file: str, pattern: str):
        self.split = regex.compile(pattern).findall
        with open(rank_file, "rb") as f:
            self.rank = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        if max(self.rank.values()) >= 64**3:
            raise ValueError("more ranks than the bitmap holds")
        self.token = [b""] * (max(self.rank.values()) + 1)
        for t, r in self.rank.items():
            self.token[r] = t
        self.byte_id = np.array([self.rank[bytes([b])] for b in range(256)], dtype=np.int32)
        pairs = {}
        for t, r in self.rank.items():
            for i in range(1, len(t)):
                a, b = self.rank.get(t[:i]), self.rank.get(t[i:])
                if a is not None and b is not None:
                    pairs[a << 18 | b] = r
        order = sorted(pairs)
        self._keys = np.array([*order, 2**62], dtype=np.int64)
        self._ranks = np.array([*(pairs[k] for k in order), NONE], dtype=np.int32)

    def _pair_rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) << 18 | right
        at = np.searchsorted(self._keys, key)
        at[self._keys[at] != key] = -1  # negative tokens (no neighbour) never match
        return self._ranks[at]

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece as little-endian uint32 bytes; a piece that is a token stays whole."""
        out: list[bytes] = [b""] * len(pieces)
        rest = []
        for i, p in enumerate(pieces):
            r = self.rank.get(p)
            if r is not None:
                out[i] = r.to_bytes(4, "little")
            elif p:
                rest.append(i)
        if rest:
            for i, ids in zip(rest, self._merge([pieces[i] for i in rest], False)):
                out[i] = ids
        return out

    def _merge(self, pieces: list[bytes], one_by_one: bool) -> list[bytes]:
        buf = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        n = len(buf)
        ends = np.cumsum([len(p) for p in pieces])
        starts = ends - [len(p) for p in pieces]
        # Slot n stands for "no neighbour".
        tok = np.append(self.byte_id[buf], np.int32(-1))
        nxt = np.append(np.arange(1, n + 1), n)
        nxt[ends - 1] = n
        prv = np.append(np.arange(-1, n - 1), n)
        prv[starts] = n
        rank_at = self._pair_rank(tok, tok[nxt])
        rank_at[n] = NONE
        buckets: dict[int, list[int]] = {}
        queue = RankBitmap()
        order = np.argsort(rank_at, kind="stable")
        order = order[: np.searchsorted(rank_at[order], NONE)]
        at = np.flatnonzero(np.diff(rank_at[order], prepend=-1))
        for positions in np.split(order, at[1:]) if len(order) else ():
            r = int(rank_at[positions[0]])
            buckets[r] = positions.tolist()
            queue.add(r)
        redo: set[int] = set()
        while (r := queue.first()) >= 0:
            queue.discard(r)
            p = np.array(buckets.pop(r))
            p = p[rank_at[p] == r]  # others are stale
            if len(p) > 1:
                p = np.unique(p)
                if one_by_one and len(p) > 1:
                    buckets[r] = p[1:].tolist()
                    queue.add(r)
                    p = p[:1]
                elif (over := nxt[p[:-1]] == p[1:]).any():
                    # Overlapping pairs merge from the left: every other one of a run.
                    first = np.append(True, ~over)
                    run = np.maximum.accumulate(np.where(first, np.arange(len(p)), 0))
                    p = p[(np.arange(len(p)) - run) % 2 == 0]
            if not len(p):
                continue
            q = nxt[p]
            after = nxt[q]
            tok[p] = r
            tok[q] = -1
            rank_at[q] = NONE
            nxt[p] = after
            prv[after] = p
            before = prv[p]
            new_p = self._pair_rank(tok[p], tok[after])
            new_b = self._pair_rank(tok[before], tok[p])
            rank_at[p] = new_p
            rank_at[before] = new_b
            rank_at[n] = NONE
            where = np.concatenate([p, before])
            ranks = np.concatenate([new_p, new_b])
            live = ranks != NONE
            where, ranks = where[live], ranks[live]
            if not one_by_one and len(p) > 1 and len(ranks) and ranks.min() < r:
                # A merge has made a pair of a lower rank, which comes before the other
                # merges of this rank in its piece: such pieces are merged again singly.
                word = np.searchsorted(starts, p, side="right") - 1
                many = word[1:][word[1:] == word[:-1]]
                lower = np.searchsorted(starts, where[ranks < r], side="right") - 1
                redo.update(np.intersect1d(many, lower).tolist())
            for x, i in zip(ranks.tolist(), where.tolist()):
                if x in buckets:
                    buckets[x].append(i)
                else:
                    buckets[x] = [i]
                    queue.add(x)
        alive = tok[:n] >= 0
        flat = tok[:n][alive].astype("<u4").tobytes()
        to = np.cumsum(alive)[ends - 1] * 4
        out, a = [], 0
        for b in to.tolist():
            out.append(flat[a:b])
            a = b
        for i in redo:
            out[i] = self._merge([pieces[i]], True)[0]
        return out

    def encode_chunks(self, chunks: list[str]) -> list[bytes]:
        """Ids of each chunk: the pattern's matches are encoded separately."""
        number: dict[str, int] = {}
        of = [[number.setdefault(m, len(number)) for m in self.split(c)] for c in chunks]
        ids = self.encode_pieces([m.encode("utf-8") for m in number])
        return [ids[x[0]] if len(x) == 1 else b"".join([ids[i] for i in x]) for x in of]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


@lru_cache(maxsize=4)
def codec(rank_file: str, pattern: str) -> BpeCodec:
    return BpeCodec(rank_file, pattern)


@lru_cache(maxsize=4)
def _chunk_encoder(rank_file: str, pattern: str) -> ChunkEncoder:
    return ChunkEncoder(codec(rank_file, pattern).encode_chunks)


def bpe_round_trip(docs: DataFrame, rank_file: str, pattern: str, with_ids: bool = False) -> DataFrame:
    """Encode each whole text, decode the ids, and return one row per input row.

    Columns: doc_id, n_tokens, ids_sha256 (of the decimal ids joined by a space),
    decoded_sha256 (of the decoded bytes); with ``with_ids`` also ids (array of int)
    and decoded (binary).  A null text counts as the empty text: no ids, no bytes.
    Other columns of ``docs`` are not read; rows with a null or repeated doc_id are
    encoded like any other.  ``rank_file`` must be at the same path on every executor.
    """
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, encoder = codec(rank_file, pattern), _chunk_encoder(rank_file, pattern)
        decimal = list(map(str, range(len(coder.token))))
        for table in batches_of(batches, _TEXT_BYTES):
            texts = [t or "" for t in table.column("text").to_pylist()]
            rows = []
            for raw in encoder.encode(texts):
                ids = np.frombuffer(raw, dtype="<u4").tolist()
                decoded = coder.decode(ids)
                said = " ".join(map(decimal.__getitem__, ids)).encode()
                row = (len(ids), hashlib.sha256(said).hexdigest(), hashlib.sha256(decoded).hexdigest())
                rows.append((*row, ids, decoded) if with_ids else row)
            n, a, b, *more = zip(*rows) if rows else ((), (), (), *(((), ()) if with_ids else ()))
            cols = [table.column("doc_id").combine_chunks().cast(pa.int64()), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                cols += [pa.array(more[0], pa.list_(pa.int32())), pa.array(more[1], pa.binary())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(cols, names)

    slim = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"])
    return arrow_map(slim, run, schema + (", ids array<int>, decoded binary" if with_ids else ""))
