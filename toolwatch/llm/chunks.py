"""Encode texts chunk by chunk, with a bounded cache of chunks already encoded.

A text may be cut before every space that stands before a character other than
white space: the byte-level pattern attaches such a space to what follows, and no
piece reaches over it.  It may also be cut before a line break between two characters
other than white space.  Each chunk is therefore encoded alone, and equal chunks
(most words) only once per batch, and while they are in the cache once per worker.

Cutting, finding equal chunks and putting the ids together are array operations over all
texts of a batch; only the distinct chunks of a batch are looked at one by one.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_SPACE = re.compile(r"\s")
#: Longer chunks are encoded but not kept.
_KEEP_CHARS = 64


def _loose(part: str) -> bool:
    """Empty, or with white space at an end (other than one line break that begins a line)."""
    if not part or _SPACE.match(part[-1]):
        return True
    return bool(_SPACE.match(part[1] if part[0] == "\n" else part[0]))


def cut(text: str) -> list[str]:
    """The chunks of ``text``; joined they give the text back."""
    out: list[str] = []
    for i, part in enumerate(text.split(" ")):
        if i and (not part or _SPACE.match(part)):
            out[-1] += " " + part
        else:
            out.append(" " + part if i else part)
    return out


def _surely_tight(strings: pa.LargeStringArray) -> np.ndarray:
    """Which strings begin (behind a line break, if one begins the line) and end with a visible ASCII character."""
    starts, data = np.frombuffer(strings.buffers()[1], dtype=np.int64)[: len(strings) + 1], strings.buffers()[2]
    text = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    first, end = starts[:-1].copy(), starts[1:]
    out = np.zeros(len(strings), dtype=bool)
    some = np.flatnonzero(end > first)
    first[some] += text[first[some]] == 10
    some = some[end[some] > first[some]]
    a, z = text[first[some]], text[end[some] - 1]
    out[some] = (a > 32) & (a < 127) & (z > 32) & (z < 127)
    return out


def stem(chunk: str) -> str:
    """``chunk`` without a last comma or full stop after a letter: pieces end between the two, and most stems are known."""
    return chunk[:-1] if chunk[-1:] in (",", ".") and chunk[-2:-1].isalpha() else chunk


#: ASCII marks: neither letters, digits nor white space.
_MARKS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())
_IS_MARK = np.isin(np.arange(256), [ord(c) for c in _MARKS])
_IS_LETTER = np.array([chr(c).isalpha() and c < 128 for c in range(256)])
#: Longer runs of marks stay with their word.
_TAIL_MARKS = 4


@lru_cache(maxsize=1 << 16)
def _stays_letter(char: str) -> bool:
    """A letter that is still one character and a letter once it is composed (NFC) and lower-cased."""
    low = char.lower()
    return char.isalpha() and len(low) == 1 and low.isalpha() and unicodedata.normalize("NFC", char) == char


def _tails(strings: pa.LargeStringArray) -> np.ndarray:
    """The run of up to ``_TAIL_MARKS`` ASCII marks that ends each string behind a letter, as a big-endian number (0: none)."""
    starts, data = np.frombuffer(strings.buffers()[1], dtype=np.int64)[: len(strings) + 1], strings.buffers()[2]
    text = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    code = np.zeros(len(strings), dtype=np.uint32)
    n_marks = np.zeros(len(strings), dtype=np.int64)
    first, end = starts[:-1], starts[1:]
    run = np.flatnonzero(end > first)
    for k in range(_TAIL_MARKS):
        last = text[end[run] - 1 - k]
        run, last = run[_IS_MARK[last]], last[_IS_MARK[last]]
        code[run] |= last.astype(np.uint32) << np.uint32(8 * k)
        n_marks[run] += 1
        run = run[end[run] - 1 - k > first[run]]
    some = np.flatnonzero(code)
    at = end[some] - 1 - n_marks[some]
    before = np.where(at >= first[some], text[np.maximum(at, 0)], 0)
    code[some[(before < 128) & ~_IS_LETTER[before]]] = 0
    beyond = some[before >= 128]
    for i, s, n in zip(beyond.tolist(), strings.take(pa.array(beyond)).to_pylist(), n_marks[beyond].tolist()):
        if not _stays_letter(s[-n - 1]):
            code[i] = 0
    return code


class ChunkCache:
    """Two generations of at most ``most`` chunks each.

    A chunk enters when it is met a second time (as far as a table of hashes tells), so
    the many that occur once push nothing out.  When the young generation is full it
    becomes the old one; what is found in the old one moves back to the young.
    """

    def __init__(self, most: int):
        self.most = most
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.met = bytearray(1 << 22)
        self.n_met = 0

    def get(self, chunks: list[str]) -> list[bytes | None]:
        found = list(map(self.young.get, chunks))
        for i, x in enumerate(found):
            if x is None and (x := self.old.get(chunks[i])) is not None:
                found[i] = self.young[chunks[i]] = x
        return found

    def put(self, chunk: str, ids: bytes, times: int) -> None:
        if len(chunk) > _KEEP_CHARS:
            return
        at = hash(chunk) & (len(self.met) - 1)
        if times > 1 or self.met[at]:
            self.young[chunk] = ids
        else:
            self.met[at] = 1
            self.n_met += 1

    def turn(self) -> None:
        """Between batches: keep both generations and the table within their bounds."""
        if len(self.young) > self.most:
            self.old, self.young = self.young, {}
        if self.n_met > len(self.met) // 2:
            self.met, self.n_met = bytearray(len(self.met)), 0


class ChunkEncoder:
    """``encode_many``: list of chunks -> list of their ids as little-endian uint32 bytes.

    ``most`` bounds each generation of chunks kept between calls (some 200 bytes a
    chunk).  ``encode_tight``: the same for chunks without white space at their ends (but for
    a space or a line break before).  ``words``: the vocabulary lower-cases and drops white space, so line breaks
    count as spaces and ASCII chunks are lower-cased first, to share their ids.
    """

    def __init__(
        self, encode_many: Callable[[list[str]], list[bytes]], most: int = 150_000, words: bool = False,
        encode_tight: Callable[[list[str]], list[bytes]] | None = None,
    ):
        self.encode_many, self.encode_tight = encode_many, encode_tight
        self.words = words
        self.cache = ChunkCache(most)  # by the chunk without its leading space

    def _words(self, flat: pa.LargeStringArray) -> tuple[np.ndarray, list[bytes]]:
        """For a vocabulary of words: the place of each chunk in a list of ids, and that list.

        ASCII chunks are lower-cased, and marks behind a word cut off, before equal ones are
        found: only distinct words are looked up, and kept.
        """
        named = flat.dictionary_encode()
        at = np.asarray(named.indices)
        chunks = named.dictionary
        chunks = pc.if_else(pc.string_is_ascii(chunks), pc.ascii_lower(chunks), chunks)
        marks, mark_at = np.unique(_tails(chunks), return_inverse=True)
        stems = pc.if_else(pa.array(marks[mark_at] > 0), pc.ascii_rtrim(chunks, _MARKS), chunks).dictionary_encode()
        stem_at = np.asarray(stems.indices)
        words = stems.dictionary.to_pylist()
        times = np.bincount(stem_at, np.bincount(at, minlength=len(chunks)), len(words)).tolist()
        found = self.cache.get(words)
        missing = [i for i, x in enumerate(found) if x is None]
        wanted = [words[i] for i in missing]
        for i, word, ids in zip(missing, wanted, (self.encode_tight or self.encode_many)(wanted)):
            found[i] = ids
            self.cache.put(word, ids, times[i])
        self.cache.turn()
        tails = self.encode_many([m.to_bytes(4, "big").lstrip(b"\0").decode() for m in marks.tolist()])
        return at, [found[i] + tails[m] for i, m in zip(stem_at.tolist(), mark_at.tolist())]

    def _kept(self, flat: pa.LargeStringArray, offsets: np.ndarray, texts: list[str]) -> tuple[np.ndarray, list[bytes], dict[int, bytes]]:
        """Where white space counts: the same, and the ids of texts that are not to be put together from chunks."""
        firsts = offsets[:-1]  # every text has a first chunk, if an empty one
        named = flat.dictionary_encode()
        at = np.asarray(named.indices).astype(np.int32)
        distinct = named.dictionary.to_pylist()
        times = np.bincount(at, minlength=len(distinct))
        found = self.cache.get(distinct)
        heads = flat.take(pa.array(firsts)).to_pylist()
        # A first chunk is encoded as it stands; all others have a space before, if they don't begin a line.
        loose = np.zeros(len(distinct), dtype=bool)
        unsure = np.flatnonzero(~_surely_tight(named.dictionary)).tolist()
        loose[[i for i in unsure if found[i] is None and _loose(distinct[i])]] = True
        found_loose = loose[at]
        found_loose[firsts] = [bool(h) and _loose(h) for h in heads]
        special = np.flatnonzero(np.add.reduceat(found_loose, firsts, dtype=np.int64)).tolist()
        missing = [i for i, x in enumerate(found) if x is None and not loose[i]]
        stems = {distinct[i]: stem(distinct[i]) for i in missing}
        wanted = dict.fromkeys(stems.values())
        known = dict(zip(wanted, self.cache.get(list(wanted))))
        then = [k for k in wanted if k and known[k] is None]
        # Texts with runs of white space are cut with more care, and their chunks encoded as they stand.
        pieces = {i: cut(texts[i]) for i in special}
        plain = list(dict.fromkeys([",", "."] + [h for h in heads if h] + [c for own in pieces.values() for c in own if c]))
        spaced = [p if p[0] == "\n" else " " + p for p in then]
        ids = self.encode_many(plain) + self.encode_tight(spaced) if self.encode_tight else self.encode_many(plain + spaced)
        whole = dict(zip(plain, ids), **{"": b""})
        fresh = dict(zip(then, ids[len(plain) :]), **{"": b""})
        for i in missing:
            key = distinct[i]
            short = stems[key]
            ids_ = known[short] if known[short] is not None else fresh[short]
            if len(short) < len(key):
                self.cache.put(short, ids_, int(times[i]))
                ids_ += whole[key[-1]]
            found[i] = ids_
            if key:
                self.cache.put(key, ids_, int(times[i]))
        self.cache.turn()
        raws = [x or b"" for x in found] + [whole[h] for h in heads]
        at[firsts] = len(distinct) + np.arange(len(heads), dtype=np.int32)
        return at, raws, {i: b"".join([whole[c] for c in own]) for i, own in pieces.items()}

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        """The ids of each text as little-endian uint32 bytes."""
        texts = list(texts)
        if not texts:
            return []
        lines = pc.replace_substring(pa.array(texts, pa.large_string()), "\n", " " if self.words else " \n")
        lists = pc.split_pattern(lines, " ")
        lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
        offsets = np.asarray(lists.offsets)
        flat = lists.flatten()
        careful: dict[int, bytes] = {}
        if self.words:
            at, raws = self._words(flat)
        else:
            at, raws, careful = self._kept(flat, offsets, texts)
        lengths = np.fromiter(map(len, raws), dtype=np.int64, count=len(raws)) // 4
        pool = np.frombuffer(b"".join(raws), dtype="<u4")
        starts = np.cumsum(lengths) - lengths
        out: list[bytes] = []
        for a in range(0, len(texts), 256):
            b = min(a + 256, len(texts))
            own = at[offsets[a] : offsets[b]]
            n = lengths[own]
            before = np.cumsum(n) - n
            got = pool[np.repeat(starts[own] - before, n) + np.arange(int(n.sum()))]
            ends = np.cumsum(np.add.reduceat(n, offsets[a:b] - offsets[a])).tolist()
            for i, x, y in zip(range(a, b), [0, *ends], ends):
                out.append(careful[i] if i in careful else got[x:y].tobytes())
        return out
