"""BPE, plane files, token counts and packing against the public libraries and exact round trips."""

import base64
import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from toolwatch.llm.bpe import BpeCodec, RankBitmap, bpe_round_trip, codec
from toolwatch.llm.chunks import ChunkEncoder, cut
from toolwatch.llm.common import new_folder
from toolwatch.llm.packing import cut_pieces, pack, pack_histogram, pattern_ranges
from toolwatch.llm.planes import PlaneReader, read_planes, write_planes
from toolwatch.llm.token_counts import scan_flat, token_counts
from toolwatch.llm.tokens import TaskFile, library_encoder

RANKS, BYTE, WORD = (P.path(f) for f in ("byte_bpe_50k.tiktoken", "byte_bpe_50k.json", "word_bpe_49k.json"))
ODD = [
    "", " ", "  ", "\n", "a", " a", "a ", "a  b", "a \n b", "x\t y  z", "It's we'll  don't", "é́ 中文 ß İ Σς", "<|endoftext|> a",
    "a" * 5000, "ab" * 3000, "1234567890" * 50, "one\x1ctwo \x85three", "  wide", "tail\n\n",
]
SCHEMA = "doc_id long, text string, ids string, file string"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "clash", "x") for i, t in enumerate(ODD)]
    rows += [(100, None, None, None), (None, "no id", None, None), (7, ODD[7], "repeated", None), (200, "word " * 5000, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def tik():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def word():
    t = Tokenizer.from_file(WORD)
    t.encode_special_tokens = True
    return t


def ids_of(raw):
    return np.frombuffer(raw, "<u4").tolist()


def test_rank_bitmap_is_a_set_with_a_lowest_member():
    b, held, r = RankBitmap(), set(), random.Random(3)
    assert b.first() == -1
    for _ in range(3000):
        x = r.randrange(64**3)
        (b.add if r.random() < 0.6 else b.discard)(x)
        (held.add if (b.low[x >> 6] >> (x & 63)) & 1 else held.discard)(x)
        assert b.first() == min(held, default=-1)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80))
def test_encode_equals_the_library_on_any_text(text):
    tik = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=codec(RANKS, P.PATTERN).rank, special_tokens={})
    c = codec(RANKS, P.PATTERN)
    ids = ids_of(ChunkEncoder(c.encode_chunks).encode([text])[0])
    assert ids == tik.encode_ordinary(text)
    assert c.decode(ids) == text.encode()


def test_merging_one_by_one_gives_the_same(tik):
    c = codec(RANKS, P.PATTERN)
    r = random.Random(5)
    pieces = ["".join(r.choice("abtheinr ") for _ in range(r.randint(2, 40))).encode() for _ in range(300)]
    assert c._merge(pieces, True) == c._merge(pieces, False)


def test_lower_rank_made_by_a_merge_comes_first(tmp_path):
    """A vocabulary where merging 'xyz' makes the pair of the lower-ranked 'xyzw': the library's order counts."""
    tokens = [bytes([b]) for b in range(256)] + [b"yz", b"zw", b"xy", b"xyzw", b"xyz", b"wx"]
    f = tmp_path / "v.tiktoken"
    f.write_bytes(b"\n".join(base64.b64encode(t) + b" " + str(i).encode() for i, t in enumerate(tokens)))
    mine = BpeCodec(str(f), r"\S+|\s+")
    lib = tiktoken.Encoding("v", pat_str=r"\S+|\s+", mergeable_ranks=mine.rank, special_tokens={})
    r = random.Random(1)
    for _ in range(300):
        s = "".join(r.choice("xyzw") for _ in range(r.randint(1, 30)))
        assert ids_of(mine.encode_pieces([s.encode()])[0]) == lib.encode_ordinary(s), s


def test_cut_joins_back():
    for t in ODD:
        assert "".join(cut(t)) == t


def test_round_trip_rows(docs, empty, tik):
    got = sorted(bpe_round_trip(docs, RANKS, P.PATTERN, with_ids=True).collect(), key=str)
    want = []
    for r in docs.collect():
        ids = tik.encode_ordinary(r.text or "")
        said = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        want.append((r.doc_id, len(ids), said, hashlib.sha256((r.text or "").encode()).hexdigest()))
    assert Counter(tuple(r)[:4] for r in got) == Counter(want)
    assert bpe_round_trip(empty, RANKS, P.PATTERN).collect() == []


def test_library_encoder_equals_the_library(word):
    byte = Tokenizer.from_file(BYTE)
    byte.encode_special_tokens = True
    for f, t in ((BYTE, byte), (WORD, word)):
        assert [ids_of(x) for x in library_encoder(f).encode(ODD)] == [t.encode(x, add_special_tokens=False).ids for x in ODD]


def test_library_encoder_of_letters_that_change_by_the_normalizer(word):
    """A letter that the normalizer turns into a letter and a mark: the mark goes with the marks behind it."""
    texts = ["İ,", "a İ. b", "क़.", "é́, ǅ. ß! Σ. x_ K.", "don't, l'İ' (a), a--b... |a| word|| 中文!!!!!! ª. ß"]
    r = random.Random(11)
    texts += ["".join(r.choice("aZéÉßÿÑªİıΣς中क़ǅ \n\t'',.!%|_(01²\u0301\u0307") for _ in range(50)) for _ in range(300)]
    got = [ids_of(x) for x in library_encoder(WORD).encode(texts)]
    assert got == [word.encode(x, add_special_tokens=False).ids for x in texts]


def test_words_are_encoded_once_whatever_marks_and_case_they_have():
    asked = []

    def tight(strings):
        asked.extend(strings)
        return [b"\1\0\0\0"] * len(strings)

    e = ChunkEncoder(lambda strings: [b"\2\0\0\0" if s else b"" for s in strings], words=True, encode_tight=tight)
    got = e.encode(["Word word, WORD!! word.\nword)", "über über!!! über,"])
    assert sorted(asked) == ["word", "über"]
    assert [ids_of(x) for x in got] == [[1, 1, 2, 1, 2, 1, 2, 1, 2], [1, 1, 2, 1, 2]]


def test_plane_files(spark, docs, empty):
    lib = Tokenizer.from_file(BYTE)
    lib.encode_special_tokens = True
    folder = new_folder(spark, "test-planes")
    manifest = write_planes(docs, folder, BYTE, 0)
    got = read_planes(manifest).collect()
    ids = {r.doc_id: lib.encode(r.text or "", add_special_tokens=False).ids + [0] for r in docs.collect()}
    start = 0
    for r in sorted(got, key=lambda r: r.start):
        own = ids[r.doc_id]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(own), zlib.crc32(np.array(own, "<u4").tobytes()))
        start += len(own)
    order = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert order == sorted(order, key=lambda x: (x is not None, x)) and len(order) == docs.count()
    assert read_planes(write_planes(empty, new_folder(spark, "test-planes"), BYTE, 0)).collect() == []


def test_plane_blocks_split_documents(spark):
    folder = new_folder(spark, "test-blocks")
    from toolwatch.llm.planes import PlaneWriter

    r = np.random.default_rng(0)
    w = PlaneWriter(TaskFile(folder, "x.planes", 1), block_ids=7)
    ids = [r.integers(0, 2**32, n, dtype=np.uint32) for n in (0, 3, 7, 20, 1)]
    for k, x in enumerate(ids):
        w.add(k, x.astype("<u4").tobytes())
    w.close()
    for (doc_id, start, n, runs), x in zip(PlaneReader(f"{folder}/x.planes").documents(), ids):
        assert n == len(x) and np.array_equal(np.concatenate([np.empty(0, "<u4"), *runs]), x)


@pytest.mark.parametrize("block_bytes", [2, 6, 64, 1 << 20])
def test_separator_scan_stitches_blocks(spark, block_bytes):
    folder = new_folder(spark, "test-flat")
    files = {"a.tok": [5, 9, 9, 1, 2, 3, 4, 9], "b.tok": [7, 7, 7], "c.tok": [9], "d.tok": [1, 9, 2, 2]}
    for name, ids in files.items():
        f = TaskFile(folder, name, 1)
        f.write(np.array(ids, "<u2").tobytes())
        f.commit()
    got = {(r.file, r.ordinal): (r.start, r.n_tokens, r.ended) for r in scan_flat(spark, folder, 9, 2, block_bytes).collect()}
    want = {}
    for name, ids in files.items():
        start = k = 0
        for i, x in enumerate(ids):
            if x == 9:
                want[name, k] = (start, i - start, True)
                start, k = i + 1, k + 1
        if start < len(ids):
            want[name, k] = (start, len(ids) - start, False)
    assert got == want


def test_token_counts(spark, docs, empty, word):
    got = token_counts(docs, new_folder(spark, "test-counts"), WORD, 49407).select("doc_id", "n_tokens").collect()
    assert Counter(map(tuple, got)) == Counter((r.doc_id, len(word.encode(r.text or "", add_special_tokens=False).ids)) for r in docs.collect())
    assert token_counts(empty, new_folder(spark, "test-counts"), WORD, 49407).collect() == []


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 300), max_size=30))
def test_patterns_use_every_length_once(counts):
    patterns = pack_histogram(counts, 64)
    used = Counter()
    for p, n in patterns:
        assert sum(p) <= 64
        for x in p:
            used[x] += n
    assert used == Counter(counts)
    ranges = pattern_ranges(patterns)
    for length, n in counts.items():
        own = sorted((a, b) for x, a, b, *_ in ranges if x == length)
        assert own[0][0] == 0 and own[-1][1] == n - 1 and all(x[1] + 1 == y[0] for x, y in zip(own, own[1:]))


def test_packing_encodes_few_bytes_at_once(spark, monkeypatch):
    """A worker's memory follows the bytes of text that it encodes in one go."""
    most = []

    class Counted:
        def encode(self, texts):
            most.append(sum(map(len, texts)))
            return [b"" for _ in texts]

    monkeypatch.setattr("toolwatch.llm.packing.arrow_map", lambda df, run, schema: run)
    monkeypatch.setattr("toolwatch.llm.packing.library_encoder", lambda vocab_file: Counted())
    run = cut_pieces(spark.createDataFrame([], SCHEMA), WORD, 1, 10)
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(128)), "text": ["word " * 819] * 128})  # half a MiB
    assert sum(b.num_rows for b in run(iter([batch] * 16))) == 16 * 128
    assert len(most) > 1 and sum(most) == 16 * 128 * 819 * 5 and max(most) <= 3 << 20


def test_packing(spark, docs, empty, word):
    many = docs.unionByName(docs.selectExpr("doc_id + 1000 as doc_id", "text", "ids", "file"))
    got = pack(many, WORD, 1, max_tokens=256, piece_tokens=128, with_ids=True).collect()
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append(r)
        assert r.length == len(r.ids) <= 128 and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
    assert sorted(by) == list(range(len(by)))
    for rows in by.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 256
    whole = Counter((r.doc_id, len(word.encode(r.text or "", add_special_tokens=False).ids) + 1) for r in many.collect())
    assert Counter((r.doc_id, r.doc_tokens) for r in got if r.start == 0) == whole
    one = sorted((r for r in got if r.doc_id == 200), key=lambda r: r.start)
    assert sum((r.ids for r in one), []) == word.encode("word " * 5000, add_special_tokens=False).ids + [1]
    assert sum(r.length for r in got) / (256 * len(by)) > 0.95
    assert pack(empty, WORD, 1).collect() == []
    assert cut_pieces(empty, WORD, 1, 10).collect() == []
