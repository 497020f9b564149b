"""Token ids of texts by a vocabulary file of the tokenizers library, and files in the shared folder."""

from __future__ import annotations

import os
import re
from array import array
from functools import lru_cache

import numpy as np
from pyarrow import fs as pafs

from toolwatch.llm.chunks import ChunkEncoder


#: Chunks joined to one string for the library.
_JOINED = 256
#: No white space at either end, but for one space before.
_TIGHT = re.compile(r" ?\S(?:[^\n]*\S)?")
#: Composed lower-case letters of ASCII and Latin-1.
_LOW = re.compile("[a-z\xdf-\xf6\xf8-\xff]+")


class JoinedEncoder:
    """Ids of many short strings by few calls of the library.

    Strings are joined by a separator of which the vocabulary makes one id that no string
    without the separator holds: a line break where white space is kept, else a bar between
    spaces.  Its places in the ids divide them again.  Strings that hold the separator or
    have white space at their ends are encoded alone.

    A vocabulary of words that marks the last id of each word needs no separator between
    words of letters; words that its normalizer leaves as they are pass it by.
    """

    def __init__(self, tok, words: bool, plain=None):
        self.tok, self.words, self.plain = tok, words, plain
        suffix = (tok.model.end_of_word_suffix or "") if plain is not None else ""
        self.last = np.zeros(tok.get_vocab_size(), dtype=bool)
        if suffix:
            self.last[[i for t, i in tok.get_vocab(with_added_tokens=False).items() if t.endswith(suffix)]] = True
        self.marked = bool(self.last.any())
        self.mark, self.sep = ("|", " | ") if words else ("\n", "\n")
        own = tok.encode(self.mark, add_special_tokens=False).ids
        self.mark_id = own[0] if len(own) == 1 else None

    def _one_by_one(self, strings: list[str]) -> list[bytes]:
        found = []
        for i in range(0, len(strings), 4096):
            found += self.tok.encode_batch_fast(strings[i : i + 4096], add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def __call__(self, strings: list[str]) -> list[bytes]:
        """The ids of any strings."""
        fit = []
        for i, s in enumerate(strings):
            t = s[1:] if s[:1] == "\n" else s
            if self.words or (_TIGHT.fullmatch(t) and "\n" not in t and (t is s or t[0] != " ")):
                fit.append(i)
        out: list[bytes | None] = [None] * len(strings)
        for i, x in zip(fit, self.tight([strings[i] for i in fit])):
            out[i] = x
        alone = [i for i, x in enumerate(out) if x is None]
        for i, x in zip(alone, self._one_by_one([strings[i] for i in alone])):
            out[i] = x
        return out

    def tight(self, strings: list[str]) -> list[bytes]:
        """The ids of strings with no white space at their ends but one space or line break before, and no line break within."""
        if not self.marked:
            return self._separated(strings)
        out: list[bytes | None] = [None] * len(strings)
        low, letters, others = [], [], []
        for i, s in enumerate(strings):
            (low if _LOW.fullmatch(s) else letters if s.isalpha() else others).append(i)
        for own, encode in ((low, self._low), (letters, self._letters), (others, self._separated)):
            for i, x in zip(own, encode([strings[i] for i in own])):
                out[i] = x
        return out

    def _low(self, strings: list[str]) -> list[bytes]:
        return self._words_of(self.plain, strings)

    def _letters(self, strings: list[str]) -> list[bytes]:
        return self._words_of(self.tok, strings)

    def _words_of(self, tok, strings: list[str]) -> list[bytes]:
        """The ids of words of letters: each word ends with the one id of it that is marked as last."""
        out: list[bytes] = []
        for a in range(0, len(strings), 64 * _JOINED):
            groups = [strings[g : g + _JOINED] for g in range(a, min(a + 64 * _JOINED, len(strings)), _JOINED)]
            for group, e in zip(groups, tok.encode_batch_fast([" ".join(group) for group in groups], add_special_tokens=False)):
                ids = np.array(e.ids, dtype="<u4")
                ends = ((np.flatnonzero(self.last[ids]) + 1) * 4).tolist()
                if len(ends) != len(group):  # the vocabulary takes some word for several
                    out += self._one_by_one(group)
                    continue
                raw = ids.tobytes()
                out += [raw[x:y] for x, y in zip([0, *ends], ends)]
        return out

    def _separated(self, strings: list[str]) -> list[bytes]:
        if self.mark_id is None:
            return self._one_by_one(strings)
        out: list[bytes] = []
        # A line break is an id of its own before what follows it.
        broken = b"" if self.words else array("I", [self.mark_id]).tobytes()
        for a in range(0, len(strings), 64 * _JOINED):
            groups = [strings[g : g + _JOINED] for g in range(a, min(a + 64 * _JOINED, len(strings)), _JOINED)]
            joined = [self.sep.join(group) for group in groups]
            if not self.words:
                joined = [j.replace("\n\n", "\n").removeprefix("\n") for j in joined]
            for group, e in zip(groups, self.tok.encode_batch_fast(joined, add_special_tokens=False)):
                ids = np.array(e.ids, dtype="<u4")
                ends = (np.flatnonzero(ids == self.mark_id) * 4).tolist()
                if len(ends) != len(group) - 1:  # a string holds the separator
                    out += self._one_by_one(group)
                    continue
                raw = ids.tobytes()
                out += [broken + raw[x:y] if s[:1] == "\n" else raw[x:y] for s, x, y in zip(group, [0, *[e + 4 for e in ends]], [*ends, len(raw)])]
        return out


def _without_normalizer(tok, vocab_file: str):
    """The vocabulary for words of ``_LOW`` between single spaces: its normalizer would not change them, its
    pre-tokeniser cuts at the spaces alone.  None if that does not hold for this vocabulary's kind."""
    from tokenizers import Tokenizer, normalizers, pre_tokenizers

    probe = "".join(map(chr, [*range(97, 123), *range(0xDF, 0xF7), *range(0xF8, 0x100)]))
    words = [*probe, probe, probe[::-1]]
    if tok.normalizer is None or tok.normalizer.normalize_str(" ".join(words)) != " ".join(words):
        return None
    plain = Tokenizer.from_file(vocab_file)
    plain.encode_special_tokens = True
    plain.normalizer = normalizers.Sequence([])
    plain.pre_tokenizer = pre_tokenizers.Sequence(
        [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
    )
    same = [plain.encode(w, add_special_tokens=False).ids == tok.encode(w, add_special_tokens=False).ids for w in words]
    return plain if all(same) else None


@lru_cache(maxsize=4)
def library_encoder(vocab_file: str) -> ChunkEncoder:
    """Encoder for a tokenizers JSON file; strings of special tokens are ordinary text.

    Every id comes from the library; chunks between safe cuts are encoded once.  Right
    for vocabularies whose pre-tokeniser cuts at spaces (byte-level and word BPE).
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark gives each task one core
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(vocab_file)
    tok.encode_special_tokens = True
    words = "Lowercase" in str(tok.normalizer)
    many = JoinedEncoder(tok, words, _without_normalizer(tok, vocab_file) if words else None)
    return ChunkEncoder(many, most=250_000, words=words, encode_tight=many.tight)


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system and inner path for a plain path or a URI (file, hdfs, s3, gs ...)."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    if "://" in path:
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


class TaskFile:
    """A file that appears under its name only when complete.

    Each task attempt writes a name of its own; the last step moves it.  A repeated
    or speculative attempt writes the same bytes and replaces the file as a whole.
    """

    def __init__(self, folder: str, name: str, attempt: int):
        self.fs, root = filesystem(folder)
        self.fs.create_dir(root, recursive=True)
        self.final, self.mine = f"{root}/{name}", f"{root}/_{name}.{attempt}"
        self.out = self.fs.open_output_stream(self.mine)
        self.size = 0

    def write(self, data: bytes) -> int:
        at = self.size
        self.out.write(data)
        self.size += len(data)
        return at

    def commit(self) -> None:
        self.out.close()
        self.fs.move(self.mine, self.final)
