"""Language of texts by a linear-chain conditional random field over their words.

Every word of a text has a language of its own, so code-switched text needs no cuts.  A
word speaks for languages by its features (affixes, character n-grams, membership in the
lexicons of the languages), its neighbours by learned transitions.  The forward-backward
algorithm gives each word a probability of every language; a text gets the language with
the largest share of its letters.

Training sequences are joined from short spans of labelled texts of different languages, so
that the transitions within and between languages are learned from both.

Forward-backward runs over all words of a batch at once.  The transfer matrices of blocks
of words are multiplied step by step in parallel, the short chain of block products is
followed, and the messages within all blocks are then filled in parallel.  The first word
of a text forgets what came before it, so many texts form one chain.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from toolwatch.llm.common import arrow_map, batches_of, written

#: Labelled texts the model is fitted on, shared equally by the languages; spans of each and words of a span.
SAMPLE_ROWS, SPANS, SPAN_WORDS = 2400, 6, 12
#: Spans joined to a training sequence.
JOINED = 4
#: Features that fewer training words have are left out; a word is in a lexicon if so many texts of the language hold it.
LEAST_WORDS, LEXICON_TEXTS = 3, 2
STEPS, RATE, DECAY = 40, 0.25, 1e-4
#: Longer runs of letters (scripts without spaces) are read as several words.
WORD_LETTERS = 24
#: Words whose feature scores a worker keeps.
KEEP_WORDS = 400_000
#: Words times squared languages that go through forward-backward together (some 200 MB).
CHAIN_CELLS = 1 << 22
_WORD = re.compile(r"[^\W\d_]{1,%d}" % WORD_LETTERS)


def words_of(text: str) -> list[str]:
    """Runs of letters in lower case, cut after every WORD_LETTERS; none if there are only numeral signs such as a raised 2."""
    found = _WORD.findall(text.lower())
    return found if any(c.isalpha() for w in found for c in w) else []


def word_features(word: str, lexicons: dict[str, str]) -> list[str]:
    """Affixes of 1 to 4 letters, bigrams and trigrams within the word, its length, and the lexicons that hold it."""
    n = len(word)
    out = [f"length {min(n, 12)}"]
    for k in range(1, min(4, n) + 1):
        out += ("^" + word[:k], word[n - k :] + "$")
    out += [word[i : i + 2] for i in range(n - 1)]
    out += [word[i : i + 3] for i in range(n - 2)]
    held = lexicons.get(word)
    if held:
        out.append("lexicon " + held)
    return out


# ---- forward-backward


def _blocks(count: int) -> int:
    return max(1, int(np.sqrt(count)))


def _messages(transfer: np.ndarray) -> np.ndarray:
    """(words, states): normalised row vectors 1 T_1 ... T_i of a chain of transfer matrices.

    ``transfer`` is (words, states, states).  Blocks of the chain go side by side.
    """
    count, states = transfer.shape[:2]
    size = _blocks(count)
    n = -(-count // size)
    padded = np.empty((n * size, states, states))
    padded[:count] = transfer
    padded[count:] = np.eye(states)
    # (step, block, state, state): each step of all blocks lies together.
    padded = np.ascontiguousarray(padded.reshape(n, size, states, states).transpose(1, 0, 2, 3))
    whole = padded[0].copy()
    for s in range(1, size):
        whole = whole @ padded[s]
        whole /= whole.max(axis=(1, 2), keepdims=True)
    entry = np.empty((n, states))
    at = np.ones(states)
    for b in range(n):
        entry[b] = at
        at = at @ whole[b]
        at /= at.sum()
    out = np.empty((size, n, states))
    for s in range(size):
        entry = np.einsum("bi,bij->bj", entry, padded[s])
        entry /= entry.sum(axis=1, keepdims=True)
        out[s] = entry
    return out.transpose(1, 0, 2).reshape(n * size, states)[:count]


def posteriors(emission: np.ndarray, first: np.ndarray, start: np.ndarray, move: np.ndarray, pairs: bool = True) -> tuple[np.ndarray, np.ndarray | None]:
    """Probability of each state of each word, and (``pairs``) of each pair of states with the word before (0 at firsts).

    ``emission`` (words, states) are log scores, ``first`` marks words that begin a text,
    ``start`` (states) and ``move`` (states, states) are the log scores of a beginning and of
    a step.
    """
    count, states = emission.shape
    # No language is ruled out by one word alone, so that no product of two messages vanishes.
    e = np.exp(np.maximum(emission - emission.max(axis=1, keepdims=True), -200.0))
    step = np.exp(move - move.max())
    begin = np.exp(start - start.max())
    transfer = step[None] * e[:, None, :]
    transfer[first] = (begin * e[first])[:, None, :]
    forward = _messages(transfer)
    # Backwards the chain is the transposed matrices in reverse; the last word's message is 1.
    # A beginning passes nothing of its text on to the text before: equal rows, as above.
    back = np.ones((count, states))
    if count > 1:
        back[:-1] = _messages(transfer[:0:-1].transpose(0, 2, 1))[::-1]
        back[:-1][first[1:]] = 1.0
    single = forward * back
    single /= single.sum(axis=1, keepdims=True)
    if not pairs:
        return single, None
    pair = np.zeros((count, states, states))
    inner = np.flatnonzero(~first)
    joint = forward[inner - 1][:, :, None] * transfer[inner] * back[inner][:, None, :]
    pair[inner] = joint / joint.sum(axis=(1, 2), keepdims=True)
    return single, pair


# ---- training


def crc32_text(column: Column) -> Column:
    return F.crc32(column.cast("string").cast("binary"))


def training_spans(docs: DataFrame, sample_rows: int, spans: int = SPANS) -> list[tuple[str, list[list[str]]]]:
    """(language, spans of words) of at most ``sample_rows`` labelled texts, the same number of every language.

    Of each language the texts with the smallest hash are taken, so the sample does not
    depend on how the table is divided; the spans lie at hashed places over the whole text.
    """
    n_langs = docs.select("lang").distinct().count()
    if not n_langs:
        return []
    quota = max(1, sample_rows // n_langs)
    keyed = docs.select("lang", "text", F.xxhash64("text", F.lit(7)).alias("at"))
    # The texts themselves only travel after the hashes have chosen.  Hashes are spread evenly, so the
    # smallest ones of a language lie under a bound that its number of texts gives, with room to spare.
    distinct = written(keyed.select("lang", "at").distinct(), "text-hashes")
    counts = distinct.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()  # a row for each language
    share = {r["lang"]: min(1.0, (4 * quota + 100) / r["n"]) for r in counts}
    upto = {lang: min(int(x * 2**64) - 2**63, 2**63 - 1) for lang, x in share.items()}
    bounds = F.create_map(*[x for lang, top in upto.items() for x in (F.lit(lang), F.lit(top).cast("long"))])
    low = distinct.filter(F.col("at") <= F.element_at(bounds, F.col("lang")))
    hashes = low.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("at"))).filter(F.col("n") <= quota)
    chosen = keyed.join(hashes.select("lang", "at"), ["lang", "at"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for text in b.column("text").to_pylist():
                ws, own = words_of(text), []
                for s in range(min(spans, -(-len(ws) // SPAN_WORDS))):
                    at = xxhash.xxh3_64_intdigest(f"{s} {len(text)} {ws[0]} {ws[-1]}") % max(1, len(ws) - SPAN_WORDS + 1)
                    own.append(" ".join(ws[at : at + SPAN_WORDS]))
                out.append(own)
            yield pa.RecordBatch.from_arrays([b.column("lang"), b.column("at"), pa.array(out, pa.list_(pa.string()))], ["lang", "at", "spans"])

    found = arrow_map(chosen.select("lang", "text", "at"), run, "lang string, at long, spans array<string>").filter(F.size("spans") > 0)
    rows = found.dropDuplicates(["lang", "at"]).collect()  # sample_rows rows of SPANS x SPAN_WORDS words
    return [(r["lang"], [s.split() for s in r["spans"]]) for r in sorted(rows, key=lambda r: (r["lang"], r["at"]))]


class LanguageModel:
    """Languages, feature weights (features, states), and the scores of beginnings and steps."""

    def __init__(self, langs: list[str], features: dict[str, int], lexicons: dict[str, str], weights: np.ndarray, start: np.ndarray, move: np.ndarray):
        self.langs, self.features, self.lexicons = langs, features, lexicons
        self.weights, self.start, self.move = weights, start, move

    def emissions(self, words: list[str]) -> np.ndarray:
        """(words, languages) sums of the weights of the known features of each word."""
        out = np.zeros((len(words), len(self.langs)))
        get = self.features.get
        known: list[int] = []
        ends = []
        for w in words:
            known += [i for i in map(get, word_features(w, self.lexicons)) if i is not None]
            ends.append(len(known))
        if known:
            edges = np.array([0, *ends])
            some = np.flatnonzero(np.diff(edges))
            out[some] = np.add.reduceat(self.weights[known], edges[some])
        return out


def _lexicons(sample: list[tuple[str, list[list[str]]]]) -> dict[str, str]:
    """Word -> the languages in which several texts hold it."""
    texts: Counter = Counter()
    for lang, spans in sample:
        texts.update({(w, lang) for s in spans for w in s})
    held: dict[str, list[str]] = {}
    for (word, lang), n in sorted(texts.items()):
        if n >= LEXICON_TEXTS:
            held.setdefault(word, []).append(lang)
    return {w: " ".join(ls) for w, ls in held.items()}


def train_language(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", train: Column | None = None,
    sample_rows: int = SAMPLE_ROWS, steps: int = STEPS,
) -> LanguageModel:
    """Fit the field on at most ``sample_rows`` labelled texts (those for which ``train`` holds).

    Without a labelled text with letters the model has no languages.
    """
    picked = docs.filter(train) if train is not None else docs
    labelled = picked.select(picked[lang_col].cast("string").alias("lang"), picked[text_col].cast("string").alias("text")).filter("lang is not null and text is not null")
    sample = training_spans(labelled, sample_rows)
    langs = sorted({lang for lang, _ in sample})
    if not langs:
        return LanguageModel([], {}, {}, np.zeros((0, 0)), np.zeros(0), np.zeros((0, 0)))
    place = {lang: i for i, lang in enumerate(langs)}
    lexicons = _lexicons(sample)
    # Spans of all languages in a fixed shuffled order; neighbours are joined, many with another language.
    spans = [(place[lang], s) for lang, own in sample for s in own]
    spans = [spans[i] for i in np.random.default_rng(17).permutation(len(spans))]
    tokens = [w for _, s in spans for w in s]
    gold = np.concatenate([np.full(len(s), lang) for lang, s in spans])
    first = np.zeros(len(tokens), dtype=bool)
    ends = np.cumsum([len(s) for _, s in spans])
    first[np.concatenate([[0], ends[:-1]])[::JOINED]] = True
    vocabulary = {w: i for i, w in enumerate(dict.fromkeys(tokens))}
    word = np.array([vocabulary[w] for w in tokens])
    listed = [word_features(w, lexicons) for w in vocabulary]
    common = Counter(f for fs in listed for f in fs)
    features = {f: i for i, f in enumerate(f for f, n in common.items() if n >= LEAST_WORDS or f.startswith("lexicon"))}
    pairs = [(i, features[f]) for i, fs in enumerate(listed) for f in fs if f in features]
    row, col = (np.array(x, dtype=np.int64) for x in zip(*pairs))
    states = len(langs)

    def spread(values: np.ndarray, to: np.ndarray, size: int) -> np.ndarray:
        return np.stack([np.bincount(to, values[:, k], size) for k in range(values.shape[1])], axis=1)

    seen = np.eye(states)[gold]
    inner = np.flatnonzero(~first)
    moved = np.zeros((states, states))
    np.add.at(moved, (gold[inner - 1], gold[inner]), 1.0)
    begun = seen[first].sum(axis=0)
    sizes = [(len(features), states), (states,), (states, states)]
    params = [np.zeros(s) for s in sizes]
    squares = [np.full(s, 1e-8) for s in sizes]
    for _ in range(steps):
        weights, start, move = params
        by_word = spread(weights[col], row, len(vocabulary))
        single, pair = posteriors(by_word[word], first, start, move)
        missing = spread(seen - single, word, len(vocabulary))
        slopes = [spread(missing[row], col, len(features)), begun - single[first].sum(axis=0), moved - pair.sum(axis=0)]
        for p, q, g in zip(params, squares, slopes):
            g = g / len(tokens) - DECAY * p
            q += g * g
            p += RATE * g / np.sqrt(q)
    return LanguageModel(langs, features, lexicons, *params)


# ---- prediction


class WordScores:
    """Feature scores of the words a worker has met, at most ``most`` kept besides those of a batch."""

    def __init__(self, model: LanguageModel, most: int = KEEP_WORDS):
        self.model, self.most = model, most
        self._clear()

    def _clear(self) -> None:
        self.place: dict[str, int] = {}
        self.rows = np.zeros((1024, len(self.model.langs)))

    def __call__(self, words: list[str]) -> np.ndarray:
        if len(self.place) > self.most:
            self._clear()
        new = list(set(words).difference(self.place))
        at = len(self.place)
        if at + len(new) > len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros((at + 2 * len(new), self.rows.shape[1]))])
        self.rows[at : at + len(new)] = self.model.emissions(new)
        self.place.update(zip(new, range(at, at + len(new))))
        return self.rows[np.fromiter(map(self.place.__getitem__, words), dtype=np.int64, count=len(words))]


def judge(texts: list[list[str]], model: LanguageModel, scores: WordScores) -> list[tuple[int, float]]:
    """Language (place in ``model.langs``) and its share of the letters, for texts with at least one word.

    A text with more words than fit at once is several chains; their letters add up.
    """
    states = len(model.langs)
    most = max(1024, CHAIN_CELLS // states**2)
    pieces = [(i, t[at : at + most]) for i, t in enumerate(texts) for at in range(0, len(t), most)]
    by_state, by_text = np.zeros((len(texts), states)), np.zeros(len(texts))
    at = 0
    while at < len(pieces):
        end, size = at, 0
        while end < len(pieces) and (end == at or size + len(pieces[end][1]) <= most):
            size += len(pieces[end][1])
            end += 1
        flat = [w for _, t in pieces[at:end] for w in t]
        edges = np.concatenate([[0], np.cumsum([len(t) for _, t in pieces[at:end]])[:-1]])
        first = np.zeros(len(flat), dtype=bool)
        first[edges] = True
        single, _ = posteriors(scores(flat), first, model.start, model.move, pairs=False)
        letters = np.fromiter(map(len, flat), dtype=np.float64, count=len(flat))
        own = np.array([i for i, _ in pieces[at:end]])
        np.add.at(by_state, own, np.add.reduceat(single * letters[:, None], edges))
        np.add.at(by_text, own, np.add.reduceat(letters, edges))
        at = end
    share = by_state / by_text[:, None]
    best = share.argmax(axis=1)
    return list(zip(best.tolist(), share[np.arange(len(texts)), best].clip(0, 1).tolist()))


def predict_language(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred and score (mean probability of that language over the letters) of every row.

    The whole text is read.  ``und`` with score 0 where the text is null or holds no
    letter, or the model has no language.  Ties go to the first language in alphabetical
    order.  Runs of letters beyond WORD_LETTERS are several words.  Every row is judged by
    its text alone; repeated rows are judged alike, null ids stay, other columns are not
    read, and an empty table gives no rows.
    """
    slim = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = WordScores(model)
        for table in batches_of(batches, 4 << 20):
            texts = [words_of(t) if t and model.langs else [] for t in table.column("text").to_pylist()]
            held = [i for i, t in enumerate(texts) if t]
            found: list[tuple[str, float]] = [("und", 0.0)] * len(texts)
            for i, (lang, share) in zip(held, judge([texts[i] for i in held], model, scores) if held else []):
                found[i] = (model.langs[lang], share)
            ids = table.column("doc_id").combine_chunks()
            yield pa.RecordBatch.from_arrays([ids, pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], ["doc_id", "lang_pred", "score"])

    return arrow_map(slim, run, "doc_id long, lang_pred string, score double")


def held_out(id_col: Column) -> Column:
    """Whether crc32 of the id as text leaves 1 modulo 3; null for a null id."""
    return crc32_text(id_col) % 3 == 1


def language_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row, by a model of the labelled rows that are not held out.

    A row with a null id is neither held out nor learned from; for all else see ``predict_language``.
    """
    slim = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"), docs[lang_col].cast("string").alias("lang"))
    model = train_language(slim, train=~held_out(F.col("doc_id")), sample_rows=sample_rows)
    out = predict_language(slim, model)
    return out.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "lang_pred", "score")
