"""Language by a conditional random field: exact inference, gradients' effect, held-out accuracy, odd rows."""

import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from toolwatch.llm.language import WordScores, judge, language_id, posteriors, predict_language, train_language, words_of

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


@pytest.fixture(scope="module")
def model(docs):
    return train_language(docs, train=F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1)


def brute(emission, start, move):
    """Posteriors of one text by adding up all labellings."""
    n, k = emission.shape
    single, pair = np.zeros((n, k)), np.zeros((n, k, k))
    for path in itertools.product(range(k), repeat=n):
        score = start[path[0]] + sum(emission[i, s] for i, s in enumerate(path)) + sum(move[a, b] for a, b in zip(path, path[1:]))
        p = np.exp(score)
        for i, s in enumerate(path):
            single[i, s] += p
        for i in range(1, n):
            pair[i, path[i - 1], path[i]] += p
    z = single[0].sum()
    return single / z, pair / z


def test_forward_backward_equals_all_labellings():
    rng = np.random.default_rng(2)
    start, move = rng.normal(size=3), rng.normal(size=(3, 3)) * 2
    lengths = [1, 5, 2, 1, 7, 4, 1, 3]
    emission = rng.normal(size=(sum(lengths), 3)) * 3
    first = np.zeros(len(emission), dtype=bool)
    edges = np.cumsum([0, *lengths])
    first[edges[:-1]] = True
    single, pair = posteriors(emission, first, start, move)
    for a, b in zip(edges, edges[1:]):
        s, p = brute(emission[a:b], start, move)
        assert np.allclose(single[a:b], s) and np.allclose(pair[a:b], p)


def test_held_out_accuracy(docs, model):
    rows = predict_language(docs, model).join(docs.select("doc_id", "lang", "text"), "doc_id").collect()
    out = [r for r in rows if r.lang and len(words_of(r.text or "")) >= 3 and zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    right = sum(r.lang == r.lang_pred for r in out)
    assert len(out) > 100 and right >= 0.97 * len(out)
    assert all(0 <= r.score <= 1 for r in rows)


def test_code_switched_text_is_told_apart_word_by_word(docs, model):
    spans = {r.lang: words_of(r.text)[:30] for r in docs.filter("length(text) > 800 and crc32(cast(cast(doc_id as string) as binary)) % 3 = 1").collect()}
    langs = sorted(spans)
    text = [w for lang in langs for w in spans[lang]]
    first = np.zeros(len(text), dtype=bool)
    first[0] = True
    single, _ = posteriors(WordScores(model)(text), first, model.start, model.move)
    gold = np.repeat([model.langs.index(lang) for lang in langs], [len(spans[lang]) for lang in langs])
    assert (single.argmax(axis=1) == gold).mean() > 0.9
    alone, _ = posteriors(WordScores(model)(text), np.ones(len(text), dtype=bool), model.start, model.move)
    assert (single.argmax(axis=1) == gold).mean() >= (alone.argmax(axis=1) == gold).mean()  # the learned steps help
    assert (np.diag(model.move) > model.move.mean(axis=1)).all()
    mostly = spans["en"] * 3 + spans["de"][:10]
    assert model.langs[judge([mostly], model, WordScores(model))[0][0]] == "en"


def test_long_texts_are_read_whole(model, monkeypatch):
    from toolwatch.llm import language

    en, fr = ["the", "and", "with", "that"] * 40, ["les", "pour", "que", "chèvre"] * 500
    whole = judge([en + fr, fr], model, WordScores(model))
    monkeypatch.setattr(language, "CHAIN_CELLS", 1)  # chains of 1024 words
    cut = judge([en + fr, fr], model, WordScores(model))
    assert [w[0] for w in whole] == [c[0] for c in cut] and np.allclose([w[1] for w in whole], [c[1] for c in cut], atol=0.01)
    assert model.langs[whole[0][0]] == "fr"


def test_only_permitted_rows_and_columns_count(spark, docs):
    base = docs.limit(300)
    a = language_id(base)
    # Held-out rows may carry any label, and ids and sources decide nothing else.
    lie = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit("xx")).otherwise(F.col("lang"))
    b = language_id(base.withColumn("lang", lie).withColumn("source", F.lit("other")).repartition(3))
    key = lambda r: (r.doc_id, r.lang_pred, round(r.score, 9), r.held_out)
    assert sorted(map(key, a.collect())) == sorted(map(key, b.collect()))


def test_odd_rows(spark):
    rows = [(i, "the cat and the dog are there " * 3, "en") for i in range(12)] + [(i, "der hund und die katze sind dort " * 3, "de") for i in range(20, 32)]
    rows += [(40, None, "en"), (41, "", "de"), (42, "12 + 3² = _ !", "en"), (None, "the dog", "zz"), (43, "die katze", None), (43, "die katze", None), (44, "x" * 100_000, None), (45, "the " * 30_000, None)]
    df = spark.createDataFrame([(*r, 1, True, 0.5) for r in rows], "doc_id long, text string, lang string, score int, held_out boolean, at double")
    out = language_id(df).collect()
    assert len(out) == len(rows)
    by = {r.doc_id: r for r in out}
    assert [by[i].lang_pred for i in (40, 41, 42)] == ["und"] * 3 and by[40].score == 0
    assert by[43].lang_pred == "de" and by[45].lang_pred == "en" and by[None].lang_pred == "en" and not by[None].held_out
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in out if r.doc_id is not None)
    assert {r.lang_pred for r in language_id(df.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert language_id(df.limit(0)).collect() == []
