"""Every pipeline stage against brute force on a small corpus; registration of the queries."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from test_filters import slow_lines, slow_measure
from test_spread import slow_classes
from tokenizers import Tokenizer

import __spark_entry__ as E
import corpus_pipeline as C
import public_tokenizers as P
from toolwatch.llm import queries as Q
from toolwatch.llm.common import written
from toolwatch.llm.line_dedup import line_dedup
from toolwatch.llm.quality_rules import quality_rules
from toolwatch.llm.toxicity import features, train_severity

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    r = random.Random(6)
    vocab = [f"word{i}" for i in range(400)]
    shared = "this line is shared by many"
    rows, labels = [], []
    for i in range(150):
        lines = [" ".join(r.choice(vocab) for _ in range(20)) for _ in range(r.randint(3, 6))]
        if i % 5 == 0:
            lines.insert(1, shared)
        if i % 4 == 0:
            lines.append("what a zzfilth and zzgrub you are")
        if i % 11 == 0:
            lines = lines[:1]
        text = "\n".join(lines)
        rows.append((i, text, "en", f"s{i % 7}", len(text)))
        if i % 2 == 0:
            labels.append((i, 1, int(i % 4 == 0)))
    for i in range(150, 170):  # near copies of kept documents, one long line each
        words = " ".join(rows[1][1].split()).split() + [r.choice(vocab) for _ in range(60)] if i == 150 else rows[150][1].split()
        if i > 150 and i % 3:
            words = [*words[:-1], f"end{i}"]
        text = " ".join(words)
        rows.append((i, text, "en", "s0", len(text)))
    rows += [(900, None, None, None, None), (901, "", "en", "s1", 0)]
    folder = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


def test_stages_equal_brute_force(spark, corpus):
    assert [n for n, _ in C.STAGES] == ["toxicity", "quality_rules", "line_dedup", "near_dedup", "packing"]
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    own = {r.doc_id: r.text for r in docs.collect()}
    model = train_severity(docs, spark.read.parquet(f"{corpus}/labels.parquet"))
    assert "zzfilth" in model.weights
    rejected = {i for i, t in own.items() if sum(model.weights.get(f, 0.0) for f in features(t or "")) >= model.thresholds[0]}
    assert rejected == {i for i, t in own.items() if t and "zzfilth" in t}
    steps = dict(C.STAGES)
    columns = docs.columns

    def run(name):
        nonlocal docs
        docs = written(steps[name](spark, docs, corpus), f"test-{name}")
        return docs

    own = {i: t for i, t in own.items() if i not in rejected}
    got = run("toxicity")
    assert got.columns == columns and {r.doc_id: r.text for r in got.collect()} == own

    def good(t):
        n, _, _, _, repeat = slow_measure(t or "")
        return n >= 50 and 100 * repeat <= 50 * n

    own = {i: t for i, t in own.items() if good(t)}
    got = run("quality_rules")
    assert got.columns == columns and {r.doc_id: r.text for r in got.collect()} == own and len(own) > 60

    want = {i: t for i, _, _, t in slow_lines(list(own.items()))}
    got = run("line_dedup")
    assert got.columns == columns and {r.doc_id: (r.text, r.n_chars) for r in got.collect()} == {i: (t, len(t)) for i, t in want.items()}
    assert want != own

    classes = slow_classes(list(want.items()), 5)
    want = {i: t for i, t in want.items() if classes[i][1] == i}
    got = run("near_dedup")
    assert got.columns == columns and {r.doc_id: r.text for r in got.collect()} == want
    assert len(want) < len(classes)

    lib = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    lib.encode_special_tokens = True
    got = run("packing").collect()
    assert Counter((r.doc_id, r.doc_tokens) for r in got if r.start == 0) == Counter((i, len(lib.encode(t, add_special_tokens=False).ids) + 1) for i, t in want.items())
    assert Counter(tuple(r) for r in C.run(spark, corpus).select(got[0].__fields__).collect()) == Counter(tuple(r) for r in got)


def test_stages_on_no_documents(spark, corpus):
    docs = spark.createDataFrame([], COLUMNS)
    for _, stage in C.STAGES[:-1]:
        docs = written(stage(spark, docs, corpus), "test-none")
        assert docs.collect() == []
    assert C.STAGES[-1][1](spark, docs, corpus).collect() == []


def test_queries_are_registered():
    names = [f"op{n}_" for n in range(1, 14)]
    have = E.queries()
    assert "pipeline" in have
    assert all(sum(k.startswith(n) for k in have) == 1 for n in names)
    assert set(Q.ORACLE_SQL) <= set(E.oracle_sql()) and C.ORACLE_SQL is None


def test_columns_named_like_those_of_the_operators_come_back(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    own = {"grade": 7, "p_toxic": "x", "kept": "mine", "n_words": 777, "held": True, "rejected": 3, "n_lines": "l", "n_dropped": 1.5,
           "__host": "h", "__id": 5, "__lines": "z", "__drop": 2, "__version": 9, "component_id": 4, "a.b": 1, "host_rejected": 8}
    odd = docs.select("*", *[F.lit(v).alias(k) for k, v in own.items()])
    for name, stage in C.STAGES[:-1]:
        out = stage(spark, odd, corpus)
        assert out.columns == odd.columns and [f.dataType for f in out.schema] == [f.dataType for f in odd.schema], name
        plain = stage(spark, docs, corpus)
        assert Counter(map(tuple, out.select(docs.columns).collect())) == Counter(map(tuple, plain.collect())), name
        assert all(r[k] == v for r in out.collect() for k, v in own.items()), name


def test_operators_take_any_column_names(spark):
    docs = spark.createDataFrame([(i, "one long line of text\n" + f"line number {i} here", "s", 1, 2, 3) for i in range(4)], "doc_id long, text string, source string, __host int, __id int, __lines int")
    assert quality_rules(docs).count() == 4
    out = line_dedup(docs).collect()
    assert [r.n_dropped for r in sorted(out, key=lambda r: r.doc_id)] == [0, 1, 1, 1] and all(r["__id"] == 2 and r["__lines"] == 3 for r in out)
