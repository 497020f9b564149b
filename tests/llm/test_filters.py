"""Toxicity, quality rules and line dedup against brute force and held-out labels."""

import hashlib
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from toolwatch.llm import queries as Q
from toolwatch.llm.line_dedup import line_dedup
from toolwatch.llm.quality_rules import Limits, host_verdicts, measure, measured, quality_rules
from toolwatch.llm.toxicity import OrdinalModel, features, fit_ordinal, score_severity, train_severity

SF = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
SPACE = " \t\n\x0b\x0c\r"


# ---- quality rules


def slow_measure(text):
    words = [w for w in re.split("[ \t\n\x0b\x0c\r]+", text) if w]
    grams = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    inside = {j for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if line.strip(SPACE):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(inside)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab \n\t\x0b\x1c é#|", max_size=80))
def test_measures_equal_the_plain_count(text):
    assert measure(text) == slow_measure(text)


def test_quality_rules_edge_rows(spark):
    good = " ".join(f"word{i}" for i in range(60))
    rows = [(1, good, "h", 5), (2, None, "h", 5), (3, "", "h", 5), (3, "", "h", 5), (4, "a b c " * 30, "h", 5), (5, good, None, 5), (None, good, "h", 5), (6, good * 3000, "h", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_words int")
    got = quality_rules(docs).collect()
    assert len(got) == len(rows) and set(got[0].asDict()) >= {"doc_id", "text", "source", "kept"}
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == slow_measure(r.text or "")
        failed = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        assert r.base_failed == failed and r.kept == (not failed and not r.host_rejected)
    assert all(r.kept for r in got if r.source is None)
    assert quality_rules(docs.limit(0)).collect() == []


def test_host_verdict_shrinks_small_hosts(spark):
    good, bad = " ".join(f"w{i}x" for i in range(60)), "too short"
    rows = [(i, bad if i % 20 else good, "junk") for i in range(400)]
    rows += [(1000 + i, good if i % 20 else bad, f"fine{i % 8}") for i in range(800)] + [(5000, bad, "tiny"), (5001, good, "tiny")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    hosts = {r["__host"]: r for r in host_verdicts(measured(docs), "source", Limits()).collect()}
    assert hosts["junk"].host_rejected and not hosts["tiny"].host_rejected and not hosts["fine1"].host_rejected
    assert 0.05 < hosts["tiny"].host_fail_rate < 0.5  # pulled from 0.5 towards the others
    kept = {r.doc_id for r in quality_rules(docs).filter("kept").collect()}
    assert kept == {i for i, t, h in rows if t == good and h != "junk"}


# ---- line dedup


def slow_lines(rows, min_docs=2):
    key = lambda x: "".join(c.lower() if "A" <= c <= "Z" else c for c in x.strip(SPACE))
    held = defaultdict(set)
    for i, t, *_ in rows:
        for x in (t or "").split("\n"):
            if i is not None and len(key(x)) >= 10:
                held[key(x)].add(i)
    out = []
    for i, t, *_ in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if i is None or len(held[key(x)]) < min_docs or min(held[key(x)]) == i]
        out.append((i, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return Counter(out)


@pytest.mark.parametrize("min_docs", [2, 3])
def test_line_dedup_equals_brute_force(spark, min_docs):
    share, other = "A line that is shared", "\t a LINE that is shared \r"
    rows = [(i, f"own line number {i}\n{share if i % 2 else other}\nshort\n{share}", "c", 1) for i in range(2, 40)]
    rows += [(1, None, "c", 1), (0, "", "c", 1), (50, "Ünïcode LINE É\nünïcode LINE É", "c", 1), (51, "Ünïcode line É", "c", 1), (52, "ünïcode line É", "c", 1)]
    rows += [(None, share, "c", 1), (60, share, "c", 1), (60, share, "c", 1), (61, "repeat it again\n" * 2000 + share, "c", 1), (62, "repeat it again", "c", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, pos string, n_lines int")
    out = line_dedup(docs, min_docs)
    assert Counter((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in out.collect()) == slow_lines(rows, min_docs)
    assert set(out.columns) == {"doc_id", "text", "pos", "n_lines", "n_dropped"}
    assert line_dedup(docs.limit(0)).collect() == []


def test_line_dedup_stays_in_the_jvm(spark):
    plan = line_dedup(spark.read.parquet(f"{SF}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_line_dedup_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    cols = "doc_id, n_lines, n_dropped, kept_sha256"
    want = con.execute(f"SELECT {cols} FROM ({Q.OP6_SQL}) ORDER BY doc_id").fetchall()
    assert [tuple(r) for r in Q.op6_line_dedup(spark, SF).selectExpr(*cols.split(", ")).orderBy("doc_id").collect()] == want
    assert hashlib.sha256(b"").hexdigest() == Q.op6_line_dedup(spark, SF).sparkSession.sql("select sha2('', 256) h").first().h


# ---- toxicity


def test_ordinal_fit_orders_grades():
    r = np.random.default_rng(0)
    rows = []
    for _ in range(600):
        own = sorted(set(r.integers(0, 30, 6).tolist()))
        bad = sum(c < 5 for c in own)
        rows.append((0 if bad == 0 else 1 if bad == 1 else 2, own, 1.0))
    w, t = fit_ordinal(rows, 30, 3)
    assert t[0] < t[1] and w[:5].min() > w[5:].max()
    score = np.array([w[x].sum() for _, x, _ in rows])
    grade = (score[:, None] > t).sum(axis=1)
    assert np.mean(grade == [y for y, *_ in rows]) > 0.9
    above = OrdinalModel({}, tuple(t)).above(score)
    assert (above[:, 0] >= above[:, 1]).all()


def test_toxicity_on_held_out_labels(spark):
    """Half of the labelled documents teach, with planted insults; the others are judged."""
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet")
    insult = F.concat(F.col("text"), F.when(F.col("toxic") == 1, F.lit(" what a zzsludge you zzgrub are")).otherwise(F.lit("")))
    docs = docs.join(labels, "doc_id").withColumn("text", insult).drop("quality", "toxic")
    model = train_severity(docs, labels.filter("doc_id % 2 = 0"))
    got = score_severity(docs, model, carry=["doc_id"]).join(labels.filter("doc_id % 2 = 1"), "doc_id").collect()
    toxic, clean = [r for r in got if r.toxic], [r for r in got if not r.toxic]
    assert len(toxic) > 20 and sum(r.rejected for r in toxic) >= 0.95 * len(toxic)
    assert sum(r.rejected for r in clean) <= 0.03 * len(clean)
    assert np.mean([r.expected_severity for r in toxic]) > 0.9 > 0.2 > np.mean([r.expected_severity for r in clean])


def test_length_alone_is_not_toxic(spark):
    signs = [f"sign{chr(97 + i)}" for i in range(12)]
    model = OrdinalModel({w: 1.0 for w in signs}, (4.0, 8.0))
    filler = ["plain"] * 1000
    apart = " ".join(x for w in signs for x in [w, *filler])
    together = [" ".join(["plain"] * at + signs + ["plain"] * (12000 - at)) for at in (0, 250, 508, 700, 12000)]
    docs = spark.createDataFrame(list(enumerate([apart, " ".join(signs), *together])), "doc_id long, text string")
    got = {r.doc_id: r for r in score_severity(docs, model).collect()}
    assert not got[0].rejected and got[0].expected_severity < 0.1
    assert all(got[i].rejected and got[i].expected_severity == got[1].expected_severity for i in range(1, 7))


def test_words_of_few_rows_get_no_weight(spark):
    rows = [(i, "awful zzgrub " * (i < 40) + " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}{chr(97 + k)}" for k in range(20)) + " qqrare" * (i < 4)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 40)) for i, _ in rows], "doc_id long, toxic int")
    weights = train_severity(docs, labels).weights
    assert "zzgrub" in weights and "qqrare" not in weights


def test_toxicity_edge_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (2, "", "x"), (None, "bad " * 9000, "x"), (3, "Bad", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, grade string")
    model = OrdinalModel({"bad": 9.0}, (4.0, 8.0))
    got = score_severity(docs, model).collect()
    assert sorted((r.text or "")[:3] for r in got if r.rejected) == ["Bad", "bad"]
    assert all(r.grade in (0, 2) and 0 <= r.expected_severity <= 2 for r in got) and len(got) == 5
    assert score_severity(docs.limit(0), model).collect() == []
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    one_kind = spark.createDataFrame([(1, 0, 1), (None, 0, 0), (2, 1, None)], none.schema)
    for labels in (none, one_kind):
        m = train_severity(docs, labels)
        assert m.weights == {} and not any(r.rejected for r in score_severity(docs, m).collect())
    assert features("It's BAD, grubby") >= {"bad", "grubby", "grub-", "grubb-"}


def test_library_encoder_keeps_a_quarter_million_chunks_a_generation():
    import public_tokenizers

    from toolwatch.llm.tokens import library_encoder

    assert library_encoder(public_tokenizers.path("word_bpe_49k.json")).cache.most == 250_000
