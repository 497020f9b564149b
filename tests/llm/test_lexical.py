"""Ranked lexical search against plain scoring of every document."""

import math
import re
from collections import Counter

import duckdb
import numpy as np

from toolwatch.llm import lexical, queries
from toolwatch.llm.lexical import Queries, lexical_search, sketch, terms

SF = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def plain(docs, items, k=20):
    """docs: (doc_id, text), items: (item_id, text) -> sorted rows (item_id, rank, doc_id, score)."""
    counts = [(i, Counter(words(t))) for i, t in docs]
    n_docs = sum(1 for _, c in counts if c)
    n_terms = sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        found = []
        for i, c in counts:
            n, score = sum(c.values()), 0
            for t in words(text):
                if t in c:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    m = 100 - 25 + (25 * n * n_docs) // n_terms
                    score += w * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m))
            if score > 0:
                found.append((-score, i is None, i or 0))
        for rank, (s, none, i) in enumerate(sorted(found)[:k], 1):
            out.append((item if item is not None else -1, rank, -1 if none else i, -s))
    return sorted(out)


def rows_of(df):
    return sorted((-1 if r.item_id is None else r.item_id, r.rank, -1 if r.doc_id is None else r.doc_id, r.score) for r in df.collect())


def test_terms_follow_the_pattern():
    text = "Ab_cD9 é-Ünï X y \x00z~Q¡`k\x7fl\t日本 İI ſK"
    assert [t.decode() for t in terms(text)] == words(text) and terms(None) == [] and terms(" .,-") == []


def test_bounds_are_never_below_scores():
    rng = np.random.default_rng(5)
    docs = [" ".join(f"w{int(x)}" for x in rng.zipf(1.3, int(n))) for n in rng.integers(1, 900, 60)] + ["w1 " * 400 + "rare"]
    q = Queries([(i, " ".join(f"w{int(x)}" for x in rng.zipf(1.3, 25))) for i in range(30)] + [(99, "rare w1 w1"), (98, None)])
    counts = [Counter(terms(d)) for d in docs]
    q.weigh(Counter(t for c in counts for t in c), len(docs), sum(sum(c.values()) for c in counts))
    tight = loose = 0
    for c in counts:
        n = sum(c.values())
        bounds = q.bounds(n, sketch(c))
        exact = np.array([q.score(c, n, int(p)) for p in q.some])
        assert (bounds >= exact).all()
        tight, loose = tight + int(exact.sum()), loose + int(bounds.sum())
    assert loose < 1.6 * tight


def test_search_equals_plain_scoring(spark, monkeypatch):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    want = plain([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert rows_of(lexical_search(docs.repartition(5), items)) == want
    monkeypatch.setattr(lexical, "BLOCK_QUERIES", 15)  # several blocks of queries
    assert rows_of(lexical_search(docs, items)) == want


def test_bounds_spare_most_exact_scores(spark):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    scored = []
    exact = lexical._exact

    def counted(texts, candidates, *rest):
        scored.append(candidates.count())
        return exact(texts, candidates, *rest)

    lexical._exact = counted
    try:
        lexical_search(docs, items, k=3).collect()
    finally:
        lexical._exact = exact
    assert scored[1] < 0.5 * docs.count() * items.count()


def test_odd_rows(spark):
    docs = [(1, "hot line of words")] * 300 + [(2, "hot line of words")] * 40 + [(i, f"word{i} common") for i in range(10, 60)]
    docs += [(3, None), (4, ""), (5, " .,; "), (None, "word11 common hot"), (6, "x" * 200_000), (7, "deep " * 50_000 + "rare"), (8, "É日本 é日本")]
    items = [(1, "HOT words"), (1, "HOT words"), (2, None), (3, ""), (4, "absent terms"), (5, "rare deep"), (None, "word11"), (6, "x" * 200_000 + " common"), (7, "日本 É日本"), (8, "common " * 300)]
    d = spark.createDataFrame([(i, t, "q", 1, 2) for i, t in docs], "doc_id long, text string, query string, score long, key int")
    q = spark.createDataFrame([(i, t, 5, 6) for i, t in items], "item_id long, text string, doc_id long, rank int")
    assert rows_of(lexical_search(d.repartition(6), q)) == plain(docs, items)
    assert rows_of(lexical_search(d, q, k=400)) == plain(docs, items, 400)
    assert lexical_search(d.limit(0), q).collect() == [] and lexical_search(d, q.limit(0)).collect() == []
    assert lexical_search(d.filter("doc_id in (3, 4, 5)"), q).collect() == []


def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = queries.op13_lexical_search(spark, SF)
    cur = con.execute(queries.ORACLE_SQL["op13_lexical_search"])
    names = [x[0] for x in cur.description]
    assert sorted(map(tuple, got.collect())) == sorted(tuple(r[names.index(c)] for c in got.columns) for r in cur.fetchall())
