"""Sharding, near duplicates and nearest neighbours against brute force."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from toolwatch.llm import near_dups
from toolwatch.llm.ann import HashFamily, PrefixForest, nearest_neighbours
from toolwatch.llm.common import with_rank
from toolwatch.llm.components import connected_components
from toolwatch.llm.near_dups import near_duplicates, shingle_set
from toolwatch.llm.sharding import kd_shards

SF = "/root/testdata/sf0.001"


# ---- sharding


def check_shards(rows, docs, n):
    want = Counter((r.doc_id, len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode())) for r in docs.collect())
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r)
    assert set(by) <= set(range(n))
    for own in by.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    return {k: sum(r.size for r in v) for k, v in by.items()}


def test_shards_are_even_and_slots_gapless(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = kd_shards(docs, 6, ["source", "lang", "n_chars", "doc_id"]).collect()
    load = check_shards(rows, docs, 6)
    largest = max(r.size for r in rows)
    assert len(load) == 6 and max(load.values()) - min(load.values()) <= 3 * largest


def test_shards_divide_ties_and_odd_rows(spark):
    rows = [(7, "same text", "hot", 1.0)] * 600 + [(i, "x" * (i % 50), f"s{i}", float("nan")) for i in range(300)] + [(None, None, None, None)] * 9
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size double")
    out = kd_shards(docs, 7, ["source", "size"]).collect()
    load = check_shards(out, docs, 7)
    assert len(load) == 7 and max(load.values()) <= 1.06 * min(load.values())
    by_target = kd_shards(docs, dims=["source"], target_bytes=sum(load.values()) // 3).collect()
    assert len(check_shards(by_target, docs, 3)) == 3
    few = kd_shards(docs.filter("doc_id is null").limit(2), 5, ["source"])
    check_shards(few.collect(), docs.filter("doc_id is null").limit(2), 5)
    assert kd_shards(docs.limit(0), 5, ["source"]).collect() == []


@pytest.mark.parametrize("before", ["site", "https://site", "https://www.example.org/a/long/path/site"])
def test_strings_that_begin_alike_are_divided_by_what_follows(spark, before):
    docs = spark.createDataFrame([(i, "same size", f"{before}{i % 6}") for i in range(600)], "doc_id long, text string, source string")
    rows = kd_shards(docs, 6, ["source"]).collect()
    hosts = defaultdict(set)
    for r in rows:
        hosts[r.shard].add(r.doc_id % 6)
    assert len(hosts) == 6 and all(len(h) == 1 for h in hosts.values())


def test_sharding_stays_in_the_jvm(spark):
    plan = kd_shards(spark.read.parquet(f"{SF}/documents.parquet"), 3, ["lang"])._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_rank_is_gapless_over_buckets(spark):
    df = spark.range(1000).withColumn("k", F.when(F.col("id") < 900, 0).otherwise(F.col("id") % 3))
    got = with_rank(df, ["k"], [F.col("id")], F.col("id") % 13, "r").collect()
    by = defaultdict(list)
    for r in got:
        by[r.k].append(r.r)
    assert all(sorted(v) == list(range(len(v))) for v in by.values()) and len(got) == 1000


# ---- components and near duplicates


def closed(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(parent)}


def test_components_equal_union_find(spark):
    r = random.Random(4)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(170)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 5000 + i) for i in range(1, 80)]
    want = {k: v for k, v in closed([e for e in edges if e[0] != e[1]]).items()}
    got = {x.id: x.component for x in connected_components(spark.createDataFrame([*edges, *edges[:9], (None, 3)], "a long, b long")).collect()}
    assert got == want
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def slow_classes(rows, words, threshold=0.8):
    sets = {}
    for i, t in rows:
        w = ["".join(c.lower() if "A" <= c <= "Z" else c for c in x) for x in re.split("[ \t\n\x0b\x0c\r]+", t or "") if x]
        sets[i] = {tuple(w[k : k + words]) for k in range(max(1, len(w) - words + 1))} if w else set()
    ids = [i for i in sets if sets[i]]
    edges = []
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            n = len(sets[a] & sets[b])
            if n >= threshold * (len(sets[a]) + len(sets[b]) - n) - 1e-9:
                edges.append((a, b))
    comp = closed(edges)
    return {i: (len(sets[i]), comp.get(i, i)) for i in sets}


def variants(seed=2, n=240):
    r = random.Random(seed)
    vocab = [f"v{i}" for i in range(3000)]
    rows, at = [], 0
    for _ in range(n):
        base = [r.choice(vocab) for _ in range(r.randint(1, 120))]
        for _ in range(r.choice([1, 1, 1, 2, 3, 6])):
            own = [r.choice(vocab) if r.random() < r.choice([0, 0.01, 0.05]) else w for w in base]
            rows.append((at, " ".join(own)))
            at += 1
    hub = [r.choice(vocab) for _ in range(90)]
    for _ in range(120):
        own = list(hub)
        for _ in range(r.randrange(5)):
            own[r.randrange(90)] = r.choice(vocab)
        rows.append((at, " ".join(own).upper() if at % 3 else " ".join(own)))
        at += 1
    return rows + [(at, None), (at + 1, ""), (at + 2, " \n"), (at + 3, "one"), (at + 4, "ONE"), (at + 5, "x y"), (at + 6, "x  y")]


@pytest.mark.parametrize("words", [2, 5])
def test_near_duplicates_equal_brute_force(spark, words):
    rows = variants()
    random.Random(1).shuffle(rows)
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, n int, rep string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(docs, words).collect()}
    assert got == slow_classes(rows, words)


def test_crowded_regions_are_cut_deeper(spark, monkeypatch):
    monkeypatch.setattr(near_dups, "REGION_ROWS", 16)
    rows = variants(5, 40)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect()}
    want = slow_classes(rows, 2)
    assert sum(got[i] != want[i] for i in want) <= 0.02 * len(want)


def template_pages(n=1000, seed=8):
    """Pages of one template, any two just below the threshold; each page but the last hundred has one partner above it."""
    r = random.Random(seed)
    head = [f"t{i}" for i in range(355)]
    rows = []
    for i in range(0, n, 2):
        own = [f"u{r.randrange(10**6)}" for _ in range(45)]
        keep = 2 if i < n - 100 else 0
        rows += [(i, " ".join(head + own)), (i + 1, " ".join(head + own[:keep] + [f"u{r.randrange(10**6)}" for _ in range(45 - keep)]))]
    r.shuffle(rows)
    return rows


def counted_classes(rows, threshold=0.8):
    """Brute force over all pairs by a product of incidence matrices (two-word shingles)."""
    sets = [set(zip(t.split(), t.split()[1:])) for _, t in rows]
    number = {x: k for k, x in enumerate(set().union(*sets))}
    have = np.zeros((len(rows), len(number)), np.float32)
    for k, own in enumerate(sets):
        have[k, [number[x] for x in own]] = 1
    n = have.sum(axis=1)
    both = have @ have.T
    a, b = np.nonzero(np.triu(both >= threshold * (n[:, None] + n[None, :] - both) - 1e-4, 1))
    comp = closed([(rows[i][0], rows[j][0]) for i, j in zip(a.tolist(), b.tolist())])
    return {i: (len(own), comp.get(i, i)) for (i, _), own in zip(rows, sets)}


@pytest.mark.parametrize("block", [None, 50])
def test_partners_in_a_crowded_template_are_all_found(spark, monkeypatch, block):
    if block:
        monkeypatch.setattr(near_dups, "BLOCK_ROWS", block)
    rows = template_pages()
    # One large component of the same template; the first page is linked with it.
    hub = rows[0][1].split()
    rows += [(5000 + k, " ".join([*hub[:380], f"h{k}", *hub[381:]])) for k in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(docs, 2).collect()}
    want = counted_classes(rows)
    assert got == want
    assert len({c for _, c in want.values()}) > 300


def test_cut_regions_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(near_dups, "REGION_ROWS", 16)
    rows = template_pages(500, 9)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(docs, 2).collect()}
    assert got == counted_classes(rows)


def test_near_duplicate_edge_rows(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "A B C D E F"), (None, "a b c d e f"), (3, "q " * 30000), (4, "q " * 30000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r.doc_id, r.component_id, r.kept) for r in near_duplicates(docs).collect())
    assert got == Counter({(1, 1, True): 2, (2, 1, False): 1, (None, None, True): 1, (3, 3, True): 1, (4, 3, False): 1})
    assert near_duplicates(docs.limit(0)).collect() == []
    assert len(shingle_set("", 5)) == 0 and len(shingle_set("a b", 5)) == 1


# ---- nearest neighbours


def slow_nearest(rows, k=10):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for i, v in good:
        if i % 100 == 0:
            d = sorted((float(np.sqrt(((v - w) ** 2).sum())), j) for j, w in good if j != i)
            out[i] = [(j, x) for x, j in d[:k]]
    return out


def test_neighbours_recall_and_scores(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = defaultdict(list)
    for r in nearest_neighbours(df, F.col("vec_id") % 100 == 0, block_rows=200).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score, r["rank"]))
    want = slow_nearest(rows)
    assert set(got) == set(want)
    vec = {i: np.array(v, float) for i, v in rows}
    hits = 0
    for q, found in got.items():
        assert [x[2] for x in found] == list(range(1, 11))
        assert all(s == pytest.approx(np.sqrt(((vec[q] - vec[v]) ** 2).sum()), abs=1e-12) for v, s, _ in found)
        hits += len({v for v, *_ in found} & {v for v, _ in want[q]})
    assert hits >= 0.9 * 10 * len(want)


def test_neighbours_recall_with_production_parameters(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()]
    found = defaultdict(set)
    for r in nearest_neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") % 100 == 0).collect():
        found[r.query_id].add(r.vec_id)
    want = slow_nearest(rows)
    assert set(found) == set(want)
    assert sum(len(found[q] & {v for v, _ in want[q]}) for q in want) >= 0.9 * 10 * len(want)


def test_neighbour_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (8, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (9, [0.5, 0.5]), (100, [2.0, 2.0])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, v int")
    got = [(r.query_id, r["rank"], r.vec_id) for r in nearest_neighbours(df, F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect()]
    # A vector of another length takes part; the shorter ones end in zeros.
    assert got == [(0, 1, 1), (0, 2, 2), (0, 3, 9), (0, 4, 100), (0, 5, 8), (100, 1, 9), (100, 2, 0), (100, 3, 1), (100, 4, 2), (100, 5, 8)]
    assert nearest_neighbours(df.limit(0), F.col("vec_id") % 100 == 0).collect() == []
    assert nearest_neighbours(df, F.col("vec_id") < 0).collect() == []


def test_forest_ascends_to_enough_rows():
    r = np.random.default_rng(1)
    x = r.standard_normal((500, 16))
    family = HashFamily(x, trees=8, bits=20)
    s = family.strings(x)
    forest = PrefixForest(s, 20)
    masks = list(forest.candidates(s[:20], 60))
    assert len(masks) == 20
    for mask in masks:
        assert mask.sum() >= 60
    a, b = forest.ranges(s[:5], 6)
    for t in range(8):
        for q in range(5):
            assert b[t, q] - a[t, q] == (s[:, t] >> np.uint64(14) == s[q, t] >> np.uint64(14)).sum()
