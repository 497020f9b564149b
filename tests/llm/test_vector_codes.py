"""Vector codes against a plain version that measures every entry."""

import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest

from toolwatch.llm.vector_codes import coded_rows, orchard

SF = "/root/testdata/sf0.001"


def plain(rows, parts=8, entries=16, rounds=6):
    """rows: (id, vector, label) -> {position: (code, error)}, label sums and the digest, in Python integers."""
    kept = [(i, r) for i, r in enumerate(rows) if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    size = -(-max((len(r[1]) for _, r in kept), default=1) // parts)
    v = {i: [max(-(2**27), min(2**27, math.floor(4096 * x))) for x in r[1]] + [0] * (parts * size - len(r[1])) for i, r in kept}
    first = sorted(v, key=lambda i: (rows[i][0] is None, rows[i][0], v[i]))[:entries]
    out, codes, digest = {i: 0 for i in v}, defaultdict(str), []
    for p in range(parts):
        own = {i: v[i][p * size : (p + 1) * size] for i in v}
        book = [own[i] for i in first]

        def assign():
            return {i: min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book)) for i, x in own.items()}

        for _ in range(rounds):
            groups = defaultdict(list)
            for i, (_, k) in assign().items():
                groups[k].append(own[i])
            book = [[sum(c) // len(groups[k]) for c in zip(*groups[k])] if k in groups else e for k, e in enumerate(book)]
        for i, (d, k) in assign().items():
            out[i] += d
            codes[i] += f"{k:02x}"
        digest += [str(x) for e in book for x in e]
    by_label = defaultdict(int)
    for i in v:
        by_label[rows[i][2]] += out[i]
    sha = hashlib.sha256(",".join(digest).encode()).hexdigest()
    return sorted((rows[i][0] if rows[i][0] is not None else -1, codes[i], out[i], by_label[rows[i][2]], sha) for i in v)


def rows_of(df):
    return sorted((r.vec_id if r.vec_id is not None else -1, r.code, r.error, r.label_error, r.codebooks_sha256) for r in df.collect())


def test_walk_finds_the_nearest_entry_and_saves_distances():
    rng = np.random.default_rng(3)
    centres = rng.integers(-9000, 9000, (16, 4))
    points = centres[rng.integers(0, 16, 3000)] + rng.integers(-300, 300, (3000, 4))
    code, square, computed = orchard(points, centres)
    every = ((points[:, None, :] - centres[None]) ** 2).sum(axis=2)
    assert (code == every.argmin(axis=1)).all() and (square == every.min(axis=1)).all()
    assert computed < 0.5 * every.size


@pytest.mark.parametrize("spread", [2, 40])
def test_walk_resolves_ties_to_the_lower_index(spread):
    rng = np.random.default_rng(4)
    for _ in range(20):
        book = rng.integers(0, spread, (16, 2))  # many equal entries and equal distances
        points = rng.integers(0, spread, (400, 2))
        every = ((points[:, None, :] - book[None]) ** 2).sum(axis=2)
        code, square, _ = orchard(points, book)
        assert (code == every.argmin(axis=1)).all() and (square == every.min(axis=1)).all()


def test_codes_equal_plain_rounds_on_a_table(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    want = plain([(r.vec_id, r.embedding, r.label) for r in df.collect()])
    assert rows_of(coded_rows(df.repartition(7))) == want


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [float(i % 5), -0.3 * i, 0.25], i % 3 if i % 4 else None) for i in range(40)]
    rows += [(7, [2.0, -2.1, 0.25], 1)] * 3 + [(50, None, 1), (51, [nan, 0.0, 0.0], 1), (52, [None, 1.0, 2.0], 2), (53, [inf, 0.0, 0.0], None)]
    rows += [(None, [1.0, 1.0, 1.0], 2), (60, [0.0] * 3, None), (61, [], 2), (62, [1.0] * 9, 1), (63, [1e30, -1e30, 0.0], None)]
    schema = "vec_id long, embedding array<double>, label int, id string, code string, v double, same int"
    df = spark.createDataFrame([(*r, "x", "y", 1.0, 2) for r in rows], schema)
    assert rows_of(coded_rows(df)) == plain(rows)
    assert rows_of(coded_rows(df.filter("vec_id < 5"))) == plain([r for r in rows if r[0] is not None and r[0] < 5])
    assert coded_rows(df.limit(0)).collect() == []
    assert coded_rows(df.filter("vec_id = 50")).collect() == []


def test_query_equals_its_sql(spark):
    import duckdb

    from toolwatch.llm import queries

    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    got = queries.op12_vector_codes(spark, SF)
    cur = con.execute(queries.ORACLE_SQL["op12_vector_codes"])
    names = [d[0] for d in cur.description]
    want = sorted(tuple(r[names.index(c)] for c in got.columns) for r in cur.fetchall())
    assert sorted(map(tuple, got.collect())) == want
