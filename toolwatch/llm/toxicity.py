"""Severity of toxic text by cumulative-link ordinal regression on sparse text features.

P(grade > k) = sigmoid(w . x - t_k): one weight vector serves all thresholds t_0 < t_1 < ...
Features are the distinct words of a document and the prefixes of its words (insults of
compounding languages); only features that tell the grades of the training rows apart
beyond chance, given how many features there are, get a weight.  A text is as severe as the
worst of its windows, which overlap by half and cover all of it, so length alone adds
nothing up.  The model is a short table and travels with the scoring tasks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from toolwatch.llm.common import arrow_map, written

WORD = re.compile(r"[^\W\d_]+")
PREFIXES = (4, 5, 6)
#: Bound of the training sample: labelled rows of either kind (toxic or not).
SAMPLE_ROWS = 4000
#: Bound of the features that get a weight, and the least likelihood-ratio statistic (G)
#: of a feature against the two kinds of rows; it rises with the number of features seen, so
#: that about CHANCE of them would pass without telling anything.
MOST_FEATURES = 4096
LEAST_G = 15.0
CHANCE = 0.01
#: Words of a window; texts up to this length are judged whole.
WINDOW_WORDS = 512
_REMEMBERED = 200_000


def word_features(word: str) -> list[str]:
    return [word, *(word[:n] + "-" for n in PREFIXES if len(word) > n)]


def features(text: str) -> set[str]:
    return {f for w in set(WORD.findall(text.lower())) for f in word_features(w)}


def worst_window(own: list[tuple[str, ...]], weights: dict[str, float]) -> float:
    """The greatest sum of the weights of distinct features in any window; ``own`` has the weighted features of each word."""
    half = WINDOW_WORDS // 2
    blocks = [{f for x in own[at : at + half] for f in x} for at in range(0, len(own), half)]
    pairs = [a | b for a, b in zip(blocks, blocks[1:])] or blocks
    return max((sum(weights[f] for f in sorted(hit)) for hit in pairs), default=0.0)


@dataclass(frozen=True)
class OrdinalModel:
    """Weights by feature and ascending thresholds; grades are 0 to len(thresholds)."""

    weights: dict[str, float]
    thresholds: tuple[float, ...]

    def above(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k) for each score and threshold."""
        return 1 / (1 + np.exp(np.clip(np.array(self.thresholds)[None, :] - score[:, None], -50, 50)))


def fit_ordinal(rows: list[tuple[int, list[int], float]], n_features: int, n_grades: int, rounds: int = 1500, l2: float = 3e-6) -> tuple[np.ndarray, np.ndarray]:
    """Weights (not negative) and thresholds that maximise the likelihood of (grade, feature numbers, row weight)."""
    y = np.array([r[0] for r in rows])
    sizes = [len(r[1]) for r in rows]
    at = np.repeat(np.arange(len(rows)), sizes)
    col = np.array([c for r in rows for c in r[1]], dtype=np.int64)
    share = np.array([r[2] for r in rows])
    share = share / share.sum()
    # Thresholds: the first one, and the logarithms of the steps between them.
    p = np.zeros(n_features + n_grades - 1)
    upto = np.array([share[y > k].sum() for k in range(n_grades - 1)]).clip(1e-6, 1 - 1e-6)
    start = np.log(1 / upto - 1)
    p[n_features] = start[0]
    p[n_features + 1 :] = np.log(np.diff(start).clip(1e-2))
    m, v = np.zeros_like(p), np.zeros_like(p)
    for i in range(1, rounds + 1):
        w, steps = p[:n_features], np.exp(p[n_features + 1 :])
        t = p[n_features] + np.concatenate([[0.0], np.cumsum(steps)])
        score = np.bincount(at, weights=w[col], minlength=len(rows))
        s = 1 / (1 + np.exp(np.clip(t[None, :] - score[:, None], -50, 50)))  # P(grade > k)
        s = np.hstack([np.ones((len(rows), 1)), s, np.zeros((len(rows), 1))])
        k = np.arange(len(rows))
        here = (s[k, y] - s[k, y + 1]).clip(1e-12)
        d = s * (1 - s)
        up, down = d[k, y] / here, d[k, y + 1] / here
        g_score = -share * (up - down)
        g_t = np.zeros(n_grades - 1)
        for j in range(n_grades - 1):
            g_t[j] = (share * (np.where(y == j + 1, up, 0) - np.where(y == j, down, 0))).sum()
        g = np.empty_like(p)
        g[:n_features] = np.bincount(col, weights=g_score[at], minlength=n_features) + l2 * w
        g[n_features] = g_t.sum()
        for j in range(1, n_grades - 1):
            g[n_features + j] = g_t[j:].sum() * steps[j - 1]
        m = 0.9 * m + 0.1 * g
        v = 0.99 * v + 0.01 * g * g
        p = p - 0.1 * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.99**i)) + 1e-9)
        p[:n_features] = p[:n_features].clip(0)  # a sign of toxicity never lowers the grade
    return p[:n_features], p[n_features] + np.concatenate([[0.0], np.cumsum(np.exp(p[n_features + 1 :]))])


def train_severity(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, most_features: int = MOST_FEATURES) -> OrdinalModel:
    """Fit on at most ``sample_rows`` toxic and as many other labelled documents (those with the smallest hash of doc_id).

    Labels say toxic 0 or 1.  Toxic rows become grade 1 (mild) or 2 (severe) by the
    median, over the sample's toxic rows, of the number of features typical of toxic
    rows that they have.  Rows without a label or a doc_id teach nothing.
    With no row of either kind the model has no weights and rejects nothing.
    """
    known = labels.filter("doc_id is not null and toxic is not null").select(
        F.col("doc_id").alias("__id"), (F.col("toxic") > 0).cast("int").alias("__toxic")
    )
    taken = [known.filter(F.col("__toxic") == k).orderBy(F.xxhash64("__id"), "__id").limit(sample_rows) for k in (0, 1)]
    sample = taken[0].unionByName(taken[1]).dropDuplicates(["__id"])
    # At most 2 * sample_rows ids: a proven bound.
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("__id"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [sorted(features(t or "")) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("__id"), b.column("__toxic"), pa.array(found, pa.list_(pa.string()))], ["id", "toxic", "features"]
            )

    found = written(arrow_map(rows.select("__id", "__toxic", "text"), extract, "id long, toxic int, features array<string>"), "toxic-sample")
    size = {r["toxic"]: r["n"] for r in found.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n0, n1 = size.get(0, 0), size.get(1, 0)
    if not n0 or not n1:
        return OrdinalModel({}, (20.0, 40.0))
    seen = found.select("toxic", F.explode("features").alias("f")).groupBy("f").agg(
        F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b")
    )
    n = F.col("a") + F.col("b")
    p = n1 / (n0 + n1)

    def term(k: Column, expected: Column) -> Column:
        return F.when(k > 0, k * F.log(k / expected)).otherwise(F.lit(0.0))

    # Presence and absence of the feature in toxic and other rows against independence.
    rest = (n0 + n1) - n
    g = 2 * (term(F.col("a"), n * p) + term(F.col("b"), n * (1 - p)) + term(n1 - F.col("a"), rest * p) + term(n0 - F.col("b"), rest * (1 - p)))
    seen = written(seen, "toxic-features")
    least_g = max(LEAST_G, 2 * float(np.log(max(1, seen.count()) / CHANCE)))
    telling = (
        seen.withColumn("toxic_side", F.col("a") * n0 > F.col("b") * n1)
        .withColumn("g", g)
        .filter((F.col("g") >= least_g) & F.col("toxic_side")).orderBy(F.col("g").desc(), "f").limit(most_features).collect()
    )
    number = {r["f"]: i for i, r in enumerate(telling)}
    names = F.array(*[F.lit(f) for f in number]) if number else F.array().cast("array<string>")
    short = found.select("toxic", F.array_intersect("features", names).alias("own")).collect()
    own = [(r["toxic"], sorted(number[f] for f in r["own"])) for r in short]
    middle = float(np.median([len(x) for toxic, x in own if toxic]))
    weight = {0: 1 / n0, 1: 1 / n1}  # both kinds count the same, however rare toxic rows are
    data = [(0 if not toxic else 1 + (len(x) > middle), x, weight[toxic]) for toxic, x in sorted(own)]
    w, t = fit_ordinal(data, len(number), 3)
    return OrdinalModel({f: float(w[i]) for f, i in number.items()}, tuple(map(float, t)))


def score_severity(docs: DataFrame, model: OrdinalModel, reject_from: float = 0.5, carry: list[str] | None = None) -> DataFrame:
    """``docs`` with p_toxic, expected_severity, grade and rejected, a row per input row.

    expected_severity is the mean grade, grade the most probable one; ``rejected`` when
    P(grade > 0) is ``reject_from`` or more.  ``carry`` names the columns to return
    besides (default all); columns with one of the added names are replaced.  A null or
    empty text has no features.  An empty table stays empty.
    """
    added = [StructField("p_toxic", DoubleType(), False), StructField("expected_severity", DoubleType(), False), StructField("grade", IntegerType(), False)]
    out_names = {f.name for f in added} | {"rejected"}
    kept = [c for c in docs.columns if c not in out_names and (carry is None or c in carry)]
    slim = docs.select(*kept, docs["text"].alias("__text"))
    schema = StructType([*(slim.schema[c] for c in kept), *added])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = model.weights
        known: dict[str, tuple[str, ...]] = {}
        for b in batches:
            if len(known) > _REMEMBERED:
                known = {}
            scores = []
            for text in b.column(b.num_columns - 1).to_pylist():
                words = WORD.findall((text or "").lower())
                some = False
                for w in set(words):
                    own = known.get(w)
                    if own is None:
                        own = known[w] = tuple(f for f in word_features(w) if f in weights)
                    some = some or bool(own)
                scores.append(worst_window([known[w] for w in words], weights) if some else 0.0)
            above = model.above(np.array(scores, dtype=float))
            edges = np.hstack([np.ones((len(scores), 1)), above, np.zeros((len(scores), 1))])
            cols = [pa.array(above[:, 0]), pa.array(above.sum(axis=1)), pa.array((edges[:, :-1] - edges[:, 1:]).argmax(axis=1), pa.int32())]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *cols], names)

    return arrow_map(slim, run, schema).withColumn("rejected", F.col("p_toxic") >= reject_from)
