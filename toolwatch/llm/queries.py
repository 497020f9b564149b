"""One registered query per operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from toolwatch.llm.ann import nearest_neighbours
from toolwatch.llm.bpe import bpe_round_trip
from toolwatch.llm.common import new_folder
from toolwatch.llm.language import language_id
from toolwatch.llm.lexical import lexical_search
from toolwatch.llm.line_dedup import line_dedup
from toolwatch.llm.near_dups import near_duplicates
from toolwatch.llm.packing import pack
from toolwatch.llm.planes import read_planes, write_planes
from toolwatch.llm.quality_rules import quality_rules
from toolwatch.llm.sharding import kd_shards
from toolwatch.llm.token_counts import token_counts
from toolwatch.llm.toxicity import score_severity, train_severity
from toolwatch.llm.vector_codes import ENTRIES, PARTS, ROUNDS, SCALE, coded_rows

N_SHARDS = 24
SHARD_DIMS = ["source", "lang", "n_chars", "doc_id"]
PLANES_END_ID = 0
PACK_END_ID = 1
FLAT_END_ID = 49407  # never made from ordinary text


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train_severity(docs, table(spark, sf_dir, "labels"))
    return score_severity(docs, model, carry=["doc_id"])


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), new_folder(spark, "flat-tokens"), public_tokenizers.path("word_bpe_49k.json"), FLAT_END_ID)


def op4_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = kd_shards(table(spark, sf_dir, "documents"), N_SHARDS, SHARD_DIMS)
    return placed.withColumn("grown_shard", F.lit(None).cast("int"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "host_fail_rate")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text"), 256).alias("kept_sha256"))


OP6_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT doc_id, pos, line,
    translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
shared AS (
  SELECT key, min(doc_id) AS first_doc FROM keyed WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2)
SELECT doc_id, count(*) AS n_lines,
  count(*) FILTER (WHERE doc_id > first_doc) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE first_doc IS NULL OR doc_id = first_doc), '')) AS kept_sha256
FROM keyed LEFT JOIN shared USING (key)
GROUP BY doc_id
"""


def op7_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle_words=2)


def op8_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write_planes(table(spark, sf_dir, "documents"), new_folder(spark, "planes"), public_tokenizers.path("byte_bpe_50k.json"), PLANES_END_ID)
    return read_planes(manifest)


def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), PACK_END_ID)


def op11_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(table(spark, sf_dir, "documents"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coded_rows(table(spark, sf_dir, "embeddings"))


def _op12_sql() -> str:
    """All rounds as chained tables: distances to every entry, the least of them, floored means."""
    square = "CAST(list_sum(list_transform(list_zip(t.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT)"
    nearest = f"SELECT t.r, t.p, min({square} * {ENTRIES} + b.e) AS least FROM parts t JOIN book{{i}} b USING (p) GROUP BY ALL"
    rounds = ""
    for i in range(ROUNDS):
        rounds += f"""
near{i} AS MATERIALIZED ({nearest.format(i=i)}),
sums{i} AS (
  SELECT p, least % {ENTRIES} AS e, j, sum(x[j]) AS s, count(*) AS n
  FROM near{i} JOIN parts USING (r, p), LATERAL (SELECT unnest(range(1, len(x) + 1)) AS j) GROUP BY ALL),
means{i} AS (SELECT p, e, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS y FROM sums{i} GROUP BY ALL),
book{i + 1} AS MATERIALIZED (SELECT p, e, coalesce(y, x) AS x FROM book{i} LEFT JOIN means{i} USING (p, e)),"""
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id, v) AS r, vec_id, label, v FROM (
    SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)),
parts AS MATERIALIZED (
  SELECT r, p, v[p * (len(v) // {PARTS}) + 1 : (p + 1) * (len(v) // {PARTS})] AS x FROM kept, (SELECT unnest(range({PARTS})) AS p)),
book0 AS MATERIALIZED (SELECT p, r - 1 AS e, x FROM parts WHERE r <= {ENTRIES}),{rounds}
last AS MATERIALIZED ({nearest.format(i=ROUNDS)}),
coded AS (
  SELECT r, string_agg(lower(printf('%02X', least % {ENTRIES})), '' ORDER BY p) AS code, CAST(sum(least // {ENTRIES}) AS BIGINT) AS error
  FROM last GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) FROM book{ROUNDS}) AS codebooks_sha256
FROM coded JOIN kept USING (r)
"""


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP13_SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
items AS (SELECT row_number() OVER () AS i, item_id, text FROM benchmark),
doc_terms AS (
  SELECT r, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM docs),
counted AS MATERIALIZED (SELECT r, term, count(*) AS tf FROM doc_terms GROUP BY ALL),
lengths AS (SELECT r, CAST(sum(tf) AS BIGINT) AS n FROM counted GROUP BY r),
whole AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM lengths),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM counted, whole GROUP BY term, docs),
norms AS (SELECT r, 100 - 25 + ((25 * n * docs) // terms) AS m FROM lengths, whole),
asked AS (
  SELECT i, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM items),
scored AS (
  SELECT i, r, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM asked JOIN counted USING (term) JOIN weights USING (term) JOIN norms USING (r) GROUP BY i, r),
ranked AS (
  SELECT i, doc_id, score, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS rank
  FROM scored JOIN docs USING (r) WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked JOIN items USING (i) WHERE rank <= 20
"""


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_bpe, op2_toxicity, op3_token_counts, op4_kd_shards, op5_quality_rules, op6_line_dedup, op7_near_dups, op8_planes, op9_nearest, op10_packing, op11_language, op12_vector_codes, op13_lexical_search)
}
ORACLE_SQL: dict[str, str] = {"op6_line_dedup": OP6_SQL, "op12_vector_codes": _op12_sql(), "op13_lexical_search": OP13_SQL}
