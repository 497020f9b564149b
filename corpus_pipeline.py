"""From raw documents to packed training sequences, by five of the operators in ``toolwatch.llm``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return
the columns of ``docs``.  Between stages the documents are written as Parquet and read
again, so a lost executor repeats part of one stage at most.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from toolwatch.llm.common import by_ids, held, released, written
from toolwatch.llm.line_dedup import line_dedup
from toolwatch.llm.near_dups import near_duplicates
from toolwatch.llm.packing import pack
from toolwatch.llm.quality_rules import quality_rules
from toolwatch.llm.toxicity import score_severity, train_severity

END_ID = 1


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose severity grade is probably above 0 go; the model learns from ``labels``.

    A null or empty text is not toxic and stays; a long one is judged by its worst window.
    Every row is judged by its text alone, repeated rows alike.  An empty table stays
    empty.  All columns come back as they are, also those named like an operator's.
    """
    model = train_severity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    judged = score_severity(held(docs, ["text"]), model)
    return released(judged.filter(~F.col("rejected")), docs, ["text"])


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules, or come from a host that fails them mostly, go.

    A null or empty text has no words and goes; long texts are measured whole.  A null
    source is no host.  Rows are judged one by one, repeated ones alike.  An empty table
    stays empty.  All columns come back as they are.
    """
    plain = ["text", "source"]
    return released(quality_rules(held(docs, plain)).filter("kept"), docs, plain)


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand in an earlier document go; every document stays, ``n_chars`` follows its text.

    A null text becomes the empty text.  Rows of equal doc_id are one document, and a null
    doc_id neither loses lines nor holds them against others.  An empty table stays empty.
    Columns other than text and n_chars come back as they are.
    """
    plain = ["doc_id", "text"]
    out = released(line_dedup(held(docs, plain)), docs, plain)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, similarity 0.8) the smallest doc_id stays.

    Texts without words and null doc_ids are no copies and stay.  Rows of equal doc_id go or
    stay together: they stay if one of them does.  An empty table stays empty.  All columns
    come back as they are.
    """
    judged = near_duplicates(docs).groupBy("doc_id").agg(F.max("kept").alias("kept"))
    return by_ids(docs, judged.filter(~F.col("kept") & F.col("doc_id").isNotNull()).select("doc_id"), "left_anti")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents left, with their places in sequences of 2048 tokens.

    A null or empty text is its end id alone; a long one is cut into several pieces.
    Repeated rows and null doc_ids are packed like any other.  An empty table has no
    pieces.  Other columns are not read.
    """
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"), END_ID)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("quality_rules", drop_low_quality),
    ("line_dedup", drop_shared_lines),
    ("near_dedup", drop_near_copies),
    ("packing", pack_sequences),
]

#: Tokenising, MinHash and the trained model have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
