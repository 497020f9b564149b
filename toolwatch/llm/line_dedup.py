"""Drop lines that many documents share, with DataFrame functions only.

Lines are exploded to (document, position, hash of the normalised line), documents
per hash are counted, positions of lines over the threshold are gathered per document,
and the text is put together from the positions that stay.  Line texts are never
shuffled, only 16 bytes of hash; the text moves once, to meet its positions.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from toolwatch.llm.common import SPACES, fresh, written


def normalised(line: Column) -> Column:
    """The line without ASCII white space at both ends, A-Z in lower case."""
    line = F.btrim(line, F.lit(SPACES))
    ascii_only = F.octet_length(line) == F.char_length(line)
    return F.when(ascii_only, F.lower(line)).otherwise(F.translate(line, string.ascii_uppercase, string.ascii_lowercase))


def _lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """(id, text hash, position, 128-bit hash of the key) of every line long enough."""
    text = F.coalesce(docs["text"], F.lit(""))
    at = docs.select(docs["doc_id"].alias("id"), F.xxhash64(text).alias("version"), F.posexplode(F.split(text, "\n")).alias("pos", "line"))
    key = at.filter("id is not null").withColumn("key", normalised(F.col("line"))).filter(F.char_length("key") >= min_chars)
    return key.select("id", "version", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))


def line_dedup(docs: DataFrame, min_docs: int = 2, min_chars: int = 10) -> DataFrame:
    """``docs`` with every line dropped whose key (``normalised``) stands in ``min_docs`` documents or more.

    The document with the smallest doc_id that has the line keeps it (all its copies).
    Keys shorter than ``min_chars`` code points are never dropped.  ``text`` becomes
    the lines that stay, joined by a newline; columns n_lines (before) and n_dropped
    are added, or replaced if ``docs`` has such names; all other columns stay.

    A null text counts as one empty line and becomes the empty text.  Rows of equal
    doc_id are one document: the same lines are dropped in each.  A row with a null
    doc_id is returned whole and holds no line against others.  An empty table stays
    empty.
    """
    its_id, its_version, its_drop, its_lines = (fresh(n, docs.columns) for n in ("__id", "__version", "__drop", "__lines"))
    lines = _lines(docs, min_chars)
    if min_docs <= 2:
        # Two documents or more: the smallest and the greatest id differ.
        seen = lines.groupBy("h1", "h2").agg(F.min("id").alias("first"), F.max("id").alias("last")).filter("first < last")
    else:
        seen = lines.groupBy("h1", "h2").agg(F.min("id").alias("first"), F.count_distinct("id").alias("n")).filter(F.col("n") >= min_docs)
    # A written table: its join below is between two plain shuffles, so Spark can split
    # the partition of a line that a third of all documents have.
    shared = written(seen.select("h1", "h2", "first"), "shared-lines")
    drop = (
        lines.join(shared, ["h1", "h2"])
        .filter("id > first")
        .groupBy(F.col("id").alias(its_id), F.col("version").alias(its_version))
        .agg(F.collect_set("pos").alias(its_drop))
    )
    text = F.coalesce(docs["text"], F.lit(""))
    rows = docs.withColumn("text", text).withColumn(its_lines, F.split("text", "\n"))
    out = rows.join(drop, (F.col("doc_id") == F.col(its_id)) & (F.xxhash64("text") == F.col(its_version)), "left")
    stay = F.array_except(F.sequence(F.lit(0), F.size(its_lines) - 1), F.col(its_drop))
    kept = F.array_join(F.transform(stay, lambda i: F.get(F.col(its_lines), i)), "\n")
    return (
        out.withColumn("n_lines", F.size(its_lines).cast("long"))
        .withColumn("n_dropped", F.coalesce(F.size(its_drop), F.lit(0)).cast("long"))
        .withColumn("text", F.when(F.col(its_drop).isNull(), F.col("text")).otherwise(kept))
        .drop(its_id, its_version, its_drop, its_lines)
    )
