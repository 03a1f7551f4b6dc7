"""Line deduplication across documents, in DataFrame expressions only."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hostpulse.llm.store import written

WHITE = " \t\n\x0b\f\r"

# The lines of a text without those at the given places. The outer lambdas bind
# the split and the remaining places, so that each is computed once per text.
_REASSEMBLED = r"""
transform(array(split(text, '\n')), lines ->
  transform(
    array(array_except(sequence(0, size(lines) - 1), coalesce(gone, cast(array() AS array<int>)))),
    places -> named_struct(
      'n_lines', cast(size(lines) AS bigint),
      'n_dropped', cast(size(lines) - size(places) AS bigint),
      'text', array_join(transform(places, place -> lines[place]), '\n')))[0])[0]
"""


def line_key(line: Column) -> Column:
    """A line without white space at its ends, A-Z in lower case."""
    return F.translate(
        F.btrim(line, F.lit(WHITE)), string.ascii_uppercase, string.ascii_lowercase
    )


def dedup_lines(docs: DataFrame, min_docs: int = 2, min_chars: int = 10) -> DataFrame:
    """``docs`` without lines that ``min_docs`` or more documents share, and two counts.

    A line counts by its :func:`line_key`, if that has ``min_chars`` code points
    or more. A shared key loses all its lines except in the smallest ``doc_id``
    that holds it. Returns the columns of ``docs`` with ``text`` rewritten, plus
    ``n_lines`` (before dropping) and ``n_dropped``; columns of these names are
    replaced, all others stay as they are.

    A null or empty text is one empty line and comes back empty. Rows of one
    ``doc_id`` are one document, repeated or not, and each row is returned. A row
    without a ``doc_id`` is returned as it is: it neither counts nor loses lines.

    Lines travel as 128-bit hashes with their place, never as text. Counting
    combines on the map side, first per document and then per line, so a line of
    a third of all documents costs a reducer one row per map task; the join that
    marks lines has plain exchanges on both sides and can be split.
    """
    texts = docs.select(F.struct("*").alias("doc")).select(
        "doc",
        F.col("doc.doc_id").alias("id"),
        F.coalesce("doc.text", F.lit("")).alias("text"),
        F.xxhash64("doc.text").alias("version"),
    )
    keyed = (
        texts.where("id IS NOT NULL")
        .select("id", "version", F.posexplode(F.split("text", "\n")).alias("place", "line"))
        .select("id", "version", "place", line_key(F.col("line")).alias("key"))
        .where(F.length("key") >= min_chars)
        .select(
            "id",
            "version",
            "place",
            F.xxhash64("key").alias("hash"),
            F.xxhash64(F.lit("line"), "key").alias("check"),
        )
    )
    keyed = written(keyed)
    shared = (
        keyed.groupBy("hash", "check")
        .agg(F.count_distinct("id").alias("holders"), F.min("id").alias("keeper"))
        .where(F.col("holders") >= min_docs)
        .select("hash", "check", "keeper")
    )
    gone = (
        keyed.join(written(shared), ["hash", "check"])
        .where("id <> keeper")
        .groupBy("id", "version")
        .agg(F.collect_list("place").alias("gone"))
    )
    rewritten = texts.join(gone, ["id", "version"], "left").select(
        "doc", F.expr(_REASSEMBLED).alias("now")
    )
    added = ["n_lines", "n_dropped"]
    kept = [
        F.col("now.text").alias(name) if name == "text" else F.col("doc").getField(name).alias(name)
        for name in docs.columns
        if name not in added
    ]
    return rewritten.select(*kept, *(F.col(f"now.{name}") for name in added))
