"""Search inside the values of a column by an index of the three-character parts they hold."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SIZE = 3

_TOKEN = re.compile(r"\\.|\[(?:\\.|[^\[\]\\])+\]|\{[0-9,]*\}[+?]?|[*+?][+?]?|.", re.DOTALL)


def plain_runs(pattern: str) -> list[str]:
    """Plain texts that whatever the regular expression finds must hold, in lower case.

    Only what is certain counts: groups, classes, and what may be absent end a run, and so do
    characters outside ASCII, whose cases differ between engines. Alternatives outside
    groups, flags, quotes and unusual escapes give no runs at all.
    """
    if "(?" in pattern or "[]" in pattern or "[^]" in pattern or re.search(r"\\[^\WdDwWsSbB_]", pattern):
        return []
    runs, run, depth = [], "", 0
    for token in _TOKEN.findall(pattern):
        literal = token[-1] if len(token) == 2 and token[0] == "\\" and not token[1].isalnum() else token
        if token in "()":
            depth += 1 if token == "(" else -1
        elif depth:
            continue
        elif token in ("|", "["):
            return []
        elif token[0] in "*?{":
            run = run[:-1]
        elif literal.isascii() and len(literal) == 1 and (literal != token or token not in ".^$+"):
            run += literal.lower()
            continue
        runs.append(run)
        run = ""
    return [text for text in [*runs, run] if text]


def _grams(text: str) -> set[str]:
    return {text[at : at + SIZE] for at in range(len(text) - SIZE + 1)}


def needed_grams(wanted: str, literal: bool = False) -> set[str]:
    """The parts that every value holds in which ``wanted`` is found; none if that tells nothing."""
    runs = re.findall(r"[\x00-\x7f]+", wanted) if literal else plain_runs(wanted)
    return set().union(*(_grams(run.lower()) for run in runs))


@dataclass(frozen=True)
class TextIndex:
    """``gram`` and ``value`` of every different value of a column, stored in the order of grams."""

    spark: SparkSession
    folder: str

    def build(self, table: DataFrame, column: str) -> TextIndex:
        """Index the values of the column; nulls, and values under three characters, have no parts.

        A gram that a third of all values hold spans as many ranges as it needs, because
        the ranges are of gram and value.
        """
        values = table.select(F.col(f"`{column}`").alias("value")).distinct()
        parts = F.expr(
            f"array_distinct(transform(sequence(1, length(lower(value)) - {SIZE - 1}), "
            f"at -> substr(lower(value), at, {SIZE})))"
        )
        grams = values.where(F.length(F.lower("value")) >= SIZE).select(
            F.explode(parts).alias("gram"), "value"
        )
        ranged = grams.repartitionByRange("gram", "value").sortWithinPartitions("gram", "value")
        ranged.write.mode("overwrite").parquet(self.folder)
        return self

    def postings(self) -> DataFrame:
        return self.spark.read.schema("gram string, value string").parquet(self.folder)

    def find(self, wanted: str, literal: bool = False) -> DataFrame | None:
        """``value``: those in which ``wanted`` is found, ignoring case; None if the index can't tell.

        Values that hold all needed parts are candidates; each is then tested itself. The filter
        on grams reaches the files, whose statistics leave out ranges of other grams.
        """
        needed = sorted(needed_grams(wanted, literal))
        if not needed:
            return None
        candidates = (
            self.postings()
            .where(F.col("gram").isin(needed))
            .groupBy("value")
            .agg(F.count("*").alias("held"))
            .where(F.col("held") == len(needed))
        )
        return candidates.where(found_in("value", wanted, literal)).select("value")


def found_in(column: str, wanted: str, literal: bool = False) -> F.Column:
    """Whether the text, or else regular expression, occurs in the column, ignoring case."""
    if literal:
        return F.contains(F.lower(column), F.lower(F.lit(wanted)))
    return F.col(column).rlike(f"(?i){wanted}")


def search(
    table: DataFrame, column: str, index: TextIndex, wanted: str, literal: bool = False
) -> DataFrame:
    """The rows whose column holds ``wanted``: by the index, or by a scan where it can't tell."""
    values = index.find(wanted, literal)
    if values is None:
        return table.where(found_in(column, wanted, literal))
    return table.join(values, table[column] == values["value"], "left_semi")
