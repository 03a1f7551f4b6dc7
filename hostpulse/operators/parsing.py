"""Log lines to typed requests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The accepted line and the time format inside it.
LINE = r'^(\S+) \S+ \S+ \[([^\]]+)\] "(\S+) (\S+) (\S+)" (\d{3}) (\S+)'
TIME_FORMAT = "dd/MMM/yyyy:HH:mm:ss Z"

# The groups of the pattern, the stamp (group 2) last: it alone may hold line breaks.
_ORDER = {"host": 1, "method": 3, "endpoint": 4, "protocol": 5, "status": 6, "size": 7, "stamp": 2}


def parse_lines(
    lines: DataFrame, column: str = "log", fields: Sequence[str] | None = None
) -> DataFrame:
    """Typed requests, one per well-formed line; other lines are dropped.

    Builds only the named ``fields``, if given: the generator keeps later column
    pruning from reaching the parts, and a time is costly to read.

    The pattern runs once per line: it rewrites the line as its parts on lines of
    their own, and a split takes them apart. All parts but the last are free of
    white space, so the split cannot go wrong, and a rewritten line always
    differs from the line, so one left unchanged did not match.

    The typed parts leave through a generator, which also drops the lines
    without parts. An ordinary filter, here or in a later step, would be pushed
    below the projection, and the pattern or the time format would run twice.

    A bad time gives a NULL timestamp and keeps the row. A size of ``-`` is 0, a
    size that is no integer is NULL: one bad line must not end a long job.
    """
    rewritten = F.regexp_replace(
        column,
        F.lit(LINE + "(?s:.*)"),
        F.lit("\n".join(f"${group}" for group in _ORDER.values())),
    )
    cut = lines.select(F.col(column).alias("line"), rewritten.alias("cut"))
    split = cut.select(
        F.when(F.col("cut") != F.col("line"), F.split("cut", "\n", len(_ORDER))).alias("parts")
    )
    parts = F.col("parts")
    part = {name: parts[place] for place, name in enumerate(_ORDER)}
    typed = {
        "host": part["host"],
        "timestamp": F.try_to_timestamp(part["stamp"], F.lit(TIME_FORMAT)),
        "method": part["method"],
        "endpoint": part["endpoint"],
        "protocol": part["protocol"],
        "status": part["status"].try_cast("int"),
        "bytes": F.when(part["size"] == "-", 0).otherwise(part["size"].try_cast("int")),
    }
    request = F.struct(*(typed[name].alias(name) for name in fields or typed))
    return split.select(F.inline(F.when(parts.isNotNull(), F.array(request))))


def event_time(column: str = "log") -> Column:
    """Time of a raw line, NULL where the line or its stamp is malformed."""
    stamp = F.nullif(F.regexp_extract(column, LINE, 2), F.lit(""))
    return F.try_to_timestamp(stamp, F.lit(TIME_FORMAT))


def parse_quality(lines: DataFrame, column: str = "log") -> DataFrame:
    """Malformed and well-formed lines, counted in one pass."""
    well_formed = F.regexp_like(F.col(column), F.lit(LINE))
    return lines.agg(
        F.count_if(~well_formed).alias("malformed_rows"),
        F.count_if(well_formed).alias("clean_rows"),
    )
