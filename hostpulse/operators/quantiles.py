"""Exact quantiles of a whole column by repeated histograms, however many different values it has."""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, IntegralType

BINS = 1024

Span = tuple  # lowest and highest value, and how many values are below them


def _bin(value: Column, low: float, high: float, whole: bool, bins: int) -> Column:
    """A number that never falls as ``value`` rises, and differs between ``low`` and ``high``."""
    if whole:
        # Rounding towards zero makes one bin around zero twice as wide.
        step = max(1, -((low - high) // bins))
        return F.call_function("div", value, F.lit(step)) if step > 1 else value
    if low <= 0 <= high or max(high / low, low / high) >= max(bins, 4):
        # Equal bins would take a round for every few magnitudes: a bin per power of two.
        power = F.floor(F.log2(F.abs(value))) + 1100  # the smallest double gives 26
        return F.when(value == 0, 0).otherwise(F.signum(value).cast("bigint") * power)
    width = high / 2 - low / 2  # halves, because the range itself may not fit
    if width == 0:
        return F.when(value == low, 0).otherwise(1).cast("bigint")
    share = (value / 2 - F.lit(low) / 2) / F.lit(width)
    return F.least(F.floor(share * bins), F.lit(bins - 1))


def values_at(
    values: DataFrame, ranks: Sequence[int], span: Span, whole: bool, bins: int = BINS
) -> dict[int, float]:
    """The values at places in the ascending order of the column ``value``, counted from 0.

    Each round counts the values in equal bins (doubles of very different sizes: a bin per
    power of two) of every range that still holds a wanted place, and goes on with the bins that hold one, between the smallest and the
    largest value seen in them. A round is one scan with map-side counting; its
    filter on the ranges reaches the Parquet files. The driver sees ``bins`` + 2
    counts per range, or 4,200 at most for powers of two; no task and no row holds more than a bin.
    """
    value, found = F.col("value"), {}
    wanted: dict[Span, list[int]] = {span: sorted(set(ranks))}
    while wanted:
        for low, high, below in [span for span in wanted if span[0] == span[1]]:
            found.update(dict.fromkeys(wanted.pop((low, high, below)), low))
        if not wanted:
            break
        spans = sorted(wanted)
        within = [value.between(low, high) for low, high, _ in spans]
        places = [
            F.when(
                inside,
                F.struct(
                    F.lit(number).alias("span"), _bin(value, low, high, whole, bins).alias("bin")
                ),
            )
            for number, (inside, (low, high, _)) in enumerate(zip(within, spans))
        ]
        counted = (
            values.where(reduce(Column.__or__, within))
            .groupBy(F.coalesce(*places).alias("place"))
            .agg(F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
            .collect()
        )
        following: dict[Span, list[int]] = defaultdict(list)
        below = [span[2] for span in spans]
        for row in sorted(counted, key=lambda row: row.low):
            number = row.place.span
            start, below[number] = below[number], below[number] + row.n
            inside = [rank for rank in wanted[spans[number]] if start <= rank < below[number]]
            if inside:
                following[row.low, row.high, start] = inside
        wanted = following
    return found


def exact_quantiles(
    table: DataFrame, column: str, shares: Sequence[float], bins: int = BINS
) -> list[float | None]:
    """The quantiles of a number column at ``shares`` (0 to 1), as ``percentile`` gives them.

    Between two values the quantile is interpolated. Nulls, NaN and infinities take no
    part; without values every quantile is None. ``percentile`` holds every
    different value in one row; this scans ``table`` once for its range, and then once
    per factor of ``bins`` in it (usually twice or three times, for all shares together), so
    pass a stored table. Integers are compared exactly, also beyond 2**53.
    """
    if not all(0 <= share <= 1 for share in shares):
        raise ValueError("shares lie between 0 and 1")
    if bins < 2:
        raise ValueError("a range is divided into 2 bins or more")
    kind = table.schema[column].dataType
    whole = isinstance(kind, IntegralType)
    if not whole and not isinstance(kind, (FloatType, DoubleType)):
        raise TypeError(f"{column} holds no integers or doubles but {kind.simpleString()}")
    value = F.col(f"`{column}`").cast("bigint" if whole else "double")
    # A comparison with a null is not true.
    usable = F.col("value").isNotNull() if whole else F.abs("value") < float("inf")
    values = table.select(value.alias("value")).where(usable)
    n, low, high = values.agg(F.count("*"), F.min("value"), F.max("value")).first()
    if not n:
        return [None] * len(shares)
    places = [share * (n - 1) for share in shares]
    ranks = [end(place) for place in places for end in (math.floor, math.ceil)]
    at = values_at(values, ranks, (low, high, 0), whole, bins)

    def between(place: float) -> float:
        one, two = math.floor(place), math.ceil(place)
        if at[one] == at[two]:
            return float(at[one])
        return (two - place) * at[one] + (place - one) * at[two]

    return [between(place) for place in places]


def quantile_table(
    table: DataFrame, columns: Sequence[str], shares: Sequence[float]
) -> DataFrame:
    """``measure``, ``share`` and ``value``: the exact quantiles of several columns of a stored table."""
    rows = [
        F.struct(F.lit(column), F.lit(share), F.lit(value))
        for column in columns
        for share, value in zip(shares, exact_quantiles(table, column, shares))
    ]
    kind = "array<struct<measure: string, share: double, value: double>>"
    return table.sparkSession.range(1).select(F.inline(F.array(*rows).cast(kind)))
