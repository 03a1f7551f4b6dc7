"""Counting and ratio expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASELINE_DAYS = 28


def tally(predicate: str) -> Column:
    """Rows of the group for which the predicate is true (NULL is not true)."""
    return F.count_if(F.expr(predicate))


def fraction(part: Column, whole: Column) -> Column:
    return F.round(part / whole, 4)


def percent(part: Column, whole: Column) -> Column:
    return F.round(part / whole * 100, 2)


def change_percent(now: Column, before: Column, damping: float = 0.0) -> Column:
    """Relative change in percent; 0 where there is nothing to compare with.

    ``damping`` is added to the divisor, for rates that can be close to zero.
    """
    divisor = before + F.lit(damping) if damping else before
    return F.when(F.coalesce(before == 0, F.lit(True)), F.lit(0.0)).otherwise(
        (now - before) / divisor * 100
    )


def only_row(table: DataFrame) -> Column:
    """The single row of ``table`` as a struct, usable in any other query.

    A scalar subquery: Spark runs it once and hands the value to the tasks, so
    there is neither a join nor a trip through the driver program. It holds in
    batch and streaming plans. An empty table gives NULL, two rows are an error.
    """
    return table.select(F.struct("*").alias("only_row")).scalar()


def zscore(value: Column, mean: Column, spread: Column, digits: int = 2) -> Column:
    """Standard score; NULL (which no rule accepts) where the spread is zero."""
    return F.round(F.try_divide(value - mean, spread), digits)


def guarded_zscore(value: Column, mean: Column, spread: Column) -> Column:
    """Unrounded standard score; 0 where the spread is zero."""
    return F.when(spread == 0, F.lit(0.0)).otherwise(F.try_divide(value - mean, spread))


def weighted(parts: dict[str, float], digits: int = 2) -> Column:
    """Weighted sum of columns, in the order given (double addition is not associative)."""
    first, *rest = [F.col(name) * F.lit(weight) for name, weight in parts.items()]
    total = first
    for part in rest:
        total = total + part
    return F.round(total, digits)
