"""Windows over a whole ordered table, without a task that holds the whole order."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

_WITHIN = 33  # bits of the row's number within its range, below those of the range


def placed(
    table: DataFrame, order: Sequence[str | Column], folder: str, parts: int | None = None
) -> DataFrame:
    """The rows with ``place``: their position, from 0, in the ascending order (nulls first).

    Rows are written to ``folder`` in ``parts`` sorted ranges with their number inside the
    range. The driver sees one count per range, from which each range learns where it
    begins. ``order`` should tell all rows apart: equal rows get different places, in any order,
    and rows that agree in the whole order stay in one range.
    """
    if "place" in table.columns:
        raise ValueError("the table has a column named place")
    spark = table.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = table.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    ranged.select("*", F.monotonically_increasing_id().alias("place")).write.parquet(folder)
    # Declared with the written schema, which opening the folder would otherwise have to find.
    schema = table.withColumn("place", F.lit(0).cast("bigint")).schema
    stored = spark.read.schema(schema).parquet(folder).withColumn(
        "range", F.shiftright("place", _WITHIN)
    )
    counts = stored.groupBy("range").count().orderBy("range").collect()
    starts = accumulate([row["count"] for row in counts[:-1]], initial=0)
    begins = [
        F.struct(F.lit(row["range"]).alias("range"), F.lit(start).cast("bigint").alias("start"))
        for row, start in zip(counts, starts)
    ]
    if not begins:
        return stored.drop("range")
    begins = spark.range(1).select(F.inline(F.array(*begins)))
    within = F.col("place").bitwiseAND((1 << _WITHIN) - 1)
    # At most a row per range.
    return stored.join(F.broadcast(begins), "range").select(
        *[F.col(f"`{name}`") for name in table.columns], (F.col("start") + within).alias("place")
    )


def over_previous(
    rows: DataFrame,
    back: int,
    measures: Callable[[WindowSpec], dict[str, Column]],
    block: int = 1 << 16,
) -> DataFrame:
    """Columns that each row computes from itself and up to ``back`` rows before it.

    ``rows`` has a ``place`` (:func:`placed`). It is cut into blocks of ``block`` rows, and the last
    ``back`` rows of each block are carried into the next one, where they serve the window
    and are dropped again. All blocks have the same size, whatever the order's values are.
    ``measures`` is given the window, in order, whose frame may reach ``back`` rows back.
    """
    width = max(block, back, 1)
    if "block" in rows.columns:
        raise ValueError("the table has a column named block")
    own = F.expr(f"place div {width}")
    carried = F.pmod("place", F.lit(width)) >= width - back
    blocks = F.when(carried, F.array(own, own + 1)).otherwise(F.array(own))
    window = Window.partitionBy("block").orderBy("place")
    spread = rows.select("*", F.explode(blocks).alias("block"))
    named = [column.alias(name) for name, column in measures(window).items()]
    return spread.select("*", *named).where(F.col("block") == own).drop("block")
