"""Traffic by any unit of the clock, with rolling means and changes over many buckets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hostpulse.functions.measures import change_percent, fraction
from hostpulse.operators.ordered import over_previous, placed
from hostpulse.operators.rollups import clock_counts


def clock_stats(
    requests: DataFrame,
    unit: str,
    folder: str,
    rolling_rows: int = 3,
    parts: int | None = None,
    block: int = 1 << 16,
) -> DataFrame:
    """Counts and shares per ``unit`` (minute, second, hour), a rolling mean and the change.

    The measures are those of the hourly rollup, over present buckets. A year has
    half a million minutes and 31 million seconds, so the buckets are put in order in
    ranges (stored in ``folder``), and no task orders them all. Requests without a
    time form a bucket of their own, which comes first.
    """
    name, total = f"{unit}_bucket", F.col("total_requests")
    counted = clock_counts(requests, unit)
    buckets = placed(counted, [F.asc_nulls_first(name)], folder, parts)
    moved = over_previous(
        buckets,
        max(rolling_rows - 1, 1),
        lambda window: {
            "rolling_avg_requests": F.round(
                F.avg(total).over(window.rowsBetween(1 - rolling_rows, 0)), 2
            ),
            "prev_requests": F.lag(total).over(window),
        },
        block,
    )
    return moved.select(
        *counted.columns,
        fraction(F.col("errors_404") + F.col("errors_500"), total).alias("error_rate"),
        fraction(F.col("success_count"), total).alias("success_rate"),
        "rolling_avg_requests",
        "prev_requests",
        change_percent(total, F.col("prev_requests")).alias("request_change_pct"),
    )
