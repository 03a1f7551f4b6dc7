"""What is normal: per host, and over all hours, hosts and endpoints."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hostpulse.functions.measures import BASELINE_DAYS


def ip_baselines(hosts: DataFrame, days: int = BASELINE_DAYS) -> DataFrame:
    """The columns of the host profile that live scoring needs."""
    return hosts.select(
        "host",
        F.col("total_requests").alias("batch_total_requests"),
        F.col("error_rate_pct").alias("batch_error_rate"),
        F.col("unique_endpoints_hit").alias("batch_endpoint_breadth"),
        F.round(F.col("total_requests") / (days * 24), 2).alias("expected_hourly_requests"),
    )


def _mean_and_spread(table: DataFrame, prefix: str = "", **columns: str) -> DataFrame:
    """One row: mean and sample standard deviation of each column."""
    return table.agg(
        *[
            measure(column).alias(f"{prefix}{word}_{name}")
            for name, column in columns.items()
            for word, measure in (("mean", F.avg), ("stddev", F.stddev_samp))
        ]
    )


def global_stats(hours: DataFrame) -> DataFrame:
    return hours.agg(
        F.avg("total_requests").alias("global_mean"),
        F.stddev_samp("total_requests").alias("global_stddev"),
    )


def hourly_baseline(hours: DataFrame) -> DataFrame:
    return _mean_and_spread(
        hours, "global_", requests="total_requests", error_rate="error_rate", bytes="total_bytes"
    )


def ip_baseline_stats(hosts: DataFrame) -> DataFrame:
    return _mean_and_spread(
        hosts,
        requests="total_requests",
        error_rate="error_rate_pct",
        endpoints="unique_endpoints_hit",
        bytes="total_bytes_transferred",
    )


def endpoint_baseline_stats(endpoints: DataFrame) -> DataFrame:
    return _mean_and_spread(
        endpoints, **{"404": "not_found_count"}, bytes="avg_bytes", hits="total_hits"
    )
