"""Requests rolled up by hour, host and endpoint.

Every grouping here combines on the map side first, so a host or endpoint with
a third of all requests costs its reducer one row per map task, not one per request.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hostpulse.functions.measures import fraction, percent, tally


def clock_counts(requests: DataFrame, unit: str) -> DataFrame:
    """Counts per hour, minute or other unit; counts of disjoint requests add up."""
    return requests.groupBy(F.date_trunc(unit, "timestamp").alias(f"{unit}_bucket")).agg(
        F.count("*").alias("total_requests"),
        F.sum("bytes").alias("total_bytes"),
        tally("status = 404").alias("errors_404"),
        tally("status = 500").alias("errors_500"),
        tally("status BETWEEN 200 AND 299").alias("success_count"),
    )


def hour_counts(requests: DataFrame) -> DataFrame:
    return clock_counts(requests, "hour")


def with_hourly_shares(hours: DataFrame, rolling_rows: int = 3) -> DataFrame:
    """:func:`hour_counts` with shares and a rolling mean over the present hours.

    The rolling window has no partition key. It sees the finished rollup, one
    row per calendar hour (8,760 a year) however many requests there are.
    """
    recent = Window.orderBy("hour_bucket").rowsBetween(1 - rolling_rows, Window.currentRow)
    total = F.col("total_requests")
    return hours.select(
        "*",
        fraction(F.col("errors_404") + F.col("errors_500"), total).alias("error_rate"),
        fraction(F.col("success_count"), total).alias("success_rate"),
        F.round(F.avg(total).over(recent), 2).alias("rolling_3hr_avg_requests"),
    )


def hourly_stats(requests: DataFrame, rolling_rows: int = 3) -> DataFrame:
    """Traffic per hour with a rolling mean over the present hours."""
    return with_hourly_shares(hour_counts(requests), rolling_rows)


def host_endpoint(requests: DataFrame, *by: str) -> DataFrame:
    """Partial measures per host and endpoint, and per what else is named.

    Both the host and the endpoint profile follow from this one shuffle of the
    requests, and their distinct counts become plain counts of its rows.
    """
    return requests.groupBy("host", "endpoint", *by).agg(
        F.count("*").alias("hits"),
        F.sum("bytes").alias("bytes_sum"),
        F.count("bytes").alias("bytes_seen"),
        F.max("bytes").alias("bytes_max"),
        tally("status >= 400").alias("errors"),
        tally("status = 404").alias("not_found"),
        tally("status = 200").alias("delivered"),
        F.min("timestamp").alias("first_seen"),
        F.max("timestamp").alias("last_seen"),
    )


def ip_behaviour(pairs: DataFrame) -> DataFrame:
    """Profile per host, from :func:`host_endpoint`."""
    hits, errors = F.sum("hits"), F.sum("errors")
    return pairs.groupBy("host").agg(
        hits.alias("total_requests"),
        F.sum("bytes_sum").alias("total_bytes_transferred"),
        errors.alias("total_errors"),
        percent(errors, hits).alias("error_rate_pct"),
        F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"),
        F.count("endpoint").alias("unique_endpoints_hit"),
    )


def endpoint_stats(pairs: DataFrame) -> DataFrame:
    """Profile per endpoint, from :func:`host_endpoint`."""
    mean_bytes = F.try_divide(F.sum("bytes_sum"), F.sum("bytes_seen"))
    return pairs.groupBy("endpoint").agg(
        F.sum("hits").alias("total_hits"),
        F.round(mean_bytes, 2).alias("avg_bytes"),
        F.max("bytes_max").alias("max_bytes"),
        F.sum("not_found").alias("not_found_count"),
        F.sum("delivered").alias("success_count"),
        F.count("host").alias("unique_visitors"),
    )


def ip_hourly(requests: DataFrame) -> DataFrame:
    """Requests per host and clock hour; requests without a time have no hour."""
    slot = F.window("timestamp", "1 hour")
    return (
        requests.groupBy("host", slot.alias("slot"))
        .agg(F.count("*").alias("requests_in_hour"))
        .select("host", F.col("slot.start").alias("hour_start"), "requests_in_hour")
    )


def status_distribution(requests: DataFrame) -> DataFrame:
    return requests.groupBy("status").count()


def broken_endpoints(endpoints: DataFrame, min_hits: int = 50) -> DataFrame:
    """Endpoints with more than ``min_hits`` hits and their share of not-found answers."""
    return endpoints.where(F.col("total_hits") > min_hits).withColumn(
        "not_found_rate_pct", percent(F.col("not_found_count"), F.col("total_hits"))
    )


def known_broken(endpoints: DataFrame, share: float = 0.2) -> DataFrame:
    """Endpoints whose share of not-found answers, rounded to 2 digits, exceeds ``share``."""
    rounded = F.round(F.col("not_found_count") / F.col("total_hits"), 2)
    return endpoints.where(rounded > share).select("endpoint")
