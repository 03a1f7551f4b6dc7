"""Rollups kept up to date by the day: partial measures that add up, and what they give together.

A partial covers the requests of one day in one batch of lines. The rollups of
:mod:`hostpulse.operators.rollups` follow from any set of partials whose requests
are disjoint, so new lines cost work in proportion to themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hostpulse.functions.measures import percent
from hostpulse.operators.rollups import (
    endpoint_stats,
    host_endpoint,
    hour_counts,
    ip_behaviour,
    ip_hourly,
    with_hourly_shares,
)

HOUR_PARTS = (
    "hour_bucket timestamp, total_requests bigint, total_bytes bigint, errors_404 bigint, "
    "errors_500 bigint, success_count bigint"
)
PAIR_PARTS = (
    "host string, endpoint string, hits bigint, bytes_sum bigint, bytes_seen bigint, "
    "bytes_max int, errors bigint, not_found bigint, delivered bigint, first_seen timestamp, "
    "last_seen timestamp"
)
HOST_HOUR_PARTS = "host string, hour_start timestamp, requests_in_hour bigint"


def day_of(time: str = "timestamp") -> Column:
    """Calendar day; requests without a time have a day of their own, NULL."""
    return F.to_date(time)


def hour_parts(requests: DataFrame) -> DataFrame:
    return hour_counts(requests).withColumn("day", day_of("hour_bucket"))


def pair_parts(requests: DataFrame) -> DataFrame:
    """Measures per day, host and endpoint."""
    return host_endpoint(requests.withColumn("day", day_of()), "day")


def host_hour_parts(requests: DataFrame) -> DataFrame:
    return ip_hourly(requests).withColumn("day", day_of("hour_start"))


def hours_of(parts: DataFrame) -> DataFrame:
    """The hourly rollup."""
    counts = ("total_requests", "total_bytes", "errors_404", "errors_500", "success_count")
    added = parts.groupBy("hour_bucket").agg(*[F.sum(name).alias(name) for name in counts])
    return with_hourly_shares(added)


def pairs_of(parts: DataFrame) -> DataFrame:
    """Measures per host and endpoint; combines on the map side, so a hot pair is a row a task."""
    sums = ("hits", "bytes_sum", "bytes_seen")
    tallies = ("errors", "not_found", "delivered")
    return parts.groupBy("host", "endpoint").agg(
        *[F.sum(name).alias(name) for name in sums],
        F.max("bytes_max").alias("bytes_max"),
        *[F.sum(name).alias(name) for name in tallies],
        F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"),
    )


def hosts_of(parts: DataFrame) -> DataFrame:
    return ip_behaviour(pairs_of(parts))


def endpoints_of(parts: DataFrame) -> DataFrame:
    return endpoint_stats(pairs_of(parts))


def host_hours_of(parts: DataFrame) -> DataFrame:
    return parts.groupBy("host", "hour_start").agg(
        F.sum("requests_in_hour").alias("requests_in_hour")
    )


def traffic_by_day(pairs: DataFrame) -> DataFrame:
    """Per day: requests, bytes, error share, hosts and endpoints seen, from pair partials.

    Distinct hosts and endpoints are counted from one row per pair and batch, not
    from requests.
    """
    hits, errors = F.sum("hits"), F.sum("errors")
    return pairs.groupBy("day").agg(
        hits.alias("total_requests"),
        F.sum("bytes_sum").alias("total_bytes"),
        percent(errors, hits).alias("error_rate_pct"),
        F.count_distinct("host").alias("hosts"),
        F.count_distinct("endpoint").alias("endpoints"),
    )
