"""Live traffic per host, judged against the batch baseline.

The same functions run on a stream and on a stored table: a watermark has no
effect on a stored table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hostpulse.functions.measures import only_row, percent, tally, zscore
from hostpulse.functions.rules import JOB_RULES, LiveRules, first_match, flag

WATERMARK = "10 minutes"
WINDOW = "10 minutes"
SLIDE = "5 minutes"
WINDOWS_PER_HOUR = 6

# A profile beyond this is joined by a shuffle.
BROADCAST_BYTES = 64 * 1024 * 1024


def host_activity(requests: DataFrame) -> DataFrame:
    """Requests, errors and not-found answers per host and sliding window."""
    return (
        requests.select("host", "timestamp", "status")
        .withWatermark("timestamp", WATERMARK)
        .groupBy(F.window("timestamp", WINDOW, SLIDE).alias("slot"), "host")
        .agg(
            F.count("*").alias("live_requests"),
            tally("status >= 400").alias("live_errors"),
            tally("status = 404").alias("live_404s"),
        )
        .select(
            "host",
            F.col("slot.start").alias("window_start"),
            "live_requests",
            "live_errors",
            "live_404s",
            percent(F.col("live_errors"), F.col("live_requests")).alias("live_error_rate"),
        )
    )


def late_rows(whole: DataFrame, emitted: DataFrame, last: Column) -> DataFrame:
    """Windows that a stream closed without some of their requests, and how many came late.

    ``whole`` is the activity of all requests, ``emitted`` what the stream appended,
    ``last`` the latest event time. Windows that were still open are left out.
    """
    end = F.col("window_start") + F.expr(f"INTERVAL {WINDOW}")
    closed = whole.where(end <= last - F.expr(f"INTERVAL {WATERMARK}"))
    key = ["host", "window_start"]
    counted = emitted.select(*key, F.col("live_requests").alias("counted"))
    late = F.col("live_requests") - F.coalesce("counted", F.lit(0))
    return (
        closed.select(*key, "live_requests")
        .join(counted, key, "left")
        .select(*key, late.alias("late_requests"))
        .where("late_requests > 0")
    )


def sized_for_join(profile: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Mark a stored profile for broadcast if it is measured to be small enough.

    A stream is planned before its sizes are known, so the choice is made here,
    from the stored table: text bytes of the hosts plus four numbers per row.
    A larger profile keeps the default shuffled join.
    """
    size = profile.agg(F.sum(F.octet_length("host") + 48).alias("bytes")).first()["bytes"]
    return F.broadcast(profile) if (size or 0) <= max_bytes else profile


def against_baseline(
    activity: DataFrame, profile: DataFrame, stats: DataFrame, rules: LiveRules = JOB_RULES
) -> DataFrame:
    """Activity with the host's profile (NULL for unknown hosts) and two scores.

    The join follows the aggregation, so the busiest host has one row per window.
    In batch, Spark picks broadcast or shuffle from the sizes it measures.
    """
    normal = only_row(stats)
    expected = F.col("expected_hourly_requests")
    if rules.unknown_expects_nothing:
        expected = F.coalesce(expected, F.lit(0.0))
    live = F.col("live_requests")
    return activity.join(profile, "host", "left").select(
        "*",
        F.round(live / (expected / WINDOWS_PER_HOUR + 1), 2).alias("rate_multiplier"),
        zscore(
            live,
            normal["global_mean"] / WINDOWS_PER_HOUR,
            normal["global_stddev"] / WINDOWS_PER_HOUR,
        ).alias("global_z_score"),
    )


def live_findings(scored: DataFrame, rules: LiveRules = JOB_RULES) -> DataFrame:
    return flag(scored, rules.kinds).withColumn(
        "severity", first_match(rules.severities, otherwise=rules.mildest)
    )


def critical_live(findings: DataFrame, limit: int | None = None) -> DataFrame:
    """Critical windows, largest multiplier first; with a ``limit`` only the first ones."""
    ordered = findings.where("severity = 'CRITICAL'").orderBy(
        F.desc("rate_multiplier"), "window_start", "host"
    )
    return (
        (ordered if limit is None else ordered.limit(limit))
        .select(
            "host",
            "window_start",
            "live_requests",
            "rate_multiplier",
            "global_z_score",
            "anomaly_type",
        )
    )
