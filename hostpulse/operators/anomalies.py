"""Batch scoring and anomaly rules over the stored rollups.

The scorers read their rollup twice, once for its rows and once for its mean and
spread: pass a stored table, not a query over the requests.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hostpulse.functions.measures import (
    change_percent,
    guarded_zscore,
    only_row,
    percent,
    weighted,
    zscore,
)
from hostpulse.functions.rules import (
    BATCH_SEVERITIES,
    ENDPOINT_RULES,
    HOST_RULES,
    HOURLY_RULES,
    SUSPICION_WEIGHTS,
    first_match,
    flag,
)
from hostpulse.operators.baselines import (
    endpoint_baseline_stats,
    hourly_baseline,
    ip_baseline_stats,
)

# The common schema of batch findings, in order.
FINDING = {
    "anomaly_source": "string",
    "detected_at": "timestamp",
    "host": "string",
    "endpoint": "string",
    "anomaly_type": "string",
    "z_score": "double",
    "metric_value": "bigint",
    "change_pct": "double",
    "baseline_value": "double",
}


def hourly_change(hours: DataFrame) -> DataFrame:
    """Each hour beside the hour before it that had traffic, with relative changes.

    Like the rolling mean this orders the finished hourly rollup as a whole,
    which the calendar bounds.
    """
    before = F.lag(F.struct("total_requests", "error_rate", "total_bytes")).over(
        Window.orderBy("hour_bucket")
    )
    paired = hours.withColumn("before", before)
    requests, rate = F.col("before.total_requests"), F.col("before.error_rate")
    return paired.select(
        *hours.columns,
        requests.alias("prev_requests"),
        rate.alias("prev_error_rate"),
        F.col("before.total_bytes").alias("prev_bytes"),
        change_percent(F.col("total_requests"), requests).alias("request_change_pct"),
        change_percent(F.col("error_rate"), rate, damping=1e-4).alias("error_rate_change_pct"),
    )


def hourly_scores(hours: DataFrame) -> DataFrame:
    normal = only_row(hourly_baseline(hours))

    def score(column: str, name: str) -> Column:
        return guarded_zscore(
            F.col(column), normal[f"global_mean_{name}"], normal[f"global_stddev_{name}"]
        )

    return hourly_change(hours).select(
        "*",
        score("total_requests", "requests").alias("request_z_score"),
        score("error_rate", "error_rate").alias("error_rate_z_score"),
        score("total_bytes", "bytes").alias("bytes_z_score"),
    )


def ip_scores(hosts: DataFrame) -> DataFrame:
    """Four standard scores per host and their weighted sum."""
    normal = only_row(ip_baseline_stats(hosts))
    scored = hosts.select(
        "*",
        *[
            zscore(F.col(column), normal[f"mean_{name}"], normal[f"stddev_{name}"]).alias(score)
            for score, column, name in (
                ("volume_z", "total_requests", "requests"),
                ("error_z", "error_rate_pct", "error_rate"),
                ("breadth_z", "unique_endpoints_hit", "endpoints"),
                ("bytes_z", "total_bytes_transferred", "bytes"),
            )
        ],
    )
    return scored.withColumn("suspicion_score", weighted(SUSPICION_WEIGHTS))


def endpoint_scores(endpoints: DataFrame) -> DataFrame:
    normal = only_row(endpoint_baseline_stats(endpoints))
    return endpoints.select(
        "*",
        percent(F.col("not_found_count"), F.col("total_hits")).alias("not_found_rate"),
        *[
            zscore(F.col(column), normal[f"mean_{name}"], normal[f"stddev_{name}"]).alias(
                f"{name}_z"
            )
            for name, column in (
                ("404", "not_found_count"),
                ("bytes", "avg_bytes"),
                ("hits", "total_hits"),
            )
        ],
    )


def _findings(flagged: DataFrame, source: str, **columns: str) -> DataFrame:
    """Flagged rows in the common schema; a column without an expression is NULL."""
    given = {"anomaly_source": f"'{source}'", "anomaly_type": "anomaly_type", **columns}
    return flagged.select(
        *[
            F.expr(given.get(name, "NULL")).cast(kind).alias(name)
            for name, kind in FINDING.items()
        ]
    )


def hourly_findings(scored: DataFrame) -> DataFrame:
    return _findings(
        flag(scored, HOURLY_RULES),
        "HOURLY",
        detected_at="hour_bucket",
        z_score="request_z_score",
        metric_value="total_requests",
        change_pct="request_change_pct",
        baseline_value="rolling_3hr_avg_requests",
    )


def ip_findings(scored: DataFrame) -> DataFrame:
    return _findings(
        flag(scored, HOST_RULES),
        "IP",
        detected_at="first_seen",
        host="host",
        z_score="suspicion_score",
        metric_value="total_requests",
        change_pct="error_rate_pct",
        baseline_value="total_requests",
    )


def endpoint_findings(scored: DataFrame) -> DataFrame:
    return _findings(
        flag(scored, ENDPOINT_RULES),
        "ENDPOINT",
        endpoint="endpoint",
        z_score="hits_z",
        metric_value="total_hits",
        change_pct="not_found_rate",
        baseline_value="avg_bytes",
    )


def graded(findings: DataFrame) -> DataFrame:
    """Severity from the score; a NULL or negative score is LOW."""
    return findings.withColumn("severity", first_match(BATCH_SEVERITIES, otherwise="LOW"))


def batch_findings(hours: DataFrame, hosts: DataFrame, endpoints: DataFrame) -> DataFrame:
    """Findings of all three kinds, graded."""
    return graded(
        hourly_findings(hourly_scores(hours))
        .unionByName(ip_findings(ip_scores(hosts)))
        .unionByName(endpoint_findings(endpoint_scores(endpoints)))
    )


def by_severity_name(findings: DataFrame) -> DataFrame:
    """Alphabetical severity (LOW before MEDIUM), highest score first."""
    return findings.orderBy(
        "severity", F.desc("z_score"), "anomaly_source", "host", "endpoint", "detected_at"
    )


def counted_by(findings: DataFrame, *columns: str) -> DataFrame:
    return findings.groupBy(*columns).count()


def critical_batch(findings: DataFrame, limit: int | None = None) -> DataFrame:
    """Critical findings, highest score first; with a ``limit`` only the first ones."""
    ordered = findings.where("severity = 'CRITICAL'").orderBy(
        F.desc("z_score"), "anomaly_source", "host", "endpoint", "detected_at"
    )
    return (
        (ordered if limit is None else ordered.limit(limit))
        .select("anomaly_source", "anomaly_type", "host", "endpoint", "z_score", "metric_value")
    )
