"""The ranked, filtered and summarised reads of an operations view.

``latest_*`` and ``top_*`` fetch a page of a stored table, by a top-k that keeps
only the page. The measures below them take the whole table: what they compare a
row with (a total, a smallest and largest value) is a one-row table of its own and
enters as a scalar subquery, so no window spans the table; a quartile is selected
first, by scans. A
``limit`` is always the last step. The reads over hours take the hours they are
given, which is where a caller chooses the range.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hostpulse.functions.measures import tally
from hostpulse.functions.rules import SEVERITIES, band, severity_rank
from hostpulse.operators.quantiles import exact_quantiles

LIVE_COLUMNS = (
    "host",
    "window_start",
    "live_requests",
    "live_errors",
    "live_404s",
    "live_error_rate",
    "batch_total_requests",
    "batch_error_rate",
    "batch_endpoint_breadth",
    "expected_hourly_requests",
    "rate_multiplier",
    "global_z_score",
    "anomaly_type",
    "severity",
)
FEED_COLUMNS = (
    "window_start",
    "host",
    "anomaly_type",
    "severity",
    "rate_multiplier",
    "global_z_score",
)

# Shown where there is no value.
DASH = "—"


# Pages of the stored tables


def _worst_first(findings: DataFrame) -> DataFrame:
    """Worst severity first, then latest window. The rank is a column while sorting:
    a sort evaluates its expressions anew for each comparison."""
    ranked = findings.withColumn("rank", severity_rank())
    return ranked.orderBy("rank", F.desc("window_start"), "host")


def latest_anomalies(findings: DataFrame, limit: int = 1000) -> DataFrame:
    return _worst_first(findings).limit(limit).select(*LIVE_COLUMNS)


@dataclass(frozen=True)
class Cursor:
    """Where a page of findings ended: rank, microseconds of the window's start, and host."""

    rank: int
    start: int | None
    host: str | None


def cursor_after(page: DataFrame) -> Cursor | None:
    """The cursor behind a page's last row, which is all that reaches the driver; None if empty."""
    last = (
        page.select(
            severity_rank().alias("rank"), F.unix_micros("window_start").alias("start"), "host"
        )
        .orderBy(F.desc("rank"), F.asc_nulls_first("start"), F.desc_nulls_last("host"))
        .first()
    )
    return last and Cursor(last["rank"], last["start"], last["host"])


def next_anomalies(findings: DataFrame, cursor: Cursor | None, limit: int = 1000) -> DataFrame:
    """The page of :func:`latest_anomalies` after ``cursor``; None: the first page.

    A filter on the order's own columns and a top-k: pages cost the same however
    far down they are, and rows that arrive meanwhile shift none. Windows without
    a start come last in their severity, hosts that are NULL first in their window.
    A host has one finding per window; rows that share both would end up on one page.
    """
    if cursor is None:
        return latest_anomalies(findings, limit)
    rank, start = severity_rank(), F.unix_micros("window_start")
    later_start, same_start = F.lit(False), start.isNull()
    if cursor.start is not None:
        later_start, same_start = (start < cursor.start) | start.isNull(), start == cursor.start
    later_host = F.col("host").isNotNull() if cursor.host is None else F.col("host") > cursor.host
    beyond = (rank > cursor.rank) | (
        (rank == cursor.rank) & (later_start | (same_start & later_host))
    )
    return latest_anomalies(findings.where(beyond), limit)


def latest_hours(hours: DataFrame, limit: int = 168) -> DataFrame:
    """The latest hours, in time order."""
    return hours.orderBy(F.desc("hour_bucket")).limit(limit).orderBy(F.asc_nulls_last("hour_bucket"))


def top_hosts(hosts: DataFrame, limit: int = 500) -> DataFrame:
    return hosts.orderBy(F.desc("total_requests"), "host").limit(limit)


def top_endpoints(endpoints: DataFrame, limit: int = 500) -> DataFrame:
    return endpoints.orderBy(F.desc("total_hits"), "endpoint").limit(limit)


# Overview


def kpi_summary(findings: DataFrame, hours: DataFrame, hosts: DataFrame) -> DataFrame:
    """One row of headline numbers, 0 where there is no data, with colour bands.

    Each number is a scalar subquery over its table; nothing is joined.
    """
    alerts = findings.agg(
        F.count("*").alias("total_anomalies"),
        tally("severity = 'CRITICAL'").alias("critical_count"),
        tally("severity = 'HIGH'").alias("high_count"),
    )
    latest = hours.agg(
        F.max_by("error_rate", "hour_bucket").alias("latest_error_rate"),
        F.max_by("total_requests", "hour_bucket").alias("latest_total_requests"),
    )
    known = hosts.agg(F.count("*").alias("unique_ips"))
    rate = F.col("latest_error_rate")
    return (
        alerts.select(
            "*",
            *[latest.select(name).scalar().alias(name) for name in latest.columns],
            known.scalar().alias("unique_ips"),
        )
        .na.fill(0)
        .select(
            "*",
            band(rate, (0.1, "RED"), (0.05, "AMBER"), otherwise="GREEN").alias("error_band"),
            band(F.col("critical_count"), (0, "RED"), otherwise="GREEN").alias("critical_band"),
        )
    )


def overview_feed(findings: DataFrame, limit: int = 15) -> DataFrame:
    return latest_anomalies(findings, limit).select(*FEED_COLUMNS)


def overview_trend(hours: DataFrame, limit: int = 48) -> DataFrame:
    return latest_hours(hours, limit).select(
        "hour_bucket",
        "total_requests",
        "rolling_3hr_avg_requests",
        (F.col("error_rate") * 100).alias("error_pct"),
    )


def source_status(
    findings: DataFrame, hours: DataFrame, hosts: DataFrame, endpoints: DataFrame
) -> DataFrame:
    """One row per source: whether it has something to show, and its label, a constant.

    Findings have something to show if one of them is critical.
    """

    def filled(table: DataFrame) -> Column:
        return table.limit(1).agg((F.count("*") > 0).alias("filled")).scalar()

    urgent = findings.agg(F.bool_or(F.col("severity") == "CRITICAL").alias("urgent"))
    answers = {
        "anomalies_stream": F.coalesce("urgent", F.lit(False)),
        "hourly_stats": filled(hours),
        "ip_behaviour": filled(hosts),
        "endpoint_stats": filled(endpoints),
    }
    return urgent.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("source"),
                        answer.alias("has_data"),
                        F.lit("CONNECTED").alias("status"),
                    )
                    for name, answer in answers.items()
                ]
            )
        )
    )


# Anomaly view


def anomaly_facets(findings: DataFrame) -> DataFrame:
    """Filter choices: types by name, then the severities present, worst first."""
    choices = findings.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(name).alias("facet"), F.col(name).alias("choice"))
                    for name in ("anomaly_type", "severity")
                ]
            )
        )
    )
    rank = F.when(F.col("facet") == "severity", severity_rank("choice"))
    return (
        choices.where("choice IS NOT NULL")
        .where((F.col("facet") == "anomaly_type") | F.col("choice").isin(*SEVERITIES))
        .distinct()
        .withColumn(
            "position", F.row_number().over(Window.partitionBy("facet").orderBy(rank, "choice"))
        )
    )


def search_anomalies(
    findings: DataFrame,
    severities: Sequence[str] = (),
    types: Sequence[str] = (),
    host: str | None = None,
    literal: bool = False,
) -> DataFrame:
    """Rows that pass the filters; an empty filter lets everything pass.

    ``host`` is found anywhere in the host name, ignoring case. It is a regular
    expression unless ``literal``.
    """
    tests = []
    if severities:
        tests.append(F.col("severity").isin(*severities))
    if types:
        tests.append(F.col("anomaly_type").isin(*types))
    if host and literal:
        tests.append(F.contains(F.lower("host"), F.lower(F.lit(host))))
    elif host:
        tests.append(F.col("host").rlike(f"(?i){host}"))
    return reduce(DataFrame.where, tests, findings)


def severity_tiles(findings: DataFrame) -> DataFrame:
    """Rows shown, and rows of each severity."""
    return findings.agg(
        F.count("*").alias("showing"),
        *[tally(f"severity = '{name}'").alias(name.lower()) for name in SEVERITIES],
    )


def top_anomalous_hosts(findings: DataFrame, limit: int = 15) -> DataFrame:
    return findings.groupBy("host").count().orderBy(F.desc("count"), "host").limit(limit)


def severity_distribution(findings: DataFrame) -> DataFrame:
    counts = findings.groupBy("severity").count()
    whole = findings.agg(F.count("*").alias("whole")).scalar()
    return counts.withColumn("share_pct", F.round(F.col("count") / whole * 100, 1))


def type_severity_pivot(findings: DataFrame) -> DataFrame:
    """Rows per type and severity, 0 where there are none."""
    return (
        findings.groupBy("anomaly_type").pivot("severity", list(SEVERITIES)).count().na.fill(0)
    )


def anomaly_feed(page: DataFrame) -> DataFrame:
    return _worst_first(page.select(*FEED_COLUMNS)).drop("rank")


# Traffic view


def traffic_snapshot(page: DataFrame) -> DataFrame:
    """Totals and unweighted mean rates over the page."""
    totals = page.agg(
        F.coalesce(F.sum("total_requests"), F.lit(0)).alias("total_requests"),
        F.coalesce(F.sum(F.col("errors_404") + F.col("errors_500")), F.lit(0)).alias(
            "total_errors"
        ),
        (F.avg("error_rate") * 100).alias("avg_error_pct"),
        F.max("total_requests").alias("peak_requests"),
        (F.avg("success_rate") * 100).alias("avg_success_pct"),
    )
    return totals.select(
        "*",
        band(F.col("total_errors"), (10000, "RED"), otherwise="AMBER").alias("errors_band"),
        band(
            F.col("avg_error_pct"), (10, "RED"), (5, "AMBER"), otherwise="GREEN"
        ).alias("rate_band"),
    )


def peak_hour(page: DataFrame) -> DataFrame:
    """The earliest hour with the most requests."""
    return (
        page.orderBy(F.desc("total_requests"), F.asc_nulls_last("hour_bucket"))
        .limit(1)
        .select("hour_bucket", "total_requests")
    )


def traffic_trend(page: DataFrame) -> DataFrame:
    error_pct = F.col("error_rate") * 100
    return page.select(
        "*",
        error_pct.alias("error_pct"),
        (error_pct > 10).alias("high_risk"),
        (F.col("success_rate") * 100).alias("success_pct"),
        (F.col("total_bytes") / (1024 * 1024)).alias("total_mb"),
    ).orderBy(F.desc_nulls_last("hour_bucket"))


# Host view


def ip_fleet_summary(hosts: DataFrame) -> DataFrame:
    totals = hosts.agg(
        F.count("*").alias("hosts"),
        F.avg("total_requests").alias("avg_requests"),
        F.avg("error_rate_pct").alias("avg_error_pct"),
        F.max("total_requests").alias("max_requests"),
        F.max("unique_endpoints_hit").alias("max_endpoint_breadth"),
    )
    return totals.withColumn("error_band", _error_band("avg_error_pct"))


def _error_band(column: str) -> Column:
    return band(F.col(column), (10, "RED"), (5, "AMBER"), otherwise="GREEN")


def ip_risk_quadrant(hosts: DataFrame) -> DataFrame:
    """Risk class of every host; busy means above the upper quartile of all.

    The quartile is exact and found by scans of the stored ``hosts`` now; the classes
    are a query to run.
    """
    (quartile,) = exact_quantiles(hosts, "total_requests", [0.75])
    busy = F.col("total_requests") > F.col("q75")
    errors = F.col("error_rate_pct")
    return hosts.withColumn("q75", F.lit(quartile).cast("double")).select(
        "host",
        "total_requests",
        "error_rate_pct",
        "q75",
        F.when(busy & (errors > 5), "HIGH VOLUME + HIGH ERROR")
        .when(busy, "HIGH VOLUME")
        .when(errors > 10, "HIGH ERROR")
        .otherwise("NORMAL")
        .alias("risk"),
    )


def ip_top_volume(hosts: DataFrame, limit: int = 20) -> DataFrame:
    return top_hosts(hosts, limit).select("host", "total_requests")


def ip_top_error(hosts: DataFrame, limit: int = 20) -> DataFrame:
    """The busiest hosts again, by error rate."""
    return (
        top_hosts(hosts, limit)
        .select("host", "error_rate_pct", _error_band("error_rate_pct").alias("error_band"))
        .orderBy(F.desc("error_rate_pct"), "host")
    )


def ip_density(hosts: DataFrame, bins: int = 20) -> DataFrame:
    """Hosts per cell of a grid over requests and error rate, equal width per axis."""
    shown = hosts.where("total_requests IS NOT NULL AND error_rate_pct IS NOT NULL")

    def cell(column: str) -> Column:
        value = F.col(column).cast("double")
        low, high = (shown.agg(bound(value).alias("bound")).scalar() for bound in (F.min, F.max))
        # All values equal: one cell, the first.
        step = F.coalesce(F.try_divide((value - low) * bins, high - low), F.lit(0.0))
        return F.least(F.floor(step), F.lit(bins - 1)).cast("int")

    return (
        shown.select(
            cell("total_requests").alias("request_bin"), cell("error_rate_pct").alias("error_bin")
        )
        .groupBy("request_bin", "error_bin")
        .agg(F.count("*").alias("hosts"))
    )


def _one_decimal(value: Column, unit: str) -> Column:
    text = F.call_function("format_number", value, F.lit("0.0"))
    return F.coalesce(F.concat(text, F.lit(unit)), F.lit(DASH))


def ip_lifecycle(hosts: DataFrame, limit: int = 20) -> DataFrame:
    return top_hosts(hosts, limit).select(
        "host",
        "total_requests",
        _one_decimal(F.col("error_rate_pct"), "%").alias("error_rate_pct"),
        _error_band("error_rate_pct").alias("error_band"),
        "first_seen",
        "last_seen",
        "unique_endpoints_hit",
    )


# Endpoint view


def endpoint_snapshot(endpoints: DataFrame) -> DataFrame:
    """Totals over all endpoints; the hotspot is the one with the most hits."""
    totals = endpoints.agg(
        F.count("*").alias("endpoints"),
        F.coalesce(F.sum("total_hits"), F.lit(0)).alias("total_hits"),
        F.coalesce(F.sum("not_found_count"), F.lit(0)).alias("total_404"),
        (F.avg("avg_bytes") / 1024).alias("avg_kb"),
        F.min_by("endpoint", F.struct(-F.col("total_hits"), F.col("endpoint"))).alias("hotspot"),
    )
    return totals.withColumn(
        "not_found_band", band(F.col("total_404"), (1000, "RED"), otherwise="AMBER")
    )


def endpoint_top(endpoints: DataFrame, limit: int = 25) -> DataFrame:
    return top_endpoints(endpoints, limit).select("endpoint", "total_hits", "unique_visitors")


def endpoint_404_heavy(endpoints: DataFrame, limit: int = 25) -> DataFrame:
    share = F.col("not_found_count") / F.greatest("total_hits", F.lit(1)) * 100
    return (
        endpoints.where("not_found_count > 0")
        .orderBy(F.desc("not_found_count"), "endpoint")
        .limit(limit)
        .select(
            "endpoint",
            "total_hits",
            "not_found_count",
            share.alias("not_found_pct"),
            band(share, (50, "RED"), (20, "ORANGE"), otherwise="AMBER").alias("not_found_band"),
        )
    )


def endpoint_heaviest(endpoints: DataFrame, limit: int = 25) -> DataFrame:
    return (
        endpoints.orderBy(F.desc_nulls_last("avg_bytes"), "endpoint")
        .limit(limit)
        .select("endpoint", "avg_bytes", (F.col("avg_bytes") / 1024).alias("avg_kb"))
    )


def endpoint_table(endpoints: DataFrame) -> DataFrame:
    return endpoints.select(
        "endpoint",
        "total_hits",
        "not_found_count",
        _one_decimal(F.col("avg_bytes") / 1024, " KB").alias("avg_bytes"),
        "unique_visitors",
    )

