"""The registered queries: name to function of a session and a folder of tables.

Queries that build a layer start from the log lines. Queries that read layers
use the stored ones (:func:`hostpulse.plans.workspace.stored_layers`).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hostpulse.functions.rules import EXPLORER_RULES, JOB_RULES, LiveRules
from hostpulse.operators import anomalies, baselines, daily, live, parsing, rollups, serving
from hostpulse.operators.clock import clock_stats
from hostpulse.operators.quantiles import quantile_table
from hostpulse.operators.textindex import TextIndex, needed_grams, search
from hostpulse.plans.daily import DailyParts
from hostpulse.plans.feed import burst_lines, event_lines
from hostpulse.plans.workspace import fresh_folder, kept_folder, stored_layers
from hostpulse.session import pin
from hostpulse.sources.buckets import BucketedTable
from hostpulse.sources.lines import read_lines, stream_lines
from hostpulse.sources.tables import Layers, schema_of, sql_table
from hostpulse.streaming.jobs import append_available, live_activity as streamed_activity
from hostpulse.streaming.jobs import live_stream
from hostpulse.streaming.progress import ProgressHistory
from hostpulse.streaming.replay import (
    DAY,
    feed_in_order,
    replay_counts,
    replay_lines,
    slice_of,
    write_arrivals,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def _zoneless(df: DataFrame) -> DataFrame:
    """Timestamps as plain UTC times, the way the reading engines compare them."""
    return df.select(
        *[
            F.col(f"`{name}`").cast("timestamp_ntz").alias(name)
            if kind == "timestamp"
            else F.col(f"`{name}`")
            for name, kind in df.dtypes
        ]
    )


def _settled(df: DataFrame, *columns: str) -> DataFrame:
    """Columns rounded to 6 digits: the last bits of a mean depend on addition order."""
    return df.withColumns({name: F.round(F.col(f"`{name}`"), 6) for name in columns})


def _query(build: Query) -> Query:
    @wraps(build)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _zoneless(build(pin(spark), sf_dir))

    QUERIES[build.__name__] = run
    return run


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The told log lines as stored once: a query's work is on lines, not on telling them."""
    folder = kept_folder(
        spark, sf_dir, "lines", lambda folder: event_lines(spark, sf_dir).write.parquet(folder)
    )
    return spark.read.schema("log string").parquet(folder)


def _bursts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for the live lines."""
    folder = kept_folder(
        spark, sf_dir, "bursts", lambda folder: burst_lines(spark, sf_dir).write.parquet(folder)
    )
    return spark.read.schema("log string").parquet(folder)


def _requests(
    spark: SparkSession, sf_dir: str, fields: Sequence[str] | None = None
) -> DataFrame:
    return parsing.parse_lines(_lines(spark, sf_dir), fields=fields)


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.host_endpoint(_requests(spark, sf_dir))


# Lines and requests


@_query
def bronze_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written as compressed text and read back as lines; one copy per state of the table."""

    def build(folder: str) -> None:
        _lines(spark, sf_dir).write.option("compression", "gzip").text(folder)

    return read_lines(spark, kept_folder(spark, sf_dir, "raw", build))


@_query
def silver_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _requests(spark, sf_dir)


@_query
def parse_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsing.parse_quality(_lines(spark, sf_dir))


@_query
def status_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.status_distribution(_requests(spark, sf_dir, ["status"])).orderBy(F.desc("count"), "status")


@_query
def status_partition_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads only the folder of one status."""
    return stored_layers(spark, sf_dir).load("silver").where("status = 404")


@_query
def replay_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay_lines(_lines(spark, sf_dir))


@_query
def replay_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay_counts(_lines(spark, sf_dir))


@_query
def layer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_layers(spark, sf_dir).row_counts(
        "bronze",
        "silver",
        "hourly_stats",
        "ip_behaviour",
        "endpoint_stats",
        "ip_baselines",
        "global_stats",
        "anomalies",
        "live_anomalies",
    )


# Rollups and baselines


@_query
def hourly_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.hourly_stats(_requests(spark, sf_dir)).orderBy("hour_bucket")


@_query
def minute_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Traffic per minute beside the minutes before it, put in order range by range."""
    requests = _requests(spark, sf_dir, ["timestamp", "status", "bytes"])
    stats = clock_stats(requests, "minute", f"{fresh_folder(spark)}/minutes", rolling_rows=5)
    return _settled(stats, "request_change_pct")


@_query
def ip_behaviour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.ip_behaviour(_pairs(spark, sf_dir)).orderBy(F.desc("total_requests"), "host")


@_query
def endpoint_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.endpoint_stats(_pairs(spark, sf_dir)).orderBy(F.desc("total_hits"), "endpoint")


@_query
def ip_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.ip_hourly(_requests(spark, sf_dir)).orderBy("host", "hour_start")


@_query
def ip_baselines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return baselines.ip_baselines(rollups.ip_behaviour(_pairs(spark, sf_dir)))


@_query
def global_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = baselines.global_stats(rollups.hourly_stats(_requests(spark, sf_dir)))
    return _settled(stats, *stats.columns)


@_query
def broken_endpoints_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    endpoints = stored_layers(spark, sf_dir).load("endpoint_stats")
    return rollups.broken_endpoints(endpoints).orderBy(F.desc("not_found_rate_pct"), "endpoint")


@_query
def known_broken_endpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.known_broken(stored_layers(spark, sf_dir).load("endpoint_stats"))


@_query
def hourly_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = baselines.hourly_baseline(stored_layers(spark, sf_dir).load("hourly_stats"))
    return _settled(stats, *stats.columns)


@_query
def ip_baseline_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = baselines.ip_baseline_stats(stored_layers(spark, sf_dir).load("ip_behaviour"))
    return _settled(stats, *stats.columns)


@_query
def endpoint_baseline_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = baselines.endpoint_baseline_stats(stored_layers(spark, sf_dir).load("endpoint_stats"))
    return _settled(stats, *stats.columns)


# Rollups kept by the day


def _daily(spark: SparkSession, sf_dir: str) -> DailyParts:
    """Partials of four batches: two spans of days, the second sent twice, a day, and stray lines.

    The stray lines have days that were covered before, or no time.
    """

    def build(folder: str) -> None:
        parts, lines = DailyParts(spark, folder), _lines(spark, sf_dir)
        day = F.to_date(parsing.event_time())
        stray = F.substr(F.md5("log"), F.lit(1), F.lit(1)) == "0"
        dated = lines.where(~stray & day.isNotNull())
        early, last = F.lit("2024-01-16").cast("date"), F.lit("2024-01-29").cast("date")
        parts.add(dated.where(day < early), "early")
        parts.add(dated.where(day.between(early, last)), "middle")
        parts.add(dated.where(day.between(early, last)), "middle")
        parts.add(dated.where(day > last), "last-day")
        parts.add(lines.where(stray | day.isNull()), "stray")

    return DailyParts(spark, kept_folder(spark, sf_dir, "daily", build))


@_query
def daily_hourly_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily.hours_of(_daily(spark, sf_dir).load("hours")).orderBy("hour_bucket")


@_query
def daily_ip_behaviour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily.hosts_of(_daily(spark, sf_dir).load("pairs"))


@_query
def daily_endpoint_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily.endpoints_of(_daily(spark, sf_dir).load("pairs"))


@_query
def daily_ip_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily.host_hours_of(_daily(spark, sf_dir).load("host_hours"))


@_query
def daily_traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    traffic = daily.traffic_by_day(_daily(spark, sf_dir).load("pairs"))
    return traffic.withColumn("day", F.col("day").cast("timestamp_ntz")).orderBy("day")


# Batch scores and findings


def _settled_findings(findings: DataFrame) -> DataFrame:
    return _settled(findings, "z_score", "change_pct")


@_query
def hourly_lag_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = anomalies.hourly_change(stored_layers(spark, sf_dir).load("hourly_stats"))
    return _settled(changes, "request_change_pct", "error_rate_change_pct")


@_query
def hourly_zscores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = anomalies.hourly_scores(stored_layers(spark, sf_dir).load("hourly_stats"))
    names = ("request_z_score", "error_rate_z_score", "bytes_z_score")
    return _settled(scores.select("hour_bucket", *names), *names)


@_query
def hourly_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = anomalies.hourly_scores(stored_layers(spark, sf_dir).load("hourly_stats"))
    return _settled_findings(anomalies.hourly_findings(scores))


@_query
def ip_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anomalies.ip_scores(stored_layers(spark, sf_dir).load("ip_behaviour"))


@_query
def ip_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = anomalies.ip_scores(stored_layers(spark, sf_dir).load("ip_behaviour"))
    return anomalies.ip_findings(scores)


@_query
def endpoint_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anomalies.endpoint_scores(stored_layers(spark, sf_dir).load("endpoint_stats"))


@_query
def endpoint_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = anomalies.endpoint_scores(stored_layers(spark, sf_dir).load("endpoint_stats"))
    return anomalies.endpoint_findings(scores)


def _batch_findings(layers: Layers) -> DataFrame:
    return anomalies.batch_findings(
        layers.load("hourly_stats"), layers.load("ip_behaviour"), layers.load("endpoint_stats")
    )


@_query
def batch_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    findings = _batch_findings(stored_layers(spark, sf_dir))
    return _settled_findings(anomalies.by_severity_name(findings))


@_query
def anomaly_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    findings = stored_layers(spark, sf_dir).load("anomalies")
    return anomalies.counted_by(findings, "anomaly_source", "anomaly_type", "severity").orderBy(
        "severity", "anomaly_source", "anomaly_type"
    )


@_query
def anomaly_by_source_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    findings = stored_layers(spark, sf_dir).load("anomalies")
    return anomalies.counted_by(findings, "anomaly_source", "anomaly_type").orderBy(
        "anomaly_source", "anomaly_type"
    )


@_query
def anomaly_by_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    findings = stored_layers(spark, sf_dir).load("anomalies")
    return anomalies.counted_by(findings, "severity").orderBy("severity")


@_query
def critical_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    findings = stored_layers(spark, sf_dir).load("anomalies")
    return _settled(anomalies.critical_batch(findings), "z_score")


# Live, over stored lines


def _activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return live.host_activity(parsing.parse_lines(_bursts(spark, sf_dir)))


def _live_scores(spark: SparkSession, sf_dir: str, rules: LiveRules) -> DataFrame:
    layers = stored_layers(spark, sf_dir)
    return live.against_baseline(
        _activity(spark, sf_dir), layers.load("ip_baselines"), layers.load("global_stats"), rules
    )


@_query
def live_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _activity(spark, sf_dir)


@_query
def live_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _live_scores(spark, sf_dir, JOB_RULES)


@_query
def live_enriched_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over a profile stored by host and never broadcast, which the join does not shuffle."""
    layers = stored_layers(spark, sf_dir)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def stored(folder: str) -> BucketedTable:
        return BucketedTable(spark, folder, "host", buckets)

    baselines = layers.load("ip_baselines")
    folder = kept_folder(
        spark, sf_dir, f"profile-{buckets}", lambda folder: stored(folder).write(baselines)
    )
    profile = stored(folder).open(schema_of("ip_baselines")).hint("merge")
    return live.against_baseline(_activity(spark, sf_dir), profile, layers.load("global_stats"))


@_query
def live_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return live.live_findings(_live_scores(spark, sf_dir, JOB_RULES), JOB_RULES)


@_query
def live_enriched_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _live_scores(spark, sf_dir, EXPLORER_RULES)


@_query
def live_anomalies_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return live.live_findings(_live_scores(spark, sf_dir, EXPLORER_RULES), EXPLORER_RULES)


@_query
def live_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    findings = stored_layers(spark, sf_dir).load("live_anomalies")
    return anomalies.counted_by(findings, "anomaly_type").orderBy(F.desc("count"), "anomaly_type")


@_query
def live_by_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    findings = stored_layers(spark, sf_dir).load("live_anomalies")
    return anomalies.counted_by(findings, "severity").orderBy("severity")


@_query
def critical_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    return live.critical_live(stored_layers(spark, sf_dir).load("live_anomalies"))


# Live, as a stream


def _width(spark: SparkSession) -> int:
    return spark.sparkContext.defaultParallelism


def _replayed(
    spark: SparkSession, sf_dir: str, work: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """The table a stream appends to while the lines arrive slice by slice."""
    folder = fresh_folder(spark)
    arrivals, output = f"{folder}/input", f"{folder}/output"

    def run() -> None:
        append_available(
            work(stream_lines(spark, arrivals)),
            output,
            f"{folder}/checkpoint",
            partitions=_width(spark),
        )

    feed_in_order(_bursts(spark, sf_dir), f"{folder}/staged", arrivals, run, 15 * DAY)
    return spark.read.parquet(output)


@_query
def live_activity_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _replayed(spark, sf_dir, streamed_activity)


@_query
def live_anomalies_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    baseline = stored_layers(spark, sf_dir)
    return _replayed(spark, sf_dir, lambda lines: live_stream(lines, baseline))


# Live, as one run of bounded batches, with late lines


def _bounded_run(spark: SparkSession, sf_dir: str) -> str:
    """A folder with what one run of the stream appended, and the history of its batches.

    Lines arrive in slices of three days, one per trigger; a sixteenth of them
    arrives two slices late.
    """

    def build(folder: str) -> None:
        late = F.substr(F.md5("log"), F.lit(1), F.lit(1)) == "0"
        arrival = slice_of(3 * DAY) + F.when(late, 2).otherwise(0)
        write_arrivals(_bursts(spark, sf_dir), f"{folder}/arrivals", arrival)
        append_available(
            streamed_activity(stream_lines(spark, f"{folder}/arrivals", max_files_per_trigger=1)),
            f"{folder}/output",
            f"{folder}/checkpoint",
            "bounded",
            partitions=_width(spark),
            history=ProgressHistory(spark, f"{folder}/progress"),
        )

    return kept_folder(spark, sf_dir, "bounded", build)


@_query
def live_activity_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows without the requests that came after the watermark."""
    return spark.read.parquet(f"{_bounded_run(spark, sf_dir)}/output")


@_query
def live_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    emitted = spark.read.parquet(f"{_bounded_run(spark, sf_dir)}/output")
    requests = parsing.parse_lines(
        _bursts(spark, sf_dir), fields=["host", "timestamp", "status"]
    )
    last = requests.agg(F.max("timestamp").alias("last")).scalar()
    return live.late_rows(live.host_activity(requests), emitted, last)


@_query
def live_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and watermark of each batch that had rows."""
    history = ProgressHistory(spark, f"{_bounded_run(spark, sf_dir)}/progress").table()
    watermark = F.to_timestamp("watermark")
    return history.where("input_rows > 0").select(
        "batch_id", "input_rows", watermark.alias("watermark"), "unseen"
    )


# Reads of an operations view


def _findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_layers(spark, sf_dir).load("live_anomalies")


def _page_of_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.latest_anomalies(_findings(spark, sf_dir))


def _page_of_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.latest_hours(stored_layers(spark, sf_dir).load("hourly_stats"))


def _hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_layers(spark, sf_dir).load("ip_behaviour")


def _endpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_layers(spark, sf_dir).load("endpoint_stats")


@_query
def serve_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _page_of_findings(spark, sf_dir)


@_query
def serve_anomalies_next(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page behind the first one, found by that page's last row."""
    cursor = serving.cursor_after(_page_of_findings(spark, sf_dir))
    return serving.next_anomalies(_findings(spark, sf_dir), cursor)


@_query
def serve_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _page_of_hours(spark, sf_dir)


@_query
def serve_ip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table addressed by its path inside the query text."""
    return serving.top_hosts(sql_table(spark, stored_layers(spark, sf_dir).path("ip_behaviour")))


@_query
def serve_endpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.top_endpoints(_endpoints(spark, sf_dir))


@_query
def serve_kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = stored_layers(spark, sf_dir)
    return serving.kpi_summary(
        layers.load("live_anomalies"), layers.load("hourly_stats"), layers.load("ip_behaviour")
    )


@_query
def overview_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.overview_feed(stored_layers(spark, sf_dir).load("live_anomalies"))


@_query
def overview_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    trend = serving.overview_trend(stored_layers(spark, sf_dir).load("hourly_stats"))
    return _settled(trend, "error_pct")


@_query
def source_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = stored_layers(spark, sf_dir)
    return serving.source_status(
        *map(layers.load, ("live_anomalies", "hourly_stats", "ip_behaviour", "endpoint_stats"))
    )


@_query
def anomaly_facets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.anomaly_facets(_findings(spark, sf_dir))


def _search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.search_anomalies(
        _findings(spark, sf_dir), severities=("CRITICAL", "HIGH"), host="HOST1"
    )


@_query
def anomaly_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _search(spark, sf_dir)


# Text and whether it is literal; the last two leave the index nothing to go by.
HOST_SEARCHES = (("HOST1", True), ("host1[0-9]+-3", False), ("(poll|crawl)er", False), ("r.?$", False))


@_query
def anomaly_host_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings of hosts by parts of their names, from an index of those parts where it helps."""
    table = _findings(spark, sf_dir)
    index = TextIndex(
        spark, kept_folder(spark, sf_dir, "hosts", lambda to: TextIndex(spark, to).build(table, "host"))
    )
    found = [
        search(table, "host", index, wanted, literal).select(
            F.lit(wanted).alias("wanted"),
            F.lit(bool(needed_grams(wanted, literal))).alias("indexed"),
            "host",
            "window_start",
            "anomaly_type",
            "severity",
        )
        for wanted, literal in HOST_SEARCHES
    ]
    return reduce(DataFrame.unionByName, found)


@_query
def anomaly_search_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.severity_tiles(_search(spark, sf_dir))


@_query
def top_anomalous_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.top_anomalous_hosts(_findings(spark, sf_dir))


@_query
def severity_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.severity_distribution(_findings(spark, sf_dir))


@_query
def type_severity_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.type_severity_pivot(_findings(spark, sf_dir))


@_query
def anomaly_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.anomaly_feed(_page_of_findings(spark, sf_dir))


@_query
def traffic_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    snapshot = serving.traffic_snapshot(_page_of_hours(spark, sf_dir))
    return _settled(snapshot, "avg_error_pct", "avg_success_pct")


@_query
def peak_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.peak_hour(_page_of_hours(spark, sf_dir))


@_query
def traffic_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    trend = serving.traffic_trend(_page_of_hours(spark, sf_dir))
    return _settled(trend, "error_pct", "success_pct", "total_mb")


@_query
def ip_fleet_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = serving.ip_fleet_summary(_hosts(spark, sf_dir))
    return _settled(summary, "avg_requests", "avg_error_pct")


@_query
def ip_risk_quadrant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.ip_risk_quadrant(_hosts(spark, sf_dir))


@_query
def ip_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact quantiles of what hosts ask for, by histograms of the stored profile."""
    measures = ["total_requests", "error_rate_pct", "total_bytes_transferred"]
    table = quantile_table(_hosts(spark, sf_dir), measures, [0.0, 0.25, 0.5, 0.75, 0.99, 1.0])
    return _settled(table, "value")


@_query
def ip_top_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.ip_top_volume(_hosts(spark, sf_dir))


@_query
def ip_top_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.ip_top_error(_hosts(spark, sf_dir))


@_query
def ip_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.ip_density(_hosts(spark, sf_dir))


@_query
def ip_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.ip_lifecycle(_hosts(spark, sf_dir))


@_query
def endpoint_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _settled(serving.endpoint_snapshot(_endpoints(spark, sf_dir)), "avg_kb")


@_query
def endpoint_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.endpoint_top(_endpoints(spark, sf_dir))


@_query
def endpoint_404_heavy(spark: SparkSession, sf_dir: str) -> DataFrame:
    heavy = serving.endpoint_404_heavy(_endpoints(spark, sf_dir))
    return _settled(heavy, "not_found_pct")


@_query
def endpoint_heaviest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _settled(serving.endpoint_heaviest(_endpoints(spark, sf_dir)), "avg_kb")


@_query
def endpoint_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.endpoint_table(_endpoints(spark, sf_dir))
