"""The batch job: lines to requests, rollups, baselines and findings."""

from __future__ import annotations

from pyspark.sql import DataFrame

from hostpulse.functions.measures import BASELINE_DAYS
from hostpulse.operators.anomalies import batch_findings
from hostpulse.operators.baselines import global_stats, ip_baselines
from hostpulse.operators.parsing import parse_lines
from hostpulse.operators.rollups import (
    endpoint_stats,
    host_endpoint,
    hourly_stats,
    ip_behaviour,
)
from hostpulse.sources.tables import Layers
from hostpulse.sources.versions import Versions


def save_requests(requests: DataFrame, layers: Layers) -> DataFrame:
    """Store requests in one folder per status.

    Nearly all requests share one status. The rebalance hint lets adaptive
    execution split that status over many tasks and files, and keeps each rare
    status in a few files instead of one per task. Without adaptive execution one
    task would write that status, so that is an error.
    """
    if requests.sparkSession.conf.get("spark.sql.adaptive.enabled") != "true":
        raise ValueError("storing requests by status needs spark.sql.adaptive.enabled")
    return layers.save(requests.hint("rebalance", "status"), "silver", partition_by="status")


def run_batch(lines: DataFrame, layers: Layers, days: int = BASELINE_DAYS) -> Layers:
    """Build every batch layer from raw lines.

    Each layer is stored and the next one reads it back, so the lines are parsed
    once, the requests are scanned twice (by hour, and by host and endpoint), and
    a lost executor costs tasks of the running step only.
    """
    bronze = layers.save(lines, "bronze")
    silver = save_requests(parse_lines(bronze), layers)
    hours = layers.save(hourly_stats(silver), "hourly_stats")
    pairs = layers.save(host_endpoint(silver), "host_endpoint")
    hosts = layers.save(ip_behaviour(pairs), "ip_behaviour")
    endpoints = layers.save(endpoint_stats(pairs), "endpoint_stats")
    layers.save(ip_baselines(hosts, days), "ip_baselines")
    layers.save(global_stats(hours), "global_stats")
    layers.save(batch_findings(hours, hosts, endpoints), "anomalies")
    return layers


def rebuild(lines: DataFrame, versions: Versions, days: int = BASELINE_DAYS) -> str:
    """Build all batch layers as a new version; readers change over when it is whole."""
    with versions.building() as layers:
        run_batch(lines, layers, days)
    return versions.name()
