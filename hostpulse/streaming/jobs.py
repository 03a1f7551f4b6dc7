"""The live job: lines in, findings appended to a table."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from hostpulse.functions.rules import JOB_RULES, LiveRules
from hostpulse.operators.live import (
    against_baseline,
    host_activity,
    live_findings,
    sized_for_join,
)
from hostpulse.operators.parsing import parse_lines
from hostpulse.sources.tables import Layers
from hostpulse.sources.versions import Versions
from hostpulse.streaming.progress import ProgressHistory

LIVE_QUERY = "anomaly_detection_stream"


def live_activity(lines: DataFrame) -> DataFrame:
    return host_activity(parse_lines(lines, fields=["host", "timestamp", "status"]))


def live_stream(
    lines: DataFrame,
    layers: Layers,
    rules: LiveRules = JOB_RULES,
    profile: DataFrame | None = None,
) -> DataFrame:
    """Findings over live lines, against the stored baseline layers.

    The baselines are read anew by each run of the job. A host profile too large to
    broadcast is best stored by host (:class:`~hostpulse.sources.buckets.BucketedTable`)
    and given as ``profile``: then no batch shuffles it.
    """
    profile = sized_for_join(layers.load("ip_baselines") if profile is None else profile)
    scored = against_baseline(live_activity(lines), profile, layers.load("global_stats"), rules)
    return live_findings(scored, rules)


@contextmanager
def state_width(spark: SparkSession, partitions: int | None) -> Iterator[None]:
    """Shuffle width for streams started inside.

    The first run of a stream freezes its width in the checkpoint: choose it for
    the state the stream will grow to, not for the first batch.
    """
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    if partitions:
        spark.conf.set(key, partitions)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def append_available(
    df: DataFrame,
    path: str,
    checkpoint: str,
    name: str | None = None,
    fmt: str = "parquet",
    partitions: int | None = None,
    history: ProgressHistory | None = None,
) -> StreamingQuery:
    """Process everything that has arrived, append the closed windows, and stop.

    Run it again on the same checkpoint to go on where it left off. A source that
    bounds its files per trigger gives several batches in this one run, and the
    watermark moves on between them. ``history`` records every batch.
    """
    writer = (
        df.writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    if name:
        writer = writer.queryName(name)
    with state_width(df.sparkSession, partitions):
        query = writer.start(path)
    if history is None:
        query.awaitTermination()
    else:
        history.follow(query)
    return query


def run_live(
    lines: DataFrame,
    layers: Layers,
    rules: LiveRules = JOB_RULES,
    partitions: int | None = None,
) -> StreamingQuery:
    return append_available(
        live_stream(lines, layers, rules),
        layers.path("live_anomalies"),
        layers.path("live_checkpoint"),
        LIVE_QUERY,
        layers.fmt,
        partitions,
    )


def run_live_versioned(
    lines: DataFrame,
    versions: Versions,
    rules: LiveRules = JOB_RULES,
    partitions: int | None = None,
) -> StreamingQuery:
    """The live job against the published baselines, which stay as they are until it ends.

    A batch build may replace them meanwhile: this run goes on with the version it
    has pinned, the next one reads the new version.
    """
    with versions.pinned() as layers:
        return append_available(
            live_stream(lines, layers, rules),
            versions.live.path("live_anomalies"),
            versions.live.path("live_checkpoint"),
            LIVE_QUERY,
            versions.fmt,
            partitions,
        )
