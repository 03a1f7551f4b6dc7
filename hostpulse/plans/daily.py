"""Daily rollups as stored tables that each batch of lines adds to."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hostpulse.operators import daily
from hostpulse.operators.baselines import global_stats, ip_baselines
from hostpulse.operators.parsing import parse_lines
from hostpulse.sources.files import Files
from hostpulse.sources.versions import Versions

_PARTS: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "hours": (daily.HOUR_PARTS, daily.hour_parts),
    "pairs": (daily.PAIR_PARTS, daily.pair_parts),
    "host_hours": (daily.HOST_HOUR_PARTS, daily.host_hour_parts),
}
_REQUESTS = (
    "host string, timestamp timestamp, method string, endpoint string, protocol string, "
    "status int, bytes int"
)


@dataclass(frozen=True)
class DailyParts:
    """Partial rollups by day and batch under one root.

    A batch is a set of lines under a name, say an hour's arrivals or one log
    file. Its partials lie in one folder per day it has lines of, so adding it
    touches no other batch and no other day, and adding it again under the same
    name, as after a failure, replaces what it left the first time.
    """

    spark: SparkSession
    root: str

    def _path(self, part: str) -> str:
        return f"{self.root}/{part}"

    def load(self, part: str) -> DataFrame:
        """Partials with their ``day`` and ``batch``; a filter on days reads their folders only."""
        schema = f"{_PARTS[part][0]}, day date, batch string"
        return self.spark.read.schema(schema).parquet(self._path(part))

    def add(self, lines: DataFrame, batch: str) -> None:
        """Parse the lines once, then write the partials of each of their days."""
        if not re.fullmatch(r"[\w.-]+", batch):
            raise ValueError(f"a batch is named by letters, digits, '.', '-' and '_': {batch!r}")
        scratch = f"{self.root}/_arriving/{batch}"
        parse_lines(lines).write.mode("overwrite").parquet(scratch)
        requests = self.spark.read.schema(_REQUESTS).parquet(scratch)
        for part, (_, build) in _PARTS.items():
            before = self._days_with(part, batch)
            (
                build(requests)
                .withColumn("batch", F.lit(batch))
                # Few files a day: adaptive execution sizes them.
                .hint("rebalance", "day")
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy("day", "batch")
                .parquet(self._path(part))
            )
            self._drop(part, batch, before - self._days_in(requests))
        Files(self.spark).delete(scratch)

    def _days_with(self, part: str, batch: str) -> set[str]:
        """Folders of days in which the batch has partials; one request per day."""
        files, path = Files(self.spark), self._path(part)
        days = [name for name in files.names(path) if name.startswith("day=")]
        return {day for day in days if files.exists(f"{path}/{day}/batch={batch}")}

    def _days_in(self, requests: DataFrame) -> set[str]:
        """The same for new requests; the driver gets one row per calendar day."""
        days = requests.select(daily.day_of().alias("day")).distinct().collect()
        return {f"day={row.day or '__HIVE_DEFAULT_PARTITION__'}" for row in days}

    def _drop(self, part: str, batch: str, days: set[str]) -> None:
        """Partials of days that a batch sent anew no longer has lines of."""
        for day in days:
            Files(self.spark).delete(f"{self._path(part)}/{day}/batch={batch}")


def publish_rollups(parts: DailyParts, versions: Versions) -> str:
    """The rollup layers from all partials, as a new version; no line is read again."""
    with versions.building() as layers:
        hours = layers.save(daily.hours_of(parts.load("hours")), "hourly_stats")
        pairs = layers.save(daily.pairs_of(parts.load("pairs")), "host_endpoint")
        hosts = layers.save(daily.ip_behaviour(pairs), "ip_behaviour")
        layers.save(daily.endpoint_stats(pairs), "endpoint_stats")
        layers.save(ip_baselines(hosts), "ip_baselines")
        layers.save(global_stats(hours), "global_stats")
    return versions.name()
