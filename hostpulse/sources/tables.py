"""Stored layers: raw lines, requests, rollups and findings, each a table under one root."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_FOLDERS = {
    "bronze": "bronze",
    "silver": "silver",
    "host_endpoint": "gold/host_endpoint",
    "hourly_stats": "gold/hourly_stats",
    "ip_behaviour": "gold/ip_behaviour",
    "endpoint_stats": "gold/endpoint_stats",
    "ip_baselines": "gold/ip_baselines",
    "global_stats": "gold/global_stats",
    "anomalies": "anomalies",
    "live_anomalies": "output/anomalies",
    "live_checkpoint": "checkpoints/anomaly_stream",
}

# Declared, so that opening a table neither lists footers nor guesses partition types.
_SCHEMAS = {
    "bronze": "log string",
    "silver": (
        "host string, timestamp timestamp, method string, endpoint string, "
        "protocol string, status int, bytes int"
    ),
    "host_endpoint": (
        "host string, endpoint string, hits bigint, bytes_sum bigint, bytes_seen bigint, "
        "bytes_max int, errors bigint, not_found bigint, delivered bigint, "
        "first_seen timestamp, last_seen timestamp"
    ),
    "hourly_stats": (
        "hour_bucket timestamp, total_requests bigint, total_bytes bigint, errors_404 bigint, "
        "errors_500 bigint, success_count bigint, error_rate double, success_rate double, "
        "rolling_3hr_avg_requests double"
    ),
    "ip_behaviour": (
        "host string, total_requests bigint, total_bytes_transferred bigint, "
        "total_errors bigint, error_rate_pct double, first_seen timestamp, "
        "last_seen timestamp, unique_endpoints_hit bigint"
    ),
    "endpoint_stats": (
        "endpoint string, total_hits bigint, avg_bytes double, max_bytes int, "
        "not_found_count bigint, success_count bigint, unique_visitors bigint"
    ),
    "ip_baselines": (
        "host string, batch_total_requests bigint, batch_error_rate double, "
        "batch_endpoint_breadth bigint, expected_hourly_requests double"
    ),
    "global_stats": "global_mean double, global_stddev double",
    "anomalies": (
        "anomaly_source string, detected_at timestamp, host string, endpoint string, "
        "anomaly_type string, z_score double, metric_value bigint, change_pct double, "
        "baseline_value double, severity string"
    ),
    "live_anomalies": (
        "host string, window_start timestamp, live_requests bigint, live_errors bigint, "
        "live_404s bigint, live_error_rate double, batch_total_requests bigint, "
        "batch_error_rate double, batch_endpoint_breadth bigint, "
        "expected_hourly_requests double, rate_multiplier double, global_z_score double, "
        "anomaly_type string, severity string"
    ),
}


def schema_of(name: str) -> str:
    """The declared columns of a layer."""
    return _SCHEMAS[name]


def table_at(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def sql_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The table at a path, addressed inside a query text."""
    return spark.sql(f"SELECT * FROM {fmt}.`{path}`")


@dataclass(frozen=True)
class Layers:
    """Named tables under a root folder, in one storage format."""

    spark: SparkSession
    root: str
    fmt: str = "parquet"

    def path(self, name: str) -> str:
        return f"{self.root}/{_FOLDERS[name]}"

    def paths(self) -> dict[str, str]:
        return {name: self.path(name) for name in _FOLDERS}

    def load(self, name: str) -> DataFrame:
        reader = self.spark.read.format(self.fmt)
        if self.fmt == "parquet":
            reader = reader.schema(_SCHEMAS[name])
        return reader.load(self.path(name))

    def save(self, df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
        """Overwrite a table and return it as stored."""
        writer = df.write.format(self.fmt).mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(partition_by)
        writer.save(self.path(name))
        return self.load(name)

    def row_counts(self, *names: str) -> DataFrame:
        """Rows per layer in one query; a table that does not exist counts NULL."""
        return reduce(DataFrame.unionByName, [self._count(name) for name in names])

    def _count(self, name: str) -> DataFrame:
        label = F.lit(name).alias("layer")
        try:
            return self.load(name).agg(F.count("*").alias("rows")).select(label, "rows")
        except AnalysisException:
            return self.spark.range(1).select(label, F.lit(None).cast("bigint").alias("rows"))
