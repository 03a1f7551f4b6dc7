"""Tables stored by the hash of a key, so that a join on that key need not shuffle them."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class BucketedTable:
    """Parquet files in ``folder``, in ``buckets`` buckets by ``key``, each sorted by it.

    A join on ``key`` reads them as they lie: the other side is shuffled to the same
    number of partitions. Files keep their bucket in their names, and the session's
    catalogue says how many there are. Choose ``buckets`` for the table's size, since a
    task reads a whole bucket. Rows with a null key share a bucket.
    """

    spark: SparkSession
    folder: str
    key: str
    buckets: int

    @property
    def name(self) -> str:
        return "hostpulse_" + hashlib.md5(f"{self.folder} {self.key} {self.buckets}".encode()).hexdigest()

    def write(self, table: DataFrame) -> DataFrame:
        """Store ``table`` in the folder, which must be new, and return it as stored.

        It is shuffled to its buckets first, so a bucket is one file and not one per task.
        """
        (
            table.repartition(self.buckets, self.key)
            .write.format("parquet")
            .bucketBy(self.buckets, self.key)
            .sortBy(self.key)
            .option("path", self.folder)
            .mode("error")
            .saveAsTable(self.name)
        )
        return self.spark.table(self.name)

    def open(self, schema: str) -> DataFrame:
        """The stored table, also in a session that has not written it; no file is read."""
        folder = self.folder.replace("'", "\\'")
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({schema}) USING parquet "
            f"CLUSTERED BY (`{self.key}`) SORTED BY (`{self.key}`) INTO {self.buckets} BUCKETS "
            f"LOCATION '{folder}'"
        )
        return self.spark.table(self.name)
