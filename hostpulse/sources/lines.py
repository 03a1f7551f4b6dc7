"""Raw log lines from files and topics, always as one string column ``log``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TEXT_SCHEMA = "value string"

# Everything stripped from both ends of a replayed line.
BLANKS = " \t\n\r\f\v\x1c\x1d\x1e\x1f"


def as_log(raw: DataFrame) -> DataFrame:
    return raw.select(F.col("value").cast("string").alias("log"))


def spread(raw: DataFrame, parts: int | None) -> DataFrame:
    """The same rows dealt over so many parts, for an input with too few splits; None: as it is."""
    return raw if parts is None else raw.repartition(parts)


def read_lines(spark: SparkSession, path: str, parts: int | None = None) -> DataFrame:
    """Lines of text files, plain or compressed.

    A gzip file cannot be split: a few large ones leave a cluster idle unless
    their lines are dealt over ``parts``.
    """
    return as_log(spread(spark.read.text(path), parts))


def stream_lines(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Lines of the text files that arrive in a folder."""
    reader = spark.readStream.format("text").schema(TEXT_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return as_log(reader.load(path))


def topic_options(servers: str, topic: str, starting: str, fail_on_loss: bool) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_loss).lower(),
    }


def stream_topic(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting: str = "latest",
    fail_on_loss: bool = False,
) -> DataFrame:
    """Lines of a Kafka topic (needs the Kafka connector on the class path)."""
    return as_log(_topic(spark, topic_options(servers, topic, starting, fail_on_loss)))


def stream_topic_pairs(
    spark: SparkSession, servers: str, topic: str, starting: str = "earliest"
) -> DataFrame:
    """Key and value of a Kafka topic as strings, from its start unless told otherwise."""
    raw = _topic(spark, topic_options(servers, topic, starting, fail_on_loss=True))
    return raw.select(F.col("key").cast("string"), F.col("value").cast("string"))


def _topic(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.readStream.format("kafka").options(**options).load()


def write_topic(lines: DataFrame, servers: str, topic: str) -> None:
    """Send lines to a Kafka topic, one message each, acknowledged by all replicas."""
    (
        lines.select(F.col("log").alias("value"))
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.acks", "all")
        .option("topic", topic)
        .save()
    )


def trimmed(lines: DataFrame) -> DataFrame:
    """Lines without surrounding blanks; blank lines dropped."""
    return lines.select(F.btrim("log", F.lit(BLANKS)).alias("log")).where("log != ''")
