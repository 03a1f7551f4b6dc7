"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import from_arrow_schema


def scratch(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``; without that setting, below the warehouse.

    What lies in ``hostpulse-llm/<application id>`` can go when the application has ended.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    root = root or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root}/hostpulse-llm/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


def written(frame: DataFrame) -> DataFrame:
    """The same rows, read from a Parquet table written now.

    Later jobs restart from these files when executors are lost, and a join of
    two such tables has plain exchanges on both sides, which adaptive execution
    can split where a key is hot.
    """
    spark, folder = frame.sparkSession, scratch(frame.sparkSession)
    frame.write.parquet(folder)
    return spark.read.schema(frame.schema).parquet(folder)


def map_rows(
    frame: DataFrame,
    schema: pa.Schema,
    rows: Callable[[Iterator[tuple]], Iterable[tuple]],
    batch: int = 1000,
) -> DataFrame:
    """``rows`` over the tuples of each partition, with ``batch`` results at a time."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def incoming() -> Iterator[tuple]:
            for part in batches:
                for place in range(part.num_rows):
                    yield tuple(column[place].as_py() for column in part.columns)

        held: list[tuple] = []

        def full() -> pa.RecordBatch:
            columns = list(zip(*held))
            arrays = [pa.array(values, kind) for values, kind in zip(columns, schema.types)]
            return pa.RecordBatch.from_arrays(arrays, schema=schema)

        for row in rows(incoming()):
            held.append(row)
            if len(held) >= batch:
                yield full()
                held.clear()
        if held:
            yield full()

    return frame.mapInArrow(task, from_arrow_schema(schema))
