"""What a stream has done so far, while it runs and after it has gone."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from hostpulse.sources.files import Files

_COLUMNS = (
    "batch_id bigint, input_rows bigint, duration_ms bigint, watermark string, dropped_late bigint"
)
_HISTORY = f"query_id string, run_id string, query string, at string, {_COLUMNS}, unseen bigint"


def _plain(batch) -> dict:
    return batch if isinstance(batch, dict) else batch.jsonValue


def _measures(batch: dict) -> dict:
    return {
        "batch_id": batch.get("batchId"),
        "input_rows": batch.get("numInputRows") or 0,
        "duration_ms": (batch.get("durationMs") or {}).get("triggerExecution") or 0,
        "watermark": (batch.get("eventTime") or {}).get("watermark"),
        "dropped_late": sum(
            state.get("numRowsDroppedByWatermark") or 0
            for state in batch.get("stateOperators") or []
        ),
    }


def progress_table(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """One row per recent micro-batch (Spark keeps the last hundred); empty before the first."""
    rows = [tuple(_measures(_plain(batch)).values()) for batch in query.recentProgress]
    return spark.createDataFrame(rows, _COLUMNS)


@dataclass(frozen=True)
class ProgressHistory:
    """Every micro-batch of every stream that is followed, kept in a folder of small files.

    The driver looks at a stream's recent progress while it waits for its end, and
    writes what is new as one file, put in place in one step: so the table grows
    while the stream runs and outlives it, and a reader never meets half a file.
    It asks rather than listens, since a listener in this language makes the
    session open a port for calls back.
    """

    spark: SparkSession
    folder: str

    def follow(self, query: StreamingQuery, every_seconds: float = 0.5) -> None:
        """Wait for the stream's end and record its batches meanwhile.

        Spark keeps ``spark.sql.streaming.numRecentProgressUpdates`` reports (100).
        Should more pass between two looks, ``unseen`` of the next row counts them.
        """
        seen: dict[str, int | None] = {"last": None, "stamp": ""}
        try:
            while not query.awaitTermination(every_seconds):
                self._take(query, seen)
        finally:
            self._take(query, seen)

    def _new(self, query: StreamingQuery, seen: dict) -> Iterator[dict]:
        for batch in map(_plain, query.recentProgress):
            stamp = (batch.get("timestamp") or "", batch.get("batchId"))
            if seen["stamp"] and stamp <= seen["stamp"]:
                continue
            number, last = batch.get("batchId"), seen["last"]
            yield {
                "query_id": str(batch.get("id")),
                "run_id": str(batch.get("runId")),
                "query": batch.get("name"),
                "at": batch.get("timestamp"),
                **_measures(batch),
                "unseen": max(0, number - last - 1) if last is not None else 0,
            }
            seen["last"], seen["stamp"] = number, stamp

    def _take(self, query: StreamingQuery, seen: dict) -> None:
        rows = list(self._new(query, seen))
        if rows:
            name = f"{rows[0]['at'].replace(':', '')}-{uuid.uuid4().hex}.json"
            text = "".join(json.dumps(row) + "\n" for row in rows)
            Files(self.spark).write(f"{self.folder}/{name}", text)

    def table(self) -> DataFrame:
        """One row per batch: query_id, run_id, query, at, its measures, and ``unseen``."""
        if not Files(self.spark).exists(self.folder):
            return self.spark.createDataFrame([], _HISTORY)
        return self.spark.read.schema(_HISTORY).json(self.folder)

    def compact(self) -> None:
        """Bring what has been recorded into one file; what is recorded meanwhile stays."""
        files = Files(self.spark)
        names = [name for name in files.names(self.folder) if name.endswith(".json")]
        texts = [files.read(f"{self.folder}/{name}") for name in names]
        if len(names) < 2:
            return
        files.write(f"{self.folder}/{names[0]}", "".join(texts))
        for name in names[1:]:
            files.delete(f"{self.folder}/{name}")
