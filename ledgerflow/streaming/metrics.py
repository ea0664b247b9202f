"""What streams did, one row per micro-batch, kept in a table.

A listener takes every progress report of the session's streams: rows read,
what the stream itself observed while it ran (``tables.route_counts``), rows
that came after the watermark, the watermark and the batch's duration. Reports
of a run are appended to the metrics table in one go, or every so many of them
on a stream that never ends, so the table gets no file per batch.
"""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from ledgerflow.sources import tables

#: Name of the observation whose counts the metrics table holds.
ROUTING = "routing"

SCHEMA = (
    "query string, query_id string, run_id string, batch long, started string, rows long, valid long, quarantine long, null_amount long, "
    "late long, state_rows long, watermark string, batch_ms long"
)


class StreamMetrics(StreamingQueryListener):
    """Collects progress reports and appends them to the table at ``path``."""

    def __init__(self, spark: SparkSession, path: str, every: int = 100):
        self.spark, self.path, self.every = spark, path, every
        self._rows: list[tuple] = []
        self._lock = threading.Lock()
        self._begun: set[str] = set()
        self._ended: set[str] = set()

    def onQueryStarted(self, event) -> None:
        self._begun.add(str(event.runId))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if not p.numInputRows and ROUTING not in p.observedMetrics:
            return  # a batch without data
        seen = p.observedMetrics[ROUTING].asDict() if ROUTING in p.observedMetrics else {}
        row = (
            p.name,
            str(p.id),
            str(p.runId),
            p.batchId,
            p.timestamp,
            seen.get("rows", p.numInputRows),
            seen.get("valid"),
            seen.get("quarantine"),
            seen.get("null_amount"),
            sum(s.numRowsDroppedByWatermark for s in p.stateOperators),
            sum(s.numRowsTotal for s in p.stateOperators),
            p.eventTime.get("watermark"),
            p.batchDuration,
        )
        with self._lock:
            self._rows.append(row)
            full = len(self._rows) >= self.every
        if full:
            self.flush()

    def onQueryTerminated(self, event) -> None:
        self._ended.add(str(event.runId))

    def wait(self, run_id: str, seconds: float = 30) -> bool:
        """Whether the last report of a run has come: reports arrive a little after the run itself ended."""
        import time

        until = time.monotonic() + seconds
        while run_id not in self._ended and time.monotonic() < until:
            time.sleep(0.05)
        return run_id in self._ended

    def flush(self) -> int:
        """Append what came since the last time; returns the number of rows."""
        with self._lock:
            rows, self._rows = self._rows, []
        if rows:
            self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(self.path)
        return len(rows)


@contextmanager
def recorded(spark: SparkSession, path: str) -> Iterator[StreamMetrics]:
    """Record the streams that run inside the block into the metrics table at ``path``."""
    listener = StreamMetrics(spark, path)
    spark.streams.addListener(listener)
    try:
        yield listener
        for run in list(listener._begun):
            listener.wait(run)
    finally:
        spark.streams.removeListener(listener)
        listener.flush()


def read(spark: SparkSession, path: str):
    """The metrics table, repeated reports of a replayed batch included."""
    return spark.read.schema(SCHEMA).parquet(path) if tables.has_data(spark, path) else spark.createDataFrame([], SCHEMA)
