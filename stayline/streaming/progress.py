"""Progress and health of streaming queries as tables."""

from __future__ import annotations

import json
import threading

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

PROGRESS_SCHEMA = "name string, batch_id long, input_rows long, rows_per_second double, trigger_ms long"


def _row(progress: dict) -> tuple:
    return (progress.get("name"), progress["batchId"], progress["numInputRows"],
            float(progress.get("processedRowsPerSecond") or 0.0), progress["durationMs"].get("triggerExecution"))


def recent_progress(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """The micro-batches that Spark still remembers of a query (the last 100, see spark.sql.streaming.numRecentProgressUpdates)
    and that read anything. ``ProgressLog`` keeps all of them.
    """
    rows = [_row(json.loads(p.json) if hasattr(p, "json") else p) for p in query.recentProgress]
    return spark.createDataFrame([r for r in rows if r[2] > 0], PROGRESS_SCHEMA)


def health(query: StreamingQuery) -> dict[str, object]:
    failure = query.exception()
    last = query.lastProgress
    return {"active": query.isActive, "failed": failure is not None, "error": str(failure) if failure else None,
            "last_batch": last["batchId"] if last else None}


class ProgressLog(StreamingQueryListener):
    """Appends every micro-batch of every query of a session to a table; register with ``spark.streams.addListener``.

    Rows are written ``every`` batches and whenever a query ends, so no batch is lost and little is held in memory.
    """

    def __init__(self, spark: SparkSession, path: str, every: int = 50):
        self.spark, self.path, self.every = spark, path, every
        self.waiting: list[tuple] = []
        self.errors: list[str] = []
        self.ended: dict[str, threading.Event] = {}

    def onQueryStarted(self, event) -> None:
        self.ended.setdefault(str(event.runId), threading.Event())

    def onQueryProgress(self, event) -> None:
        self.waiting.append(_row(json.loads(event.progress.json)))
        if len(self.waiting) >= self.every:
            self._write()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            self.errors.append(event.exception)
        self._write()
        self.ended.setdefault(str(event.runId), threading.Event()).set()

    def _write(self) -> None:
        rows, self.waiting = self.waiting, []
        if rows:
            self.spark.createDataFrame(rows, PROGRESS_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def wait_for(self, query: StreamingQuery, timeout: float = 60.0) -> None:
        """Return when the last event of an ended query is in the table."""
        if not self.ended.setdefault(str(query.runId), threading.Event()).wait(timeout):
            raise TimeoutError(f"the end of query {query.runId} was not reported in {timeout} seconds")

    def table(self) -> DataFrame:
        """All batches written so far."""
        empty = self.spark.createDataFrame([], PROGRESS_SCHEMA)
        try:
            return self.spark.read.schema(PROGRESS_SCHEMA).parquet(self.path)
        except AnalysisException:  # nothing was written yet
            return empty
