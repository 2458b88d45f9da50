"""Query listeners that keep progress and observed metrics as JSON lines in a table folder."""

from __future__ import annotations

import datetime as dt
import json
import threading

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from parley.schemas import OBSERVED_LOG


class ProgressLog(StreamingQueryListener):
    """Buffers events and appends them as text lines.

    Lines are written when ``rollover`` has passed since the last write and
    when a query ends, never on query start, which would hold up the query.
    """

    def __init__(self, spark: SparkSession, folder: str, rollover: dt.timedelta = dt.timedelta(minutes=5)):
        self._spark = spark
        self._folder = folder
        self._rollover = rollover
        self._lines: list[str] = []
        self._written = dt.datetime.now(dt.timezone.utc)
        self._lock = threading.Lock()
        self._ended: dict[str, threading.Event] = {}

    def _add(self, status: str, **fields) -> None:
        now = dt.datetime.now(dt.timezone.utc).isoformat()
        with self._lock:
            self._lines.append(json.dumps({"EVENT_TIME": now, "STATUS": status, **fields}))

    def flush(self) -> None:
        """Append the buffered lines; they stay in the buffer if that fails."""
        with self._lock:
            if self._lines:
                rows = [(line,) for line in self._lines]
                self._spark.createDataFrame(rows, "value string").coalesce(1).write.mode("append").text(self._folder)
                self._lines.clear()
            self._written = dt.datetime.now(dt.timezone.utc)

    def onQueryStarted(self, event) -> None:
        self._add("STREAM_STARTED", STREAM_ID=str(event.id), RUN_ID=str(event.runId), STREAM_NAME=event.name)

    def onQueryProgress(self, event) -> None:
        self._add("STREAM_UPDATED", BATCH_INFO=event.progress.json)
        if dt.datetime.now(dt.timezone.utc) - self._written >= self._rollover:
            self.flush()

    def onQueryIdle(self, event) -> None:
        if dt.datetime.now(dt.timezone.utc) - self._written >= self._rollover:
            self.flush()

    def onQueryTerminated(self, event) -> None:
        self._add(
            "STREAM_TERMINATED",
            STREAM_ID=str(event.id), RUN_ID=str(event.runId), TERMINATION_EXCEPTION=event.exception,
        )
        self.flush()
        self._end_of(str(event.runId)).set()

    def _end_of(self, run_id: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run_id, threading.Event())

    def wait_for_end(self, run_id, seconds: float = 60.0) -> bool:
        """Wait until the run's end is in the folder; events arrive some time after the query's end."""
        return self._end_of(str(run_id)).wait(seconds)


class ObservedLog(ProgressLog):
    """Keeps the observed metrics of every batch: a query's own reports are the last hundred only.

    One line per query, batch and metric name. Lines are appended, at the latest at the query's end; a batch
    that runs again after a restart appends again, and :func:`read_observed` counts it once.
    """

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        ident = {"query_id": str(progress.id), "run_id": str(progress.runId), "batch_id": progress.batchId}
        for name, figures in progress.observedMetrics.items():
            told = {k: None if v is None else str(v) for k, v in figures.asDict().items()}
            with self._lock:
                self._lines.append(json.dumps({**ident, "name": name, "time": progress.timestamp, "metrics": told}))
        if dt.datetime.now(dt.timezone.utc) - self._written >= self._rollover:
            self.flush()

    def onQueryTerminated(self, event) -> None:
        self.flush()
        self._end_of(str(event.runId)).set()


def read_observed(spark: SparkSession, folder: str) -> DataFrame:
    """``query_id, batch_id, name, run_id, time, metrics``: the metrics of every batch, as it ran last.

    Appends that were repeated, and batches replayed by a later run, count once.
    """
    lines = spark.read.schema(OBSERVED_LOG).json(folder)
    ident = ["query_id", "batch_id", "name"]
    newest = F.max_by(F.struct("run_id", "time", "metrics"), F.struct("time", "run_id"))
    return lines.groupBy(*ident).agg(newest.alias("last")).select(*ident, "last.*")


def missing_batches(observed: DataFrame) -> DataFrame:
    """``query_id, name, after, before``: gaps between the batches of a query, such as a lost listener leaves."""
    # One row per batch and metric of a query, a number that grows with time and not with data.
    order = Window.partitionBy("query_id", "name").orderBy("batch_id")
    gaps = observed.withColumn("after", F.lag("batch_id").over(order))
    return gaps.where(F.col("batch_id") > F.col("after") + 1).select("query_id", "name", "after", F.col("batch_id").alias("before"))
