"""What streams report about themselves, as a metric table."""

from __future__ import annotations

import json
import threading
from types import TracebackType

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.streaming.query import StreamingQuery

COLUMNS = "run_id STRING, batch_id BIGINT, at STRING, input_rows BIGINT, trigger_ms DOUBLE, newest STRING, watermark STRING, dropped_rows BIGINT"


class ProgressLog(StreamingQueryListener):
    """Keeps the progress of every batch of every stream of a session, while it is open.

    ``recentProgress`` of a query has the last batches of that query only, and is gone with it. Use it as a context; each
    batch is one small row, and :meth:`flush` moves the rows held so far to a folder.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.rows = spark, []
        self.ended: dict[str, threading.Event] = {}
        self.lock = threading.Lock()

    def __enter__(self) -> ProgressLog:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, kind: type | None, value: BaseException | None, trace: TracebackType | None) -> None:
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = json.loads(event.progress.json)
        times = p.get("eventTime") or {}
        dropped = sum(s.get("numRowsDroppedByWatermark", 0) for s in p.get("stateOperators", []))
        took = float(p["durationMs"].get("triggerExecution", 0))
        with self.lock:
            self.rows.append((p["runId"], p["batchId"], p["timestamp"], p["numInputRows"], took, times.get("max"), times.get("watermark"), dropped))

    def onQueryTerminated(self, event) -> None:
        self._end(str(event.runId)).set()

    def _end(self, run_id: str) -> threading.Event:
        with self.lock:
            return self.ended.setdefault(run_id, threading.Event())

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Until the query has ended and all that it reported has arrived, as listeners are told later."""
        query.awaitTermination()
        self._end(str(query.runId)).wait(seconds)

    def table(self) -> DataFrame:
        """One row per batch: when it ran, its rows and duration, its newest event, the watermark, and rows that came behind it."""
        with self.lock:
            rows = list(self.rows)
        times = {c: F.to_timestamp(c) for c in ("at", "newest", "watermark")}
        return self.spark.createDataFrame(rows, COLUMNS).withColumns(times)

    def flush(self, path: str) -> None:
        """Append what is held to a folder and let go of it."""
        self.table().coalesce(1).write.mode("append").parquet(path)
        with self.lock:
            self.rows.clear()


def lag_behind(progress: DataFrame, head: DataFrame, ts: str) -> DataFrame:
    """How far the newest event read lies behind the newest one there is, per batch with rows, as input of the lag alarms.

    ``head`` is the table that the producer writes; ``at`` becomes the time of the newest event read.
    """
    newest = head.agg(F.max(F.col(ts).cast("timestamp"))).scalar()
    lag = F.unix_millis(newest) - F.unix_millis("newest")
    return progress.filter(F.col("newest").isNotNull()).select("run_id", "batch_id", "input_rows", F.col("newest").alias("at"), lag.alias("lag_ms"))
