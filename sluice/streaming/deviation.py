"""Deviation from the preceding hour, and alerts, for streams.

A stream cannot use a moving frame of rows. Rows are scored once the watermark has passed them, by the table form over
these rows and the hour before, so late rows within the delay count as they do in the table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from sluice.streaming.closed import OWN, closed_batches
from sluice.streaming.sinks import write_batch
from sluice.streaming.windows import alerts, hourly_deviation


def score_stream(
    events: DataFrame,
    store: str,
    out: str,
    checkpoint: str,
    limit: float = 3.0,
    delay_seconds: int = 5,
    every: str | None = None,
    shape: Callable[[DataFrame], DataFrame] = lambda scored: scored,
) -> StreamingQuery:
    """Write every event with its score (all columns stay) to ``out``, one folder per batch."""

    def work(rows: DataFrame, batch_id: int) -> None:
        scored = hourly_deviation(rows, limit=limit).filter(OWN).drop(OWN)
        write_batch(shape(scored), out, batch_id)

    return closed_batches(events, "timestamp", store, work, checkpoint, delay_seconds, lookback_seconds=3600, every=every)


def alert_stream(events: DataFrame, store: str, out: str, checkpoint: str, limit: float = 3.0, delay_seconds: int = 5, every: str | None = None) -> StreamingQuery:
    """Write the alerts only."""
    return score_stream(events, store, out, checkpoint, limit, delay_seconds, every, alerts)


def path_stream(
    events: DataFrame, store: str, out: str, checkpoint: str, paths: Callable[[DataFrame], DataFrame], minutes: int = 30, delay_seconds: int = 5, every: str | None = None
) -> StreamingQuery:
    """Write the paths of all windows that have ended; ``paths`` is the table form."""

    def work(rows: DataFrame, batch_id: int) -> None:
        write_batch(paths(rows.filter(F.col(OWN)).drop(OWN)), out, batch_id)

    return closed_batches(events, "timestamp", store, work, checkpoint, delay_seconds, 60 * minutes, every=every)
