"""Sessions as custom keyed state with event-time timers.

``streaming.windows.sessions`` does the same with Spark's session window and is the first
choice. This form shows how to keep own state per key, and can be extended with logic a
window cannot express.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

OPEN = "start_us BIGINT, last_us BIGINT, n BIGINT, cents BIGINT, types STRING"
OUT = (
    "user_id BIGINT, session_start TIMESTAMP, session_end TIMESTAMP, duration_minutes DOUBLE, "
    "event_count BIGINT, total_value DOUBLE, event_types STRING"
)


def merge(sessions: list[tuple], gap_us: int) -> list[tuple]:
    """Join sessions that lie at most a gap apart."""
    out: list[tuple] = []
    for start, last, n, cents, types in sorted(sessions):
        if out and start - out[-1][1] <= gap_us:
            a = out[-1]
            kinds = ",".join(sorted(set(a[4].split(",")) | set(types.split(","))))
            out[-1] = (a[0], max(a[1], last), a[2] + n, a[3] + cents, kinds)
        else:
            out.append((start, last, n, cents, types))
    return out


def runs(events: pd.DataFrame, gap_us: int) -> list[tuple]:
    """The sessions within one batch of a user's events."""
    ordered = events.sort_values("us")
    run = (ordered["us"].diff() > gap_us).cumsum()
    grouped = ordered.groupby(run)
    return list(
        zip(
            grouped["us"].min().tolist(),
            grouped["us"].max().tolist(),
            grouped.size().tolist(),
            grouped["cents"].sum().tolist(),
            grouped["event_type"].agg(lambda s: ",".join(sorted(set(s)))).tolist(),
        )
    )


class SessionState(StatefulProcessor):
    """Holds the open sessions of a user; a timer per session end emits it."""

    def __init__(self, gap_us: int = 1_800_000_000):
        self.gap_us = gap_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getListState("open", OPEN)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        known = [tuple(s) for s in self.open.get()] if self.open.exists() else []
        for batch in rows:
            known += runs(batch, self.gap_us)
        self._keep(merge(known, self.gap_us))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now_us = expiredTimerInfo.getExpiryTimeInMs() * 1000
        known = [tuple(s) for s in self.open.get()] if self.open.exists() else []
        done = [s for s in known if s[1] + self.gap_us <= now_us]
        self._keep([s for s in known if s[1] + self.gap_us > now_us])
        if done:
            yield self._rows(key[0], done)

    def close(self) -> None:
        pass

    def _keep(self, sessions: list[tuple]) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if not sessions:
            self.open.clear()
            return
        self.open.put(sessions)
        for session in sessions:
            self.handle.registerTimer(-(-(session[1] + self.gap_us) // 1000))

    def _rows(self, user: int, sessions: list[tuple]) -> pd.DataFrame:
        ends = [s[1] + self.gap_us for s in sessions]
        return pd.DataFrame(
            {
                "user_id": [user] * len(sessions),
                "session_start": pd.to_datetime([s[0] for s in sessions], unit="us"),
                "session_end": pd.to_datetime(ends, unit="us"),
                "duration_minutes": [(e - s[0]) / 60_000_000 for s, e in zip(sessions, ends)],
                "event_count": [s[2] for s in sessions],
                "total_value": [s[3] / 100 for s in sessions],
                "event_types": [s[4] for s in sessions],
            }
        )


def stateful_sessions(events: DataFrame, ts: str = "timestamp", value: str = "amount", gap_seconds: int = 1800) -> DataFrame:
    """Sessions of a watermarked stream. The session must use the RocksDB state store."""
    slim = events.select(
        "user_id", ts, "event_type",
        F.unix_micros(ts).alias("us"),
        F.round(F.col(value) * 100).cast("bigint").alias("cents"),
    )
    return slim.groupBy("user_id").transformWithStateInPandas(
        statefulProcessor=SessionState(gap_seconds * 1_000_000),
        outputStructType=OUT,
        outputMode="Append",
        timeMode="EventTime",
    )


# Fixed value: the state store that timers and list state need.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    )
}
