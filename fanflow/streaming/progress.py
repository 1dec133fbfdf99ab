"""Progress of replication streams as a relation: when they last polled and replicated, how long their batches took."""

from __future__ import annotations

import threading
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from fanflow.operators import cursors

_SCHEMA = "query string, started_at timestamp, last_poll_at timestamp, last_replicated_at timestamp, batches bigint, last_batch_seconds double, longest_batch_seconds double, ended boolean, error string"


@dataclass
class _State:
    started_at: datetime
    last_poll_at: datetime | None = None
    last_replicated_at: datetime | None = None
    batches: int = 0
    last_batch_seconds: float | None = None
    longest_batch_seconds: float | None = None
    ended: bool = False
    error: str | None = None


def _time(text: str) -> datetime:
    return datetime.fromisoformat(text.replace("Z", "+00:00"))


class Progress(StreamingQueryListener):
    """Keeps a row for each streaming query of the session (spark.streams.addListener(progress)).

    A trigger without new snapshots is a poll, one that takes some a replication too; a started query has polled once.
    """

    def __init__(self) -> None:
        self._lock, self._states = threading.Lock(), {}

    def onQueryStarted(self, event) -> None:  # noqa: N802
        at = _time(event.timestamp)
        with self._lock:
            self._states[str(event.runId)] = _State(at, at)

    def _polled(self, run: str, at: datetime) -> _State:
        state = self._states.setdefault(run, _State(at))
        state.last_poll_at = max(at, state.last_poll_at or at)
        return state

    def onQueryIdle(self, event) -> None:  # noqa: N802
        with self._lock:
            self._polled(str(event.runId), _time(event.timestamp))

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        with self._lock:
            state = self._polled(str(p.runId), _time(p.timestamp))
            state.last_batch_seconds = p.batchDuration / 1000
            state.longest_batch_seconds = max(state.last_batch_seconds, state.longest_batch_seconds or 0.0)
            if any(s.startOffset != s.endOffset for s in p.sources):
                state.last_replicated_at, state.batches = state.last_poll_at, state.batches + 1

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        with self._lock:
            if state := self._states.get(str(event.runId)):
                state.ended, state.error = True, event.exception

    def relation(self, spark: SparkSession) -> DataFrame:
        """A row for each query that was started since the listener was added."""
        with self._lock:
            rows = [(run, *vars(s).values()) for run, s in self._states.items()]
        return spark.createDataFrame(rows, _SCHEMA)

    def health(self, spark: SparkSession, now=None) -> DataFrame:
        """relation() with alive and ready by the ages of the last poll and replication; an ended query is neither."""
        aged = cursors.health(self.relation(spark), F.current_timestamp() if now is None else now)
        return aged.withColumns({c: F.col(c) & ~F.col("ended") for c in ("alive", "ready")})
