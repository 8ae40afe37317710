"""Life cycle of streaming queries by Spark's own events (STR-7..9, SNK-16).

One listener a session hears of every query's start, batches, idleness and end.
Waiting for one of these is a wait on a condition, not a loop over status
texts, and each event can go to the run log.
"""

from __future__ import annotations

import threading
import time
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from tidewater.plans.runlog import RunLog

TARGET = "stream"


@dataclass
class State:
    """What is known of one run of a query."""

    id: str
    name: str | None
    batches: int = 0
    rows: int = 0
    idle: bool = False
    ended: bool = False
    error: str | None = None


class QueryWatch(StreamingQueryListener):
    def __init__(self):
        self.runs: dict[str, State] = {}
        self.logs: dict[str, RunLog] = {}
        self.changed = threading.Condition()

    def log_to(self, name: str, log: RunLog) -> None:
        """Sends the events of the queries named ``name`` to a run log, which the caller flushes."""
        self.logs[name] = log

    def _say(self, s: State, message: str, level: str = "INFO") -> None:
        if s.name in self.logs:
            self.logs[s.name].event("", "", "", TARGET, message, level)

    def _change(self, run: str, say: str, level: str = "INFO", **new) -> None:
        with self.changed:
            s = self._state(run)
            for k, v in new.items():
                setattr(s, k, v)
            self._say(s, say, level)
            self.changed.notify_all()

    def _state(self, run: str) -> State:
        """Of a run; one that started before the listener has no name."""
        return self.runs.setdefault(run, State(run, None))

    def onQueryStarted(self, event) -> None:
        with self.changed:
            s = self.runs[str(event.runId)] = State(str(event.id), event.name)
            self._say(s, "query started")
            self.changed.notify_all()

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if "addBatch" in p.durationMs:  # a batch ran
            s = self._state(str(p.runId))
            self._change(str(p.runId), f"batch {p.batchId} read {p.numInputRows} rows", batches=s.batches + 1, rows=s.rows + p.numInputRows, idle=False)

    def onQueryIdle(self, event) -> None:
        self._change(str(event.runId), "query idle", "DEBUG", idle=True)

    def onQueryTerminated(self, event) -> None:
        failed = event.exception is not None
        self._change(str(event.runId), f"query failed: {event.exception}" if failed else "query ended", "ERROR" if failed else "INFO",
                     ended=True, error=event.exception)

    def wait(self, found, timeout_s: float | None) -> bool:
        """Waits until ``found()`` holds; False when the time is over."""
        with self.changed:
            return self.changed.wait_for(found, timeout_s)


_watches: dict[str, QueryWatch] = {}
_guard = threading.Lock()


def watch(spark: SparkSession) -> QueryWatch:
    """The session's listener; made at the first call."""
    key = f"{spark.sparkContext.applicationId}/{id(spark._jsparkSession)}"
    with _guard:
        if key not in _watches:
            _watches[key] = QueryWatch()
            spark.streams.addListener(_watches[key])
        return _watches[key]


def find_query(spark: SparkSession, name: str, wait_s: float = 300) -> StreamingQuery | None:
    """STR-7: an active query by name, waiting for it to start."""
    w, deadline = watch(spark), time.monotonic() + wait_s

    def active():
        return next((q for q in spark.streams.active if q.name == name), None)
    while (query := active()) is None:
        started = len(w.runs)
        if not w.wait(lambda: len(w.runs) > started, deadline - time.monotonic()):
            return active()
    return query


def stop_when_idle(spark: SparkSession, query: StreamingQuery, timeout_s: float | None = None) -> bool:
    """STR-8 / STR-9: stops a query once Spark reports it idle: nothing to read and no
    batch at work. With ``timeout_s`` it is stopped anyway after that long. True
    when the stop was graceful, also where the query had ended by itself."""
    w, run = watch(spark), str(query.runId)

    def settled() -> bool:
        s = w.runs.get(run)
        return s is not None and (s.idle or s.ended) or not query.isActive
    graceful = w.wait(settled, timeout_s)
    query.stop()
    return graceful
