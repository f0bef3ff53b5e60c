"""Timed runs of a streaming query that end between micro-batches."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener


class BatchLog(StreamingQueryListener):
    """The micro-batches of queries as Spark reports them: query id -> {batch id: rows}."""

    def __init__(self):
        self.batches: dict[str, dict[int, int]] = {}
        self.changed = threading.Condition()

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        with self.changed:
            if p.numInputRows:
                self.batches.setdefault(str(p.id), {})[p.batchId] = p.numInputRows
            self.changed.notify_all()

    def onQueryIdle(self, event):
        with self.changed:
            self.changed.notify_all()

    def onQueryTerminated(self, event):
        with self.changed:
            self.changed.notify_all()


@dataclass
class TimedRun:
    rows: int                                   # messages read
    batches: dict[int, int] = field(default_factory=dict)  # batch id -> messages
    ended: str = "deadline"                     # or "idle", or "terminated"


def run_timed(spark: SparkSession, start: Callable[[], StreamingQuery], seconds: float,
              idle_seconds: float | None = None) -> TimedRun:
    """Start a query and stop it at the deadline, or once it had nothing to read for ``idle_seconds``.

    The stop waits for the running micro-batch, so no batch is cut.  The counts are the listener's.
    """
    log = BatchLog()
    spark.streams.addListener(log)
    try:
        query = start()
        deadline, seen, since, ended = time.monotonic() + seconds, 0, time.monotonic(), "deadline"
        while query.isActive:
            with log.changed:
                log.changed.wait(0.1)
                done = len(log.batches.get(str(query.id), {}))
            now = time.monotonic()
            busy = query.status["isTriggerActive"]
            if done != seen or busy:
                seen, since = done, now
            if now >= deadline or (idle_seconds is not None and seen and now - since >= idle_seconds):
                ended = "deadline" if now >= deadline else "idle"
                if not busy:
                    break
        else:
            ended = "terminated"
        query.stop()
        if query.exception() is not None:
            raise query.exception()
        _settle(log, query)
        batches = dict(sorted(log.batches.get(str(query.id), {}).items()))
        return TimedRun(sum(batches.values()), batches, ended)
    finally:
        spark.streams.removeListener(log)


def _settle(log: BatchLog, query: StreamingQuery, wait: float = 5.0) -> None:
    """Progress events arrive after their batch: wait for those that the query itself knows."""
    want = {p["batchId"] for p in query.recentProgress if p["numInputRows"]}
    end = time.monotonic() + wait
    with log.changed:
        while not want <= set(log.batches.get(str(query.id), {})) and time.monotonic() < end:
            log.changed.wait(0.1)
