"""What becomes of running queries: rows dropped behind the watermark, and failures, by query name."""

from __future__ import annotations

import threading
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


class Watch(StreamingQueryListener):
    """Counts per query: source rows, rows dropped by stateful operators, epochs; and the error of a query that failed.

    Dropped rows are counted where the state is: a windowed count drops groups of late rows, one per key and window of a
    batch. Listeners hear of an epoch some time after it; ``settled`` waits for the end of given queries.
    """

    def __init__(self):
        self._names: dict[str, str | None] = {}
        self._lock = threading.Condition()
        self.rows: dict[str, int] = defaultdict(int)
        self.dropped: dict[str, int] = defaultdict(int)
        self.epochs: dict[str, int] = defaultdict(int)
        self.errors: dict[str, str] = {}
        self._ended: set[str] = set()

    def onQueryStarted(self, event) -> None:
        with self._lock:
            self._names[str(event.runId)] = event.name

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        with self._lock:
            self.rows[progress.name] += progress.numInputRows
            self.dropped[progress.name] += sum(s.numRowsDroppedByWatermark for s in progress.stateOperators)
            self.epochs[progress.name] += 1

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            run = str(event.runId)
            if event.exception:
                self.errors[self._names.get(run) or run] = event.exception
            self._ended.add(run)
            self._lock.notify_all()

    def settled(self, queries: list[StreamingQuery], seconds: float = 60) -> Watch:
        """Wait until the end of these queries was heard of."""
        runs = {str(q.runId) for q in queries}
        with self._lock:
            if not self._lock.wait_for(lambda: runs <= self._ended, seconds):
                raise TimeoutError(f"no end of {len(runs - self._ended)} queries heard of in {seconds} s")
        return self


def state_counts(spark: SparkSession, checkpoint: str, operator: int = 0) -> DataFrame:
    """Keys and counts that a counting query holds in its state, as of its last committed epoch."""
    state = spark.read.format("statestore").option("operatorId", operator).load(checkpoint)
    return state.select("key.*", state["value.count"].alias("count"))
