"""Start, await and stop the named streaming queries."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.log_metrics import LOG_METRICS
from tidemark.streaming.sinks import epoch_writer


def start(
    aggregates: Mapping[str, DataFrame],
    sink_folder: str,
    checkpoint_folder: str,
    trigger: dict | None = None,
    writer: Callable[[str], Callable[[DataFrame, int], None]] | None = None,
) -> list[StreamingQuery]:
    """One query in update mode per named aggregate, each with its own checkpoint."""
    writer = writer or (lambda name: epoch_writer(f"{sink_folder}/{name}"))
    started = []
    try:
        for name, aggregate in aggregates.items():
            stream = (
                aggregate.writeStream.queryName(name)
                .outputMode("update")
                .option("checkpointLocation", f"{checkpoint_folder}/{name}")
                .foreachBatch(writer(name))
            )
            started.append((stream.trigger(**trigger) if trigger else stream).start())
    except BaseException:
        # all of them run, or none
        stop(started)
        raise
    return started


def start_log_metrics(
    parsed: DataFrame, sink_folder: str, checkpoint_folder: str, trigger: dict | None = None
) -> list[StreamingQuery]:
    """The four log aggregates with their default windows and thresholds."""
    aggregates = {name: metric(parsed) for name, metric in LOG_METRICS.items()}
    return start(aggregates, sink_folder, checkpoint_folder, trigger)


def await_all(queries: list[StreamingQuery]) -> None:
    """Wait for queries that end by themselves; the first failure is raised and stops the others."""
    try:
        for query in queries:
            query.awaitTermination()
    finally:
        stop(queries)


def run_until_stopped(queries: list[StreamingQuery], poll_seconds: float = 1) -> None:
    """Run until any of these queries ends, fails or the user interrupts; then stop them all.

    Queries that ended earlier in the same session do not count. A failure is raised.
    """
    try:
        while all(query.isActive for query in queries):
            queries[0].awaitTermination(poll_seconds)
        for query in queries:
            if not query.isActive:
                query.awaitTermination()
    except KeyboardInterrupt:
        pass
    finally:
        stop(queries)


def stop(queries: list[StreamingQuery]) -> None:
    for query in queries:
        if query.isActive:
            query.stop()
