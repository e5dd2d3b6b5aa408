"""Session helpers: the folder every executor can reach, and lineage cuts written to it."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


# Settings the operators are made for. On a cluster add spark.checkpoint.dir and a
# number of shuffle partitions that keeps each below a few hundred MB.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # short Python tasks wait some 40 ms for the acknowledgements of a TCP connection
    "spark.python.unix.domain.socket.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
# Rows that go to Python at once where rows hold whole texts. Both sides hold a few batches per task.
TEXT_ROWS = 500


def build_session(name: str, settings: Mapping[str, str] | None = None) -> SparkSession:
    """A session with ``SETTINGS`` and any further ones."""
    builder = SparkSession.builder.appName(name)
    for key, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder from ``spark.checkpoint.dir``; a temporary one only where Spark runs in one process."""
    context = spark.sparkContext
    configured = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Meanwhile at most ``rows`` rows go to Python at once; a smaller setting stays."""
    before = spark.conf.get(BATCH_ROWS)
    if not 0 < int(before) <= rows:
        spark.conf.set(BATCH_ROWS, str(rows))
    try:
        yield
    finally:
        spark.conf.set(BATCH_ROWS, before)


def cut_texts(df: DataFrame, name: str) -> DataFrame:
    """``cut_lineage`` of what Python makes of whole texts, a few of them at a time."""
    with batches_of(df.sparkSession, TEXT_ROWS):
        return cut_lineage(df, name)


def cut_lineage(df: DataFrame, name: str, folder_per: str | None = None) -> DataFrame:
    """``df`` as a table written to the shared folder, so that lost executors cannot change its rows.

    The planner sees its true size, so a small one is broadcast and a large one is not.
    """
    path = scratch_path(df.sparkSession, name)
    (df.write.partitionBy(folder_per) if folder_per else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
