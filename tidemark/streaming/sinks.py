"""Sinks: one folder per epoch, a latest-wins view, topics and exports."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark import fixed_values as fixed
from tidemark.functions.text import utf8
from tidemark.sources.files import CSV_OPTIONS

ROWS_PER_FILE = 1_000_000
# Texts keep their outer spaces, times their microseconds.
CSV_AS_IT_IS = {
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def epoch_writer(folder: str) -> Callable[[DataFrame, int], None]:
    """Write each non-empty micro-batch to its own epoch folder.

    A replayed epoch overwrites its folder, so a restart adds nothing twice. An
    error fails the query: an epoch must not commit unwritten.
    """

    def write(batch: DataFrame, epoch_id: int) -> None:
        batch = batch.persist()
        try:
            rows = batch.count()
            if rows:
                # One state partition would become one small file each.
                files = batch.coalesce(rows // ROWS_PER_FILE + 1)
                files.write.mode("overwrite").parquet(f"{folder}/epoch_id={epoch_id}")
        finally:
            batch.unpersist()

    return write


def collection_writer(
    collection: str, keys: Sequence[str], fmt: str = "mongodb", **options: str
) -> Callable[[DataFrame, int], None]:
    """The same for a document store: rows carry their epoch, and an id made of it and their keys.

    The store replaces by id, so a replayed epoch adds nothing twice. Needs the store's connector on the class path.
    """
    by_id = {"operationType": "replace", "idFieldList": "_id", "upsertDocument": "true"}

    def write(batch: DataFrame, epoch_id: int) -> None:
        key = F.sha2(F.to_json(F.struct(F.lit(epoch_id).alias("epoch"), *keys), {"ignoreNullFields": "false"}), 256)
        batch = batch.withColumn("epoch_id", F.lit(epoch_id)).withColumn("_id", key).persist()
        try:
            if not batch.isEmpty():
                writer = batch.write.format(fmt).mode("append").option("collection", collection)
                writer.options(**by_id | options).save()
        finally:
            batch.unpersist()

    return write


def latest_view(
    spark: SparkSession, folder: str, keys: Sequence[str], schema: str, may_be_empty: bool = False
) -> DataFrame:
    """Current count per key: update mode emits a key again whenever it changes, the last epoch wins.

    A folder that is not there is an error, unless the sink may have had no rows yet.
    """
    return _history(spark, folder, schema, may_be_empty).groupBy(*keys).agg(F.max_by("count", "epoch_id").alias("count"))


def _history(spark: SparkSession, folder: str, schema: str, may_be_empty: bool) -> DataFrame:
    try:
        return spark.read.schema(f"{schema}, epoch_id bigint").parquet(folder)
    except AnalysisException as error:
        if not may_be_empty or error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"{schema}, epoch_id bigint")


def compact(spark: SparkSession, folder: str, target: str, keys: Sequence[str], schema: str) -> int:
    """Fold all epochs of ``folder`` into one epoch folder of ``target``, numbered as the last of them.

    Only the last count of a key is kept. ``target`` is a new folder, to which the sink writes from then on, so that
    readers of the old one are not disturbed. Returns the number of that epoch.
    """
    history = _history(spark, folder, schema, may_be_empty=False)
    last = history.agg(F.max("epoch_id")).first()[0]
    latest = history.groupBy(*keys).agg(F.max_by("count", "epoch_id").alias("count"))
    columns = [c for c in history.columns if c != "epoch_id"]
    latest.select(*columns).write.mode("overwrite").parquet(f"{target}/epoch_id={last}")
    return last


def publish(
    lines: DataFrame, checkpoint: str, fmt: str = "kafka", trigger: dict | None = None, **options: str
) -> StreamingQuery:
    """Send cleaned lines as UTF-8 bytes to a topic (or, with another format, to files)."""
    if fmt == "kafka":
        options.setdefault("topic", fixed.TOPIC)
    writer = (
        lines.select(utf8(F.col("value")).alias("value"))
        .writeStream.format(fmt)
        .options(**options)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(**trigger) if trigger else writer).start()


def export(rows: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Write a result table; refuses an empty one."""
    # kept while it is looked at and written, so that the rows are computed once
    rows = rows.persist()
    try:
        if rows.isEmpty():
            raise ValueError("no results to export")
        writer = rows.write.mode("overwrite").format(fmt)
        if fmt == "csv":
            writer = writer.options(**CSV_OPTIONS, **CSV_AS_IT_IS)
        writer.save(path)
    finally:
        rows.unpersist()
    return path
