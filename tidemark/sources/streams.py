"""Streams of log lines, always as a text column ``value``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark import fixed_values as fixed
from tidemark.operators.logs import decode


def topic_lines(spark: SparkSession, servers: str, topic: str = fixed.TOPIC, **options: str) -> DataFrame:
    """Lines from a topic, from its end on the first start. Needs the Kafka connector on the class path."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    return decode(reader.options(**options).load().select("value"))


def folder_lines(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """Lines of the text files that appear in a folder; a rotated log is just a new file."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(folder)


def table_stream(spark: SparkSession, folder: str, schema: str, files_per_batch: int | None = None) -> DataFrame:
    """Rows of the Parquet files that appear in a folder."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)
