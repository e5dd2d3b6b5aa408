"""Batch tables from files or object stores; every path Spark can open is fine."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tidemark import fixed_values as fixed

FORMATS = ("csv", "json", "parquet", "orc")


# Quotes inside quoted fields are doubled; a broken field is an error.
CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"'}


def read_csv(
    spark: SparkSession, path: str, schema: StructType | str | None = None, multi_line: bool = False
) -> DataFrame:
    """CSV with a header. Without a schema the types are inferred, at the price of a second pass.

    A cell that does not fit its type, or a row with too few or too many cells, fails the read. Line breaks in quoted
    fields need ``multi_line``, which reads each file in one task; without it a row broken by them fails.
    """
    reader = spark.read.options(**CSV_OPTIONS).option("mode", "FAILFAST").option("multiLine", multi_line)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    # Check names against the header, so that a reordered file fails instead of mixing columns.
    return reader.schema(schema).option("enforceSchema", False).csv(path)


def read_table(
    spark: SparkSession, path: str, schema: StructType | str | None = None, fmt: str | None = None
) -> DataFrame:
    """Table in the format named, or else given by the path's ending."""
    fmt = fmt or path.rstrip("/").rsplit(".", 1)[-1].lower()
    if fmt not in FORMATS:
        raise ValueError(f"no reader for {path!r}: expected one of {', '.join(FORMATS)}")
    if fmt == "csv":
        return read_csv(spark, path, schema)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.format(fmt).load(path)


def require_columns(rows: DataFrame, names: Iterable[str] = fixed.LEARNING_COLUMNS) -> DataFrame:
    """The table itself if it has all the columns; otherwise an error, before any job runs."""
    absent = [n for n in names if n not in rows.columns]
    if absent:
        raise ValueError(f"missing columns: {', '.join(absent)}")
    return rows


def records(spark: SparkSession, rows: list[tuple], schema: StructType | str) -> DataFrame:
    """A small literal table."""
    return spark.createDataFrame(rows, schema)
