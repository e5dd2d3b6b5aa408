"""Cleaning, classifying and parsing of log lines. Batch and stream alike."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import logline, text


def decode(messages: DataFrame, value: str = "value") -> DataFrame:
    """Message bytes as text."""
    return messages.withColumn(value, F.col(value).cast("string"))


def clean(rows: DataFrame, value: str = "value") -> DataFrame:
    """Strip each line and drop the blank ones."""
    return rows.withColumn(value, text.strip(F.col(value))).filter(F.col(value) != "")


def classify(rows: DataFrame, value: str = "value") -> DataFrame:
    """Add format check, status, severity band and preview of each line."""
    line = F.col(value)
    return rows.select(
        "*",
        logline.is_access_line(line).alias("is_access"),
        logline.status_after_request(line).alias("line_status"),
        logline.severity(line).alias("band"),
        text.preview(line).alias("preview"),
    )


def parse(rows: DataFrame, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Fields of each line: ip, timestamp, method, url, protocol, status, size."""
    line = F.col(value)
    parts = logline.tokens(line)
    return rows.select(
        *keep,
        logline.client(parts).alias("ip"),
        logline.event_time(line).alias("timestamp"),
        logline.verb(line).alias("method"),
        logline.url(line).alias("url"),
        logline.protocol(line).alias("protocol"),
        logline.status_token(parts).alias("status"),
        logline.size_token(parts).alias("size"),
    )
