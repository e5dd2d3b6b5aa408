"""The four log aggregates. On a batch table the watermark has no effect, so one function serves both.

Each is a partial count before the shuffle: a key that holds a third of all rows
arrives as one row per input task and window.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import fixed_values as fixed
from tidemark.functions import logline
from tidemark.functions.numbers import utc
from tidemark.operators.common import computed_once


def windowed_count(rows: DataFrame, key: str, width: str, watermark: str) -> DataFrame:
    return (
        rows.withWatermark("timestamp", watermark)
        .groupBy(F.window("timestamp", width), key)
        .count()
    )


def status_counts(parsed: DataFrame) -> DataFrame:
    """Lines per status, since ever. State grows with the number of statuses only."""
    return parsed.groupBy("status").count()


def error_trends(
    parsed: DataFrame, width: str = fixed.ERROR_WINDOW, watermark: str = fixed.ERROR_WATERMARK
) -> DataFrame:
    """Error lines per window and status. Only error lines move the watermark."""
    errors = parsed.filter(F.col("status").isin(*fixed.ERROR_STATUSES))
    return windowed_count(computed_once(errors, "timestamp", "status"), "status", width, watermark)


def popular_products(
    parsed: DataFrame,
    width: str = fixed.PRODUCT_WINDOW,
    watermark: str = fixed.PRODUCT_WATERMARK,
    threshold: int = fixed.PRODUCT_THRESHOLD,
) -> DataFrame:
    """Products requested more than ``threshold`` times in a window."""
    with_id = parsed.withColumn("product_id", logline.product_id(F.col("url")))
    products = computed_once(with_id, "timestamp", "product_id").filter(F.col("product_id") != "")
    return windowed_count(products, "product_id", width, watermark).filter(F.col("count") > threshold)


def suspicious_ips(
    parsed: DataFrame,
    width: str = fixed.CLIENT_WINDOW,
    watermark: str = fixed.CLIENT_WATERMARK,
    threshold: int = fixed.CLIENT_THRESHOLD,
) -> DataFrame:
    """Clients with more than ``threshold`` requests in a window."""
    requests = computed_once(parsed, "timestamp", "ip")
    return windowed_count(requests, "ip", width, watermark).filter(F.col("count") > threshold)


LOG_METRICS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "status_counts": status_counts,
    "error_trends": error_trends,
    "popular_products": popular_products,
    "suspicious_ips": suspicious_ips,
}


def flat_window(counts: DataFrame) -> DataFrame:
    """Replace the window struct by its bounds in UTC."""
    others = [c for c in counts.columns if c != "window"]
    return counts.select(
        utc(F.col("window.start")).alias("window_start"), utc(F.col("window.end")).alias("window_end"), *others
    )
