"""Exact running totals over a distributed sort, without a one-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import cut_lineage


def _order(column: str, descending: bool) -> Column:
    return F.col(column).desc() if descending else F.col(column).asc()


def _slices(rows: DataFrame, order: str, sums: Sequence[str], by: Sequence[str], descending: bool) -> DataFrame:
    """Rows in range slices, with what each slice needs to know of the others.

    That is the sums of all earlier slices (``_<c>_before``), of the own one
    (``_<c>_here``) and of all, and the first values of the next one (``_<c>_after``).
    Slice bounds are sampled, hence the slices are written once. The facts per slice are a small table: a row
    per slice, and one more per group.
    """
    # No number of slices is given, so that adaptive execution can join small neighbours.
    spread = rows.repartitionByRange(*by, _order(order, descending))
    slices = cut_lineage(spread.withColumn("_slice", F.spark_partition_id()), "slices", folder_per="_slice")

    earlier = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    in_order = Window.partitionBy(*by).orderBy("_slice")
    first_of = F.max_by if descending else F.min_by
    per_slice = slices.groupBy(*by, "_slice").agg(
        *[F.sum(c).alias(f"_{c}_here") for c in sums], *[first_of(c, order).alias(f"_{c}_first") for c in sums]
    )
    offsets = per_slice.select(
        *[F.col(c).alias(f"_by_{c}") for c in by],
        F.col("_slice").alias("_offset_slice"),
        *[f"_{c}_here" for c in sums],
        *[F.coalesce(F.sum(f"_{c}_here").over(earlier), F.lit(0)).alias(f"_{c}_before") for c in sums],
        *[F.sum(f"_{c}_here").over(whole).alias(f"{c}_total") for c in sums],
        *[F.lead(f"_{c}_first").over(in_order).alias(f"_{c}_after") for c in sums],
    )
    same = F.col("_slice") == F.col("_offset_slice")
    for c in by:
        same = same & (F.col(c) == F.col(f"_by_{c}"))
    # Without groups there is exactly a row per slice; with groups the written size decides.
    offsets = cut_lineage(offsets, "offsets") if by else F.broadcast(offsets)
    return slices.join(offsets, same)


def _within_slices(
    slices: DataFrame, columns: Sequence[str], order: str, sums: Sequence[str], by: Sequence[str], descending: bool
) -> DataFrame:
    # by range, not by hash: a hash of the slice numbers would put several slices on one task and none on others
    slices = slices.repartitionByRange("_slice", *by)
    ordered = Window.partitionBy("_slice", *by).orderBy(_order(order, descending))
    inside = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return slices.select(
        *columns,
        *[(F.sum(c).over(inside) + F.col(f"_{c}_before")).alias(f"{c}_upto") for c in sums],
        *[F.col(f"{c}_total") for c in sums],
        *[F.coalesce(F.lead(c).over(ordered), F.col(f"_{c}_after")).alias(f"{c}_next") for c in sums],
    )


def running_totals(
    rows: DataFrame, order: str, sums: Sequence[str], by: Sequence[str] = (), descending: bool = False
) -> DataFrame:
    """Add ``<c>_upto`` (inclusive running sum), ``<c>_total`` and ``<c>_next`` (next row's value) per summed column.

    ``rows`` must hold one row per (by, order) value, i.e. be aggregated already,
    so that no value is heavier than any other and the slices are even. Groups
    must not be null.
    """
    slices = _slices(rows, order, sums, by, descending)
    return _within_slices(slices, rows.columns, order, sums, by, descending)
