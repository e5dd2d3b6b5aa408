"""Small sets of groups, such as the classes of a label, known to the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Per-group statistics are kept for this many groups at most; a column with more is no label.
MOST_GROUPS = 1024


def group_values(rows: DataFrame, by: str, most: int = MOST_GROUPS) -> list:
    """The distinct present values of a column, sorted; more than ``most`` are an error."""
    found = rows.select(by).where(F.col(by).isNotNull()).distinct().limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"column {by!r} has more than {most} values; it is not a label")
    return sorted(r[0] for r in found)


def group_number(rows: DataFrame, by: str, values: Sequence) -> Column:
    """Place of the row's group in ``values``; null for other values."""
    listed = F.array(*[F.lit(v) for v in values]).cast(f"array<{dict(rows.dtypes)[by]}>")
    return (F.nullif(F.array_position(listed, F.col(by)), F.lit(0)) - 1).cast("int")


def group_of(rows: DataFrame, by: str, values: Sequence, number: Column) -> Column:
    """The value at a place, in the column's type."""
    return F.get(F.array(*[F.lit(v) for v in values]).cast(f"array<{dict(rows.dtypes)[by]}>"), number)
