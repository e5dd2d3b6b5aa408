"""Pearson correlations of many column pairs in one pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import observed


def correlation(x: str, y: str) -> Column:
    """Pearson's r over the rows where both are present; null when either is constant, where ``corr`` would fail."""
    x_pair = F.when(F.col(y).isNotNull(), F.col(x))
    y_pair = F.when(F.col(x).isNotNull(), F.col(y))
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x_pair) * F.stddev_pop(y_pair))


def pair_correlations(rows: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """(pair, corr) with ``pair`` counting through ``pairs``.

    Each row gives one short row per pair, merged at once by the partial aggregate.
    One aggregate per pair would make a row buffer too wide to compile from some
    dozen pairs on.
    """
    names = list(dict.fromkeys(name for pair in pairs for name in pair))
    values = rows.select(*[observed(F.col(c)).alias(f"c{i}") for i, c in enumerate(names)])
    cells = [
        F.struct(
            F.lit(k).alias("pair"), F.col(f"c{names.index(x)}").alias("x"), F.col(f"c{names.index(y)}").alias("y")
        )
        for k, (x, y) in enumerate(pairs)
    ]
    return values.select(F.inline(F.array(*cells))).groupBy("pair").agg(correlation("x", "y").alias("corr"))
