"""Gaussian kernel densities per feature and class."""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import observed
from tidemark.operators.groups import group_number, group_of, group_values

# Send the functions themselves to the workers, which need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# exp(-z*z/2) is exactly 0 in double precision from here on.
KERNEL_REACH = 38.7


def kernel_sums(values: np.ndarray, counts: np.ndarray, points: np.ndarray, width: float) -> np.ndarray:
    """Sum of counted kernels at each point; only values in reach of a point are visited."""
    order = np.argsort(values)
    scaled, counts, points = values[order] / width, counts[order], points / width
    first = np.searchsorted(scaled, points - KERNEL_REACH)
    last = np.searchsorted(scaled, points + KERNEL_REACH, side="right")
    sums = np.empty(len(points))
    for i, point in enumerate(points):
        z = scaled[first[i] : last[i]] - point
        z *= z
        z *= -0.5
        np.exp(z, out=z)
        sums[i] = np.dot(counts[first[i] : last[i]], z)
    return sums


@dataclass(frozen=True)
class Curve:
    """Grid and bandwidth of a class's feature, and the number of its values."""

    rows: int
    width: float
    start: float
    step: float

    def points(self, grid: int) -> np.ndarray:
        return self.start + np.arange(grid) * self.step


def _curves(rows: DataFrame, features: Sequence[str], number, classes: int, grid: int, cut: float) -> dict[tuple[int, int], Curve]:
    """From one aggregate of the wide rows: a row per class."""
    cells = [(f, observed(F.col(name))) for f, name in enumerate(features)]
    stats = rows.groupBy(number.alias("_g")).agg(
        *[F.count(x).alias(f"n{f}") for f, x in cells],
        *[F.stddev_samp(x).alias(f"d{f}") for f, x in cells],
        *[F.min(x).alias(f"l{f}") for f, x in cells],
        *[F.max(x).alias(f"h{f}") for f, x in cells],
    )
    out = {}
    for r in stats.where(F.col("_g").isNotNull()).collect():
        for f, _ in cells:
            n, deviation = r[f"n{f}"], r[f"d{f}"]
            width = deviation * n**-0.2 if n and deviation else 0.0
            if width > 0:
                low, high = r[f"l{f}"], r[f"h{f}"]
                out[r["_g"], f] = Curve(n, width, low - cut * width, (high - low + 2 * cut * width) / (grid - 1))
    return out


def _partial_sums(curves: dict[tuple[int, int], Curve], grid: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task's kernels, summed at the points of every curve."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {key: np.zeros(grid) for key in curves}
        points = {key: curve.points(grid) for key, curve in curves.items()}
        for batch in batches:
            classes = batch.column(0).to_numpy(zero_copy_only=False)
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns[1:]]
            for (g, f), curve in curves.items():
                values = columns[f][classes == g]
                values, counts = np.unique(values[~np.isnan(values)], return_counts=True)
                sums[g, f] += kernel_sums(values, counts.astype(float), points[g, f], curve.width)
        if sums:
            keys = np.repeat(np.array(list(sums), dtype=np.int32).reshape(-1, 2), grid, axis=0)
            cells = [
                pa.array(keys[:, 0]),
                pa.array(keys[:, 1]),
                pa.array(np.tile(np.arange(grid, dtype=np.int32), len(sums))),
                pa.array(np.concatenate(list(sums.values()))),
            ]
            yield pa.RecordBatch.from_arrays(cells, ["_g", "_f", "point", "mass"])

    return run


def class_density(
    rows: DataFrame, features: Sequence[str], label: str, grid: int = 200, cut: float = 3.0
) -> DataFrame:
    """Density on ``grid`` points from ``cut`` bandwidths below the least to above the greatest value.

    Bandwidth is the sample deviation times n^(-1/5). The rows are read twice and never move: once for one row of
    statistics per class, once for the kernels, of which each task sends a number per class, feature and point. As
    bandwidth shrinks with n, large tables visit few points per value. Features that are constant in a class have no
    density there.
    """
    classes = group_values(rows, label)
    number = group_number(rows, label, classes)
    curves = _curves(rows, features, number, len(classes), grid, cut)
    wide = rows.select(number.alias("_g"), *[observed(F.col(f)).alias(f"_x{i}") for i, f in enumerate(features)])
    mass = (
        wide.where(F.col("_g").isNotNull())
        .mapInArrow(_partial_sums(curves, grid), "_g int, _f int, point int, mass double")
        .groupBy("_g", "_f", "point")
        .agg(F.sum("mass").alias("mass"))
    )
    facts = pd.DataFrame([(g, f, c.rows, c.width, c.start, c.step) for (g, f), c in curves.items()])
    schema = "_g int, _f int, rows bigint, width double, start double, step double"
    spark = rows.sparkSession
    known = spark.createDataFrame(facts, schema) if curves else spark.createDataFrame([], schema)
    density = F.col("mass") / (F.col("rows") * F.col("width") * math.sqrt(2 * math.pi))
    return mass.join(F.broadcast(known), ["_g", "_f"]).select(
        F.get(F.array(*[F.lit(f) for f in features]), F.col("_f")).alias("feature"),
        group_of(rows, label, classes, F.col("_g")).alias(label),
        "point",
        (F.col("start") + F.col("point") * F.col("step")).alias("at_value"),
        density.alias("density"),
    )
