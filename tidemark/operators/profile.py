"""Table profiling. Each summary is one pass over the table, whatever the number of features."""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import fixed_values as fixed
from tidemark.functions.numbers import min_max, observed
from tidemark.operators.correlate import pair_correlations
from tidemark.operators.groups import group_values
from tidemark.operators.quantiles import exact_quantiles

# A class of ``class_proportions`` is a column of its result.
MOST_CLASSES = 256


def _long(one_row: DataFrame, names: Sequence[str], key: str, value: str) -> DataFrame:
    """A one-row table as (key, value) rows."""
    return one_row.unpivot([], list(names), key, value)


def shape(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(rows.columns)))


def _is_missing(rows: DataFrame, name: str) -> Column:
    """Null, or NaN in a float column."""
    floating = dict(rows.dtypes)[name] in ("float", "double")
    return F.col(name).isNull() | F.isnan(name) if floating else F.col(name).isNull()


def null_counts(rows: DataFrame) -> DataFrame:
    """Missing values per column and in total (``column_name`` = ``(all)``)."""
    each = rows.agg(*[F.count_if(_is_missing(rows, c)).alias(c) for c in rows.columns])
    total = sum((F.col(c) for c in rows.columns), F.lit(0).cast("bigint"))
    return _long(each.withColumn("(all)", total), [*rows.columns, "(all)"], "column_name", "n_null")


def table_info(rows: DataFrame) -> DataFrame:
    """Type and number of present values per column."""
    each = rows.agg(*[F.count_if(~_is_missing(rows, c)).alias(c) for c in rows.columns])
    types = F.create_map(*[F.lit(x) for pair in rows.dtypes for x in pair])
    long = _long(each, rows.columns, "column_name", "n_present")
    return long.select("column_name", types[F.col("column_name")].alias("data_type"), "n_present")


def head(rows: DataFrame, key: str, n: int = 5) -> DataFrame:
    return rows.orderBy(key).limit(n)


def tail(rows: DataFrame, key: str, n: int = 100) -> DataFrame:
    return rows.orderBy(F.col(key).desc()).limit(n)


def _name(place: Column, names: Sequence[str]) -> Column:
    return F.get(F.array(*[F.lit(n) for n in names]), place)


def target_correlation(rows: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Correlation of each feature with the target, signed and absolute."""
    each = pair_correlations(rows, [(f, target) for f in features])
    return each.select(_name(F.col("pair"), features).alias("feature"), "corr", F.abs("corr").alias("abs_corr"))


def top_features(correlations: DataFrame, n: int = fixed.TOP_FEATURES) -> DataFrame:
    """The n strongest features; equal strength in order of name."""
    return correlations.orderBy(F.col("abs_corr").desc_nulls_last(), "feature").limit(n)


def selected_features(correlations: DataFrame, threshold: float = fixed.CORRELATION_THRESHOLD) -> DataFrame:
    """Features strictly above the threshold."""
    return correlations.filter(F.col("abs_corr") > threshold)


def feature_list(correlations: DataFrame) -> list[str]:
    """Feature names, strongest first. One row per column of the table, so small enough for the driver."""
    ranked = correlations.orderBy(F.col("abs_corr").desc_nulls_last(), "feature")
    return [row.feature for row in ranked.select("feature").collect()]


def correlation_matrix(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Lower triangle with diagonal, as (row, column, corr) with positions i >= j."""
    cells = [(i, j) for i in range(len(columns)) for j in range(i + 1)]
    each = pair_correlations(rows, [(columns[i], columns[j]) for i, j in cells])
    i, j = (F.get(F.array(*[F.lit(cell[k]) for cell in cells]), F.col("pair")) for k in (0, 1))
    return each.select(
        i.alias("i"), j.alias("j"), _name(i, columns).alias("row_name"), _name(j, columns).alias("col_name"), "corr"
    )


def long_features(rows: DataFrame, features: Sequence[str], *keep: str) -> DataFrame:
    """(kept columns, feature, value) rows with present values only; ``feature`` is the position in the list."""
    values = F.array(*[observed(F.col(f)) for f in features])
    return rows.select(*keep, F.posexplode(values).alias("feature", "value")).filter(F.col("value").isNotNull())


def with_names(rows: DataFrame, features: Sequence[str]) -> DataFrame:
    """Replace feature positions by names; done last, so that shuffles carry numbers."""
    return rows.withColumn("feature", _name(F.col("feature"), features))


def class_proportions(
    rows: DataFrame, features: Sequence[str], label: str, classes: Sequence = ()
) -> DataFrame:
    """Share of each class per feature value, as ``share_<class>``; null where a value never meets a class.

    The classes are those of the data, at most ``MOST_CLASSES``, as each is a column; ``classes`` adds more.
    """
    classes = sorted({*group_values(rows, label, MOST_CLASSES), *classes})

    def share(c) -> Column:
        hits = F.count_if(F.col(label) == c)
        return F.try_divide(F.nullif(hits, F.lit(0).cast("bigint")), F.count(label)).alias(f"share_{c}")

    shares = (
        long_features(rows.filter(F.col(label).isNotNull()), features, label)
        .groupBy("feature", "value")
        .agg(*[share(c) for c in classes])
    )
    return with_names(shares, features)


def class_quartiles(rows: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Quartiles of each feature per class, exact."""
    return exact_quantiles(rows, features, {"q1": 0.25, "q2": 0.5, "q3": 0.75}, label)


def class_profile(rows: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Class means of the min-max scaled features with their angle on a radar chart.

    Scaling is linear, so the mean of the scaled values is the scaled mean: one
    aggregate per class gives everything and the table is read once.
    """
    per_class = rows.groupBy(F.col(label).alias("label")).agg(
        F.array(
            *[
                F.struct(
                    F.lit(f).alias("feature"),
                    F.lit(2 * math.pi * i / len(features)).alias("angle"),
                    F.avg(observed(F.col(f))).alias("mean"),
                    F.min(observed(F.col(f))).alias("low"),
                    F.max(observed(F.col(f))).alias("high"),
                )
                for i, f in enumerate(features)
            ]
        ).alias("stats")
    )
    # From here on: one row per class and feature.
    cells = per_class.select("label", F.inline("stats"))
    feature = Window.partitionBy("feature")
    least, most = F.min("low").over(feature), F.max("high").over(feature)
    return cells.select("label", "feature", "angle", min_max(F.col("mean"), least, most).alias("mean_scaled")).filter(
        F.col("label").isNotNull()
    )


def column_ranges(rows: DataFrame, features: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Least and greatest value of each feature: two numbers per column on the driver."""
    row = rows.agg(
        *[F.min(observed(F.col(f))).alias(f"l{i}") for i, f in enumerate(features)],
        *[F.max(observed(F.col(f))).alias(f"h{i}") for i, f in enumerate(features)],
    ).first()
    return {f: (row[f"l{i}"], row[f"h{i}"]) for i, f in enumerate(features)}


def pair_bins(
    rows: DataFrame, ranges: dict[str, tuple[float, float]], label: str, bins: int = 20
) -> DataFrame:
    """2-D histogram of every pair of features per class, with ``bins`` equal bins per axis.

    Stands for a scatter plot of all points: its size depends on the number of
    bins, never on the number of rows.
    """

    def bin_of(feature: str) -> Column:
        low, high = ranges[feature]
        if low is None or low == high:
            return F.when(observed(F.col(feature)).isNotNull(), 0)
        place = F.floor((observed(F.col(feature)) - F.lit(low)) / F.lit(high - low) * bins)
        return F.when(place < bins, place).when(place >= bins, bins - 1).cast("int")

    binned = rows.filter(F.col(label).isNotNull()).select(label, *[bin_of(f).alias(f) for f in ranges])
    pairs = F.array(
        *[
            F.struct(
                F.lit(x).alias("x_feature"), F.lit(y).alias("y_feature"), F.col(x).alias("x_bin"), F.col(y).alias("y_bin")
            )
            for x, y in combinations(ranges, 2)
        ]
    )
    return (
        binned.select(label, F.inline(pairs))
        .filter(F.col("x_bin").isNotNull() & F.col("y_bin").isNotNull())
        .groupBy("x_feature", "y_feature", label, "x_bin", "y_bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
