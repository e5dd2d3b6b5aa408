"""Feature building: event counts per entity, ratios, scaling and the train/test split."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import fixed_values as fixed
from tidemark.functions.numbers import min_max, observed, ratio, z_score
from tidemark.operators.common import computed_once
from tidemark.operators.groups import group_number, group_values
from tidemark.operators.quantiles import values_at_ranks


def event_counts(events: DataFrame, entity: str, event: str, features: Sequence[str]) -> DataFrame:
    """One row per entity with the number of its events of each listed kind, 0 where it has none."""
    return (
        events.filter(F.col(entity).isNotNull())
        .groupBy(entity)
        .agg(*[F.count_if(F.col(event) == F.lit(f)).alias(f) for f in features])
    )


def with_ratio(rows: DataFrame, numerator: str, denominator: str, name: str) -> DataFrame:
    return rows.withColumn(name, ratio(F.col(numerator), F.col(denominator)))


def below(rows: DataFrame, column: str, limit: float = fixed.RATIO_LIMIT) -> DataFrame:
    """Rows strictly below the limit; missing values and NaN drop out."""
    return rows.filter(F.col(column) < limit)


def hash_bucket(key: Column, buckets: int, seed: int = fixed.SEED) -> Column:
    """A bucket that depends on key and seed only, whatever the partitioning or a retry."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % buckets


def with_split(
    rows: DataFrame, key: str, test_percent: int = fixed.TEST_PERCENT, seed: int = fixed.SEED
) -> DataFrame:
    """Mark about ``test_percent`` of the rows as ``is_test``. Needs no shuffle."""
    return rows.withColumn("is_test", hash_bucket(F.col(key), 100, seed) < test_percent)


def split_hash(key: Column, seed: int = fixed.SEED) -> Column:
    """A 60-bit number that depends on key and seed only."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string"))), 1, 15), 16, 10).cast("bigint")


def hash_at_share(rows: DataFrame, key: str, share: float, seed: int = fixed.SEED) -> int:
    """The hash of rank ceil(share x rows), found by narrowing it 15 bits at a time.

    Each step counts the rows of one bucket in 2^15 smaller ones, so only counts
    are shuffled and the driver sees at most 2^15 of them.
    """
    hashes = computed_once(rows, split_hash(F.col(key), seed).alias("h")).filter(F.col("h").isNotNull())
    bits = 15
    prefix, wanted = 0, None
    for shift in (45, 30, 15, 0):
        bucket = F.shiftright("h", shift)
        inside = hashes if wanted is None else hashes.filter(F.shiftright("h", shift + bits) == prefix)
        counts = inside.groupBy(bucket.alias("bucket")).agg(F.count("h").alias("n"))
        sizes = sorted((r.bucket, r.n) for r in counts.collect())
        if wanted is None:
            wanted = math.ceil(share * sum(n for _, n in sizes))
            if wanted == 0:
                return -1
        for prefix, n in sizes:
            if wanted <= n:
                break
            wanted -= n
    return prefix


def with_exact_split(
    rows: DataFrame, key: str, test_share: float = fixed.TEST_PERCENT / 100, seed: int = fixed.SEED
) -> DataFrame:
    """Mark exactly ceil(test_share x rows) rows as ``is_test``, given unique keys.

    Costs a few passes over the key column and no shuffle of rows. Rows of equal
    key stay on one side.
    """
    last = hash_at_share(rows, key, test_share, seed)
    return rows.withColumn("is_test", split_hash(F.col(key), seed) <= last)


def with_folds(
    rows: DataFrame, key: str, label: str, folds: int = fixed.FOLDS, seed: int = fixed.SEED
) -> DataFrame:
    """Fold number per row: each label's rows in order of the key's hash, cut into equal parts.

    The parts of a label differ by one row at most, given unique keys. The bounds are found by counting hashes; the rows
    are read a few times and do not move. Rows without a label have no fold.
    """
    labels = group_values(rows, label)
    hashed = split_hash(F.col(key), seed + 1)

    def lasts(n: int) -> list[int]:
        return [r for i in range(1, folds) if 0 <= (r := math.ceil(n * i / folds) - 1)]

    found = values_at_ranks(rows, [hashed], lasts, group_number(rows, label, labels), len(labels), whole=True)
    fold = F.lit(None).cast("int")
    for g, value in enumerate(labels):
        if (g, 0) in found:
            at, ranks = found[g, 0].at, lasts(found[g, 0].n)
            # a label of fewer rows than folds has bounds of rank -1, which every row is beyond
            passed = [(hashed > F.lit(at[r])).cast("int") for r in ranks]
            skipped = F.lit(folds - 1 - len(ranks))
            fold = F.when(F.col(label) == F.lit(value), sum(passed, skipped)).otherwise(fold)
    return rows.withColumn("fold", fold)


def _with_stats(rows: DataFrame, features: Sequence[str], first, second, fit_on: Column) -> DataFrame:
    """Add the two statistics of every feature as one struct: a scalar subquery, no join.

    ``fit_on`` chooses the rows inside the aggregate. As a filter it would move
    below whatever made the rows, and the two uses could not share that work.
    """
    chosen = [F.when(fit_on, observed(F.col(c))) for c in features]
    stats = rows.agg(
        F.struct(
            *[first(x).alias(f"a{i}") for i, x in enumerate(chosen)],
            *[second(x).alias(f"b{i}") for i, x in enumerate(chosen)],
        ).alias("s")
    )
    return rows.withColumn("_stats", stats.scalar())


def standardize(rows: DataFrame, features: Sequence[str], fit_on: Column) -> DataFrame:
    """Replace features by z-scores with mean and population deviation of the rows where ``fit_on`` holds."""
    scaled = {
        c: z_score(observed(F.col(c)), F.col(f"_stats.a{i}"), F.col(f"_stats.b{i}")) for i, c in enumerate(features)
    }
    return _with_stats(rows, features, F.avg, F.stddev_pop, fit_on).withColumns(scaled).drop("_stats")


def min_max_scale(rows: DataFrame, features: Sequence[str]) -> DataFrame:
    """Replace features by their position between the column's minimum and maximum."""
    scaled = {
        c: min_max(observed(F.col(c)), F.col(f"_stats.a{i}"), F.col(f"_stats.b{i}")) for i, c in enumerate(features)
    }
    return _with_stats(rows, features, F.min, F.max, F.lit(True)).withColumns(scaled).drop("_stats")
