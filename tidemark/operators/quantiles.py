"""Exact quantiles by radix selection: the rows are counted where they are, and never move.

Every value has a 64-bit image of the same order. A pass counts the images by their next 16 bits, for all wanted ranks of
all groups and columns together, and each rank's bucket becomes the prefix that the next pass looks into. Four passes
give the exact value. Only counts are shuffled, at most 2^16 per group, column and prefix, combined per task; the driver
gets a number per wanted rank.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.groups import group_number, group_of, group_values

# Send the functions themselves to the workers, which need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

DIGIT_BITS = 16
# Distinct counts a task holds before it merges them.
HELD_COUNTS = 1 << 20

_TOP = np.uint64(1 << 63)


def image(values: np.ndarray) -> np.ndarray:
    """64-bit numbers in the order of doubles or whole numbers; both zeros are one."""
    if values.dtype == np.int64:
        return values.view(np.uint64) ^ _TOP
    bits = (values + 0.0).view(np.uint64)
    return np.where(bits & _TOP, ~bits, bits | _TOP)


def value_of(bits: int, whole: bool) -> float | int:
    number = np.array([bits], np.uint64)
    if whole:
        return int((number ^ _TOP).view(np.int64)[0])
    return float(np.where(number & _TOP, number ^ _TOP, ~number).view(np.float64)[0])


@dataclass(frozen=True)
class Target:
    """Rows of a group whose image of a column begins with some bits."""

    group: int
    column: int
    prefix: int


def _counting(targets: Sequence[Target], shift: int, whole: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Counts per target and next digit of a task's rows."""
    places: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for number, t in enumerate(targets):
        places.setdefault((t.group, t.column), []).append((t.prefix, number))
    lookup = {}
    for key, found in places.items():
        prefixes, numbers = zip(*sorted(found), strict=True)
        lookup[key] = np.array(prefixes, np.uint64), np.array(numbers, np.int64)
    bits, mask = np.uint64(DIGIT_BITS), np.uint64((1 << DIGIT_BITS) - 1)
    first = shift == 64 - DIGIT_BITS

    def codes(groups: np.ndarray, values: np.ndarray, column: int) -> Iterator[np.ndarray]:
        images = image(values)
        heads = np.zeros(len(images), np.uint64) if first else images >> np.uint64(shift + DIGIT_BITS)
        digits = (images >> np.uint64(shift)) & mask
        for g in np.unique(groups):
            if (int(g), column) not in lookup:
                continue
            prefixes, numbers = lookup[int(g), column]
            mine = groups == g
            at = np.minimum(np.searchsorted(prefixes, heads[mine]), len(prefixes) - 1)
            hit = prefixes[at] == heads[mine]
            yield (numbers[at[hit]].astype(np.uint64) << bits) | digits[mine][hit]

    def merged(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        keys, at = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
        return keys, np.bincount(at, np.concatenate([n for _, n in held]), len(keys)).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            groups = batch.column(0).to_numpy(zero_copy_only=False)
            for column in range(batch.num_columns - 1):
                cells = batch.column(column + 1)
                present = cells.is_valid().to_numpy(zero_copy_only=False)
                values = cells.fill_null(0).to_numpy(zero_copy_only=False)
                if not whole:
                    present = present & ~np.isnan(values)
                held += [np.unique(c, return_counts=True) for c in codes(groups[present], values[present], column)]
            if sum(len(k) for k, _ in held) > HELD_COUNTS:
                held = [merged(held)]
        if held:
            keys, n = merged(held)
            yield pa.RecordBatch.from_arrays(
                [pa.array((keys >> bits).astype(np.int32)), pa.array((keys & mask).astype(np.int32)), pa.array(n)],
                ["target", "digit", "n"],
            )

    return run


@dataclass(frozen=True)
class Selected:
    """Number of present values of a group's column, and its values at the wanted ranks (from 0)."""

    n: int
    at: dict[int, float | int]


def values_at_ranks(
    rows: DataFrame, columns: Sequence[Column], ranks: Callable[[int], Iterable[int]], group: Column | None = None,
    groups: int = 1, whole: bool = False,
) -> dict[tuple[int, int], Selected]:
    """Per (group number, column place), the values at the ranks that ``ranks`` wants of a column with n present values.

    ``rows`` are read four times. Rows of a null group, nulls and NaN do not count. ``whole`` columns are compared as
    64-bit numbers, others as doubles.
    """
    kind = "bigint" if whole else "double"
    number = F.lit(0) if group is None else group
    table = rows.select(number.alias("_g"), *[c.cast(kind).alias(f"_c{i}") for i, c in enumerate(columns)])
    table = table.where(F.col("_g").isNotNull())
    targets = [Target(g, c, 0) for g in range(groups) for c in range(len(columns))]
    # wanted rank of the column -> its target, and its rank within it
    open_ranks: list[tuple[int, int, int]] = []
    sizes: dict[int, int] = {}
    before = Window.partitionBy("target").orderBy("digit").rowsBetween(Window.unboundedPreceding, -1)
    for shift in range(64 - DIGIT_BITS, -1, -DIGIT_BITS):
        counts = (
            table.mapInArrow(_counting(targets, shift, whole), "target int, digit int, n bigint")
            .groupBy("target", "digit")
            .agg(F.sum("n").alias("n"))
        )
        first = shift == 64 - DIGIT_BITS
        if first:
            # small, and asked twice
            counts = counts.persist()
            sizes = {r["target"]: r["n"] for r in counts.groupBy("target").agg(F.sum("n").alias("n")).collect()}
            open_ranks = [(t, r, r) for t, n in sizes.items() for r in sorted(set(ranks(n)))]
        if not open_ranks:
            break
        wanted = rows.sparkSession.createDataFrame(open_ranks, "target int, inside bigint, rank bigint")
        buckets = counts.withColumn("below", F.coalesce(F.sum("n").over(before), F.lit(0)))
        hits = buckets.join(F.broadcast(wanted), "target").where("below <= inside AND inside < below + n")
        found = hits.select("target", "digit", "rank", (F.col("inside") - F.col("below")).alias("inside")).collect()
        if first:
            counts.unpersist()
        narrowed: dict[Target, int] = {}
        open_ranks = []
        for r in found:
            t = targets[r["target"]]
            place = Target(t.group, t.column, (t.prefix << DIGIT_BITS) | r["digit"])
            open_ranks.append((narrowed.setdefault(place, len(narrowed)), r["inside"], r["rank"]))
        targets = list(narrowed)
    out = {(t // len(columns), t % len(columns)): Selected(n, {}) for t, n in sizes.items()}
    for t, _, rank in open_ranks:
        out[targets[t].group, targets[t].column].at[rank] = value_of(targets[t].prefix, whole)
    return out


def _around(share: float, n: int) -> tuple[int, int, float]:
    place = share * (n - 1)
    low = int(np.floor(place))
    return low, int(np.ceil(place)), place - low


def _quantile(found: Selected, share: float) -> float:
    low, high, part = _around(share, found.n)
    return found.at[low] + (found.at[high] - found.at[low]) * part


def exact_quantiles(
    rows: DataFrame, values: Sequence[str], shares: dict[str, float], by: str | None = None
) -> DataFrame:
    """Named quantiles, interpolated linearly, per present group (``by``) and value column (``feature``: its name).

    Columns without present values in a group give no row. Rows without a group are left out.
    """
    names = [] if by is None else group_values(rows, by)
    number = None if by is None else group_number(rows, by, names)

    def ranks(n: int) -> set[int]:
        return {r for s in shares.values() for r in _around(s, n)[:2]}

    columns = [F.col(v) for v in values]
    found = values_at_ranks(rows, columns, ranks, number, 1 if by is None else len(names))
    lines = [
        (values[c], g, *[float(_quantile(s, share)) for share in shares.values()]) for (g, c), s in sorted(found.items())
    ]
    fields = [T.StructField("feature", T.StringType()), T.StructField("_g", T.IntegerType())]
    fields += [T.StructField(name, T.DoubleType()) for name in shares]
    table = rows.sparkSession.createDataFrame(lines, T.StructType(fields))
    if by is None:
        return table.drop("_g")
    # a table without groups has no rows here either
    group = group_of(rows, by, names, F.col("_g"))
    return table.select(group.alias(by), "feature", *shares)


def median(rows: DataFrame, value: str) -> float | None:
    """The exact median of a column, None without present values."""
    found = exact_quantiles(rows, [value], {"median": 0.5}).first()
    return found["median"] if found else None
