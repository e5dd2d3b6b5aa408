"""Feature building."""

import hashlib
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.functions import numbers
from tidemark.operators import features


def test_event_counts(spark):
    rows = [("u1", "a"), ("u1", "a"), ("u1", None), ("u2", "b"), (None, "a"), ("u3", "other")]
    df = spark.createDataFrame(rows, "pseudo string, evenement string")
    got = features.event_counts(df, "pseudo", "evenement", ["a", "b"]).orderBy("pseudo").collect()
    assert [tuple(r) for r in got] == [("u1", 2, 0), ("u2", 0, 1), ("u3", 0, 0)]


def test_ratio_and_limit(spark):
    rows = [(1.0, 0.0), (10.0, 2.0), (None, 1.0), (90000.0, 3.0), (float("nan"), 1.0), (89999.0, 3.0)]
    df = features.with_ratio(spark.createDataFrame(rows, "p double, s double"), "p", "s", "r")
    assert sorted(r.r for r in features.below(df, "r").collect()) == [5.0, 89999.0 / 3]


def test_standardize_uses_train_and_population_deviation(spark):
    rows = [(1, 1.0, 5.0, False), (2, 3.0, 5.0, False), (3, 100.0, 7.0, True), (4, None, 5.0, False)]
    df = spark.createDataFrame(rows, "id int, x double, c double, is_test boolean")
    got = {r.id: (r.x, r.c) for r in features.standardize(df, ["x", "c"], ~F.col("is_test")).collect()}
    assert got == {1: (-1.0, 0.0), 2: (1.0, 0.0), 3: (98.0, 2.0), 4: (None, 0.0)}


def test_min_max_of_a_constant_is_missing(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 2.0), (2.0, 2.0)], "x double, c double")
    assert sorted(tuple(r) for r in features.min_max_scale(df, ["x", "c"]).collect()) == [
        (0.0, None),
        (0.5, None),
        (1.0, None),
    ]


def test_hash_split_does_not_depend_on_partitions(spark):
    df = spark.range(3000)
    one = {r.id for r in features.with_split(df.repartition(1), "id").filter("is_test").collect()}
    many = {r.id for r in features.with_split(df.repartition(7), "id").filter("is_test").collect()}
    assert one == many
    assert 500 < len(one) < 700


@pytest.mark.parametrize("n", [1, 7, 1000, 50_001])
def test_exact_split(spark, n):
    marked = features.with_exact_split(spark.range(n), "id")
    test = {r.id for r in marked.filter("is_test").collect()}
    ranked = sorted(range(n), key=lambda i: int(hashlib.md5(f"42:{i}".encode()).hexdigest()[:15], 16))
    assert test == set(ranked[: math.ceil(0.2 * n)])


def test_exact_split_narrows_a_crowded_bucket(spark):
    # One key for a third of all rows: its copies share a hash and stay together.
    df = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("key"))
    marked = features.with_exact_split(df, "key")
    sides = marked.groupBy("key").agg(F.countDistinct("is_test").alias("sides"))
    assert sides.filter("sides > 1").count() == 0
    assert marked.filter("is_test").count() >= 12_000


def test_empty_split(spark):
    assert features.with_exact_split(spark.range(0), "id").count() == 0


def test_folds_are_stratified(spark):
    df = spark.range(5003).withColumn("label", F.when(F.col("id") < 17, 1).when(F.col("id") < 20, 2).otherwise(0))
    df = df.withColumn("label", F.when(F.col("id") == 5000, None).otherwise(F.col("label")))
    folded = features.with_folds(df, "id", "label")
    counts = {(r["label"], r["fold"]): r["count"] for r in folded.groupBy("fold", "label").count().collect()}
    for label, n in ((0, 4982), (1, 17), (2, 3)):
        want = Counter(rank * 5 // n for rank in range(n))
        assert {f: c for (of, f), c in counts.items() if of == label} == want
    assert counts[None, None] == 1
    again = features.with_folds(df.repartition(7), "id", "label")
    assert folded.exceptAll(again).count() == 0


def test_clip_keeps_missing(spark):
    df = spark.createDataFrame([(-1.0,), (25.0,), (3.0,), (None,)], "x double")
    got = [r.y for r in df.select(numbers.clip(F.col("x"), 0.0, 20.0).alias("y")).collect()]
    assert got == [0.0, 20.0, 3.0, None]


@pytest.mark.parametrize("digits", [0, 1, 2, 3, 4])
def test_fixed_point_like_python(spark, digits):
    random.seed(digits)
    values = [0.125, 0.375, 1.005, 1.015, 2.675, 0.5, 1.5, 2.5, -0.125, -3.14159, 0.0, 19.995, 99.95, 1e6 + 0.125]
    values += [random.randint(-4000, 40000) / 2000 for _ in range(300)] + [random.uniform(0, 20) for _ in range(300)]
    values += [random.randint(0, 20000) / 1000 for _ in range(300)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for row in df.select("x", numbers.fixed_point(F.col("x"), digits).alias("t")).collect():
        assert row.t == f"{row.x:.{digits}f}", row.x


def test_percent_like_python(spark):
    values = [0.0, 0.1234, 0.12345, 0.9995, 1.0, 0.33333]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for row in df.select("x", numbers.percent(F.col("x"), 1).alias("t")).collect():
        assert row.t == f"{row.x:.1%}"


def test_fixed_point_of_odd_numbers(spark):
    values = [float("nan"), float("inf"), float("-inf"), 1e17, -1e17, 1e300, 9.1e15, None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r.t for r in df.select(numbers.fixed_point(F.col("x"), 2).alias("t")).collect()]
    assert got[:5] == ["nan", "inf", "-inf", "100000000000000000.00", "-100000000000000000.00"]
    assert got[5].startswith("1000000") and len(got[5]) == 304 and got[6:] == ["9100000000000000.00", None]
