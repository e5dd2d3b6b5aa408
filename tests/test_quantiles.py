"""Radix selection against numpy."""

import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import quantiles
from tidemark.operators.quantiles import exact_quantiles, image, median, value_of, values_at_ranks

SHARES = {"a": 0.0, "b": 0.1, "c": 0.5, "d": 0.77, "e": 1.0}


def test_images_keep_the_order():
    values = [-np.inf, -1e300, -2.5, -1e-310, 0.0, 5e-324, 1.0, np.nextafter(1.0, 2), 1e308, np.inf]
    images = image(np.array(values))
    assert (np.diff(images.astype(object)) > 0).all()
    assert image(np.array([-0.0]))[0] == image(np.array([0.0]))[0]
    assert [value_of(int(i), False) for i in images] == values
    whole = [-(1 << 63), -7, 0, 3, (1 << 63) - 1]
    images = image(np.array(whole, np.int64))
    assert (np.diff(images.astype(object)) > 0).all() and [value_of(int(i), True) for i in images] == whole


def test_quantiles_per_group_and_column(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "HELD_COUNTS", 50)
    random.seed(2)
    rows = [("x", random.gauss(0, 1), float(i)) for i in range(501)] + [("y", float(random.randint(0, 3)), None) for _ in range(400)]
    rows += [("z", 5.0, -1.0), ("x", None, 2.0), ("x", float("nan"), 3.0), (None, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "g string, v double, w double").repartition(4)
    got = {(r.g, r.feature): tuple(r)[2:] for r in exact_quantiles(df, ["v", "w"], SHARES, "g").collect()}
    assert set(got) == {("x", "v"), ("y", "v"), ("z", "v"), ("x", "w"), ("z", "w")}
    for group, name in got:
        values = [v for g, *cells in rows if g == group and (v := cells["vw".index(name)]) is not None and v == v]
        assert got[group, name] == pytest.approx(np.quantile(values, list(SHARES.values())), abs=1e-12)


def test_median_of_a_hot_value(spark):
    values = [7.0] * 5000 + [float(i) for i in range(10_000)]
    assert median(spark.createDataFrame([(v,) for v in values], "v double"), "v") == statistics.median(values)
    assert median(spark.createDataFrame([(None,), (float("nan"),)], "v double"), "v") is None


def test_whole_numbers_beyond_doubles(spark):
    values = [(1 << 60) + random.randint(-1000, 1000) for _ in range(301)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v bigint")
    got = values_at_ranks(df, [F.col("v")], lambda n: [0, n // 3, n - 1], whole=True)[0, 0]
    assert got.n == 301 and got.at == {r: sorted(values)[r] for r in (0, 100, 300)}


def test_no_rows(spark):
    df = spark.createDataFrame([], "g int, v double")
    assert exact_quantiles(df, ["v"], SHARES, "g").count() == 0
    assert exact_quantiles(df, ["v"], SHARES).count() == 0


def test_rows_do_not_move(spark, monkeypatch):
    """What is shuffled is a count per digit, however many rows and distinct values there are."""
    sent = []
    counting = quantiles._counting

    def watched(targets, shift, whole):
        sent.append(len(targets))
        return counting(targets, shift, whole)

    monkeypatch.setattr(quantiles, "_counting", watched)
    df = spark.range(100_000).selectExpr("double(id) / 3 AS v", "id % 2 AS g")
    exact_quantiles(df, ["v"], {"q": 0.5}, "g").collect()
    assert len(sent) == 4 and max(sent) <= 4


def test_too_many_groups(spark):
    with pytest.raises(ValueError, match="not a label"):
        exact_quantiles(spark.range(5000).selectExpr("id AS g", "1D AS v"), ["v"], SHARES, "g")
