"""Profiling against pandas and numpy."""

import math

import numpy as np
import pandas as pd
import pytest

from tidemark.operators import density, profile


@pytest.fixture(scope="module")
def survey():
    random = np.random.default_rng(3)
    n = 400
    label = random.integers(0, 2, n)
    frame = pd.DataFrame(
        {
            "y": label,
            "a": label * 2 + random.normal(size=n),
            "b": random.integers(0, 5, n).astype(float),
            "c": 1.0,
            "d": -label + random.normal(size=n) * 3,
        }
    )
    frame.loc[::17, "a"] = np.nan
    return frame


@pytest.fixture(scope="module")
def table(spark, survey):
    return spark.createDataFrame(survey).repartition(3)


FEATURES = ["a", "b", "c", "d"]


def test_correlations_skip_missing_and_constant(table, survey):
    got = {r.feature: r["corr"] for r in profile.target_correlation(table, FEATURES, "y").collect()}
    want = survey.corr()["y"]
    assert got["c"] is None
    for f in ("a", "b", "d"):
        assert got[f] == pytest.approx(want[f], abs=1e-12)


def test_ranking_puts_missing_last(table):
    correlations = profile.target_correlation(table, FEATURES, "y")
    assert profile.feature_list(correlations)[-1] == "c"
    assert [r.feature for r in profile.top_features(correlations, 2).collect()] == ["a", "d"]
    assert "c" not in profile.feature_list(profile.selected_features(correlations))


def test_correlation_matrix(table, survey):
    columns = ["a", "b", "d", "y"]
    want = survey[columns].corr().to_numpy()
    cells = profile.correlation_matrix(table, columns).collect()
    assert len(cells) == 10
    for r in cells:
        assert r["corr"] == pytest.approx(want[r.i, r.j], abs=1e-12)
        assert (r.row_name, r.col_name) == (columns[r.i], columns[r.j])


def test_wide_correlations(spark):
    random = np.random.default_rng(4)
    frame = pd.DataFrame(random.normal(size=(200, 60)), columns=[f"f{i}" for i in range(60)])
    got = {
        r.feature: r["corr"]
        for r in profile.target_correlation(spark.createDataFrame(frame), list(frame.columns[1:]), "f0").collect()
    }
    want = frame.corr()["f0"]
    assert all(got[f] == pytest.approx(want[f], abs=1e-12) for f in got) and len(got) == 59


def test_class_proportions(spark):
    rows = [(1.0, "a"), (1.0, "b"), (1.0, "b"), (1.0, "c"), (2.0, "a"), (2.0, "a"), (None, "a"), (3.0, "c"), (3.0, None)]
    shares = profile.class_proportions(spark.createDataFrame(rows, "f double, y string"), ["f"], "y", classes=["d"])
    got = {r["value"]: (r["share_a"], r["share_b"], r["share_c"], r["share_d"]) for r in shares.collect()}
    assert got == {1.0: (0.25, 0.5, 0.25, None), 2.0: (1.0, None, None, None), 3.0: (None, None, 1.0, None)}


def test_class_proportions_of_a_pure_value(spark):
    df = spark.createDataFrame([(1.0, 0), (1.0, 0), (2.0, 1), (2.0, None)], "f double, y int")
    got = {r.value: (r.share_0, r.share_1) for r in profile.class_proportions(df, ["f"], "y").collect()}
    assert got == {1.0: (1.0, None), 2.0: (None, 1.0)}


def test_quartiles(table, survey):
    for r in profile.class_quartiles(table, ["a", "d"], "y").collect():
        values = survey.loc[survey.y == r.y, r.feature].dropna()
        assert (r.q1, r.q2, r.q3) == pytest.approx(tuple(np.quantile(values, [0.25, 0.5, 0.75])))


def test_class_profile(spark):
    rows = [(0.0, 10.0, 7.0, 0), (4.0, 30.0, 7.0, 0), (8.0, 20.0, 7.0, 1), (None, 14.0, 7.0, 1)]
    got = profile.class_profile(spark.createDataFrame(rows, "a double, b double, c double, y int"), ["a", "b", "c"], "y")
    want = {(0, "a"): 0.25, (1, "a"): 1.0, (0, "b"): 0.5, (1, "b"): 0.35, (0, "c"): None, (1, "c"): None}
    assert {(r.label, r.feature): r.mean_scaled for r in got.collect()} == pytest.approx(want)
    angles = {r.feature: r.angle for r in got.collect()}
    assert angles == pytest.approx({"a": 0.0, "b": 2.0943951023931953, "c": 4.1887902047863905})


@pytest.mark.parametrize(("grid", "cut"), [(200, 3.0), (100, 2.0)])
def test_density(table, survey, grid, cut):
    rows = density.class_density(table, ["a", "b", "c"], "y", grid, cut).toPandas()
    assert set(rows.feature) == {"a", "b"}  # a constant has no density
    for (feature, label), part in rows.groupby(["feature", "y"]):
        values = survey.loc[survey.y == label, feature].dropna().to_numpy()
        width = values.std(ddof=1) * len(values) ** -0.2
        at = np.linspace(values.min() - cut * width, values.max() + cut * width, grid)
        z = (at[:, None] - values[None, :]) / width
        want = np.exp(-0.5 * z * z).sum(axis=1) / (len(values) * width * math.sqrt(2 * math.pi))
        part = part.sort_values("point")
        np.testing.assert_allclose(part.at_value, at, atol=1e-9)
        np.testing.assert_allclose(part.density, want, atol=1e-12)


def test_kernel_reach_drops_only_zeros():
    random = np.random.default_rng(5)
    values, counts = random.normal(size=500) * 1000, random.integers(1, 4, 500).astype(float)
    points = np.linspace(-3000, 3000, 50)
    z = (points[:, None] - values[None, :]) / 3.0
    want = (np.exp(-0.5 * z * z) * counts).sum(axis=1)
    np.testing.assert_allclose(density.kernel_sums(values, counts, points, 3.0), want, rtol=1e-9, atol=0)


def test_pair_bins_count_every_row(table, survey):
    ranges = profile.column_ranges(table, ["a", "b", "c"])
    bins = profile.pair_bins(table, ranges, "y", bins=10).toPandas()
    assert bins.x_bin.between(0, 9).all() and bins.y_bin.between(0, 9).all()
    totals = bins.groupby(["x_feature", "y_feature"])["n"]
    both = {("a", "b"): survey.a.notna().sum(), ("a", "c"): survey.a.notna().sum(), ("b", "c"): len(survey)}
    assert totals.sum().to_dict() == both


def test_summaries(spark):
    df = spark.createDataFrame([(1, None, 1.0), (2, "x", float("nan")), (None, "y", None)], "a int, b string, c double")
    assert profile.shape(df).first().asDict() == {"n_rows": 3, "n_columns": 3}
    assert {r.column_name: r.n_null for r in profile.null_counts(df).collect()} == {"a": 1, "b": 1, "c": 2, "(all)": 4}
    info = {r.column_name: (r.data_type, r.n_present) for r in profile.table_info(df).collect()}
    assert info == {"a": ("int", 2), "b": ("string", 2), "c": ("double", 1)}


def test_head_and_tail(spark):
    df = spark.range(300)
    assert [r.id for r in profile.head(df, "id").collect()] == [0, 1, 2, 3, 4]
    assert sorted(r.id for r in profile.tail(df, "id").collect()) == list(range(200, 300))
