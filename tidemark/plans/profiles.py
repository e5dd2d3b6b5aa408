"""Profiling queries on the order rollup."""

from __future__ import annotations

import math
from itertools import permutations

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators import density, profile
from tidemark.plans.inputs import ROLLUP_FEATURES, ROLLUP_SQL, order_rollup, rounded, table
from tidemark.plans.registry import query
from tidemark.session import cut_lineage

TOP = 6
BINS = 20

_CORRELATIONS_SQL = f"""WITH {ROLLUP_SQL}, c AS (""" + " UNION ALL ".join(
    f"SELECT '{f}' AS feature, round(corr({f}, label), 6) AS corr FROM rollup" for f in ROLLUP_FEATURES
) + "), correlations AS (SELECT feature, corr, abs(corr) AS abs_corr FROM c)"

_STEADY_SQL = f"""{ROLLUP_SQL.replace('rollup AS', 'plain AS', 1)},
rollup AS (SELECT * REPLACE (round(avg_tax, 6) AS avg_tax, round(avg_discount, 6) AS avg_discount) FROM plain)"""

_RANKED_SQL = (
    "ranked AS (SELECT feature, row_number() OVER (ORDER BY abs(c) DESC NULLS LAST, feature) - 1 AS pos FROM ("
    + " UNION ALL ".join(f"SELECT '{f}' AS feature, corr({f}, label) AS c FROM rollup" for f in ROLLUP_FEATURES)
    + f") QUALIFY pos < {TOP})"
)

# All features in long form, then only those picked by rank.
LONG_SQL = (
    f"{_RANKED_SQL}, every AS ("
    + " UNION ALL ".join(f"SELECT label, '{f}' AS feature, CAST({f} AS DOUBLE) AS value FROM rollup" for f in ROLLUP_FEATURES)
    + "), long AS (SELECT every.* FROM every SEMI JOIN ranked USING (feature))"
)


def _rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_rollup(table(spark, sf_dir, "lineitem"))


def _ranked(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[str]]:
    """The rollup and its strongest features, strongest first. Averages are rounded, so that engines agree on them."""
    averages = [c for c in ROLLUP_FEATURES if c.startswith("avg_")]
    rollup = cut_lineage(rounded(_rollup(spark, sf_dir), *averages), "rollup")
    best = profile.top_features(profile.target_correlation(rollup, ROLLUP_FEATURES, "label"))
    return rollup, profile.feature_list(best)


def _correlations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.target_correlation(_rollup(spark, sf_dir), ROLLUP_FEATURES, "label")


@query("target_correlation", _CORRELATIONS_SQL + " SELECT * FROM correlations")
def target_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_correlations(spark, sf_dir), "corr", "abs_corr")


@query("top_features", _CORRELATIONS_SQL + " SELECT * FROM correlations ORDER BY abs_corr DESC, feature LIMIT 6")
def top_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.top_features(_correlations(spark, sf_dir)), "corr", "abs_corr")


@query("selected_features", _CORRELATIONS_SQL + " SELECT * FROM correlations WHERE abs_corr > 0.2")
def selected_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.selected_features(_correlations(spark, sf_dir)), "corr", "abs_corr")


@query(
    "project_selected",
    f"WITH {ROLLUP_SQL} SELECT l_orderkey, label, n_lines, sum_qty, max_price, n_returned FROM rollup",
)
def project_selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    rollup = cut_lineage(_rollup(spark, sf_dir), "rollup")
    correlations = profile.target_correlation(rollup, ROLLUP_FEATURES, "label")
    names = profile.feature_list(profile.selected_features(correlations))
    return rollup.select("l_orderkey", "label", *names)


_MATRIX = (*ROLLUP_FEATURES, "label")


@query(
    "corr_matrix",
    f"WITH {_STEADY_SQL}, {_RANKED_SQL}, places AS (SELECT * FROM ranked UNION ALL SELECT 'label', {TOP}), pairs AS ("
    + " UNION ALL ".join(
        f"SELECT '{x}' AS row_name, '{y}' AS col_name, round(corr({x}, {y}), 6) AS corr FROM rollup"
        for x in _MATRIX
        for y in _MATRIX
    )
    + """) SELECT CAST(r.pos AS INTEGER) AS i, CAST(c.pos AS INTEGER) AS j, row_name, col_name, corr
FROM pairs JOIN places r ON r.feature = row_name JOIN places c ON c.feature = col_name WHERE r.pos >= c.pos""",
)
def corr_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rollup, top = _ranked(spark, sf_dir)
    return rounded(profile.correlation_matrix(rollup, [*top, "label"]), "corr")


@query(
    "class_proportions",
    f"""WITH {_STEADY_SQL}, {LONG_SQL}
SELECT feature, value,
       round(nullif(count(*) FILTER (WHERE label = 0), 0) / count(label)::DOUBLE, 6) AS share_0,
       round(nullif(count(*) FILTER (WHERE label = 1), 0) / count(label)::DOUBLE, 6) AS share_1
FROM long WHERE label IS NOT NULL GROUP BY feature, value""",
)
def class_proportions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rollup, top = _ranked(spark, sf_dir)
    return rounded(profile.class_proportions(rollup, top, "label"), "share_0", "share_1")


@query(
    "proportions_three_classes",
    """SELECT 'l_linenumber' AS feature, CAST(l_linenumber AS DOUBLE) AS value,
       round(nullif(count(*) FILTER (WHERE l_returnflag = 'A'), 0) / count(*)::DOUBLE, 6) AS "share_A",
       round(nullif(count(*) FILTER (WHERE l_returnflag = 'N'), 0) / count(*)::DOUBLE, 6) AS "share_N",
       round(nullif(count(*) FILTER (WHERE l_returnflag = 'R'), 0) / count(*)::DOUBLE, 6) AS "share_R"
FROM lineitem WHERE l_returnflag IS NOT NULL AND l_linenumber IS NOT NULL GROUP BY l_linenumber""",
)
def proportions_three_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    shares = profile.class_proportions(table(spark, sf_dir, "lineitem"), ["l_linenumber"], "l_returnflag")
    return rounded(shares, *[c for c in shares.columns if c.startswith("share_")])


@query(
    "class_quartiles",
    f"""WITH {_STEADY_SQL}, {LONG_SQL}
SELECT feature, label, round(quantile_cont(value, 0.25), 6) AS q1, round(quantile_cont(value, 0.5), 6) AS q2,
       round(quantile_cont(value, 0.75), 6) AS q3
FROM long GROUP BY feature, label""",
)
def class_quartiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    rollup, top = _ranked(spark, sf_dir)
    return rounded(profile.class_quartiles(rollup, top, "label"), "q1", "q2", "q3")


@query(
    "minmax_profile",
    f"""WITH {_STEADY_SQL}, {LONG_SQL},
bounds AS (SELECT feature, min(value) AS lo, max(value) AS hi FROM long GROUP BY feature),
scaled AS (SELECT label, feature, (value - lo) / nullif(hi - lo, 0) AS value FROM long JOIN bounds USING (feature)),
positions AS (SELECT feature, pos * {2 * math.pi / TOP!r}::DOUBLE AS angle FROM ranked)
SELECT label, feature, round(angle, 6) AS angle, round(avg(value), 6) AS mean_scaled
FROM scaled JOIN positions USING (feature) GROUP BY label, feature, angle""",
)
def minmax_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    rollup, top = _ranked(spark, sf_dir)
    return rounded(profile.class_profile(rollup, top, "label"), "angle", "mean_scaled")


def _density_sql(grid: int, cut: int) -> str:
    return f"""WITH {_STEADY_SQL}, {LONG_SQL},
counts AS (SELECT feature, label, value, count(*) AS n FROM long GROUP BY ALL),
stats AS (SELECT feature, label, count(*) AS rows, stddev_samp(value) * pow(count(*), -0.2) AS width,
                 min(value) AS lo, max(value) AS hi FROM long GROUP BY feature, label),
points AS (SELECT *, lo - {cut} * width + point * ((hi - lo + 2 * {cut} * width) / {grid - 1}) AS at_value
           FROM stats, (SELECT CAST(unnest(range({grid})) AS INTEGER) AS point) WHERE width > 0)
SELECT feature, label, point, round(any_value(at_value), 6) AS at_value,
       round(sum(n * exp(-0.5 * pow((at_value - value) / width, 2)))
             / (any_value(rows) * any_value(width) * {math.sqrt(2 * math.pi)!r}), 6) AS density
FROM points JOIN counts USING (feature, label) GROUP BY feature, label, point"""


@query("class_density", _density_sql(200, 3))
def class_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    rollup, top = _ranked(spark, sf_dir)
    return rounded(density.class_density(rollup, top, "label"), "at_value", "density")


@query("violin_density", _density_sql(100, 2))
def violin_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    rollup, top = _ranked(spark, sf_dir)
    shapes = density.class_density(rollup, top, "label", grid=100, cut=2.0)
    return rounded(shapes, "at_value", "density")


def _bin_sql(feature: str) -> str:
    low, high = f"(SELECT min({feature}) FROM rollup)", f"(SELECT max({feature}) FROM rollup)"
    return f"""least(CAST(floor((CAST({feature} AS DOUBLE) - CAST({low} AS DOUBLE))
      / CAST({high} - {low} AS DOUBLE) * {BINS}) AS INTEGER), {BINS - 1}) AS {feature}"""


@query(
    "pair_bins",
    f"WITH {_STEADY_SQL}, {_RANKED_SQL}, binned AS (SELECT label, {', '.join(map(_bin_sql, ROLLUP_FEATURES))} FROM rollup), "
    + "pairs AS ("
    + " UNION ALL ".join(
        f"SELECT '{x}' AS x_feature, '{y}' AS y_feature, label, {x} AS x_bin, {y} AS y_bin, count(*) AS n "
        "FROM binned GROUP BY ALL"
        for x, y in permutations(ROLLUP_FEATURES, 2)
    )
    + """) SELECT pairs.* FROM pairs JOIN ranked x ON x.feature = x_feature JOIN ranked y ON y.feature = y_feature
WHERE x.pos < y.pos""",
)
def pair_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    rollup, top = _ranked(spark, sf_dir)
    return profile.pair_bins(rollup, profile.column_ranges(rollup, top), "label", BINS)
