"""Feature building and table summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import features, profile
from tidemark.plans.inputs import EVENT_KINDS, ROLLUP_FEATURES, ROLLUP_SQL, order_rollup, rounded, table
from tidemark.plans.registry import query

LINEITEM_TYPES = {
    "l_orderkey": "bigint",
    "l_partkey": "bigint",
    "l_suppkey": "bigint",
    "l_linenumber": "int",
    "l_quantity": "double",
    "l_extendedprice": "double",
    "l_discount": "double",
    "l_tax": "double",
    "l_returnflag": "string",
    "l_linestatus": "string",
    "l_shipdate": "timestamp_ntz",
}

_SPLIT_SQL = "CAST(concat('0x', substr(md5(concat('42:', {key})), 1, 8)) AS BIGINT) % 100 < 20"


@query(
    "event_pivot",
    "SELECT user_id, "
    + ", ".join(f"count(*) FILTER (WHERE event_type = '{e}') AS \"{e}\"" for e in EVENT_KINDS)
    + " FROM events WHERE user_id IS NOT NULL GROUP BY user_id",
)
def event_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.event_counts(table(spark, sf_dir, "events"), "user_id", "event_type", EVENT_KINDS)


@query(
    "unit_price_filter",
    """SELECT l_orderkey, l_linenumber, l_extendedprice / nullif(l_quantity, 0) AS unit_price
       FROM lineitem WHERE l_extendedprice / nullif(l_quantity, 0) < 30000""",
)
def unit_price_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    priced = features.below(features.with_ratio(lines, "l_extendedprice", "l_quantity", "unit_price"), "unit_price")
    kept = {"l_orderkey", "l_linenumber", "unit_price"}
    return priced.drop(*[c for c in priced.columns if c not in kept], "no_such_column")


@query("table_shape", "SELECT count(*) AS n_rows, 11 AS n_columns FROM lineitem")
def table_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.shape(table(spark, sf_dir, "lineitem"))


_NULLS = {c: f"count(*) - count({c})" for c in LINEITEM_TYPES}


@query(
    "null_counts",
    " UNION ALL ".join(f"SELECT '{c}' AS column_name, {n} AS n_null FROM lineitem" for c, n in _NULLS.items())
    + f" UNION ALL SELECT '(all)', {' + '.join(_NULLS.values())} FROM lineitem",
)
def null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.null_counts(table(spark, sf_dir, "lineitem"))


@query(
    "table_info",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{t}' AS data_type, count({c}) AS n_present FROM lineitem"
        for c, t in LINEITEM_TYPES.items()
    ),
)
def table_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.table_info(table(spark, sf_dir, "lineitem"))


@query("head_rows", "SELECT event_id, user_id, event_type, value FROM events ORDER BY event_id LIMIT 5")
def head_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.head(table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value"), "event_id")


@query("tail_rows", "SELECT event_id, user_id, event_type, value FROM events ORDER BY event_id DESC LIMIT 100")
def tail_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.tail(table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value"), "event_id")


@query("hash_split", f"SELECT event_id, {_SPLIT_SQL.format(key='event_id')} AS is_test FROM events")
def hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.with_split(table(spark, sf_dir, "events").select("event_id"), "event_id")


@query(
    "exact_split",
    """WITH h AS (SELECT event_id, CAST(concat('0x', substr(md5(concat('42:', event_id)), 1, 15)) AS BIGINT) AS h
           FROM events)
SELECT event_id, row_number() OVER (ORDER BY h) <= ceil(0.2::DOUBLE * count(*) OVER ()) AS is_test FROM h""",
)
def exact_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.with_exact_split(table(spark, sf_dir, "events").select("event_id"), "event_id")


@query(
    "standardize",
    f"""WITH {ROLLUP_SQL},
split AS (SELECT *, {_SPLIT_SQL.format(key='l_orderkey')} AS is_test FROM rollup),
stats AS (SELECT """
    + ", ".join(f"avg({f}) AS m_{f}, stddev_pop({f}) AS s_{f}" for f in ROLLUP_FEATURES)
    + """ FROM split WHERE NOT is_test)
SELECT l_orderkey, is_test, """
    + ", ".join(
        f"round(({f} - m_{f}) / CASE WHEN s_{f} = 0 THEN 1 ELSE s_{f} END, 6) + 0.0 AS {f}" for f in ROLLUP_FEATURES
    )
    + " FROM split, stats",
)
def standardize(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = features.with_split(order_rollup(table(spark, sf_dir, "lineitem")), "l_orderkey")
    scaled = features.standardize(rows, ROLLUP_FEATURES, ~F.col("is_test"))
    result = rounded(scaled.select("l_orderkey", "is_test", *ROLLUP_FEATURES), *ROLLUP_FEATURES)
    return result.withColumns({f: F.col(f) + 0.0 for f in ROLLUP_FEATURES})


@query(
    "min_max_scale",
    f"""WITH {ROLLUP_SQL},
stats AS (SELECT """
    + ", ".join(f"min({f}) AS lo_{f}, max({f}) AS hi_{f}" for f in ROLLUP_FEATURES)
    + """ FROM rollup)
SELECT l_orderkey, """
    + ", ".join(f"round(({f} - lo_{f}) / nullif(hi_{f} - lo_{f}, 0), 6) AS {f}" for f in ROLLUP_FEATURES)
    + " FROM rollup, stats",
)
def min_max_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = order_rollup(table(spark, sf_dir, "lineitem")).select("l_orderkey", *ROLLUP_FEATURES)
    return rounded(features.min_max_scale(rows, ROLLUP_FEATURES), *ROLLUP_FEATURES)
