"""Inputs of the registered queries, derived from whole driver tables, as Spark tables and as SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import text
from tidemark.functions.numbers import clip
from tidemark.operators.features import event_counts

EVENT_KINDS = ("click", "error", "purchase", "signup", "view")
ROLLUP_FEATURES = ("n_lines", "sum_qty", "max_price", "n_returned", "min_price", "avg_tax", "avg_discount")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def access_line() -> Column:
    """One access-log line per event."""
    k = F.get_json_object("props", "$.k").cast("int")
    kind = F.col("event_type")
    status = F.when(kind != "error", 200).when(k % 2 == 0, 404).otherwise(500)
    return F.concat(
        F.lit("10.0.0."),
        F.col("user_id").cast("string"),
        F.lit(" - - ["),
        F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"),
        F.lit(' +0000] "'),
        F.when(kind == "purchase", "POST").otherwise("GET"),
        F.lit(" /"),
        kind,
        F.lit("?id="),
        k.cast("string"),
        F.lit(' HTTP/1.1" '),
        status.cast("string"),
        F.lit(" "),
        F.floor(F.col("value") * 100).cast("string"),
    )


def access_lines(events: DataFrame) -> DataFrame:
    return events.select("event_id", access_line().alias("value"))


LINE_SQL = """
  '10.0.0.' || user_id || ' - - [' || strftime(ts, '%d/%b/%Y:%H:%M:%S') || ' +0000] "'
  || CASE WHEN event_type = 'purchase' THEN 'POST' ELSE 'GET' END
  || ' /' || event_type || '?id=' || json_extract_string(props, '$.k') || ' HTTP/1.1" '
  || CASE WHEN event_type <> 'error' THEN '200'
          WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) % 2 = 0 THEN '404' ELSE '500' END
  || ' ' || CAST(floor(value * 100) AS BIGINT)"""

LINES_SQL = f"lines AS (SELECT event_id, {LINE_SQL} AS value FROM events)"


def messy_lines(events: DataFrame) -> DataFrame:
    """The same lines, most of them damaged in a way that depends on the event."""
    line = F.col("value")
    damage = F.col("event_id") % 10
    return access_lines(events).select(
        "event_id",
        F.when(damage == 0, F.regexp_replace(line, r" \d+$", " -"))
        .when(damage == 1, F.replace(line, F.lit(" - - "), F.lit(" - bob ")))
        .when(damage == 2, F.replace(line, F.lit("HTTP/1.1"), F.lit("HTTP/2")))
        .when(damage == 3, F.replace(line, F.lit("?id="), F.lit(" page?userid=7&id=")))
        .when(damage == 4, F.replace(line, F.lit(" +0000"), F.lit(" +0230")))
        .when(damage == 5, F.replace(line, F.lit(' HTTP/1.1" 200 '), F.lit(' HTTP/1.1" 302 ')))
        .when(damage == 6, F.regexp_replace(line, r"\[.*\]", "[bad]"))
        .when(damage == 7, F.substring(line, 1, 40))
        .when(damage == 8, F.replace(line, F.lit('" 200 '), F.lit('" 99 ')))
        .otherwise(F.concat(line, F.lit(' "-" "'), F.repeat(F.lit("agent "), 12), F.lit('"')))
        .alias("value"),
    )


MESSY_SQL = rf"""{LINES_SQL},
messy AS (SELECT event_id, CASE event_id % 10
  WHEN 0 THEN regexp_replace(value, ' \d+$', ' -')
  WHEN 1 THEN replace(value, ' - - ', ' - bob ')
  WHEN 2 THEN replace(value, 'HTTP/1.1', 'HTTP/2')
  WHEN 3 THEN replace(value, '?id=', ' page?userid=7&id=')
  WHEN 4 THEN replace(value, ' +0000', ' +0230')
  WHEN 5 THEN replace(value, ' HTTP/1.1" 200 ', ' HTTP/1.1" 302 ')
  WHEN 6 THEN regexp_replace(value, '\[.*\]', '[bad]')
  WHEN 7 THEN substr(value, 1, 40)
  WHEN 8 THEN replace(value, '" 200 ', '" 99 ')
  ELSE value || ' "-" "' || repeat('agent ', 12) || '"' END AS value FROM lines)"""


def document_lines(documents: DataFrame) -> DataFrame:
    """Every line of every document, with its place."""
    return documents.select("doc_id", F.posexplode(text.lines(F.col("text"))).alias("line_no", "value"))


DOCUMENT_LINES_SQL = r"""pieces AS (SELECT doc_id, regexp_split_to_array(text, '\r\n|\r|\n') AS parts FROM documents),
document_lines AS (
  SELECT doc_id, CAST(unnest(range(len(parts))) AS INTEGER) AS line_no, unnest(parts) AS value FROM pieces)"""


def order_rollup(lineitem: DataFrame) -> DataFrame:
    """One row per order: seven features, its price sum and a 0/1 label."""
    price = F.col("l_extendedprice")
    return lineitem.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum("l_quantity").alias("sum_qty"),
        F.max(price).alias("max_price"),
        F.count_if(F.col("l_returnflag") == "R").alias("n_returned"),
        F.min(price).alias("min_price"),
        F.avg("l_tax").alias("avg_tax"),
        F.avg("l_discount").alias("avg_discount"),
        F.sum(price).alias("total_price"),
        (F.sum(price) > 200000).cast("int").alias("label"),
    )


ROLLUP_SQL = """rollup AS (
  SELECT l_orderkey, count(*) AS n_lines, sum(l_quantity) AS sum_qty, max(l_extendedprice) AS max_price,
         count(*) FILTER (WHERE l_returnflag = 'R') AS n_returned, min(l_extendedprice) AS min_price,
         avg(l_tax) AS avg_tax, avg(l_discount) AS avg_discount, sum(l_extendedprice) AS total_price,
         CAST(sum(l_extendedprice) > 200000 AS INTEGER) AS label
  FROM lineitem GROUP BY l_orderkey)"""


def rule_scores(rollup: DataFrame) -> DataFrame:
    """A score by rule that many orders share only in part, with its 0/1 prediction."""
    score = F.least(F.lit(1.0), (F.col("sum_qty") * 1000.0 + F.floor(F.col("max_price") / 100) * 100) / 400000.0)
    return rollup.select("l_orderkey", "label", score.alias("score")).withColumn(
        "prediction", (F.col("score") >= 0.5).cast("int")
    )


RULE_SQL = f"""{ROLLUP_SQL},
scored AS (SELECT *, CAST(score >= 0.5 AS INTEGER) AS prediction FROM (
  SELECT l_orderkey, label,
         least(1.0::DOUBLE, (sum_qty * 1000.0::DOUBLE + floor(max_price / 100) * 100) / 400000.0::DOUBLE) AS score
  FROM rollup))"""


def user_points(events: DataFrame) -> DataFrame:
    """Event counts per user, with points by a linear rule."""
    counts = event_counts(events, "user_id", "event_type", EVENT_KINDS)
    points = F.col("click") * 0.5 + F.col("purchase") * 1.25 - F.col("error") * 0.75 + F.col("view") * 0.125
    return counts.withColumn("points", points)


def scored_users(events: DataFrame) -> DataFrame:
    """Users scored by their points, in the shape of scored entities."""
    note = clip(F.col("points"), 0.0, 20.0)
    return user_points(events).select(
        F.col("user_id").alias("pseudo"),
        note.alias("note"),
        (note >= 10).cast("int").alias("reussite"),
        (note / 20.0).alias("proba"),
    )


SCORED_USERS_SQL = """counts AS (
  SELECT user_id, count(*) FILTER (WHERE event_type = 'click') AS click,
         count(*) FILTER (WHERE event_type = 'error') AS error,
         count(*) FILTER (WHERE event_type = 'purchase') AS purchase,
         count(*) FILTER (WHERE event_type = 'view') AS "view"
  FROM events WHERE user_id IS NOT NULL GROUP BY user_id),
notes AS (
  SELECT user_id AS pseudo,
         greatest(0.0::DOUBLE, least(20.0::DOUBLE, click * 0.5::DOUBLE + purchase * 1.25::DOUBLE
                  - error * 0.75::DOUBLE + "view" * 0.125::DOUBLE)) AS note FROM counts),
users AS (SELECT pseudo, note, CAST(note >= 10 AS INTEGER) AS reussite, note / 20.0::DOUBLE AS proba FROM notes)"""


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Round floats, so that the order of additions does not show."""
    return df.withColumns({c: F.round(c, digits) for c in columns})
