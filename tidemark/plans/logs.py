"""Log queries. Windows and thresholds are wider than the defaults: the events are sparse."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import fixed_values as fixed
from tidemark.functions import text
from tidemark.functions.numbers import utc
from tidemark.operators import log_metrics, logs
from tidemark.plans.inputs import (
    DOCUMENT_LINES_SQL,
    LINES_SQL,
    MESSY_SQL,
    access_lines,
    document_lines,
    messy_lines,
    table,
)
from tidemark.plans.registry import query

PRODUCT_THRESHOLD = 7
CLIENT_THRESHOLD = 5

FIELDS_SQL = r"""
  string_split(value, ' ')[1] AS ip,
  try_strptime(regexp_extract(value, '\[(.*?)\]', 1), '%d/%b/%Y:%H:%M:%S %z') AT TIME ZONE 'UTC' AS "timestamp",
  regexp_extract(value, '"(\w+) ', 1) AS "method",
  regexp_extract(value, '"(?:\w+) (.*?) HTTP', 1) AS url,
  regexp_extract(value, 'HTTP/\d\.\d', 0) AS protocol,
  TRY_CAST(string_split(value, ' ')[9] AS INTEGER) AS status,
  TRY_CAST(string_split(value, ' ')[10] AS INTEGER) AS "size" """

PARSED_SQL = f"{LINES_SQL}, parsed AS (SELECT {FIELDS_SQL} FROM lines)"

STATUS_COUNTS_SQL = f"""WITH {PARSED_SQL}
SELECT status, count(*) AS "count" FROM parsed GROUP BY status"""

ERROR_TRENDS_SQL = f"""WITH {PARSED_SQL}
SELECT time_bucket(INTERVAL 5 MINUTE, "timestamp") AS window_start,
       time_bucket(INTERVAL 5 MINUTE, "timestamp") + INTERVAL 5 MINUTE AS window_end,
       status, count(*) AS "count"
FROM parsed WHERE status IN (404, 500) GROUP BY ALL"""

POPULAR_PRODUCTS_SQL = rf"""WITH {PARSED_SQL}
SELECT date_trunc('day', "timestamp") AS window_start,
       date_trunc('day', "timestamp") + INTERVAL 1 DAY AS window_end,
       regexp_extract(url, 'id=(\d+)', 1) AS product_id, count(*) AS "count"
FROM parsed WHERE regexp_extract(url, 'id=(\d+)', 1) <> ''
GROUP BY ALL HAVING count(*) > {PRODUCT_THRESHOLD}"""

SUSPICIOUS_IPS_SQL = f"""WITH {PARSED_SQL}
SELECT date_trunc('day', "timestamp") AS window_start,
       date_trunc('day', "timestamp") + INTERVAL 1 DAY AS window_end, ip, count(*) AS "count"
FROM parsed GROUP BY ALL HAVING count(*) > {CLIENT_THRESHOLD}"""


def parsed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.parse(access_lines(table(spark, sf_dir, "events")))


@query("log_parse", f"WITH {MESSY_SQL} SELECT event_id, {FIELDS_SQL} FROM messy")
def log_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = messy_lines(table(spark, sf_dir, "events"))
    messages = logs.decode(lines.withColumn("value", text.utf8(F.col("value"))))
    return logs.parse(messages, keep=("event_id",)).withColumn("timestamp", utc(F.col("timestamp")))


@query(
    "log_clean",
    rf"""WITH {DOCUMENT_LINES_SQL},
trimmed AS (SELECT doc_id, line_no, regexp_replace(regexp_replace(value, '^\s+', ''), '\s+$', '') AS value
            FROM document_lines)
SELECT doc_id, line_no, value,
       CASE WHEN length(value) > 100 THEN substr(value, 1, 100) || '...' ELSE value END AS preview,
       strlen(value) AS n_bytes
FROM trimmed WHERE value <> ''""",
)
def log_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = logs.clean(document_lines(table(spark, sf_dir, "documents")))
    return cleaned.select(
        "doc_id",
        "line_no",
        "value",
        text.preview(F.col("value")).alias("preview"),
        F.octet_length(text.utf8(F.col("value"))).cast("bigint").alias("n_bytes"),
    )


@query(
    "log_classify",
    rf"""WITH {MESSY_SQL}, {DOCUMENT_LINES_SQL},
tested AS (SELECT *, regexp_matches(value, '{fixed.ACCESS_LINE}') AS is_access,
                  coalesce(TRY_CAST(nullif(regexp_extract(value, '" (\d+) ', 1), '') AS BIGINT), 0) AS line_status
           FROM (SELECT event_id AS line_key, value FROM messy
                 UNION ALL SELECT -1 - doc_id, value FROM document_lines))
SELECT line_key, is_access, line_status,
       CASE WHEN NOT is_access THEN 'raw' WHEN line_status >= 500 THEN 'server_error'
            WHEN line_status >= 400 THEN 'client_error' WHEN line_status >= 300 THEN 'redirect'
            WHEN line_status >= 200 THEN 'success' ELSE 'other' END AS band,
       CASE WHEN length(value) > 100 THEN substr(value, 1, 100) || '...' ELSE value END AS preview
FROM tested""",
)
def log_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    access = messy_lines(table(spark, sf_dir, "events")).select(F.col("event_id").alias("line_key"), "value")
    other = document_lines(table(spark, sf_dir, "documents")).select((-1 - F.col("doc_id")).alias("line_key"), "value")
    return (
        logs.classify(access.unionAll(other))
        .withColumn("line_status", F.col("line_status").cast("bigint"))
        .drop("value")
    )


@query("status_counts", STATUS_COUNTS_SQL)
def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_metrics.status_counts(parsed_lines(spark, sf_dir))


@query("error_trends", ERROR_TRENDS_SQL)
def error_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_metrics.flat_window(log_metrics.error_trends(parsed_lines(spark, sf_dir)))


@query("popular_products", POPULAR_PRODUCTS_SQL)
def popular_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = log_metrics.popular_products(parsed_lines(spark, sf_dir), width="1 day", threshold=PRODUCT_THRESHOLD)
    return log_metrics.flat_window(counts)


@query("suspicious_ips", SUSPICIOUS_IPS_SQL)
def suspicious_ips(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = log_metrics.suspicious_ips(parsed_lines(spark, sf_dir), width="1 day", threshold=CLIENT_THRESHOLD)
    return log_metrics.flat_window(counts)
