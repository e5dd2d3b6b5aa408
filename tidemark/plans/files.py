"""File scans and exports: whole tables written to a new folder and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import reports
from tidemark.plans.evaluation import REPORT_TIME, SCORE_ROWS_SQL, SUMMARY_SQL
from tidemark.plans.inputs import scored_users, table
from tidemark.plans.registry import query
from tidemark.session import scratch_path
from tidemark.sources.files import read_csv, read_table, require_columns
from tidemark.streaming.sinks import export

_EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


@query("scan_csv", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def scan_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    path = export(rows, scratch_path(spark, "events") + ".csv", "csv")
    return require_columns(read_csv(spark, path, _EVENTS), ["event_id", "user_id", "event_type"])


@query("scan_csv_texts", "SELECT doc_id, text, lang FROM documents")
def scan_csv_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with quotes, commas and line breaks, written as CSV and read back."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    path = export(rows, scratch_path(spark, "texts") + ".csv", "csv")
    return read_csv(spark, path, "doc_id bigint, text string, lang string", multi_line=True)


@query(
    "scan_by_format",
    "SELECT f AS file_format, customer.* FROM customer, (VALUES ('csv'), ('json'), ('parquet'), ('orc')) AS v(f)",
)
def scan_by_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer")
    parts = []
    for fmt in ("csv", "json", "parquet", "orc"):
        path = export(rows, scratch_path(spark, "customer") + f".{fmt}", fmt)
        parts.append(read_table(spark, path, rows.schema).select(F.lit(fmt).alias("file_format"), "*"))
    return parts[0].unionAll(parts[1]).unionAll(parts[2]).unionAll(parts[3])


@query("export_results", SCORE_ROWS_SQL)
def export_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = reports.score_rows(scored_users(table(spark, sf_dir, "events")))
    path = export(rows, scratch_path(spark, "results") + ".parquet")
    return read_table(spark, path)


@query("export_summary", SUMMARY_SQL)
def export_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    moment = F.lit(REPORT_TIME).cast("timestamp_ntz")
    rows = reports.summary_table(scored_users(table(spark, sf_dir, "events")), "analyst", moment)
    path = export(rows, scratch_path(spark, "summary") + ".csv", "csv")
    return read_table(spark, path, "position int, information string, value string")
