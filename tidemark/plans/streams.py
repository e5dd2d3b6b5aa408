"""The log queries as streams: the events table is read as a stream of lines, parsed, counted and sunk."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import log_metrics, logs
from tidemark.plans import logs as batch
from tidemark.plans.inputs import access_lines, document_lines, table
from tidemark.plans.registry import query
from tidemark.session import scratch_path
from tidemark.sources.streams import folder_lines, table_stream
from tidemark.streaming.buckets import bucket_writer, current_view
from tidemark.streaming.runner import await_all, start
from tidemark.streaming.sinks import export, latest_view, publish
from tidemark.streaming.watch import Watch, state_counts

_EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
_WINDOW = "window_start timestamp_ntz, window_end timestamp_ntz"


def _replay(
    spark: SparkSession, sf_dir: str, name: str, metric: Callable[[DataFrame], DataFrame], key: str, key_type: str
) -> DataFrame:
    """Run one aggregate over the whole stream and return the sink's current view."""
    # A pattern, because a stream takes a single file only from one.
    parsed = logs.parse(access_lines(table_stream(spark, f"{sf_dir}/event[s].parquet", _EVENTS)))
    counts = metric(parsed)
    windowed = "window" in counts.columns
    folder = scratch_path(spark, name)
    aggregates = {name: log_metrics.flat_window(counts) if windowed else counts}
    await_all(start(aggregates, f"{folder}/sink", f"{folder}/checkpoint", {"availableNow": True}))
    keys = (["window_start", "window_end"] if windowed else []) + [key]
    schema = f"{_WINDOW}, {key} {key_type}" if windowed else f"{key} {key_type}"
    return latest_view(spark, f"{folder}/sink/{name}", keys, f"{schema}, count bigint", may_be_empty=True)


@query("stream_status_counts", batch.STATUS_COUNTS_SQL)
def stream_status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _replay(spark, sf_dir, "status_counts", log_metrics.status_counts, "status", "int")


@query("stream_error_trends", batch.ERROR_TRENDS_SQL)
def stream_error_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _replay(spark, sf_dir, "error_trends", log_metrics.error_trends, "status", "int")


@query("stream_popular_products", batch.POPULAR_PRODUCTS_SQL)
def stream_popular_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    def metric(parsed: DataFrame) -> DataFrame:
        return log_metrics.popular_products(parsed, width="1 day", threshold=batch.PRODUCT_THRESHOLD)

    return _replay(spark, sf_dir, "popular_products", metric, "product_id", "string")


@query("stream_suspicious_ips", batch.SUSPICIOUS_IPS_SQL)
def stream_suspicious_ips(spark: SparkSession, sf_dir: str) -> DataFrame:
    def metric(parsed: DataFrame) -> DataFrame:
        return log_metrics.suspicious_ips(parsed, width="1 day", threshold=batch.CLIENT_THRESHOLD)

    return _replay(spark, sf_dir, "suspicious_ips", metric, "ip", "string")


@query(
    "stream_publish",
    rf"""WITH {batch.DOCUMENT_LINES_SQL},
trimmed AS (SELECT regexp_replace(regexp_replace(value, '^\s+', ''), '\s+$', '') AS value FROM document_lines)
SELECT value, count(*) AS n FROM trimmed WHERE value <> '' GROUP BY value""",
)
def stream_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log files to topic: text files appear in a folder, their lines are cleaned and published as bytes."""
    folder = scratch_path(spark, "publish")
    document_lines(table(spark, sf_dir, "documents")).select("value").write.text(f"{folder}/logs")
    lines = logs.clean(folder_lines(spark, f"{folder}/logs"))
    await_all(
        [publish(lines, f"{folder}/checkpoint", "parquet", {"availableNow": True}, path=f"{folder}/topic")]
    )
    sent = logs.decode(spark.read.schema("value binary").parquet(f"{folder}/topic"))
    return sent.groupBy("value").agg(F.count(F.lit(1)).alias("n"))


def _lines_of(spark: SparkSession, folder: str) -> DataFrame:
    """The lines of a folder of events that grows, as a stream."""
    return logs.parse(access_lines(spark.readStream.schema(_EVENTS).parquet(folder)))


def _append(events: DataFrame, folder: str) -> None:
    events.write.mode("append").parquet(folder)


def _twice(spark: SparkSession, folder: str, events: DataFrame, parts: list[Column], metric, writer) -> Watch:
    """Run a metric over a folder of events to its end, once per part that is added: a stop and a restart in between."""
    watch = Watch()
    spark.streams.addListener(watch)
    try:
        for part in parts:
            _append(events.where(part), f"{folder}/events")
            counts = metric(_lines_of(spark, f"{folder}/events"))
            queries = start({"counts": counts}, folder, f"{folder}/checkpoint", {"availableNow": True}, lambda _: writer)
            await_all(queries)
            watch.settled(queries)
    finally:
        spark.streams.removeListener(watch)
    return watch


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(*[c.split()[0] for c in _EVENTS.split(", ")])


def _halves() -> list[Column]:
    return [F.col("event_id") % 2 == 0, F.col("event_id") % 2 != 0]


@query("stream_bucketed_view", batch.STATUS_COUNTS_SQL)
def stream_bucketed_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status counts before and after a restart into the sink with manifests: one row per key in its view."""
    folder = scratch_path(spark, "buckets")
    writer = bucket_writer(f"{folder}/sink", ["status"])
    _twice(spark, folder, _events(spark, sf_dir), _halves(), log_metrics.status_counts, writer)
    return current_view(spark, f"{folder}/sink", "status int, count bigint")


@query("stream_recovered_state", batch.STATUS_COUNTS_SQL)
def stream_recovered_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status counts as the state of a query holds them that was stopped after half of the events and started again."""
    folder = scratch_path(spark, "recovered")
    writer = bucket_writer(f"{folder}/sink", ["status"])
    _twice(spark, folder, _events(spark, sf_dir), _halves(), log_metrics.status_counts, writer)
    return state_counts(spark, f"{folder}/checkpoint/counts")


_LATE_SQL = f"""WITH {batch.PARSED_SQL},
errors AS (SELECT event_id, "timestamp" AS t, time_bucket(INTERVAL 5 MINUTE, "timestamp") AS w, status
           FROM (SELECT event_id, {batch.FIELDS_SQL} FROM lines) WHERE status IN (404, 500)),
middle AS (SELECT date_trunc('day', make_timestamp((epoch_us(min(ts)) + epoch_us(max(ts))) // 2)) AS middle FROM events),
mark AS (SELECT max(t) - INTERVAL 5 MINUTE AS mark FROM errors, middle WHERE t >= middle),
late AS (SELECT w, status FROM errors, middle, mark WHERE t < middle AND w + INTERVAL 5 MINUTE <= mark)
SELECT (SELECT count(*) FROM errors) - (SELECT count(*) FROM late) AS n_rows_kept,
       (SELECT count(*) FROM (SELECT DISTINCT w, status FROM late)) AS n_groups_dropped, 0 AS n_failed"""


@query("stream_late_rows", _LATE_SQL)
def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error trends of a replay whose older half comes last: what is kept, and what the watermark drops."""
    folder, events = scratch_path(spark, "late"), _events(spark, sf_dir)
    ends = events.agg(F.min("ts").alias("first"), F.max("ts").alias("last")).first()
    middle = (ends["first"] + (ends["last"] - ends["first"]) / 2).replace(hour=0, minute=0, second=0, microsecond=0)
    cut = F.lit(middle.isoformat(sep=" ")).cast("timestamp_ntz")
    keys = ["window_start", "window_end", "status"]
    writer = bucket_writer(f"{folder}/sink", keys)

    def metric(parsed: DataFrame) -> DataFrame:
        return log_metrics.flat_window(log_metrics.error_trends(parsed))

    watch = _twice(spark, folder, events, [F.col("ts") >= cut, F.col("ts") < cut], metric, writer)
    kept = current_view(spark, f"{folder}/sink", f"{_WINDOW}, status int, count bigint")
    return kept.agg(F.sum("count").alias("n_rows_kept")).select(
        "n_rows_kept",
        F.lit(watch.dropped["counts"]).cast("bigint").alias("n_groups_dropped"),
        F.lit(len(watch.errors)).alias("n_failed"),
    )


@query("export_refusal", "SELECT count(*) AS n_exported, true AS empty_refused FROM events WHERE event_type = 'error'")
def export_refusal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The guard of the export: results are written, no results are refused."""
    found, refused = table(spark, sf_dir, "events").where("event_type = 'error'"), False
    path = export(found, scratch_path(spark, "errors"))
    try:
        export(found.where("event_id IS NULL"), scratch_path(spark, "nothing"))
    except ValueError:
        refused = True
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n_exported")).withColumn("empty_refused", F.lit(refused))
