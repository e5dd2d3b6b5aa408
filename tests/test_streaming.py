"""Streams: late data, restart, replay, failure, and equality with the batch result."""

import os
import threading

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tidemark.operators import log_metrics, logs
from tidemark.sources.streams import folder_lines, table_stream
from tidemark.streaming import runner, sinks

NOW = {"availableNow": True}
ERRORS = "window_start timestamp_ntz, window_end timestamp_ntz, status int, count bigint"


def access(time, status, ip="1.1.1.1", url="/"):
    return f'{ip} - - [01/Jan/2024:{time} +0000] "GET {url} HTTP/1.1" {status} 1'


def put(folder, name, lines):
    folder.mkdir(exist_ok=True)
    path = folder / name
    path.write_text("\n".join(lines) + "\n")
    # The source takes files in order of their time.
    order = len(list(folder.iterdir()))
    os.utime(path, (1_700_000_000 + order, 1_700_000_000 + order))


def run_errors(spark, folder, files_per_batch=1):
    parsed = logs.parse(folder_lines(spark, str(folder / "in"), files_per_batch))
    trends = log_metrics.flat_window(log_metrics.error_trends(parsed))
    queries = runner.start({"errors": trends}, str(folder / "sink"), str(folder / "checkpoint"), NOW)
    runner.await_all(queries)
    return queries[0]


def epochs(spark, folder):
    rows = spark.read.parquet(str(folder / "sink" / "errors")).collect()
    found = {}
    for r in rows:
        found.setdefault(r.epoch_id, set()).add((f"{r.window_start:%H:%M}", r.status, r["count"]))
    return found


LATE = [
    [access("00:01:00", 404), access("00:02:00", 404), "junk"],
    [access("00:03:00", 404), access("00:06:00", 500)],
    [access("00:20:00", 200), access("00:20:01", 404)],
    [access("00:01:30", 404), access("00:20:02", 404)],
    [access("00:01:45", 404), access("00:20:03", 404)],
]


def test_late_data(spark, tmp_path):
    for i, lines in enumerate(LATE):
        put(tmp_path / "in", f"{i}.log", lines)
    query = run_errors(spark, tmp_path)
    assert epochs(spark, tmp_path) == {
        0: {("00:00", 404, 2)},
        1: {("00:00", 404, 3), ("00:05", 500, 1)},
        2: {("00:20", 404, 1)},
        3: {("00:00", 404, 4), ("00:20", 404, 2)},
        4: {("00:20", 404, 3)},
    }
    dropped = sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])
    assert dropped == 1
    keys = ["window_start", "window_end", "status"]
    view = sinks.latest_view(spark, str(tmp_path / "sink" / "errors"), keys, ERRORS)
    assert {(f"{r.window_start:%H:%M}", r["count"]) for r in view.collect()} == {("00:00", 4), ("00:05", 1), ("00:20", 3)}


def test_restart_goes_on_from_the_checkpoint(spark, tmp_path):
    for i in (0, 1):
        put(tmp_path / "in", f"{i}.log", LATE[i])
    run_errors(spark, tmp_path)
    put(tmp_path / "in", "2.log", LATE[2])
    run_errors(spark, tmp_path)
    found = epochs(spark, tmp_path)
    assert found[1] == {("00:00", 404, 3), ("00:05", 500, 1)}
    assert set.union(*found.values()) >= {("00:20", 404, 1)}
    assert sum(("00:00", 404, 2) in rows for rows in found.values()) == 1


def test_replayed_epoch_overwrites(spark, tmp_path):
    write = sinks.epoch_writer(str(tmp_path / "sink"))
    batch = spark.createDataFrame([(404, 3)], "status int, count bigint")
    write(batch, 7)
    write(batch, 7)
    assert spark.read.parquet(str(tmp_path / "sink")).count() == 1


def test_empty_epoch_writes_nothing(spark, tmp_path):
    sinks.epoch_writer(str(tmp_path / "sink"))(spark.createDataFrame([], "status int, count bigint"), 0)
    assert not (tmp_path / "sink").exists()
    view = sinks.latest_view(spark, str(tmp_path / "sink"), ["status"], "status int, count bigint", may_be_empty=True)
    assert view.count() == 0
    with pytest.raises(AnalysisException):
        sinks.latest_view(spark, str(tmp_path / "sink"), ["status"], "status int, count bigint")


def test_sink_failure_fails_the_query(spark, tmp_path):
    put(tmp_path / "in", "0.log", LATE[0])

    def broken(name):
        def write(batch, epoch_id):
            raise RuntimeError("sink is down")

        return write

    counts = log_metrics.status_counts(logs.parse(folder_lines(spark, str(tmp_path / "in"))))
    queries = runner.start({"status": counts}, "unused", str(tmp_path / "checkpoint"), NOW, writer=broken)
    with pytest.raises(Exception, match="sink is down"):
        runner.await_all(queries)
    assert not any(q.isActive for q in queries)


def test_four_named_queries_equal_batch(spark, tmp_path):
    lines = [access(f"00:00:{i % 60:02d}", 404 if i % 5 == 0 else 200, "9.9.9.9", "/p?id=3") for i in range(150)]
    lines += [access(f"00:01:{i % 60:02d}", 500, f"2.2.2.{i % 7}", f"/p?id={i % 11}") for i in range(90)] + ["junk", ""]
    put(tmp_path / "in", "0.log", lines)
    parsed = logs.parse(folder_lines(spark, str(tmp_path / "in")))
    queries = runner.start_log_metrics(parsed, str(tmp_path / "sink"), str(tmp_path / "checkpoint"), NOW)
    assert {q.name for q in queries} == set(log_metrics.LOG_METRICS)
    runner.await_all(queries)
    batch = logs.parse(spark.read.text(str(tmp_path / "in")))
    for name, metric in log_metrics.LOG_METRICS.items():
        want = metric(batch)
        got = spark.read.schema(want.schema).parquet(str(tmp_path / "sink" / name)).drop("epoch_id")
        assert want.count() > 0
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_publish_sends_cleaned_bytes(spark, tmp_path):
    put(tmp_path / "in", "0.log", ["  a é ", "", "\t", "b"])
    lines = logs.clean(folder_lines(spark, str(tmp_path / "in")))
    query = sinks.publish(lines, str(tmp_path / "checkpoint"), "parquet", NOW, path=str(tmp_path / "topic"))
    runner.await_all([query])
    sent = spark.read.parquet(str(tmp_path / "topic"))
    assert dict(sent.dtypes) == {"value": "binary"}
    assert sorted(bytes(r.value).decode() for r in sent.collect()) == ["a é", "b"]


def test_interrupt_stops_all(spark, tmp_path):
    put(tmp_path / "in", "0.log", LATE[0])
    counts = log_metrics.status_counts(logs.parse(folder_lines(spark, str(tmp_path / "in"))))
    queries = runner.start({"open_end": counts}, str(tmp_path / "sink"), str(tmp_path / "checkpoint"))
    queries[0].processAllAvailable()
    assert queries[0].isActive
    runner.stop(queries)
    assert not queries[0].isActive


def test_table_stream(spark, tmp_path):
    spark.range(10).write.parquet(str(tmp_path / "t"))
    stream = table_stream(spark, str(tmp_path / "t"), "id bigint", 1)
    assert stream.isStreaming
    counts = stream.groupBy((F.col("id") % 2).alias("odd")).count()
    runner.await_all(runner.start({"odd": counts}, str(tmp_path / "sink"), str(tmp_path / "cp"), NOW))
    view = sinks.latest_view(spark, str(tmp_path / "sink" / "odd"), ["odd"], "odd bigint, count bigint")
    assert {r.odd: r["count"] for r in view.collect()} == {0: 5, 1: 5}


def rate(spark):
    return spark.readStream.format("rate").load().groupBy("value").count()


def test_queries_that_ended_before_do_not_stop_new_ones(spark, tmp_path):
    put(tmp_path / "in", "a", [access("00:00:01", 404)])
    parsed = logs.parse(folder_lines(spark, str(tmp_path / "in"), 1))
    counts = {"first": log_metrics.error_trends(parsed)}
    runner.await_all(runner.start(counts, str(tmp_path / "s"), str(tmp_path / "c"), NOW))
    running = runner.start({"second": rate(spark)}, str(tmp_path / "s2"), str(tmp_path / "c2"))
    seen = []

    def later():
        seen.append(running[0].isActive)
        running[0].stop()

    timer = threading.Timer(3, later)
    timer.start()
    runner.run_until_stopped(running, 0.2)
    assert seen == [True] and not running[0].isActive


def test_no_query_stays_if_a_later_one_cannot_start(spark, tmp_path):
    names = {"one": rate(spark), "two": spark.range(3).groupBy("id").count()}
    with pytest.raises(AnalysisException):
        runner.start(names, str(tmp_path / "s"), str(tmp_path / "c"))
    assert not spark.streams.active


def test_replayed_epoch_of_a_collection_has_the_same_ids(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), (None, 2)], "k string, count int")
    write = sinks.collection_writer("c", ["k"], fmt="parquet", path=str(tmp_path / "c"))
    for epoch in (0, 0, 1):
        write(rows, epoch)
    assert spark.read.parquet(str(tmp_path / "c")).select("_id").distinct().count() == 4


def test_view_is_the_same_after_compaction(spark, tmp_path):
    write, schema = sinks.epoch_writer(str(tmp_path / "a")), "k string, count bigint"
    for epoch, rows in enumerate([[("x", 1), ("y", 1)], [("x", 3)], [("z", 2)]]):
        write(spark.createDataFrame(rows, schema), epoch)
    before = sorted(map(tuple, sinks.latest_view(spark, str(tmp_path / "a"), ["k"], schema).collect()))
    assert sinks.compact(spark, str(tmp_path / "a"), str(tmp_path / "b"), ["k"], schema) == 2
    assert sorted(map(tuple, sinks.latest_view(spark, str(tmp_path / "b"), ["k"], schema).collect())) == before
    sinks.epoch_writer(str(tmp_path / "b"))(spark.createDataFrame([("x", 9)], schema), 3)
    assert ("x", 9) in map(tuple, sinks.latest_view(spark, str(tmp_path / "b"), ["k"], schema).collect())
