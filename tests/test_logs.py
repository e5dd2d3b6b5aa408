"""Line expressions against the golden rows and against Python's own functions."""

import datetime
import re

import pytest
from pyspark.sql import functions as F

from tidemark import fixed_values as fixed
from tidemark.functions import logline, text
from tidemark.functions.numbers import utc
from tidemark.operators import log_metrics, logs

GOLDEN = [
    (
        '1.2.3.4 - - [01/Jan/2024:00:00:07 +0000] "GET /p?id=12 HTTP/1.1" 404 123',
        ("1.2.3.4", "2024-01-01 00:00:07", "GET", "/p?id=12", "HTTP/1.1", 404, 123),
    ),
    ("garbage line", ("garbage", None, "", "", "", None, None)),
    ("", ("", None, "", "", "", None, None)),
    (
        '1.2.3.4 - - [01/Jan/2024:00:00:07 +0200] "GET /a b HTTP/1.1" 200 -',
        ("1.2.3.4", "2023-12-31 22:00:07", "GET", "/a b", "HTTP/1.1", None, 200),
    ),
    ('::1 - - [bad] "POST /x HTTP/2" 500 7', ("::1", None, "POST", "/x", "", 7, None)),
    (
        '1.2.3.4 - - [01/Jan/2024:00:00:07 +0000] "GET /x HTTP/1.1" 200.5 9',
        ("1.2.3.4", "2024-01-01 00:00:07", "GET", "/x", "HTTP/1.1", None, 9),
    ),
]

LINES = [line for line, _ in GOLDEN] + [
    'h - bob [01/Jan/2024:00:00:07 +0000] "GET / HTTP/1.1" 200 5',
    'h - - [01/Jan/2024:00:00:07 +0000] "GET / HTTP/1.1" 200 -',
    'h - - [01/Jan/2024:00:00:07 +0000] "GET / HTTP/1.1" 200 5 "ref" "agent"',
    'h - - [01/Jan/2024:00:00:07 +0000] "GÉT /é HTTP/1.1" 301 5',
    'h - - [01/Jan/2024:00:00:07 +0000] "GET / x HTTP/1.1" 503 5',
    'h - - [01/Jan/2024:00:00:07 +0000] "GET / HTTP/1.1" 99 5',
    'h - - [01/Jan/2024:00:00:07 +0000] "GET / HTTP/1.1" 99999999999999999999 5',
    'h - - [1/Jan/2024:00:00:07 +0000] "GET / HTTP/1.1" 200 5',
    "x" * 100,
    "y" * 101,
    "é" * 150,
]


def frame(spark, lines):
    return spark.createDataFrame([(line,) for line in lines], "value string")


def test_golden_rows(spark):
    messages = frame(spark, [line for line, _ in GOLDEN]).select(text.utf8(F.col("value")).alias("value"))
    parsed = logs.parse(logs.decode(messages), keep=("value",))
    rows = parsed.withColumn("timestamp", utc(F.col("timestamp")).cast("string")).collect()
    got = {r.value: tuple(r)[1:] for r in rows}
    assert got == dict(GOLDEN)


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Kolkata"])
def test_session_zone_does_not_matter(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        counts = log_metrics.flat_window(log_metrics.error_trends(logs.parse(frame(spark, [GOLDEN[0][0]]))))
        assert counts.first().window_start == datetime.datetime(2024, 1, 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def expected_class(line):
    if not re.match(fixed.ACCESS_LINE, line):
        return False, "raw"
    found = re.search(fixed.STATUS_AFTER_REQUEST, line)
    status = int(found.group(1)) if found else 0
    bands = ((500, "server_error"), (400, "client_error"), (300, "redirect"), (200, "success"))
    return True, next((band for least, band in bands if status >= least), "other")


def test_classify_like_python(spark):
    rows = logs.classify(frame(spark, LINES)).collect()
    assert len(rows) == len(LINES)
    for row in rows:
        assert (row.is_access, row.band) == expected_class(row.value), row.value
        assert row.preview == (row.value[:100] + "..." if len(row.value) > 100 else row.value)


def test_strip_like_python(spark):
    samples = ["  a b ", "\t x　", "\x1c\x1d y\x85", "​z​", "", " \n ", "é è", "  q"]
    rows = frame(spark, samples).select("value", text.strip(F.col("value")).alias("s")).collect()
    assert [r.s for r in rows] == [r.value.strip() for r in rows]
    assert logs.clean(frame(spark, samples)).count() == sum(1 for s in samples if s.strip())


def test_lines_of_any_ending(spark):
    rows = frame(spark, ["a\r\nb\rc\nd"]).select(text.lines(F.col("value")).alias("l")).first()
    assert rows.l == ["a", "b", "c", "d"]


def access(ip, second, url="/", status=200):
    return f'{ip} - - [01/Jan/2024:00:00:{second:02d} +0000] "GET {url} HTTP/1.1" {status} 1'


def test_thresholds_are_strict(spark):
    lines = [access("a", i % 60, "/p?id=7") for i in range(21)] + [access("b", i % 60, "/p?id=8") for i in range(20)]
    parsed = logs.parse(frame(spark, lines))
    assert [(r.product_id, r["count"]) for r in log_metrics.popular_products(parsed).collect()] == [("7", 21)]
    busy = logs.parse(frame(spark, [access("a", i % 60) for i in range(101)] + [access("b", i % 60) for i in range(100)]))
    assert [(r.ip, r["count"]) for r in log_metrics.suspicious_ips(busy).collect()] == [("a", 101)]


def test_product_id_is_unanchored(spark):
    lines = [access("a", i % 60, "/p?userid=55&id=9") for i in range(21)]
    row = log_metrics.popular_products(logs.parse(frame(spark, lines))).first()
    assert row.product_id == "55"


def test_hot_client_is_counted_whole(spark):
    ids = spark.range(0, 90_000, numPartitions=8)
    ip = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), (F.col("id") % 5000).cast("string")))
    line = F.concat(ip, F.lit(' - - [01/Jan/2024:00:00:01 +0000] "GET / HTTP/1.1" 200 1'))
    counts = log_metrics.suspicious_ips(logs.parse(ids.select(line.alias("value"))))
    assert [(r.ip, r["count"]) for r in counts.collect()] == [("hot", 30_000)]


def test_hours_that_a_session_zone_repeats_stay_apart(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql("SELECT explode(array(timestamp'2024-11-03 05:30:00Z', timestamp'2024-11-03 06:30:00Z')) AS t")
        got = [r.t for r in df.select(utc(F.col("t")).cast("string").alias("t")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == ["2024-11-03 05:30:00", "2024-11-03 06:30:00"]


def test_status_of_any_length(spark):
    line = '1.1.1.1 - - [01/Jan/2024:00:00:07 +0000] "GET / HTTP/1.1" {} 5'
    statuses = ["9" * 40, "0" * 50 + "404", "7", "200"]
    df = frame(spark, [line.format(s) for s in statuses])
    got = [r.s for r in df.select(logline.severity(F.col("value")).alias("s")).collect()]
    assert got == ["server_error", "client_error", "other", "success"]
