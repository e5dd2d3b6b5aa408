"""Run a registered query and its SQL on the same tables and compare the rows."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, float)):
        return "nan" if math.isnan(value) else float(value)
    return str(value)


def canonical(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=2e-6)
    return a == b


def check(spark, con, function, sql: str, sf_dir: str) -> tuple[int, float]:
    started = time.time()
    df = function(spark, sf_dir)
    columns, got = df.columns, [tuple(r) for r in df.collect()]
    seconds = time.time() - started
    result = con.execute(sql)
    names, want = [d[0] for d in result.description], result.fetchall()
    assert sorted(columns) == sorted(names), (columns, names)
    got, want = canonical(columns, got), canonical(names, want)
    assert len(got) == len(want), (len(got), len(want), got[:3], want[:3])
    for g, w in zip(got, want, strict=True):
        assert all(same(x, y) for x, y in zip(g, w, strict=True)), (g, w)
    exact = got == want
    return len(got), seconds if exact else -seconds


if __name__ == "__main__":
    import traceback

    sys.path.insert(0, ".")
    import __spark_entry__ as e
    from pyspark.sql import SparkSession

    sf = sys.argv[1]
    wanted = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    oracles = e.oracle_sql()
    for name, function in e.queries().items():
        if wanted and name not in wanted:
            continue
        try:
            if name in oracles:
                n, seconds = check(spark, con, function, oracles[name], sf)
                print(f"{name:28s} ok {'' if seconds > 0 else '(to tolerance)'} rows={n} {abs(seconds):.2f}s", flush=True)
            else:
                started = time.time()
                rows = function(spark, sf).collect()
                print(f"{name:28s} rows only n={len(rows)} {time.time() - started:.2f}s {rows[:3]}", flush=True)
        except Exception as error:
            text = str(error) or traceback.format_exc()
            print(f"{name:28s} FAIL {type(error).__name__} {text[:700]}", flush=True)
