import hashlib
import random

import numpy as np
import pytest

from tidemark.llm.clustering import centroid_clusters, centroid_digest

CLASHING = "1 AS v, 2 AS cluster, 3 AS distance, 4 AS n, 5 AS s0, 6 AS best, 7 AS centroid".split(", ")
NAN, INF = float("nan"), float("inf")


def brute(rows, clusters, rounds, width, scale=64):
    kept = [
        (i, tuple(int(np.floor(scale * float(np.float32(x)))) for x in v))
        for i, v in rows
        if v is not None and len(v) == width and all(x is not None and np.isfinite(x) for x in v)
    ]
    seeds = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    centroids = [v for _, v in seeds[:clusters]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), k) for k, c in enumerate(centroids))

    for _ in range(rounds):
        parts = [[v for _, v in kept if near(v)[1] == k] for k in range(len(centroids))]
        centroids = [
            tuple(sum(col) // len(p) for col in zip(*p, strict=True)) if p else c
            for p, c in zip(parts, centroids, strict=True)
        ]
    best = [(i, *near(v)) for i, v in kept] if centroids else [(i, None, None) for i, _ in kept]
    inertia = {k: sum(d for _, d, c in best if c == k) for _, _, k in best}
    total = sum(d or 0 for _, d, _ in best)
    return sorted(
        (
            (i, k, d, inertia[k], total, hashlib.sha256(",".join(map(str, centroids[k])).encode()).hexdigest())
            if k is not None
            else (i, None, None, None, None, None)
            for i, d, k in best
        ),
        key=repr,
    )


def run(spark, rows, **settings):
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").selectExpr("*", *CLASHING)
    found = centroid_clusters(table, **settings)
    columns = ("vec_id", "cluster", "distance", "cluster_inertia", "inertia")
    return sorted((tuple(r) for r in found.select(*columns, centroid_digest()).collect()), key=repr)


@pytest.mark.parametrize("rounds", [0, 3])
def test_same_as_brute_force(spark, rounds):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(i % 7, 0.3) for _ in range(6)]) for i in range(300)]
    rows += [(1000 + i, [0.25] * 6) for i in range(200)]
    assert run(spark, rows, clusters=9, rounds=rounds, width=6) == brute(rows, 9, rounds, 6)


def test_odd_rows(spark):
    rows = [
        (1, [0.5, -0.01]), (1, [0.5, -0.01]), (1, [4.0, 4.0]), (2, None), (3, []), (4, [1.0]), (5, [1.0, 2.0, 3.0]),
        (6, [None, 1.0]), (7, [NAN, 1.0]), (8, [INF, 1.0]), (9, [-INF, 1.0]), (None, [9.0, 9.0]), (10, [-0.015, 0.0]),
    ]
    got = run(spark, rows, clusters=3, width=2)
    assert got == brute(rows, 3, 3, 2)
    assert sorted(r[0] for r in got if r[0]) == [1, 1, 1, 10]
    # fewer vectors than centroids
    assert run(spark, rows, clusters=40, width=2) == brute(rows, 40, 3, 2)


def test_equal_centroids_and_an_empty_cluster(spark):
    rows = [(i, [1.0, 1.0]) for i in range(20)] + [(100, [2.0, 1.0])]
    got = run(spark, rows, clusters=21, width=2)
    assert got == brute(rows, 21, 3, 2)
    assert len({r[1] for r in got}) < 21


def test_nothing_usable(spark):
    assert run(spark, [], width=2) == []
    assert run(spark, [(1, None)], width=2) == []
    assert run(spark, [(None, [1.0, 1.0])], width=2) == [(None,) * 6]


def test_the_plan_has_no_python(spark):
    table = spark.createDataFrame([(1, [1.0, 1.0])], "vec_id bigint, embedding array<float>")
    plan = centroid_clusters(table, width=2)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
