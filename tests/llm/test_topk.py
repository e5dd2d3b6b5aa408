import math
import pickle
import random

import numpy as np
from tidemark.llm import topk
from tidemark.llm.topk import cover_tree, quantised, top_k


def brute(rows, is_query, k):
    vectors = {(i, tuple(v)) for i, v in rows}
    out = set()
    for q in sorted({x for x in vectors if is_query(x[0])}):
        scores = {(-sum(a * b for a, b in zip(q[1], v)), i) for i, v in vectors if i != q[0]}  # noqa: B905
        out |= {(q[0], n, i, -s) for n, (s, i) in enumerate(sorted(scores)[:k], 1)}
    return out


def test_same_as_brute_force_over_several_cells(spark, monkeypatch):
    monkeypatch.setattr(topk, "CELL_ROWS", 40)
    monkeypatch.setattr(topk, "QUERY_CELL_ROWS", 8)
    monkeypatch.setattr(topk, "PIVOTS", 4)
    rng = random.Random(4)
    centers = [[rng.randrange(-300, 300) for _ in range(8)] for _ in range(5)]
    rows = [(i, [c + rng.randrange(-20, 20) for c in centers[i % 5]]) for i in range(400)]
    rows += [(1000 + i, centers[0]) for i in range(150)] + [(2000 + i, [0] * 8) for i in range(30)]
    data = spark.createDataFrame(rows, "vec_id bigint, v array<bigint>")
    got = {tuple(r) for r in top_k(data.where("vec_id % 50 = 0"), data).collect()}
    assert got == brute(rows, lambda i: i % 50 == 0, 5)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, -0.001]), (1, [1.0, 1.0]), (2, None), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]), (6, [1.0]), (7, []),
            (None, [1.0, 1.0]), (1, [1.0, 1.0]), (50, [2.0, 2.0, 2.0])]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").selectExpr("*", "1 AS v", "2 AS score", "3 AS cell")
    data = quantised(table)
    whole = [(r["vec_id"], list(r["v"])) for r in data.collect()]
    assert sorted(whole) == [(0, [128, -1]), (1, [256, 256]), (1, [256, 256]), (6, [256]), (7, []), (50, [512, 512, 512])]
    got = {tuple(r) for r in top_k(data.where("vec_id % 50 = 0"), data).collect()}
    assert got == brute(whole, lambda i: i % 50 == 0, 5)
    assert top_k(data.limit(0), data).count() == 0 and top_k(data.limit(0), data.limit(0)).count() == 0
    assert top_k(data.where("vec_id = 0"), data.where("vec_id = 0")).count() == 0


def test_vectors_without_nearness_are_one_leaf():
    # small leaves prune nothing there, and a visit of two costs more than their products
    points = np.random.default_rng(6).integers(-60, 60, (4096, 64))
    assert len(cover_tree(points)["radius"]) == 1


def test_same_as_all_products_without_nearness(spark):
    rng = np.random.default_rng(7)
    whole = rng.integers(-60, 60, (20000, 16))
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(whole.tolist())], "vec_id bigint, v array<bigint>")
    got = {tuple(r) for r in top_k(rows.where("vec_id % 50 = 0"), rows).collect()}
    scores = whole[::50] @ whole.T
    scores[np.arange(400), np.arange(400) * 50] = -(1 << 40)
    order = np.lexsort((np.broadcast_to(np.arange(20000), scores.shape), -scores), axis=1)[:, :5]
    assert got == {(q * 50, n + 1, int(i), int(scores[q, i])) for q in range(400) for n, i in enumerate(order[q])}


def search_all(queries, data, k=5, ids=None):
    """One cell of queries against one of data, as rows of (score, id) per query."""
    def side(points, ids):
        return topk.Side(pickle.dumps({"tree": cover_tree(points), "v": points, "ids": ids}))

    q_ids = np.arange(len(queries)) + 10**6
    best = topk.Best(len(queries), k)
    own, other = side(queries, q_ids), side(data, np.arange(len(data)) if ids is None else ids)
    topk.dual_tree(own, other, best)
    found = {int(q): list(zip(best.score[i, : best.n[i]].tolist(), best.ids[i, : best.n[i]].tolist(), strict=True)) for i, q in enumerate(own.ids)}
    return [found[int(q)] for q in q_ids], own, other


def best_of(queries, data, k, ids):
    all_ = [[(sum(a * b for a, b in zip(q, v, strict=True)), int(i)) for v, i in zip(data.tolist(), ids, strict=True)] for q in queries.tolist()]
    return [sorted(set(s), key=lambda x: (-x[0], x[1]))[:k] for s in all_]


def test_products_of_any_size_are_exact():
    rng = np.random.default_rng(3)
    # single precision, double precision, 64 bits, and beyond
    for scale, kind in ((100, np.float32), (10**5, np.float64), (2 * 10**8, np.int64), (12 * 10**8, object)):
        queries, data = rng.integers(-scale, scale, (20, 12)), rng.integers(-scale, scale, (700, 12))
        got, own, other = search_all(queries, data)
        assert topk._type_of(own.longest, other.longest) is kind
        assert got == best_of(queries, data, 5, range(700))


def test_equal_candidates_do_not_push_others_out():
    rng = np.random.default_rng(5)
    data = rng.integers(-50, 50, (300, 4))
    # one id many times with one score, and few ids in all
    ids = np.where(np.arange(300) < 280, 7, np.arange(300))
    data[:280, 0], data[:280, 1:] = 50, 0
    queries = np.array([[90, 1, 0, 0], [1, 0, 0, 0], [-1, 3, 2, 1]])
    assert search_all(queries, data, ids=ids)[0] == best_of(queries, data, 5, ids)


def test_near_groups_are_pruned(monkeypatch):
    monkeypatch.setattr(topk, "LEAF", 32)
    monkeypatch.setattr(topk, "LEAST_CHILD", 8)
    rng = np.random.default_rng(2)
    data = np.concatenate([rng.integers(-3, 3, (200, 8)) + c for c in rng.integers(-400, 400, (20, 8))])
    tree = cover_tree(data)
    assert len(tree["radius"]) > 20
    assert search_all(data[::100], data)[0] == best_of(data[::100], data, 5, range(4000))


def test_cover_tree_covers():
    points = np.random.default_rng(1).integers(-200, 200, (500, 6))
    tree = cover_tree(points)
    assert sorted(tree["order"].tolist()) == list(range(500))
    for i in range(len(tree["radius"])):
        own = points[tree["order"][tree["begin"][i] : tree["end"][i]]]
        away = np.sqrt(((own - tree["center"][i]) ** 2).sum(axis=1)).max(initial=0)
        assert math.isclose(away, tree["radius"][i], abs_tol=1e-9)
        children = range(tree["first"][i], tree["last"][i])
        assert not children or sum(tree["end"][c] - tree["begin"][c] for c in children) == len(own)
