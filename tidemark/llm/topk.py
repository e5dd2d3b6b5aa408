"""Exact top-k by inner product: a dual-tree search over cover trees of queries and data.

Vectors are dealt to cells of bounded size, near ones together, and each cell builds a cover tree: every node has a
center and a covering radius, a child's radius is smaller by ``BASE``, and children keep their distance. Queries are
indexed the same way. For a pair of nodes with centers q, p and radii r, s no inner product exceeds
``q.p + r|p| + s|q| + r s``; a pair is pruned if that is below the worst kth score of the query node. The same bound
prunes whole pairs of cells: first every query cell searches the data cell with the best bound, which gives it a worst
kth score, and then only the data cells whose bound reaches that score.

Where no bound helps, every product is computed, so these must be cheap: a task holds a group of query cells and a slice
of the data cells, and reads each of both once; the products of two leaves are one matrix product, in single precision
where whole numbers stay exact in it; and only the scores that reach the kth one leave it.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import cut_lineage

# Pivots are drawn from this many vectors at most; every vector is dealt to its nearest pivot.
PIVOTS = 64
CELL_ROWS = 4096
QUERY_CELL_ROWS = 512
# Bytes of query cells and of data cells that one task of the search holds; slices are smaller where cores would be idle.
GROUP_BYTES = 1 << 24
SLICE_BYTES = 1 << 26
LEAST_SLICE_BYTES = 1 << 22
BASE = 1.4
# A node of at most LEAF rows, or whose children would have fewer than LEAST_CHILD rows on average, is a leaf: the
# products of two smaller leaves cost less than the visit.
LEAF = 256
LEAST_CHILD = 64
# Columns of a block of scores, which is to stay in a core's cache.
BLOCK = 2048
# Data cells whose bounds one task computes for a query cell.
SHELF_CELLS = 64
# Room for rounding in bounds that are compared with whole numbers.
SLACK = 1e-6


def quantised(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """``vec_id``, ``v``: floor(scale * x) of each component. Null vectors, and those with a null or non-finite
    component, are left out."""
    x = F.transform("embedding", lambda c: F.floor(c.cast("double") * scale))
    bad = F.exists("embedding", lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf")))
    return vectors.where(F.col("embedding").isNotNull() & F.col("vec_id").isNotNull() & ~bad).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), x.alias("v")
    )


_PACKED = "vec_id bigint, width int, bytes tinyint, v binary"


def _packed(vectors: DataFrame) -> DataFrame:
    """``vec_id``, ``width`` and the components as whole numbers of as few ``bytes`` as the vector needs: equal vectors are
    equal bytes."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lists = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            widths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            begins = np.cumsum(widths) - widths
            for width in np.unique(widths).tolist():
                rows = np.flatnonzero(widths == width)
                values = flat[begins[rows][:, None] + np.arange(width)]
                low, high = values.min(axis=1, initial=0), values.max(axis=1, initial=0)
                sizes = np.full(len(rows), 8, np.int8)
                for size in (4, 2, 1):
                    limits = np.iinfo(f"<i{size}")
                    sizes[(low >= limits.min) & (high <= limits.max)] = size
                for size in np.unique(sizes).tolist():
                    own = np.flatnonzero(sizes == size)
                    data = np.ascontiguousarray(values[own].astype(f"<i{size}"))
                    ends = np.arange(len(own) + 1, dtype=np.int32) * (width * size)
                    cells = pa.BinaryArray.from_buffers(pa.binary(), len(own), [None, pa.py_buffer(ends), pa.py_buffer(data)])
                    columns = [
                        pa.array(ids[rows[own]], pa.int64()),
                        pa.array(np.full(len(own), width, np.int32)),
                        pa.array(np.full(len(own), size, np.int8)),
                        cells,
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["vec_id", "width", "bytes", "v"])

    return vectors.select(F.col("vec_id").cast("bigint"), "v").mapInArrow(pack, _PACKED)


def _rows(widths, sizes, cells, width: int | None = None) -> np.ndarray:
    """Packed vectors as rows of a matrix; shorter ones are filled up with zeros."""
    widths, sizes = np.asarray(widths, dtype=np.int64), np.asarray(sizes, dtype=np.int64)
    width = int(widths.max(initial=0)) if width is None else width
    out = np.zeros((len(widths), width), dtype=np.int64)
    shapes = widths * 16 + sizes
    for shape in np.unique(shapes).tolist():
        own = np.flatnonzero(shapes == shape)
        joined = b"".join([cells[i] for i in own.tolist()])
        out[own, : shape // 16] = np.frombuffer(joined, f"<i{shape % 16}").reshape(len(own), shape // 16)
    return out


def cover_tree(points: np.ndarray) -> dict[str, np.ndarray]:
    """Nodes of a cover tree: center row, radius, norm of the center, range of ``order``, range of children."""
    n = len(points)
    floats = points.astype(np.float64)
    centers, radii, begins, ends, firsts, lasts = [], [], [], [], [], []
    order = np.arange(n)
    # (begin, end, center, radius of the level)
    waiting = [(0, n, 0, None)]
    position = 0
    while position < len(waiting):
        begin, end, center, level = waiting[position]
        position += 1
        rows = order[begin:end]
        own = floats[rows]
        away = np.sqrt(((own - floats[center]) ** 2).sum(axis=1))
        radius = float(away.max()) if len(rows) else 0.0
        centers.append(center)
        radii.append(radius)
        begins.append(begin)
        ends.append(end)
        firsts.append(len(waiting))
        most = (end - begin) // LEAST_CHILD
        if end - begin > LEAF and radius > 0:
            reach = min(radius, radius if level is None else level) / BASE
            near, owner = away.copy(), np.zeros(len(rows), dtype=np.int64)
            picked = [center]
            while near.max() > reach and len(picked) <= most:
                far = int(near.argmax())
                picked.append(int(rows[far]))
                distance = np.sqrt(((own - own[far]) ** 2).sum(axis=1))
                closer = distance < near
                owner[closer] = len(picked) - 1
                near = np.minimum(near, distance)
            if len(picked) <= most:
                sort = np.argsort(owner, kind="stable")
                order[begin:end] = rows[sort]
                bounds = np.searchsorted(owner[sort], np.arange(len(picked) + 1))
                for i, c in enumerate(picked):
                    waiting.append((begin + int(bounds[i]), begin + int(bounds[i + 1]), c, reach))
        lasts.append(len(waiting))
    points_of = floats[np.asarray(centers, dtype=np.int64)] if n else floats[:0]
    return {
        "order": order,
        "center": points_of,
        "radius": np.asarray(radii),
        "norm": np.sqrt((points_of**2).sum(axis=1)),
        "begin": np.asarray(begins),
        "end": np.asarray(ends),
        "first": np.asarray(firsts),
        "last": np.asarray(lasts),
    }


def _type_of(a: float, b: float):
    """The fastest type in which the inner products of whole-number vectors of these lengths are exact.

    No partial sum of a product exceeds the product of the lengths.
    """
    largest = a * b * (1 + SLACK)
    for kind, limit in ((np.float32, 1 << 24), (np.float64, 1 << 53), (np.int64, 1 << 62)):
        if largest < limit:
            return kind
    return object


class Side:
    """A cell in the order of its tree: vectors, ids, length of the longest, and the vectors as another type when asked."""

    def __init__(self, packed: bytes, width: int | None = None):
        whole = pickle.loads(packed)
        self.tree = whole["tree"]
        self.v, self.ids = whole["v"][self.tree["order"]], whole["ids"][self.tree["order"]]
        self.longest = float(np.sqrt((self.v.astype(np.float64) ** 2).sum(axis=1).max(initial=0)))
        self._as: dict = {}
        if width is not None:
            self.widen(width)

    def widen(self, width: int) -> None:
        extra = width - self.v.shape[1]
        if extra > 0:
            self.v = np.pad(self.v, ((0, 0), (0, extra)))
            self.tree["center"] = np.pad(self.tree["center"], ((0, 0), (0, extra)))
            self._as = {}

    def typed(self, kind) -> np.ndarray:
        if kind not in self._as:
            self._as[kind] = self.v.astype(kind)
        return self._as[kind]


class Best:
    """The best k candidates of each query of a cell, and its kth score or what is known to reach that."""

    def __init__(self, rows: int, k: int, worst: np.ndarray | None = None):
        self.k = k
        self.n = np.zeros(rows, dtype=np.int64)
        self.score = np.zeros((rows, k), dtype=np.int64)
        self.ids = np.zeros((rows, k), dtype=np.int64)
        self.worst = np.full(rows, -np.inf) if worst is None else worst.copy()

    def add(self, row: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        """Candidates by row; equal ones count once, ties go to the smaller id."""
        k = self.k
        full = self.n[row] == k
        last = self.score[row, k - 1]
        use = ~full | (score > last) | ((score == last) & (ids < self.ids[row, k - 1]))
        row, ids, score = row[use], ids[use], score[use]
        if not len(row):
            return
        old = np.unique(row)
        at, place = np.nonzero(np.arange(k) < self.n[old][:, None])
        row = np.concatenate([old[at], row])
        ids = np.concatenate([self.ids[old[at], place], ids])
        score = np.concatenate([self.score[old[at], place], score])
        order = np.lexsort((ids, -score, row))
        row, ids, score = row[order], ids[order], score[order]
        new = np.ones(len(row), dtype=bool)
        new[1:] = (row[1:] != row[:-1]) | (ids[1:] != ids[:-1]) | (score[1:] != score[:-1])
        row, ids, score = row[new], ids[new], score[new]
        rank = np.arange(len(row)) - np.searchsorted(row, row, side="left")
        kept = rank < k
        row, rank = row[kept], rank[kept]
        self.ids[row, rank], self.score[row, rank] = ids[kept], score[kept]
        np.maximum.at(self.n, row, rank + 1)
        full = old[self.n[old] == k]
        self.worst[full] = np.maximum(self.worst[full], self.score[full, k - 1].astype(np.float64))


class Room:
    """Memory for one block of scores, used again and again: new memory costs as much as the products."""

    def __init__(self):
        self._held: dict = {}

    def get(self, kind, rows: int, columns: int) -> np.ndarray:
        held = self._held.get(kind)
        if held is None or held.size < rows * columns:
            held = self._held[kind] = np.empty(rows * columns, kind)
        return held[: rows * columns].reshape(rows, columns)


def dual_tree(queries: Side, data: Side, best: Best, limit: float | None = None, room: Room | None = None) -> None:
    """Adds to ``best`` all candidates of ``data`` that can be among a query's best k.

    A query's own row is no candidate. ``limit`` is the bound of the two cells where it is known.
    """
    room = Room() if room is None else room
    q, p, k, worst = queries.tree, data.tree, best.k, best.worst
    kind = _type_of(queries.longest, data.longest)
    qv, pv = queries.typed(kind), data.typed(kind)
    # whole numbers beyond 2^53 are compared as the next smaller float at most
    exact = kind in (np.float32, np.float64)

    def bound(i: int, j: np.ndarray) -> np.ndarray:
        return p["center"][j] @ q["center"][i] + q["radius"][i] * p["norm"][j] + p["radius"][j] * (q["norm"][i] + q["radius"][i])

    def base(i: int, j: int) -> None:
        a, b = int(q["begin"][i]), int(q["end"][i])
        for c in range(int(p["begin"][j]), int(p["end"][j]), BLOCK):
            block(a, b, c, min(c + BLOCK, int(p["end"][j])))

    def block(a: int, b: int, c: int, d: int) -> None:
        scores = np.matmul(qv[a:b], pv[c:d].T, out=room.get(kind, b - a, d - c))
        floor = worst[a:b].astype(kind) if exact else worst[a:b] - np.abs(worst[a:b]) * SLACK
        new = np.flatnonzero(np.isneginf(floor)) if d - c > k + 1 else []
        if len(new):
            # k scores besides the query's own reach the (k + 1)th
            kth = np.partition(scores[new], d - c - k - 1, axis=1)[:, d - c - k - 1].astype(floor.dtype)
            floor[new] = kth if exact else kth - np.abs(kth) * SLACK
        take(a, c, scores, floor)
        if len(new):
            # but for equal candidates, and rows of the query's own id
            few = new[(best.n[a + new] < k) | (best.score[a + new, k - 1] < floor[new])]
            if len(few):
                rest = np.full(b - a, np.inf)
                rest[few] = -np.inf
                take(a, c, scores, rest)

    def take(a: int, c: int, scores: np.ndarray, floor: np.ndarray) -> None:
        some = np.flatnonzero(scores.max(axis=1) >= floor)
        if len(some):
            row, column = np.nonzero((scores[some] >= floor[some, None]).astype(bool, copy=False))
            row = some[row]
            own = queries.ids[a + row] != data.ids[c + column]
            row, column = row[own], column[own]
            best.add(a + row, data.ids[c + column], scores[row, column].astype(np.int64))

    def visit(i: int, j: int, limit: float) -> None:
        if limit * (1 + SLACK) + SLACK < worst[q["begin"][i] : q["end"][i]].min():
            return
        q_leaf, p_leaf = q["first"][i] == q["last"][i], p["first"][j] == p["last"][j]
        if q_leaf and p_leaf:
            base(i, j)
        elif q_leaf or (not p_leaf and p["radius"][j] >= q["radius"][i]):
            children = np.arange(p["first"][j], p["last"][j])
            limits = bound(i, children)
            for c in np.argsort(-limits):
                visit(i, int(children[c]), abs_up(limits[c]))
        else:
            for c in range(q["first"][i], q["last"][i]):
                visit(c, j, abs_up(bound(c, np.asarray([j]))[0]))

    def abs_up(x: float) -> float:
        # a bound times (1 + SLACK) must not fall below itself
        return float(x) + SLACK * abs(float(x))

    if len(queries.ids) and len(data.ids):
        visit(0, 0, abs_up(bound(0, np.asarray([0]))[0] if limit is None else limit))


def _cells(packed: DataFrame, pivots: np.ndarray, rows: int) -> DataFrame:
    """One row per cell of about ``rows`` vectors at most: ``cell``, ``n``, center, radius, norm and the pickled tree."""

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            widths, sizes = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
            width = max(pivots.shape[1], int(widths.max(initial=0)))
            own = _rows(widths, sizes, batch.column(3).to_pylist(), width).astype(np.float64)
            to = np.zeros((len(pivots), width))
            to[:, : pivots.shape[1]] = pivots
            away = (to**2).sum(axis=1)[None, :] - 2 * own @ to.T
            at = pa.array(away.argmin(axis=1).astype(np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns, at], [*batch.schema.names, "pivot"])

    def build(group: pd.DataFrame) -> pd.DataFrame:
        points, ids = _rows(group["width"], group["bytes"], group["v"].tolist()), group["vec_id"].to_numpy()
        tree = cover_tree(points)
        size = int(group["bytes"].max())
        packed = pickle.dumps({"tree": tree, "v": points.astype(f"<i{size}"), "ids": ids}, protocol=5)
        return pd.DataFrame(
            {
                "cell": [f"{group['pivot'].iloc[0]}:{group['slice'].iloc[0]}"],
                "n": [len(ids)],
                "center": [tree["center"][0]],
                "radius": [tree["radius"][0]],
                "norm": [tree["norm"][0]],
                "packed": [packed],
            }
        )

    dealt = packed.mapInArrow(nearest, f"{_PACKED}, pivot int")
    # a row per pivot
    sizes = {r["pivot"]: r["n"] for r in dealt.groupBy("pivot").agg(F.count(F.lit(1)).alias("n")).collect()}
    slices = F.get(F.array(*[F.lit(-(-sizes.get(i, 1) // rows)) for i in range(max(1, len(pivots)))]), F.col("pivot"))
    return dealt.withColumn("slice", F.pmod(F.xxhash64("vec_id"), slices)).groupBy("pivot", "slice").applyInPandas(
        build, "cell string, n bigint, center array<double>, radius double, norm double, packed binary"
    )


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.coalesce(x * y, F.lit(0.0))), F.lit(0.0), lambda s, x: s + x)


def _sides(packed, width: int | None = None) -> list[Side]:
    sides = [Side(p) for p in packed]
    width = max([s.v.shape[1] for s in sides], default=0) if width is None else width
    for side in sides:
        side.widen(width)
    return sides


def _first(k: int):
    """The kth score of each query of a cell, in the order of its tree, as far as some data cells tell."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        queries, *data = _sides([group["q_packed"].iloc[0], *group["packed"]])
        best, room = Best(len(queries.ids), k), Room()
        for side in data:
            dual_tree(queries, side, best, room=room)
        return pd.DataFrame({"q_cell": [group["q_cell"].iloc[0]], "worst": [best.worst.tobytes()]})

    return run


def _search(k: int):
    """The best k of each query of a group of cells in a slice of the data cells."""

    def run(asked: pd.DataFrame, cells: pd.DataFrame) -> pd.DataFrame:
        queries = _sides(asked["q_packed"])
        best = [Best(len(q.ids), k, np.frombuffer(w)) for q, w in zip(queries, asked["worst"], strict=True)]
        width, room = max((q.v.shape[1] for q in queries), default=0), Room()

        def shapes(sides: list[Side]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            return tuple(np.array([s.tree[name][0] for s in sides]) for name in ("center", "radius", "norm"))

        center, radius, norm = shapes(queries) if queries else (None, None, None)
        for packed in cells["packed"] if queries else ():
            side = Side(packed)
            if side.v.shape[1] > width:
                width = side.v.shape[1]
                for q in queries:
                    q.widen(width)
                center = shapes(queries)[0]
            side.widen(width)
            (c,), (r,), (n,) = shapes([side])
            limits = center @ c + radius * n + r * (norm + radius)
            for i in np.argsort(-limits).tolist():
                limit = float(limits[i])
                dual_tree(queries[i], side, best[i], limit + SLACK * abs(limit), room)
        at = [np.nonzero(np.arange(k) < b.n[:, None]) for b in best]
        found = {
            "query_id": [q.ids[rows] for q, (rows, _) in zip(queries, at, strict=True)],
            "vec_id": [b.ids[a] for b, a in zip(best, at, strict=True)],
            "score": [b.score[a] for b, a in zip(best, at, strict=True)],
        }
        return pd.DataFrame({name: np.concatenate([np.zeros(0, np.int64), *parts]) for name, parts in found.items()})

    return run


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(queries: DataFrame, data: DataFrame, k: int = 5) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the k highest inner products of every query, exactly.

    ``queries`` and ``data`` have whole-number vectors: ``vec_id``, ``v``. A query's own row is no candidate; ties go
    to the smaller vec_id; with fewer candidates than k all are returned. Vectors of different lengths are compared as
    if filled up with zeros. Repeated rows count once. Empty queries or data give no rows.

    The pivots come from the ``PIVOTS`` rows of smallest hash; every row is indexed. All pairs of a query cell and a
    data cell are judged by their bound, and none is left out unless the bound proves it useless.
    """
    spark = data.sparkSession
    rows = cut_lineage(_packed(data).dropDuplicates(), "vectors")
    wanted = cut_lineage(_packed(queries).dropDuplicates(), "queries")
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(PIVOTS).collect()
    pivots = _rows([r["width"] for r in sample], [r["bytes"] for r in sample], [bytes(r["v"]) for r in sample]).astype(np.float64)
    if not len(sample):
        pivots = np.zeros((1, 0))
    cells = cut_lineage(_cells(rows, pivots, CELL_ROWS), "cells")
    asked = cut_lineage(_cells(wanted, pivots, QUERY_CELL_ROWS), "asked")
    size = (F.count(F.lit(1)).alias("cells"), F.coalesce(F.sum(F.length("packed")), F.lit(0)).alias("bytes"))
    held, posed = cells.agg(*size).first(), asked.agg(*size).first()
    shelves = 1 + held["cells"] // SHELF_CELLS
    shelf = F.pmod(F.xxhash64("cell"), F.lit(shelves)).cast("int")
    numbers = cells.select("cell", "n", "center", "radius", "norm", shelf.alias("shelf"))
    # every query cell meets every data cell by its bound alone: a stated query set against all rows, in blocks
    shapes = asked.select(F.col("cell").alias("q_cell"), F.col("center").alias("q"), F.col("radius").alias("r"), F.col("norm").alias("w"))
    met = shapes.withColumn("shelf", F.explode(F.sequence(F.lit(0), F.lit(shelves - 1)))).join(numbers, "shelf")
    limit = _dot(F.col("q"), F.col("center")) + F.col("r") * F.col("norm") + F.col("radius") * (F.col("w") + F.col("r"))
    pairs = cut_lineage(met.select("q_cell", "cell", "n", limit.alias("limit")), "bounds")
    # enough cells, best bound first, to hold k candidates besides the query itself
    order = Window.partitionBy("q_cell").orderBy(F.desc("limit"), "cell")
    before = F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    homes = cut_lineage(pairs.withColumn("before", before).where(F.col("before") < k + 1).select("q_cell", "cell"), "homes")
    packed = asked.select(F.col("cell").alias("q_cell"), F.col("packed").alias("q_packed"))
    whole = homes.join(packed, "q_cell").join(cells.select("cell", "packed"), "cell").select("q_cell", "q_packed", "packed")
    known = cut_lineage(whole.groupBy("q_cell").applyInPandas(_first(k), "q_cell string, worst binary"), "known")
    # every group of query cells meets every slice of the data cells in one task
    groups = max(1, -(-posed["bytes"] // GROUP_BYTES))
    tasks = -(-4 * spark.sparkContext.defaultParallelism // groups)
    slices = max(1, -(-held["bytes"] // SLICE_BYTES), min(held["bytes"] // LEAST_SLICE_BYTES, tasks))
    group, part = (F.pmod(F.xxhash64(name), F.lit(n)).cast("int") for name, n in (("q_cell", groups), ("cell", slices)))
    grouped = packed.join(known, "q_cell").withColumn("group", group)
    grouped = grouped.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    sliced = cells.select("packed", part.alias("slice")).withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    found = (
        grouped.groupBy("group", "slice")
        .cogroup(sliced.groupBy("group", "slice"))
        .applyInPandas(_search(k), "query_id bigint, vec_id bigint, score bigint")
    )
    return _ranked(found, k).select("query_id", "rank", "vec_id", "score")
