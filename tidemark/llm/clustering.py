"""Centroid clustering (Lloyd's rounds) of whole-number vectors in built-in expressions only.

Centroids are literal arrays of the plan: ``zip_with`` and ``aggregate`` give a row's squared distance to each,
``array_min`` over structs of distance and number picks the nearest, and a round's sums are plain column sums of a
generated aggregate, combined per task before anything is shuffled. So a round moves one row per cluster and task,
however many vectors a cluster holds, and the driver gets one row per cluster.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import cut_lineage

Centroid = list[int]


def whole_vectors(vectors: DataFrame, width: int, scale: int) -> DataFrame:
    """``vec_id``, ``v``: floor(scale * x) of each component of the vectors that have ``width`` finite ones."""
    finite = F.forall(
        "embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf"))
    )
    return vectors.where((F.size("embedding") == width) & finite).select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.transform("embedding", lambda c: F.floor(c.cast("double") * scale)).alias("v"),
    )


def _literal(values: Sequence[int]) -> Column:
    # one expression text instead of a call into the JVM per number; the planner folds it to one literal
    return F.expr(f"array({', '.join(f"bigint('{x}')" for x in values)})")


def _distance(centroid: Centroid) -> Column:
    squares = F.zip_with("v", _literal(centroid), lambda x, c: (x - c) * (x - c))
    return F.aggregate(squares, F.lit(0).cast("bigint"), lambda total, square: total + square)


def nearest(centroids: Sequence[Centroid]) -> Column:
    """(distance, cluster) of the nearest centroid; of equally near ones the smallest number."""
    return F.array_min(
        F.array(*[F.struct(_distance(c).alias("distance"), F.lit(i).alias("cluster")) for i, c in enumerate(centroids)])
    )


def first_centroids(vectors: DataFrame, clusters: int, seed: str) -> list[Centroid]:
    """The vectors whose hash of seed and id is smallest, in this order; rows without an id are not chosen."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    chosen = vectors.where("vec_id IS NOT NULL").orderBy(key, "v").limit(clusters)
    return [list(r["v"]) for r in chosen.select("v").collect()]


def updated(vectors: DataFrame, centroids: Sequence[Centroid]) -> list[Centroid]:
    """Each centroid's vectors' exact mean, rounded down; a centroid without vectors stays."""
    width = len(centroids[0])
    assigned = vectors.select(nearest(centroids)["cluster"].alias("cluster"), "v")
    sums = assigned.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(F.get("v", F.lit(i))).alias(f"s{i}") for i in range(width)]
    )
    out = list(centroids)
    for row in sums.collect():
        out[row["cluster"]] = [row[f"s{i}"] // row["n"] for i in range(width)]
    return out


def centroid_clusters(
    vectors: DataFrame, clusters: int = 16, rounds: int = 3, width: int = 64, scale: int = 64, seed: str = "1"
) -> DataFrame:
    """One row per usable row of ``vectors`` (``vec_id``, ``embedding``): its nearest centroid after ``rounds`` rounds.

    Returns ``vec_id``, ``cluster``, ``distance`` (squared), ``cluster_inertia``, ``inertia`` and ``centroid`` (the
    final array). Vectors that are null, of another width, or hold null or non-finite components give no row. Rows
    that repeat an id or a whole vector each count and each give a row; rows without an id are clustered too, but do
    not seed a centroid. Fewer usable rows than ``clusters`` give fewer centroids; without any the result is empty,
    or has null clusters if all usable rows lack an id. Other columns are ignored. Distances are 64-bit numbers; a
    component beyond about 2^28 steps overflows them, which is an error.
    """
    kept = cut_lineage(whole_vectors(vectors, width, scale), "vectors")
    centroids = first_centroids(kept, clusters, seed)
    for _ in range(rounds if centroids else 0):
        centroids = updated(kept, centroids)
    if not centroids:
        nothing = F.lit(None).cast("struct<distance: bigint, cluster: int>")
        assigned = kept.select("vec_id", nothing.alias("best"))
    else:
        assigned = kept.select("vec_id", nearest(centroids).alias("best"))
    assigned = cut_lineage(assigned.select("vec_id", "best.cluster", "best.distance"), "assigned")
    totals = {r["cluster"]: r["inertia"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
    numbers = range(len(centroids))
    return assigned.select(
        "vec_id",
        "cluster",
        "distance",
        F.get(_literal([totals.get(i, 0) for i in numbers]), F.col("cluster")).cast("bigint").alias("cluster_inertia"),
        F.when(F.col("cluster").isNotNull(), F.lit(sum(x or 0 for x in totals.values())).cast("bigint")).alias("inertia"),
        F.get(F.array(*[_literal(c) for c in centroids]), F.col("cluster")).alias("centroid")
        if centroids
        else F.lit(None).cast("array<bigint>").alias("centroid"),
    )


def centroid_digest(column: str = "centroid") -> Column:
    """sha256 of the components as decimal numbers joined by commas."""
    return F.sha2(F.array_join(F.transform(column, lambda x: x.cast("string")), ","), 256)
