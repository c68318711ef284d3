"""Centroid clustering of integer vectors, in Spark expressions.

The centroids of a round are literals of its plan. ``zip_with`` and ``aggregate``
give a vector's squared distance to each, ``array_min`` of (distance, number)
structs the nearest one, and one sum per component the next centroids: combined on
the map side, so that each task sends one row per cluster, however many vectors a
cluster holds. The driver sees the centroids and nothing else, k rows a round.
All arithmetic is in whole numbers, so the order of rows cannot change a result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.session import Workspace

DIMENSIONS, SCALE = 64, 256
CLUSTERS, ROUNDS, SEED = 40, 5, 2
# Components up to here keep squared distances of 64 of them within a long.
LARGEST = 1 << 26

Centroids = list[tuple[int, ...]]


@dataclass(frozen=True)
class Clustering:
    """``rows``: id, cluster, distance of every vector. ``inertia``: summed distance per cluster."""

    centroids: Centroids
    rows: DataFrame
    inertia: list[int]

    def digests(self) -> list[str]:
        """sha256 per centroid of its components, as decimal numbers joined by commas."""
        return [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in self.centroids]


def integer_vectors(
    vectors: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """id and floor(scale * component) of the vectors that have ``dimensions`` finite components.

    A null vector, another length, a null, NaN or infinite component: the row is left
    out. A component beyond ``LARGEST`` once scaled raises, as distances would not be exact.
    """
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    too_large = F.raise_error(F.lit(f"a component is beyond {LARGEST} when scaled"))

    def whole(x: Column) -> Column:
        return F.when(F.abs(scale * x) <= LARGEST, F.floor(scale * x)).otherwise(too_large.cast("bigint"))

    kept = vectors.filter((F.size(vector) == dimensions) & finite)
    return kept.select(F.col(f"`{id_col}`").alias("id"), F.transform(vector, whole).alias("vector"))


def first_centroids(rows: DataFrame, clusters: int = CLUSTERS, seed: int = SEED) -> Centroids:
    """The vectors with the smallest sha256 of ``seed:id``, in that order; equal ids by their vectors, a null id as text "null".

    Every task keeps its ``clusters`` smallest, so the sort is of bounded size.
    """
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("null")))
    drawn = rows.select(F.sha2(name, 256).alias("hash"), "vector").orderBy("hash", "vector").limit(clusters)
    return [tuple(row.vector) for row in drawn.collect()]


def nearest(vector: Column, centroids: Centroids) -> Column:
    """Struct (distance, cluster) of the nearest centroid; the smaller number where several are as near."""

    def distance(centroid: Sequence[int]) -> Column:
        literal = F.expr(f"array({','.join(f'{c}L' for c in centroid)})")
        gaps = F.zip_with(vector, literal, lambda x, c: x - c)
        return F.aggregate(gaps, F.lit(0).cast("bigint"), lambda total, gap: total + gap * gap)

    return F.array_min(
        F.array(*[F.struct(distance(c).alias("distance"), F.lit(j).alias("cluster")) for j, c in enumerate(centroids)])
    )


def assigned(rows: DataFrame, centroids: Centroids) -> DataFrame:
    """The rows with ``cluster`` and ``distance``."""
    return rows.withColumn("nearest", nearest(F.col("vector"), centroids)).select(
        "id", "vector", F.col("nearest.cluster").alias("cluster"), F.col("nearest.distance").alias("distance")
    )


def moved(rows: DataFrame, centroids: Centroids) -> Centroids:
    """One round: every centroid that has vectors becomes the floor of their mean, the others stay."""
    dimensions = len(centroids[0])
    sums = [F.sum(F.col("vector")[i]).alias(f"s{i}") for i in range(dimensions)]
    found = assigned(rows, centroids).groupBy("cluster").agg(F.count("*").alias("n"), *sums).collect()
    after = list(centroids)
    for row in found:
        after[row.cluster] = tuple(row[f"s{i}"] // row.n for i in range(dimensions))
    return after


def cluster_vectors(
    rows: DataFrame, work: Workspace, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED
) -> Clustering:
    """``rounds`` of assigning and moving, then a last assignment, which is stored.

    ``rows`` come from ``integer_vectors``. Fewer vectors than ``clusters`` give as
    many clusters; equal vectors may start several, of which the first takes them
    all. Repeated rows count as often as they occur. Without vectors there are no
    clusters and no rows. A round that moves nothing ends the rounds, as later ones
    would move nothing either.
    """
    centroids = first_centroids(rows, clusters, seed)
    if not centroids:
        none = rows.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("bigint").alias("distance"))
        return Clustering([], none, [])
    for _ in range(rounds):
        before, centroids = centroids, moved(rows, centroids)
        if before == centroids:
            break
    placed = work.store(assigned(rows, centroids).drop("vector"), "clusters")
    inertia = [0] * len(centroids)
    for row in placed.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect():
        inertia[row.cluster] = row.inertia
    return Clustering(centroids, placed, inertia)


def with_cluster_facts(found: Clustering) -> DataFrame:
    """The rows with their cluster's inertia, the whole inertia and their centroid's digest.

    One value per cluster, as literals: nothing is joined.
    """

    def of_cluster(literals: list[str], kind: str) -> Column:
        listed = f"array({','.join(literals)})" if literals else "array()"
        return F.get(F.expr(f"CAST({listed} AS array<{kind}>)"), F.col("cluster"))

    return found.rows.select(
        "*",
        of_cluster([f"{n}L" for n in found.inertia], "bigint").alias("cluster_inertia"),
        F.lit(sum(found.inertia)).cast("bigint").alias("inertia"),
        of_cluster([f"'{d}'" for d in found.digests()], "string").alias("centroid_sha256"),
    )
