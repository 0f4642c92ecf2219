"""Centroid clustering on JVM expressions: integer distances, literal centroids.

Every pass over the vectors is one plan without Python: ``zip_with`` and
``aggregate`` give the squared distance to each literal centroid array,
``array_min`` of (distance, number) structs picks the cluster, and partial
sums of the components, 64 columns in one generated aggregate, give the new
centroids.  Only k rows of sums come back from a pass; the vectors are never
shuffled, so a vector that a third of all rows repeat costs no more than others.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depot.llm.common import stored
from depot.session import scratch_path, scratch_scope

#: Components are held to this size, so that 64 squared differences fit a long.
LARGEST = 1 << 27


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dims: int = 64, scale: int = 64) -> DataFrame:
    """(id, v): vectors with exactly ``dims`` components, none null or not
    finite, each as floor(scale * x) in double arithmetic.

    A null vector, one of another length or with a null, NaN or infinite
    component is left out; results beyond +-2^27 are held there.  Null ids and
    repeated rows stay, and other columns do not matter.
    """
    v = F.col(vector_col)
    usable = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    held = F.transform(v, lambda x: F.floor(F.greatest(F.least(x.cast("double") * scale, F.lit(float(LARGEST))), F.lit(float(-LARGEST)))))
    return vectors.filter((F.size(v) == dims) & usable).select(F.col(id_col).alias("id"), held.alias("v"))


def seeds(data: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The k vectors with the smallest sha256 of ``seed:id`` (a null id counts
    as empty, equal ids go by their vectors): k rows at most."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    return [list(r["v"]) for r in data.orderBy(key, "v").limit(k).collect()]


def nearest(v: Column, centroids: list[list[int]]) -> Column:
    """Struct (distance, cluster) of the nearest centroid; the smaller number wins a tie."""
    def distance(centre: list[int]) -> Column:
        squares = F.zip_with(v, F.lit(np.array(centre, np.int64)), lambda a, b: (a - b) * (a - b))
        return F.aggregate(squares, F.lit(0).cast("long"), lambda total, x: total + x)

    return F.array_min(F.array(*[F.struct(distance(c).alias("distance"), F.lit(i).alias("cluster")) for i, c in enumerate(centroids)]))


def moved(data: DataFrame, centroids: list[list[int]], dims: int) -> list[list[int]]:
    """Centroids after one round: componentwise exact floor(sum / count) of
    their vectors; one without vectors stays where it is."""
    rows = (data.select(nearest(F.col("v"), centroids)["cluster"].alias("cluster"), "v").groupBy("cluster")
            .agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.col("v")[j]).alias(f"s{j}") for j in range(dims)]).collect())
    out = list(centroids)
    for r in rows:
        out[r["cluster"]] = [r[f"s{j}"] // r["n"] for j in range(dims)]
    return out


def _assigned(vectors: DataFrame, k: int, rounds: int, seed: int, scale: int, dims: int, id_col: str, vector_col: str) -> tuple[list[list[int]], DataFrame]:
    """The final centroids, and (id, cluster, distance) of every usable vector."""
    data = stored(quantised(vectors, id_col, vector_col, dims, scale), "centroids-vectors")
    centroids = seeds(data, k, seed)
    if not centroids:
        return [], data.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
    for _ in range(rounds):
        centroids = moved(data, centroids, dims)
    return centroids, data.select("id", nearest(F.col("v"), centroids).alias("at")).select("id", "at.cluster", "at.distance")


def cluster(vectors: DataFrame, k: int = 16, rounds: int = 3, seed: int = 1, scale: int = 64, dims: int = 64,
            id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Each usable vector's cluster after ``rounds`` of moving the centroids:
    (id_col, cluster, distance, cluster_inertia, inertia, centroid_sha256).

    Fewer than k usable vectors give as many centroids; an empty table, or one
    without usable vectors, gives no rows.  Repeated rows each count.  The
    quantised vectors and the assignment are stored once, so a lost executor
    reads them again instead of computing them.
    """
    spark = vectors.sparkSession
    path = scratch_path(spark, "centroids-placed")
    with scratch_scope(spark):                              # the vectors go, the assignment stays
        centroids, placed = _assigned(vectors, k, rounds, seed, scale, dims, id_col, vector_col)
        placed.write.parquet(path)
    placed = spark.read.schema(placed.schema).parquet(path)
    # k sums: no row of the vectors leaves its task
    sums = {r["cluster"]: int(r["s"]) for r in placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    if not centroids:
        none = F.lit(0).cast("long")
        return placed.select(F.col("id").alias(id_col), "cluster", "distance", none.alias("cluster_inertia"), none.alias("inertia"), F.lit("").alias("centroid_sha256"))
    of_cluster = F.lit(np.array([sums.get(i, 0) for i in range(len(centroids))], np.int64))
    digests = F.array(*[F.lit(hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for c in centroids])
    return placed.select(F.col("id").alias(id_col), "cluster", "distance", F.get(of_cluster, F.col("cluster")).alias("cluster_inertia"),
                         F.lit(sum(sums.values())).cast("long").alias("inertia"), F.get(digests, F.col("cluster")).alias("centroid_sha256"))
