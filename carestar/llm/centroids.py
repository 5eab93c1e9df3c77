"""Centroid clustering by dimension-sharded Lloyd rounds.

Vectors are cut into column blocks.  A row of the shard table holds one block of
one vector and meets only that block's slice of the centroids: its task gives the
exact partial distances to all centroids.  Adding the blocks of a vector gives its
distances, the argmin its cluster.  Each block then updates its own slice from its
own columns and the clusters.  All arithmetic is on whole numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, written

# Components of a column block
BLOCK_DIMS = 16


def _kept(vectors: DataFrame, id_col: str, vector_col: str, dims: int, scale: int) -> DataFrame:
    """``row, vec_id, xs`` of the vectors with ``dims`` finite components, scaled to whole numbers."""
    x = F.transform(F.col(vector_col), lambda v: v.cast("double"))
    rows = vectors.select(F.col(id_col).alias("vec_id"), x.alias("x"))
    whole = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    rows = rows.filter((F.size("x") == dims) & whole)
    return rows.select(F.monotonically_increasing_id().alias("row"), "vec_id",
                       F.transform("x", lambda v: F.floor(v * F.lit(float(scale)))).alias("xs"))


def _blocks(xs: Column, dims: int) -> Column:
    """Array of ``(block, xs)``: consecutive components in runs of ``BLOCK_DIMS``."""
    return F.array(*[F.struct(F.lit(b).alias("block"), F.slice(xs, at + 1, min(BLOCK_DIMS, dims - at)).alias("xs"))
                     for b, at in enumerate(range(0, dims, BLOCK_DIMS))])


def _assign(shards: DataFrame, centroids: DataFrame, k: int) -> DataFrame:
    """``row, distance, cluster``: partial distances by block, added by row, smallest first (ties: smaller cluster)."""
    slices = (centroids.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("cluster", "c"))).alias("s"))
              .select("block", F.col("s.c").alias("slices")))
    # one slice of k * BLOCK_DIMS numbers for each block: bounded by the parameters, whatever the input
    partial = shards.join(F.broadcast(slices), "block").select("row", F.transform(
        "slices", lambda c: F.aggregate(F.zip_with("xs", c, lambda a, b: (a - b) * (a - b)),
                                        F.lit(0).cast("long"), lambda t, v: t + v)).alias("d"))
    total = partial.groupBy("row").agg(*[F.sum(F.get("d", F.lit(i))).alias(f"d{i}") for i in range(k)])
    nearest = [F.struct(F.col(f"d{i}").alias("distance"), F.lit(i).alias("cluster")) for i in range(k)]
    best = F.least(*nearest) if k > 1 else nearest[0]
    return total.select("row", best.alias("_best")).select("row", "_best.distance", "_best.cluster")


def _update(shards: DataFrame, nearest: DataFrame, centroids: DataFrame) -> DataFrame:
    """Every block's new slice: the floor of its columns' means by cluster; an empty cluster keeps its old one."""
    sums = (shards.join(nearest.select("row", "cluster"), "row").groupBy("block", "cluster")
            .agg(F.count(F.lit(1)).alias("n"), F.max(F.size("xs")).alias("width"),
                 *[F.sum(F.get("xs", F.lit(j))).alias(f"s{j}") for j in range(BLOCK_DIMS)]))
    means = F.array(*[F.expr(f"(s{j} - pmod(s{j}, n)) div n") for j in range(BLOCK_DIMS)])
    new = sums.select("block", "cluster", F.slice(means, F.lit(1), F.col("width")).alias("new"))
    return (centroids.join(new, ["block", "cluster"], "left")
            .select("block", "cluster", F.coalesce("new", "c").alias("c")))


def lloyd_clusters(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", dims: int = 64,
                   scale: int = 64, k: int = 16, rounds: int = 3, seed: int = 1) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256``, one row per kept vector.

    Kept are vectors with exactly ``dims`` components, none null or non-finite;
    a component x becomes ``floor(scale * x)``.  The first centroids are the
    ``k`` kept vectors with the smallest sha256 of ``seed:vec_id``, in hash
    order.  A round assigns every vector to its nearest centroid by squared
    distance (ties: the smaller number) and replaces each non-empty centroid by
    the floor of its vectors' mean; a last assignment follows.

    Defined cases: a null id counts as the empty text in the hash; rows with the
    same id are vectors of their own, ordered by their components where hashes
    are equal; equal vectors get the same cluster; with fewer than ``k`` kept
    vectors all of them are centroids; a null vector is not kept; an empty table
    gives an empty result; other columns are ignored, whatever their names.
    Components whose squared distances go beyond 64 bits are an arithmetic
    error, not a wrong result.
    """
    rows = written(_kept(vectors, id_col, vector_col, dims, scale), "lloyd-rows")
    shards = written(rows.select("row", F.explode(_blocks(F.col("xs"), dims)).alias("b")).select("row", "b.*"),
                     "lloyd-shards")
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    first = rows.select(F.struct(F.sha2(name, 256).alias("h"), "xs").alias("o")).orderBy("o").limit(k)
    first = first.agg(F.array_sort(F.collect_list("o")).alias("all")).select(F.posexplode("all").alias("cluster", "o"))
    centroids = written(first.select("cluster", F.explode(_blocks(F.col("o.xs"), dims)).alias("b"))
                        .select("b.block", "cluster", F.col("b.xs").alias("c")), "lloyd-centroids")
    k = max(1, centroids.filter("block = 0").count())

    nearest = _assign(shards, centroids, k)
    for _ in range(rounds):
        last, centroids = centroids, written(_update(shards, nearest, centroids), "lloyd-centroids")
        discard(last)
        nearest = _assign(shards, centroids, k)
    nearest = written(nearest, "lloyd-nearest")

    text = F.array_join(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("block", "c"))),
                                              lambda b: b["c"])), ",")
    final = centroids.groupBy("cluster").agg(F.sha2(text, 256).alias("centroid_sha256"))
    by_cluster = nearest.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    whole = nearest.agg(F.sum("distance").alias("inertia"))
    # at most k rows, and one
    clusters = by_cluster.join(final, "cluster").join(F.broadcast(whole))
    return (rows.select("row", "vec_id").join(nearest, "row").join(F.broadcast(clusters), "cluster")
            .select("vec_id", F.col("cluster").cast("int").alias("cluster"), "distance", "cluster_inertia", "inertia",
                    "centroid_sha256"))
