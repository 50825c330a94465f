"""Exact integer k-means with a table of pivot distances (LAESA)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corral.llm.common import map_batches, staged

#: Largest component of an integer vector: a squared distance of 64 of them fits in 64 bits.
LARGEST = 1 << 27
_BLOCK = 4096
_TABLE = "vec_id long, vector array<int>, to_pivots array<long>"


def integer_vectors(embeddings: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", size: int = 64, scale: int = 64) -> DataFrame:
    """``(vec_id, vector)`` of the vectors with exactly ``size`` components, all
    finite, each component ``x`` turned into ``floor(scale * x)``."""
    x = F.col(vec_col).cast("array<double>")
    bad = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    kept = embeddings.select(F.col(id_col).cast("long").alias("vec_id"), x.alias("x")).where(
        F.col("x").isNotNull() & (F.size("x") == size) & ~F.exists("x", bad)
    )
    wide = F.exists("x", lambda v: F.abs(scale * v) > LARGEST)
    too_wide = F.raise_error(F.lit(f"a component is over {LARGEST} after scaling: squared distances would not fit in 64 bits"))
    ints = F.transform("x", lambda v: F.floor(scale * v).cast("int"))
    return kept.select("vec_id", F.when(wide, too_wide.cast("array<int>")).otherwise(ints).alias("vector"))


def starting_centroids(vectors: DataFrame, k: int = 16, seed: int = 1) -> np.ndarray:
    """The ``k`` vectors with the smallest SHA-256 of ``seed:vec_id``, in that order;
    equal ids by components, vectors without an id last.  At most ``k`` rows reach the driver."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.select(key.alias("key"), "vector").orderBy(F.col("key").asc_nulls_last(), "vector").limit(k).collect()
    return np.array([r["vector"] for r in rows], dtype=np.int64)


def squared(vectors: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Exact squared distances of every vector (rows) to every point (columns)."""
    return np.stack([((vectors - p) ** 2).sum(axis=1) for p in points], axis=1)


def _matrix(column: pa.Array, dtype) -> np.ndarray:
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).astype(dtype).reshape(n, -1) if n else np.zeros((0, 1), dtype)


def pivot_table(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """``vectors`` with their exact squared distances to every pivot, written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            if batch.num_rows:
                to = squared(_matrix(batch.column("vector"), np.int64), pivots)
                yield {"vec_id": batch.column("vec_id"), "vector": batch.column("vector"), "to_pivots": list(to)}

    return staged(map_batches(vectors, run, _TABLE), "pivot_table")


def nearest_centroids(vectors: np.ndarray, to_pivots: np.ndarray, centroids: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of and exact squared distance to the nearest centroid (ties: the smaller number).

    For a pivot p, |d(v,p) - d(c,p)| never exceeds d(v,c).  The largest such
    difference bounds every centroid from below; the centroid with the lowest
    bound is measured first, and of the others only those whose bound does not
    exceed the best distance so far.  The bounds are rounded down by more than
    their floating error, so no nearest or equally near centroid is passed over.
    """
    who = np.zeros(len(vectors), dtype=np.int32)
    best = np.zeros(len(vectors), dtype=np.int64)
    of_centroids = np.sqrt(squared(centroids, pivots))
    for at in range(0, len(vectors), _BLOCK):
        v, own = vectors[at : at + _BLOCK], np.sqrt(to_pivots[at : at + _BLOCK])
        low = np.abs(own[:, None, :] - of_centroids[None, :, :]).max(axis=2)
        low -= 1e-12 * (own.max(axis=1)[:, None] + of_centroids.max(axis=1)[None, :])
        first = low.argmin(axis=1).astype(np.int32)
        near, dist = first.copy(), ((v - centroids[first]) ** 2).sum(axis=1)
        for j in range(len(centroids)):
            rows = np.flatnonzero((first != j) & (low[:, j] <= np.sqrt(dist) * (1 + 1e-12)))
            if rows.size:
                d = ((v[rows] - centroids[j]) ** 2).sum(axis=1)
                better = (d < dist[rows]) | ((d == dist[rows]) & (j < near[rows]))
                near[rows[better]], dist[rows[better]] = j, d[better]
        who[at : at + _BLOCK], best[at : at + _BLOCK] = near, dist
    return who, best


def _assigned(batch: pa.RecordBatch, centroids: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    v = _matrix(batch.column("vector"), np.int64)
    return (v, *nearest_centroids(v, _matrix(batch.column("to_pivots"), np.int64), centroids, pivots))


def moved_centroids(table: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """One round: each non-empty centroid becomes the floor of the exact mean of its vectors.
    Every task sends one sum per cluster; Spark adds them by cluster and component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        sums = np.zeros((len(centroids), centroids.shape[1] + 1), dtype=np.int64)  # the last column counts
        for batch in batches:
            if batch.num_rows:
                v, who, _ = _assigned(batch, centroids, pivots)
                for j in np.unique(who):
                    mine = v[who == j]
                    sums[j, :-1] += mine.sum(axis=0)
                    sums[j, -1] += len(mine)
        used = np.flatnonzero(sums[:, -1])
        yield {"cluster": used.astype(np.int32), "sums": list(sums[used])}

    parts = map_batches(table, run, "cluster int, sums array<long>")
    totals = (
        parts.select("cluster", F.posexplode("sums").alias("component", "value"))
        .groupBy("cluster", "component")
        .agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
        .collect()
    )
    by_cluster: dict[int, dict[int, int]] = {}
    for r in totals:
        by_cluster.setdefault(r["cluster"], {})[r["component"]] = int(r["value"])
    out = centroids.copy()
    size = centroids.shape[1]
    for j, total in by_cluster.items():
        out[j] = [total[i] // total[size] for i in range(size)]
    return out


def clusters(
    embeddings: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    k: int = 16,
    rounds: int = 3,
    size: int = 64,
    scale: int = 64,
    seed: int = 1,
) -> DataFrame:
    """Cluster every usable vector in exact integers.

    Vectors that are null, have another number of components or hold a null or
    non-finite one take no part; a component over 2 ** 27 after scaling is an
    error, as distances would not fit.  Rows with equal ids are vectors of
    their own; a null id is kept.  Fewer than ``k`` vectors give fewer
    centroids; no vector, no row.  Other columns, whatever their names, are
    left behind.  The pivots are the starting centroids; the driver holds ``k``
    centroids and their sums only.
    """
    vectors = integer_vectors(embeddings, id_col, vec_col, size, scale)
    pivots = starting_centroids(vectors, k, seed)
    out = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not len(pivots):
        return embeddings.sparkSession.createDataFrame([], out)
    table, centroids = pivot_table(vectors, pivots), pivots
    for _ in range(rounds):
        centroids = moved_centroids(table, centroids, pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            if batch.num_rows:
                _, who, dist = _assigned(batch, centroids, pivots)
                yield {"vec_id": batch.column("vec_id"), "cluster": who, "distance": dist}

    done = staged(map_batches(table, run, "vec_id long, cluster int, distance long"), "clusters")
    sums = done.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()
    inertia = {r["cluster"]: int(r["s"]) for r in sums}  # at most k rows
    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]

    def of_cluster(values: list) -> Column:
        return F.get(F.array(*[F.lit(v) for v in values]), F.col("cluster"))

    return done.select(
        "vec_id",
        "cluster",
        "distance",
        of_cluster([inertia.get(j, 0) for j in range(len(centroids))]).cast("long").alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("long").alias("inertia"),
        of_cluster(digests).alias("centroid_sha256"),
    )


def _round_sql(i: int) -> str:
    """Assign to centroids ``c{i}`` and move them to ``c{i+1}``."""
    return f"""
d{i} AS (SELECT v.rid, c.cluster, CAST(list_sum(list_transform(list_zip(v.v, c.v), lambda p: (p[1]-p[2])*(p[1]-p[2]))) AS BIGINT) AS distance FROM k v, c{i} c),
a{i} AS (SELECT rid, cluster, distance FROM (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY distance, cluster) AS rn FROM d{i}) WHERE rn=1),
s{i} AS (SELECT cluster, pos, CAST(floor(sum(x)/count(*)) AS BIGINT) AS x FROM (SELECT a.cluster, unnest(k.v) AS x, unnest(range(64)) AS pos FROM a{i} a JOIN k ON k.rid=a.rid) GROUP BY cluster, pos),
m{i} AS (SELECT cluster, list(x ORDER BY pos) AS v FROM s{i} GROUP BY cluster),
c{i + 1} AS (SELECT c.cluster, coalesce(m.v, c.v) AS v FROM c{i} c LEFT JOIN m{i} m ON m.cluster=c.cluster),"""


#: The clustering in DuckDB: every vector measured against every centroid.
CLUSTERS_SQL = f"""
WITH k AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id,
  list_transform(embedding, lambda x: CAST(floor(64*CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding)=64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x)))=0),
c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY sha256(concat('1:',vec_id)), v)-1 AS INT) AS cluster, v FROM k QUALIFY cluster < 16),
{"".join(_round_sql(i) for i in range(4)).replace(" AS (", " AS MATERIALIZED (")}
r AS (SELECT k.vec_id, a.cluster, a.distance, sum(a.distance) OVER (PARTITION BY a.cluster) AS ci, sum(a.distance) OVER () AS ti FROM a3 a JOIN k ON k.rid=a.rid)
SELECT vec_id, r.cluster, distance, CAST(ci AS BIGINT) AS cluster_inertia, CAST(ti AS BIGINT) AS inertia,
  sha256(array_to_string(c3.v, ',')) AS centroid_sha256 FROM r JOIN c3 ON c3.cluster=r.cluster
"""
