"""Centroid clustering of integer vectors; distances are gathered from scalar lookup tables.

Vectors are quantised once and written to the shared folder. Each round sends the centroids (``k`` times ``dims`` integers)
to the tasks. A task tabulates, for every dimension, the squared difference of each integer value that occurs in its
batch to each centroid; the distances of a vector are then sums of rows gathered from these tables. All arithmetic is
on integers, so results don't depend on how rows are dealt to tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import discard, stored, type_of

DIMS, K, ROUNDS, SCALE = 64, 16, 3, 64
#: Vectors of a batch that are tabulated together, and integers whose squared distances still fit 64 bits.
BATCH, LARGEST = 8192, 1 << 27


def usable(vector: str, dims: int = DIMS) -> Column:
    """True for arrays of exactly ``dims`` components, none of them null, NaN or infinite."""
    x = F.col(vector)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return F.coalesce((F.size(x) == dims) & finite, F.lit(False))


def quantised(df: DataFrame, id_col: str = "vec_id", vector: str = "embedding", dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """``id_col, v``: the usable vectors, each component ``x`` as ``floor(scale * x)`` in double precision."""
    whole = F.transform(F.col(vector), lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    return df.filter(usable(vector, dims)).select(id_col, whole.alias("v"))


def first_centroids(vectors: DataFrame, id_col: str = "vec_id", k: int = K, seed: str = "1:") -> np.ndarray:
    """The ``k`` vectors with the smallest SHA-256 of ``seed`` and the id; null ids come last, ties go by components."""
    key = F.sha2(F.concat(F.lit(seed), F.col(id_col).cast("string")), 256)
    rows = vectors.select(key.alias("key"), "v").orderBy(F.col("key").asc_nulls_last(), "v").limit(k).collect()
    return np.array([r["v"] for r in rows], dtype=np.int64)


class Tables:
    """Squared differences of the integer values that occur in each column of ``matrix`` to each centroid."""

    def __init__(self, matrix: np.ndarray, centroids: np.ndarray):
        self.codes, self.tables = [], []
        low, high = matrix.min(axis=0), matrix.max(axis=0)
        for d in range(matrix.shape[1]):
            span, column = int(high[d] - low[d]) + 1, matrix[:, d]
            if span <= 4 * len(column) + 1024:
                shifted = column - low[d]
                occurs = np.zeros(span, dtype=bool)
                occurs[shifted] = True
                values = np.flatnonzero(occurs) + low[d]
                codes = (np.cumsum(occurs) - 1)[shifted]
            else:  # values far apart
                values, codes = np.unique(column, return_inverse=True)
            self.codes.append(codes.reshape(-1))
            self.tables.append((values[:, None] - centroids[None, :, d]) ** 2)

    def distances(self) -> np.ndarray:
        """Vectors by centroids."""
        total = np.zeros((len(self.codes[0]), self.tables[0].shape[1]), dtype=np.int64)
        for codes, table in zip(self.codes, self.tables):
            total += np.take(table, codes, axis=0)
        return total


def _matrices(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH):
            part = batch.slice(at, BATCH)
            matrix = part.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)
            if len(matrix):
                if max(int(matrix.max()), -int(matrix.min())) > LARGEST:
                    raise ValueError(f"a quantised component beyond {LARGEST}: squared distances would not fit 64 bits")
                yield part, matrix


def assign(vectors: DataFrame, centroids: np.ndarray, id_col: str = "vec_id") -> DataFrame:
    """``id_col, cluster, distance``: nearest centroid by squared distance (ties: the smaller number)."""
    dims = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, matrix in _matrices(batches, dims):
            all_ = Tables(matrix, centroids).distances()
            cluster = all_.argmin(axis=1)
            distance = all_[np.arange(len(all_)), cluster]
            columns = [part.column(0), pa.array(cluster.astype(np.int32)), pa.array(distance)]
            yield pa.RecordBatch.from_arrays(columns, names=[id_col, "cluster", "distance"])

    return vectors.select(id_col, "v").mapInArrow(run, f"`{id_col}` {type_of(vectors, id_col)}, cluster int, distance long")


def moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: each the floor of the mean of its vectors, by component; those without any stay.

    A task sends one row per cluster and dimension, whatever the size of a cluster.
    """
    k, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((k, dims), dtype=np.int64), np.zeros(k, dtype=np.int64)
        for _, matrix in _matrices(batches, dims):
            cluster = Tables(matrix, centroids).distances().argmin(axis=1)
            counts += np.bincount(cluster, minlength=k)
            order = np.argsort(cluster, kind="stable")
            found, first = np.unique(cluster[order], return_index=True)
            sums[found] += np.add.reduceat(matrix[order], first, axis=0)
        for c in np.flatnonzero(counts):
            columns = [np.full(dims, c, np.int32), np.arange(dims, dtype=np.int32), np.full(dims, counts[c]), sums[c]]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["cluster", "dim", "n", "total"])

    parts = vectors.select("v").mapInArrow(run, "cluster int, dim int, n long, total long")
    rows = parts.groupBy("cluster", "dim").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect()
    after = centroids.copy()
    for row in rows:
        after[row["cluster"], row["dim"]] = row["total"] // row["n"]
    return after


def cluster(
    df: DataFrame, id_col: str = "vec_id", vector: str = "embedding", dims: int = DIMS, k: int = K, rounds: int = ROUNDS, scale: int = SCALE
) -> tuple[DataFrame, np.ndarray]:
    """``id_col, cluster, distance`` of every usable vector after ``rounds`` rounds, and the final centroids.

    Rows with a null vector, another number of components, or a null, NaN or infinite one are no vectors and give no row.
    Rows that share an id are vectors of their own; a vector without an id is clustered too. With fewer than ``k`` vectors
    each starts a cluster; an empty table gives no rows and no centroids. Components beyond ``LARGEST`` after
    quantising raise, since a 64-bit distance could not hold them. Other columns are left aside.
    """
    vectors = stored(quantised(df, id_col, vector, dims, scale), "vectors")
    centroids = first_centroids(vectors, id_col, k).reshape(-1, dims)
    if not len(centroids):
        return vectors.select(id_col, F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), centroids
    for _ in range(rounds):
        centroids = moved(vectors, centroids)
    assigned = stored(assign(vectors, centroids, id_col), "clusters")
    discard(vectors)
    return assigned, centroids


def with_totals(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``assigned`` with the sums of distances of each cluster and of all, and a digest of the cluster's centroid."""
    spark = assigned.sparkSession
    texts = [(c, ",".join(map(str, row))) for c, row in enumerate(centroids.tolist())]
    digests = spark.createDataFrame(texts, "cluster int, components string").select("cluster", F.sha2("components", 256).alias("centroid_sha256"))
    sums = assigned.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    total = sums.agg(F.sum("cluster_inertia").alias("inertia"))
    # One row per cluster.
    per_cluster = digests.join(sums, "cluster").join(F.broadcast(total))
    return assigned.join(F.broadcast(per_cluster), "cluster")


def _sql(dims: int = DIMS, k: int = K, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    steps = [
        f"""v AS MATERIALIZED (
    SELECT vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims}
), long AS MATERIALIZED (
    SELECT vec_id, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM v
), c0 AS MATERIALIZED (
    SELECT n - 1 AS cluster, unnest(v) AS c, generate_subscripts(v, 1) AS d
    FROM (SELECT v, row_number() OVER (ORDER BY sha256('1:' || vec_id)) AS n FROM v) WHERE n <= {k}
)"""
    ]
    for r in range(rounds + 1):
        steps.append(
            f"""a{r} AS MATERIALIZED (
    SELECT vec_id, arg_min(cluster, (distance, cluster)) AS cluster, min(distance) AS distance
    FROM (SELECT vec_id, cluster, sum((x - c) * (x - c))::BIGINT AS distance FROM long JOIN c{r} USING (d) GROUP BY ALL) GROUP BY vec_id
)"""
        )
        if r < rounds:
            # Floor of the mean: // cuts towards zero, so the remainder is taken off first.
            steps.append(
                f"""c{r + 1} AS MATERIALIZED (
    SELECT cluster, d, coalesce((total - ((total % n) + n) % n) // n, c) AS c
    FROM c{r} LEFT JOIN (
        SELECT cluster, d, sum(x)::BIGINT AS total, count(*) AS n FROM long JOIN a{r} USING (vec_id) GROUP BY ALL
    ) USING (cluster, d)
)"""
            )
    last = rounds
    return "WITH " + ", ".join(steps) + (
        f""", digests AS (
    SELECT cluster, sha256(string_agg(c::VARCHAR, ',' ORDER BY d)) AS centroid_sha256 FROM c{last} GROUP BY cluster
)
SELECT vec_id, cluster::INTEGER AS cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
       (sum(distance) OVER ())::BIGINT AS inertia, centroid_sha256
FROM a{last} JOIN digests USING (cluster)"""
    )


SQL = _sql()
