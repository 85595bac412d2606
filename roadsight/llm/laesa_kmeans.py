"""Centroid clustering with a LAESA pivot table.

*Pivot table.*  Every vector's distances to a few fixed pivots are computed
once and stored beside its integers.  Pivots are rows of the table, each chosen
as the one farthest from those before it among the first ``CANDIDATES`` rows by
hash.

*Rounds.*  In a round the distances between centroids and pivots are computed
(centroids x pivots, tiny).  By the triangle inequality the largest difference
between a vector's and a centroid's pivot distances is at most the distance
between the two: a lower bound for every centroid without touching the vector.
Each vector's centroid of the smallest bound is measured exactly; centroids
whose bound exceeds that distance are dropped and only the survivors receive
exact integer distances.  Bounds are lowered by more than their rounding error,
so the result is that of measuring all.

*Scale.*  The centroids (at most ``clusters`` rows) travel with the tasks.  A
task sums its vectors per centroid and hands on one row of sums a centroid, so
a round shuffles tasks x clusters rows whatever the table's size or the
largest cluster, and brings clusters rows to the driver.  Sums are exact
integers; they do not depend on the order of rows.

Defined cases: rows whose vector is null, has not exactly ``dim`` components or
holds null or non-finite ones are left out; ids may be null or repeat, a row is
a vector of its own (a null id is the last by hash, equal hashes are ordered by
their components); fewer vectors than clusters give fewer centroids, an empty
table no rows; equal centroids are told apart by number; components beyond
+-2^27 are set to these; ``inertia`` is null if it exceeds a long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import read_table, stored
from .vectors import matrix, quantised

DIM, CLUSTERS, ROUNDS, SEED = 64, 40, 5, 2
PIVOTS, CANDIDATES = 16, 1024


def _squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer vectors, row by row."""
    d = x - y
    return np.einsum("ij,ij->i", d, d)


def choose_pivots(x: np.ndarray, n: int) -> np.ndarray:
    """Rows of ``x``, each the farthest from those chosen before."""
    if not len(x):
        return x
    chosen = [0]
    near = _squared(x, x[:1])
    while len(chosen) < min(n, len(x)) and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, _squared(x, x[chosen[-1:]]))
    return x[chosen]


def pivot_distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.stack([_squared(x, p[None, :]) for p in pivots], axis=1).astype(np.float64))


def assign(x: np.ndarray, table: np.ndarray, centroids: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Number and squared distance of each vector's nearest centroid (the
    smaller number of equals), and how many distances were measured."""
    of_centroids = pivot_distances(centroids, pivots)
    bound = np.zeros((len(x), len(centroids)))
    for p in range(len(pivots)):
        np.maximum(bound, np.abs(table[:, p, None] - of_centroids[None, :, p]), out=bound)
    # lowered beyond the rounding of two roots and their difference
    slack = 1e-12 * (table.max(axis=1)[:, None] + of_centroids.max(axis=1)[None, :]) + 1e-9
    bound = np.maximum(bound - slack, 0.0) ** 2 * (1 - 1e-12)
    best = bound.argmin(axis=1)
    distance = _squared(x, centroids[best])
    i, j = np.nonzero(bound <= distance[:, None])
    other = j != best[i]
    i, j = i[other], j[other]
    measured = np.empty(len(i), dtype=np.int64)
    for s in range(0, len(i), 1 << 14):
        measured[s:s + (1 << 14)] = _squared(x[i[s:s + (1 << 14)]], centroids[j[s:s + (1 << 14)]])
    order = np.lexsort((j, measured, i))
    i, j, measured = i[order], j[order], measured[order]
    first = np.flatnonzero(np.r_[True, i[1:] != i[:-1]]) if len(i) else np.zeros(0, np.int64)
    row, number, d = i[first], j[first], measured[first]
    closer = (d < distance[row]) | ((d == distance[row]) & (number < best[row]))
    best[row[closer]], distance[row[closer]] = number[closer], d[closer]
    return best, distance, len(x) + len(measured)


def _read(b: pa.RecordBatch, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Integers and pivot distances of a batch of the stored table."""
    x = np.frombuffer(b"".join(b.column("c").to_pylist()), np.int32).reshape(b.num_rows, dim).astype(np.int64)
    return x, np.frombuffer(b"".join(b.column("pivots").to_pylist()), np.float64).reshape(b.num_rows, -1)


def clusters_of(table: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, dim: int = DIM, seed: int = SEED,
                id_col: str = "vec_id", vector_col: str = "embedding", pivots: int = PIVOTS) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256
    of every vector."""
    spark = table.sparkSession
    kept = quantised(table, id_col, vector_col, named=False).filter(F.col("dim") == dim)
    kept = stored(kept.select(F.col("vec_id").alias("id"), "c"), "kept-vectors")
    first = (kept.select("c", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256).alias("h"))
             .orderBy(F.asc_nulls_last("h"), "c").limit(max(clusters, CANDIDATES)).toArrow())
    start = matrix(first["c"].combine_chunks(), dim)
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not len(start):
        return spark.createDataFrame([], schema)
    fixed, centroids = choose_pivots(start, pivots), start[:clusters].copy()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = matrix(b.column("c"), dim)
                near = pivot_distances(x, fixed)
                yield pa.RecordBatch.from_arrays(
                    [b.column("id"), pa.array([r.tobytes() for r in x.astype(np.int32)], pa.binary()),
                     pa.array([r.tobytes() for r in near], pa.binary())], ["id", "c", "pivots"])

    pivot_table = stored(kept.mapInArrow(place, "id long, c binary, pivots binary"), "pivot-table")

    def sums(centroids: np.ndarray):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, count = np.zeros((len(centroids), dim), dtype=np.int64), np.zeros(len(centroids), dtype=np.int64)
            for b in batches:
                if b.num_rows:
                    x, near = _read(b, dim)
                    cluster, _, _ = assign(x, near, centroids, fixed)
                    np.add.at(total, cluster, x)
                    count += np.bincount(cluster, minlength=len(centroids))
            used = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays(
                [pa.array(used.astype(np.int32)), pa.array(count[used]),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(used) + 1, dtype=np.int32) * dim), pa.array(total[used].ravel()))],
                ["cluster", "n", "total"])
        return run

    for _ in range(rounds):
        parts = pivot_table.mapInArrow(sums(centroids), "cluster int, n long, total array<long>")
        # one row a centroid: its count and component sums, wide enough for any table
        wide = parts.groupBy("cluster").agg(F.sum("n").alias("n"), *[F.sum(F.col("total")[d].cast("decimal(38,0)")).alias(f"s{d}") for d in range(dim)])
        for r in wide.collect():
            centroids[r["cluster"]] = [int(r[f"s{d}"]) // r["n"] for d in range(dim)]

    final = centroids.copy()

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                cluster, distance, _ = assign(*_read(b, dim), final, fixed)
                yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(cluster.astype(np.int32)), pa.array(distance)], ["vec_id", "cluster", "distance"])

    placed = stored(pivot_table.mapInArrow(last, "vec_id long, cluster int, distance long"), "clusters")
    names = spark.createDataFrame([(i, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for i, c in enumerate(final.tolist())],
                                  "number int, centroid_sha256 string")
    each = stored(placed.groupBy(F.col("cluster").alias("number")).agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")), "inertia")
    whole = each.agg(F.sum("d").cast("decimal(38,0)")).first()[0]
    # at most ``clusters`` rows
    facts = each.join(F.broadcast(names), "number").select(
        "number", F.col("d").try_cast("long").alias("cluster_inertia"), F.lit(whole).try_cast("long").alias("inertia"), "centroid_sha256")
    return (placed.join(F.broadcast(facts), placed["cluster"] == facts["number"])
            .select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"))


def op13_laesa_kmeans(spark, sf_dir: str) -> DataFrame:
    """Query: vec_id, cluster, distance, cluster_inertia, inertia,
    centroid_sha256 over ``embeddings``."""
    return clusters_of(read_table(spark, sf_dir, "embeddings"))


def _sql(clusters: int = CLUSTERS, rounds: int = ROUNDS, dim: int = DIM, seed: int = SEED) -> str:
    """Every distance measured, one step a round."""
    steps = [f"""
kept AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(e, lambda x: floor(256 * x)::BIGINT) AS c
  FROM (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings)
  WHERE len(e) = {dim} AND len(list_filter(e, lambda x: x IS NOT NULL AND isfinite(x))) = {dim}),
part AS MATERIALIZED (SELECT rid, d, c[d] AS x FROM kept, range(1, {dim + 1}) AS t(d)),
c0 AS MATERIALIZED (
  SELECT n, d, c[d] AS x FROM (
    SELECT c, row_number() OVER (ORDER BY sha256('{seed}:' || vec_id::VARCHAR) NULLS LAST, c) - 1 AS n FROM kept) s, range(1, {dim + 1}) AS t(d)
  WHERE n < {clusters})"""]
    for r in range(rounds + 1):
        steps.append(f"""
a{r} AS MATERIALIZED (
  SELECT rid, arg_min(n, (distance, n)) AS n, min(distance) AS distance FROM (
    SELECT p.rid, k.n, sum((p.x - k.x) * (p.x - k.x))::BIGINT AS distance FROM part p JOIN c{r} k ON p.d = k.d GROUP BY p.rid, k.n) s
  GROUP BY rid)""")
        if r < rounds:
            steps.append(f"""
c{r + 1} AS MATERIALIZED (
  SELECT k.n, k.d, coalesce(m.x, k.x) AS x FROM c{r} k LEFT JOIN (
    SELECT n, d, ((s - ((s % w) + w) % w) / w)::BIGINT AS x FROM (
      SELECT a.n, p.d, sum(p.x)::BIGINT AS s, count(*) AS w FROM a{r} a JOIN part p ON p.rid = a.rid GROUP BY a.n, p.d) t) m
  ON m.n = k.n AND m.d = k.d)""")
    return "WITH " + ",".join(steps) + f""",
sums AS (SELECT n, sum(distance)::BIGINT AS cluster_inertia FROM a{rounds} GROUP BY n),
digest AS (SELECT n, sha256(string_agg(x::VARCHAR, ',' ORDER BY d)) AS centroid_sha256 FROM c{rounds} GROUP BY n)
SELECT kept.vec_id, a.n::INTEGER AS cluster, a.distance, cluster_inertia,
       (SELECT sum(cluster_inertia)::BIGINT FROM sums) AS inertia, centroid_sha256
FROM a{rounds} a JOIN kept ON kept.rid = a.rid JOIN sums ON sums.n = a.n JOIN digest ON digest.n = a.n
"""


OP13_SQL = _sql()
