import hashlib

import numpy as np

from roadsight.llm import laesa_kmeans as lk
from tests.llm.vectors_brute import SCHEMA, edge_vectors, integers


def brute(rows, clusters, rounds, dim):
    kept = [(a, integers(v)) for a, v, _ in rows if v is not None and len(v) == dim and integers(v) is not None]
    by_hash = sorted(kept, key=lambda r: (r[0] is None, "" if r[0] is None else hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    centres = [c for _, c in by_hash[:clusters]]

    def nearest(x):
        return min((sum((p - q) ** 2 for p, q in zip(x, c)), n) for n, c in enumerate(centres))

    for _ in range(rounds):
        found = [nearest(x)[1] for _, x in kept]
        for n in range(len(centres)):
            mine = [x for (_, x), f in zip(kept, found) if f == n]
            if mine:
                centres[n] = [sum(col) // len(mine) for col in zip(*mine)]
    found = [nearest(x) for _, x in kept]
    inertia = [sum(d for d, n in found if n == k) for k in range(len(centres))]
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((a if a is not None else -1), n, d, inertia[n], sum(inertia), sha[n]) for (a, _), (d, n) in zip(kept, found))


def result(df, **more):
    cols = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted((-1 if r.vec_id is None else r.vec_id, *tuple(r)[1:]) for r in lk.clusters_of(df, **more).select(*cols).collect())


def test_matches_measuring_all_distances(spark):
    r = np.random.default_rng(6)
    base = r.normal(size=(7, 6))
    rows = [(i, ((base[i % 7] + r.normal(size=6) * 0.3) * 0.4).astype("float32").tolist(), 0) for i in range(500)]
    rows += [(500 + i, rows[0][1], 1) for i in range(250)]        # a third of all rows is one vector
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    assert result(df, clusters=12, dim=6) == brute(rows, 12, 5, 6)
    assert result(df, clusters=12, dim=6, pivots=1) == brute(rows, 12, 5, 6)


def test_edge_vectors(spark):
    rows = edge_vectors()
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", cluster int, c string")
    for dim in (2, 3):
        assert result(df, clusters=4, dim=dim) == brute(rows, 4, 5, dim)
    assert result(df, dim=5) == []                                # nothing of that length
    assert result(df.limit(0), dim=2) == []


def test_empty_clusters_keep_their_centroid(spark):
    rows = [(i, [0.5, 0.5] if i < 8 else [float(i), -1.0], 0) for i in range(10)]
    assert result(spark.createDataFrame(rows, SCHEMA), clusters=10, dim=2) == brute(rows, 10, 5, 2)


def test_bounds_spare_most_distances():
    r = np.random.default_rng(7)
    centres = r.integers(-200, 200, (40, 8))
    x = (centres[r.integers(0, 40, 3000)] + r.integers(-10, 11, (3000, 8))).astype(np.int64)
    pivots = lk.choose_pivots(x[:1000], 16)
    cluster, distance, measured = lk.assign(x, lk.pivot_distances(x, pivots), centres, pivots)
    every = ((x[:, None, :] - centres[None]) ** 2).sum(axis=2)
    assert (cluster == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()
    assert measured < 0.2 * every.size


def test_sums_past_a_long_give_null(spark):
    rows = [(i, [1e300 if i % 2 else -1e300] * 64, 0) for i in range(8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = lk.clusters_of(df, clusters=1).collect()
    assert len(got) == 8 and all(r.inertia is None and r.distance == 64 * (1 << 27) ** 2 for r in got)
