"""K-Means has no SQL form: check it against a brute-force Lloyd's algorithm
(numpy, many random starts) on a small fixture."""

import numpy as np

from roadsight.operators import clustering


def _lloyd(pts, w, k, rng, iters=100):
    c = pts[rng.choice(len(pts), k, replace=False)]
    for _ in range(iters):
        lab = ((pts[:, None, :] - c[None]) ** 2).sum(-1).argmin(1)
        new = np.array([np.average(pts[lab == j], axis=0, weights=w[lab == j])
                        if (lab == j).any() else c[j] for j in range(k)])
        if np.allclose(new, c):
            break
        c = new
    lab = ((pts[:, None, :] - c[None]) ** 2).sum(-1).argmin(1)
    return ((pts - c[lab]) ** 2).sum(-1) @ w, c


def test_zones_match_brute_force(spark):
    rng = np.random.default_rng(7)
    centres = np.array([[12.9, 80.1], [13.0, 80.3], [13.1, 80.0], [13.2, 80.2], [13.05, 80.45]])
    raw = np.vstack([c + rng.normal(scale=0.01, size=(60, 2)).round(3) for c in centres])
    df = spark.createDataFrame([tuple(map(float, r)) for r in raw],
                               "Latitude double, Longitude double")
    fitted = clustering.fit_zones(df)
    model, _, got_centres = fitted
    got_cost = model.summary.trainingCost
    pts, counts = np.unique(raw, axis=0, return_counts=True)
    best = min((_lloyd(pts, counts.astype(float), 5, rng) for _ in range(50)),
               key=lambda t: t[0])
    assert abs(got_cost - best[0]) <= 1e-9 + 1e-6 * best[0]
    want = sorted(map(tuple, best[1]))
    for g, w in zip(got_centres, want):
        assert np.allclose(g, w, atol=1e-9)
    # every point is assigned to its nearest centre
    assign = clustering.kmeans_clusters(df, fitted).collect()
    c = np.array(got_centres)
    for r in assign:
        d = ((c - np.array([r.Latitude, r.Longitude])) ** 2).sum(1)
        assert r.cluster == int(d.argmin())
