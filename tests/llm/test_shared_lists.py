import numpy as np
import pytest

from roadsight.llm import shared_lists as sl
from tests.llm.vectors_brute import SCHEMA, edge_vectors, integers


def brute(rows, every, positives=5, negatives=10):
    known = []
    for i, (a, v, k) in enumerate(rows):
        c = integers(v)
        if a is not None and k is not None and c is not None:
            known.append((i, a, c, (k + 1) % 10 if a % 7 == 0 else k))
    out = []
    for i, a, x, k in known:
        if a % every:
            continue
        score = [(-sum(p * q for p, q in zip(x, y)), b, j, m) for j, b, y, m in known if j != i and len(x) == len(y)]
        for s, b, _, _ in sorted(t for t in score if t[3] == k)[:positives]:
            near = sorted(t for t in score if t[3] != k and 30 * -s <= 100 * -t[0] <= 90 * -s)[:negatives]
            out += [(a, b, rank, n, -s, -t) for rank, (t, n, _, _) in enumerate(near, 1)]
    return sorted(out)


def result(df, **more):
    return sorted(tuple(r) for r in sl.hard_negatives(df, **more)
                  .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def vectors(n=700, dim=8, seed=4):
    r = np.random.default_rng(seed)
    base = r.normal(size=(10, dim))
    rows = [(i, ((base[i % 10] + r.normal(size=dim) * (0.2 + i % 3)) * 0.2).astype("float32").tolist(), int(r.integers(0, 10))) for i in range(n)]
    return rows + [(n + i, rows[i % 5][1], 3 if i % 2 else 4) for i in range(80)]     # equal vectors under a hot label


@pytest.mark.parametrize("sizes", [{}, {"block": 60, "group": 4}])
def test_matches_brute_force(spark, sizes):
    rows = vectors()
    want = brute(rows, 20)
    assert len(want) > 500
    assert result(spark.createDataFrame(rows, SCHEMA), every=20, **sizes) == want


def test_edge_vectors(spark):
    rows = edge_vectors()
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", rank int, no string")
    assert result(df, every=1) == brute(rows, 1)
    assert result(df.limit(0)) == []


def test_negative_and_zero_scores(spark):
    rows = [(100, [1.0, 0.0], 0), (1, [-1.0, 0.0], 0), (2, [0.0, 1.0], 0), (3, [0.0, -1.0], 1), (4, [-0.5, 0.0], 1), (5, [0.0, 0.0], 1)]
    want = brute(rows, 100)
    assert {(p, n) for _, p, _, n, _, _ in want} == {(2, 3), (2, 5)}
    assert result(spark.createDataFrame(rows, SCHEMA)) == want


def test_walks_end_early_and_lose_nothing():
    r = np.random.default_rng(5)
    x = np.round(r.normal(size=(40, 16)) * 10).astype(np.int64)
    c = np.concatenate([x + r.integers(-2, 3, x.shape), np.round(r.normal(size=(5000, 16)) * 2).astype(np.int64)])
    members = x[:1] + r.integers(-1, 2, (6, 16))
    lst = sl.SharedList(members, c, *sl._directions(c))
    ids, seen = np.arange(len(c)), []
    stretches = lst.stretches
    lst.stretches = lambda need: (seen.append(len(at)) or (w, at, s) for w, at, s in stretches(need))
    found = sl.walk_positives(lst, np.full(6, -1), ids, ids, 5)
    for m, (at, s) in zip(members, found):
        order = np.lexsort((ids, -(c @ m)))[:5]
        assert at.tolist() == order.tolist() and s.tolist() == (c @ m)[order].tolist()
    assert sum(seen) < len(c) / 4
