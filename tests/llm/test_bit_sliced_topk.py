import numpy as np
import pytest

from roadsight.llm import bit_sliced_topk as bs
from tests.llm.vectors_brute import SCHEMA, edge_vectors, integers


def brute(rows, k, every):
    """(query row, its scores in order): ids of equal score and id are alike."""
    known = [(i, r[0], integers(r[1])) for i, r in enumerate(rows) if r[0] is not None and integers(r[1]) is not None]
    out = []
    for i, a, x in known:
        if a % every == 0:
            near = sorted((-sum(p * q for p, q in zip(x, y)), b) for j, b, y in known if j != i and len(y) == len(x))[:k]
            out += [(a, rank, b, -s) for rank, (s, b) in enumerate(near, 1)]
    return sorted(out)


def result(df, **more):
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in bs.top_k(df, **more).collect())


def test_bitmap_sums_are_the_inner_products():
    r = np.random.default_rng(1)
    c, q = r.integers(-300, 300, (200, 9)), r.integers(-300, 300, (11, 9))
    q[3] = 0
    low = c.min(axis=0)
    total, constant = bs.scores(q, low, *bs.bit_slices(c - low))
    got = np.repeat(constant[:, None], 200, axis=1)
    for level, bits in enumerate(total):
        if bits is not None:
            got += np.unpackbits(bits.view(np.uint8), axis=1, bitorder="little")[:, :200].astype(np.int64) << level
    assert (got == q @ c.T).all()


def test_selection_leaves_ties_at_the_boundary():
    score = np.array([5, 1, 7, 5, 5, 0, 7, 3])
    slices = [np.packbits((score >> b & 1).astype(np.uint8), bitorder="little") for b in range(3)]
    total = [np.concatenate([s, np.zeros(7, np.uint8)]).view(np.uint64)[None, :] for s in slices]
    sure, tied = bs.select(total, np.array([[np.uint64(0xFF)]]), 3)
    assert (bs._rows_of(sure[0]).tolist(), bs._rows_of(tied[0]).tolist()) == ([2, 6], [0, 3, 4])


@pytest.mark.parametrize("block", [bs.BLOCK, 70])
def test_matches_brute_force(spark, block):
    r = np.random.default_rng(2)
    rows = [(i, (r.normal(size=12) * 0.2).astype("float32").tolist(), 0) for i in range(400)]
    rows += [(400 + i, rows[i % 3][1], 0) for i in range(60)]       # ties by the dozen
    assert result(spark.createDataFrame(rows, SCHEMA), block=block) == brute(rows, 5, 50)


def test_edge_vectors(spark):
    rows = edge_vectors()
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", score int, rid string")
    assert result(df, every=1, k=3) == brute(rows, 3, 1)
    assert result(df.limit(0)) == []


def test_more_wanted_than_there_are(spark):
    rows = [(0, [1.0, 2.0], 0), (50, [0.5, -1.0], 0), (7, [0.0, 0.0], 0)]
    assert result(spark.createDataFrame(rows, SCHEMA)) == brute(rows, 5, 50)


def test_huge_components_are_set_to_the_range(spark):
    rows = [(0, [1e300, 1.0], 0), (1, [-1e300, 0.0], 0), (2, [1.0, 0.0], 0)]
    got = result(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), every=1)
    top = 1 << 29
    assert (0, 1, 2, 256 * top) in got and (0, 2, 1, -top * top) in got
