import numpy as np
import pytest

from roadsight.llm import embedding_dedup as ed


def brute(rows, cosine):
    ids = {r[0] for r in rows}
    links, parent = {i: set() for i in ids}, {i: i for i in ids}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    def sound(v):
        return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    for i, (a, v, k) in enumerate(rows):
        for b, w, m in rows[i + 1:]:
            if a == b or k is None or k != m or not sound(v) or not sound(w) or len(v) != len(w):
                continue
            x, y = (np.array(z, dtype=float) / np.abs(np.array(z, dtype=float)).max() for z in (v, w))
            if x @ y / np.sqrt((x @ x) * (y @ y)) >= cosine:
                links[a].add(b)
                links[b].add(a)
                p, q = top(a), top(b)
                parent[max(p, q)] = min(p, q)
    return {i: (len(links[i]), top(i), top(i) == i) for i in ids}


def result(df, **more):
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in ed.near_duplicates(df, **more).collect()}


@pytest.fixture(scope="module")
def vectors():
    r = np.random.default_rng(3)
    rows, n = [], 0
    for label in (0, 1):
        for _ in range(30):
            base = r.normal(size=16)
            for _ in range(int(r.integers(1, 5))):
                rows.append((n, (base + r.normal(size=16) * 0.03).astype("float32").tolist(), label))
                n += 1
    hot = r.normal(size=16)
    for i in range(60):      # a hot group of copies and near copies
        rows.append((n + i, (hot + (i % 2) * r.normal(size=16) * 0.02).astype("float32").tolist(), 1))
    return rows


SCHEMA = "vec_id long, embedding array<float>, label int"


def test_links_and_components_match_brute_force(spark, vectors):
    want = brute(vectors, 0.98)
    df = spark.createDataFrame(vectors, SCHEMA)
    assert result(df) == want
    assert result(df, piece=7, sample=40) == want      # hot lists in pieces, a smaller sample


def test_edge_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 0), (2, [2.0, 0.0], 0), (3, [1.0, 0.0], None), (4, None, 0), (5, [], 0), (6, [0.0, 0.0], 0),
            (7, [nan, 1.0], 0), (8, [inf, 1.0], 0), (9, [None, 1.0], 0), (10, [1.0, 0.0, 0.0], 0), (11, [1.0, 0.0, 0.1], 0),
            (12, [1.0, 0.0], 1), (13, [-0.0, -1.0], 0)]
    df = spark.createDataFrame([(*r, "c", 5) for r in rows], SCHEMA + ", cell string, n_links int")
    assert result(df) == brute(rows, 0.98)
    assert result(df.limit(0)) == {}


def test_several_lengths_in_a_label(spark):
    rows = [(i, [1.0, float(i)], 0) for i in range(5)]
    rows += [(10, [1.0, 0.0, 0.0], 0), (11, [1.0, 0.0, 0.1], 0), (12, [1.0, 0.0, 0.0, 0.0], 0), (13, [1.0, 0.0, 0.1, 0.0], 0), (14, [3.0], 0)]
    assert result(spark.createDataFrame(rows, SCHEMA)) == brute(rows, 0.98)


def test_rows_of_a_vec_id_are_one_vertex(spark):
    rows = [(1, [1.0, 0.0], 0), (5, [2.0, 0.0], 0), (5, [0.0, 1.0], 1), (9, [0.0, 3.0], 1), (5, [1.0, 1.0], 2), (7, [1.0, -1.0], 0),
            (5, None, 0), (7, [1.0, -1.0], 0), (7, [1.0, -1.0], None), (1, [0.0, 2.0], 1), (3, [1.0, 0.01], 0), (8, [0.0, 5.0], 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = ed.near_duplicates(df).collect()
    assert len(got) == len(rows) and len({tuple(r) for r in got}) == len({r[0] for r in rows})
    assert result(df) == brute(rows, 0.98)


def test_shared_ids_among_many_links(spark, vectors):
    rows = vectors + [(i, vectors[(i * 7) % len(vectors)][1], vectors[(i * 7) % len(vectors)][2]) for i in range(0, 60, 3)]
    assert result(spark.createDataFrame(rows, SCHEMA), piece=9) == brute(rows, 0.98)


def test_components_of_any_size(spark, vectors):
    scale = [1e-200, 1e200, 1e-310, 1.0, 1e307]
    rows = [(i, [float(x) * scale[i % 5] for x in v], k) for i, v, k in vectors]
    rows += [(1000, [5e-324] + [0.0] * 15, 1), (1001, [1.7e308] * 16, 1), (1002, [-1.7e308] * 16, 1), (1003, [1e-200] * 16, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    want = brute(rows, 0.98)
    assert sum(n for n, _, _ in want.values()) > 1000
    assert result(df) == want


def test_given_table(spark):
    from tests.conftest import SF001
    df = spark.read.parquet(f"{SF001}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    assert result(df, min_cosine=0.3) == brute(rows, 0.3)     # a cosine at which this table has links
