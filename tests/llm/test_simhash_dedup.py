import random
from itertools import combinations

import pytest
import xxhash

from roadsight.llm import components, simhash_dedup as sd
from .conftest import edge_documents, prose


def fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    shingles = [b" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or ([b" ".join(words)] if words else [])
    bits = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for b in range(64):
            bits[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * bits[b] > len(shingles))


def groups(values, limit=4):
    """Smallest key reachable, for {key: fingerprint}."""
    parent = {k: k for k in values}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(sorted(values), 2):
        if (values[a] ^ values[b]).bit_count() <= limit:
            p, q = top(a), top(b)
            parent[max(p, q)] = min(p, q)
    return {k: top(k) for k in values}


def test_every_four_shared_positions_have_a_triple():
    assert len(sd.POSITION_TRIPLES) == 20
    assert all(any(set(t) <= set(four) for t in sd.POSITION_TRIPLES) for four in combinations(range(8), 4))


@pytest.mark.parametrize("max_list", [sd.MAX_LIST, 3])
@pytest.mark.parametrize("limit", [4, 2])
def test_links_of_fingerprints_near_and_far(spark, max_list, limit):
    r = random.Random(5)
    values = {}
    for i in range(60):
        base = r.getrandbits(64)
        for j in range(4):
            flips = sum(1 << b for b in r.sample(range(64), r.randrange(7)))
            values[len(values)] = base ^ flips
    centre = r.getrandbits(64)
    for _ in range(40):       # a hot group in which most pairs share lists
        values[len(values)] = centre ^ sum(1 << b for b in r.sample(range(64), 2))
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    fps = spark.createDataFrame([(signed(v),) for v in set(values.values())], "fp long")
    links = sd.fingerprint_links(fps, limit, max_list).collect()
    unsigned = lambda v: v % (1 << 64)
    assert all((unsigned(x.a) ^ unsigned(x.b)).bit_count() <= limit for x in links)
    got = components.connected_components(spark.createDataFrame([(x.a, x.b) for x in links], "a long, b long"))
    of = {x.id: x.component for x in got.collect()}
    want = groups(values, limit)
    for i, j in combinations(values, 2):
        a, b = signed(values[i]), signed(values[j])
        assert (of.get(a, a) == of.get(b, b)) == (want[i] == want[j])


def test_documents(spark, edge_docs, sample_docs, no_docs):
    for df in (sample_docs, edge_docs):
        texts = {r.doc_id: r.text for r in df.collect() if r.doc_id is not None}
        prints = {k: fingerprint(t) for k, t in texts.items()}
        want = groups(prints)
        rows = sd.simhash_components(df).collect()
        assert len(rows) == df.count()
        for r in rows:
            if r.doc_id is not None:
                assert (r.fp % (1 << 64), r.component_id) == (prints[r.doc_id], want[r.doc_id])
            else:
                assert r.component_id is None
    assert sd.simhash_components(no_docs).collect() == []
    assert sd.one_of_each(no_docs).count() == 0


def test_one_of_each_group_stays(edge_docs):
    kept = sd.one_of_each(edge_docs)
    assert kept.columns == edge_docs.columns
    want = groups({r[0]: fingerprint(r[1]) for r in edge_documents() if r[0] is not None})
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(k for k, v in want.items() if k == v)
    assert sum(r.doc_id is None for r in kept.collect()) == 1


def test_very_long_text_is_hashed_in_portions(monkeypatch):
    text = prose(3, 500)
    whole = sd.fingerprint(text.encode())
    monkeypatch.setattr(sd, "CHUNK", 7)
    assert sd.fingerprint(text.encode()) == whole == fingerprint(text)


def test_components_of_a_path_a_star_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (200, 199), (199, 200)]
    got = {r.id: r.component for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 199: 199, 200: 199}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).collect() == []
