import hashlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from roadsight.llm import fingerprints as fp
from tests.llm.conftest import SCHEMA, prose


def shingles(text):
    w = text.encode().lower().split()
    return {b" ".join(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) > 5 else {b" ".join(w)} if w else set()


def brute(docs):
    """doc_id order, edited text by the rule, resemblance of the full shingle sets."""
    rows = sorted(((d, t or "") for d, t in docs), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    out = []
    for i, (d, t) in enumerate(rows):
        following = rows[(i + 1) % len(rows)][1]
        n = len(t) // 4
        new = t[:len(t) - n] + following[:n]
        a, b, c = shingles(t), shingles(new), shingles(following)
        like = lambda x, y: len(x & y) / len(x | y) if x | y else 1.0
        out.append((d, len(t), hashlib.sha256(new.encode()).hexdigest(), like(a, b), like(a, c)))
    return out


def check(df, exact):
    want = brute([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()])
    got = fp.edit_fingerprints(df, fraction=1.0 if exact else fp.FRACTION).collect()
    key = lambda r: (r[0] is not None, r[0] or 0, r[2])
    got = sorted(((r.doc_id, r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in got), key=key)
    want = sorted(want, key=key)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    return np.array([g[3:] for g in got]) - np.array([w[3:] for w in want])


def test_edits_and_full_sketches_match_brute_force(edge_docs, sample_docs):
    assert np.abs(check(edge_docs, exact=True)).max() < 1e-12
    assert np.abs(check(sample_docs, exact=True)).max() < 1e-12


def test_scaled_sketches_estimate_likeness(sample_docs):
    assert np.abs(check(sample_docs, exact=False)).mean() < 0.1


def test_equal_texts_have_equal_fingerprints_and_copies_are_alike(edge_docs):
    rows = {r.doc_id: r for r in fp.edit_fingerprints(edge_docs).collect()}
    assert rows[1].fingerprint == rows[2].fingerprint and rows[1].near_next == 1.0
    assert rows[4].fingerprint == rows[5].fingerprint == ""


def test_empty_table_and_single_document(spark, no_docs):
    assert fp.edit_fingerprints(no_docs).collect() == []
    one = spark.createDataFrame([(1, "a b c d e f g h")], "doc_id long, text string")
    r = fp.edit_fingerprints(one).first()
    assert (r.n_chars, r.near_next) == (15, 1.0)


@given(st.lists(st.text("abc ", max_size=60), min_size=2, max_size=2), st.sampled_from([0.1, 0.5, 1.0]))
@settings(max_examples=60, deadline=None)
def test_sketches_merge(texts, fraction):
    a, b = (fp.sketch(t.encode(), fraction) for t in texts)
    hashes = np.union1d(*(fp.sketch(t.encode(), 1.0) for t in texts))
    low = hashes[hashes <= np.uint64(int(fraction * 2.0 ** 64) - 1)]
    want = low if len(low) else hashes[:1]
    assert fp.merge_sketches(a, b, fraction).tolist() == want.tolist()


def test_blocks_from_a_draw_of_ids(spark, monkeypatch):
    monkeypatch.setattr(fp, "IDS_PER_BLOCK", 1)
    monkeypatch.setattr(fp, "MOST_BLOCKS", 4)
    rows = [(i * 3 - 50, prose(i, 20), "en", "a", 1) for i in range(200)] + [(7, "one id of many rows", "en", "a", 1)] * 60
    got = fp.edit_fingerprints(spark.createDataFrame(rows, SCHEMA).repartition(5))
    in_order = sorted({r[0]: r[1] for r in rows}.items())
    after = {a: t for (a, _), (_, t) in zip(in_order, in_order[1:] + in_order[:1])}
    for r in got.collect():
        if r.doc_id not in (7, 4):
            text = dict(in_order)[r.doc_id]
            assert r.edited_sha256 == hashlib.sha256(fp.edited(text, after[r.doc_id]).encode()).hexdigest()
