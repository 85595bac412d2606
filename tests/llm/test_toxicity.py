import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from roadsight.llm import toxicity as tox
from .conftest import WORDS


def all_maximal(scores):
    """Maximal segments by definition: the best-scoring stretch (of those the
    shortest), then the same left and right of it."""
    best = None
    for a in range(len(scores)):
        total = 0
        for b in range(a, len(scores)):
            total += scores[b]
            if total > 0 and (best is None or total > best[2] or (total == best[2] and b + 1 - a < best[1] - best[0])):
                best = (a, b + 1, total)
    if best is None:
        return []
    a, b, s = best
    return all_maximal(scores[:a]) + [(a, b, s)] + [(x + b, y + b, z) for x, y, z in all_maximal(scores[b:])]


@given(st.lists(st.integers(-5, 5), max_size=25))
@settings(max_examples=400, deadline=None)
def test_segments_match_the_definition(scores):
    got = tox.maximal_segments(np.array(scores, dtype=float))
    want = all_maximal(scores)
    assert sorted(s for *_, s in got) == sorted(s for *_, s in want)
    assert all(sum(scores[a:b]) == s for a, b, s in got)


def corpus(n, seed):
    r = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = [r.choice(WORDS) + str(r.randrange(30)) for _ in range(r.randrange(5, 120))]
        bad = int(r.random() < 0.25)
        if bad:
            at = r.randrange(len(words))
            words[at:at] = [r.choice(["vile", "nasty", "rotten"]) + r.choice(["", "est", "ling"]) for _ in range(4)]
        rows.append((i, " ".join(words)))
        labels.append((i, 1, bad))
    return rows, labels


@pytest.fixture(scope="module")
def trained(spark):
    rows, labels = corpus(600, 1)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    table = spark.createDataFrame([*labels, (None, 1, 1), (3, 1, None), labels[0]], "doc_id long, quality int, toxic int")
    return docs, table, tox.train(docs, table), labels


def test_held_out_documents_are_told_apart(trained):
    docs, _, model, labels = trained
    truth = {i: bad for i, _, bad in labels}
    held = {i for i in truth if zlib.crc32(str(i).encode()) % 3 == 1}
    right = [r.predicted == truth[r.doc_id] for r in tox.score_documents(docs, model).collect() if r.doc_id in held]
    assert len(right) > 150 and np.mean(right) > 0.97


def test_scores_match_the_model_and_see_text_alone(spark, trained, edge_docs):
    _, _, model, _ = trained
    for r, d in zip(*(sorted(df.collect(), key=lambda r: (r.doc_id is None, r.doc_id)) for df in (tox.score_documents(edge_docs, model), edge_docs))):
        assert r.doc_id == d.doc_id and r.score == model.score(d.text) and 0 <= r.score <= 1
    assert model.score(None) == model.score("") == model.score("  ") < tox.THRESHOLD


def test_held_out_labels_do_not_train(spark, trained):
    docs, table, model, labels = trained
    flipped = spark.createDataFrame([(i, q, 1 - t if zlib.crc32(str(i).encode()) % 3 == 1 else t) for i, q, t in labels],
                                    "doc_id long, quality int, toxic int")
    assert (tox.train(docs, flipped).weights == model.weights).all()


def test_passages_point_at_the_toxic_words(trained):
    _, _, model, _ = trained
    text = " ".join(["pine3"] * 40 + ["vile", "nastyest", "rottenling", "vile"] + ["river7"] * 40)
    segments, n = model.segments(text)
    best = max(segments, key=lambda s: s[2])
    assert n == 84 and (best[0], best[1]) == (40, 44)


def test_filter_keeps_clean_rows_and_columns(spark, trained, edge_docs, no_docs):
    _, _, model, _ = trained
    out = tox.without_toxic(edge_docs, model)
    assert out.schema == edge_docs.schema and out.count() == edge_docs.count()
    bad = spark.createDataFrame([(1, "pine1 vile nasty rotten vile nasty"), (2, "pine1 river2")], "doc_id long, text string")
    assert [r.doc_id for r in tox.without_toxic(bad, model).collect()] == [2]
    assert tox.without_toxic(no_docs, model).count() == 0


@pytest.mark.parametrize("kind,low,high", [(None, 0.0, 1e-6), (0, 0.0, 1e-6), (1, 0.999, 1.0)])
def test_labels_of_one_kind_or_none(spark, edge_docs, kind, low, high):
    rows = [] if kind is None else [(i, 1, kind) for i in range(1, 12)]
    model = tox.train(edge_docs, spark.createDataFrame(rows, "doc_id long, quality int, toxic int"))
    assert low <= model.score("anything at all") <= high
