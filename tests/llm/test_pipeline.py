import corpus_pipeline
import sentencepiece

from roadsight.llm import sanitise, sentencepiece_codec, toxicity
from roadsight.llm.tables import read_table, stored
from tests.conftest import SF001
from .test_simhash_dedup import fingerprint, groups


def test_each_stage_against_a_plain_version(spark):
    docs = read_table(spark, SF001, "documents")
    columns = docs.columns
    model = toxicity.train(docs, read_table(spark, SF001, "labels"))
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "simhash_dedup", "pii", "mixing", "sentencepiece"]

    a = stored(stages["toxicity"](spark, docs, SF001), "t")
    assert sorted(r.doc_id for r in a.collect()) == sorted(r.doc_id for r in docs.collect() if model.score(r.text) < 0.7)

    b = stored(stages["simhash_dedup"](spark, a, SF001), "t")
    want = groups({r.doc_id: fingerprint(r.text) for r in a.collect()})
    assert sorted(r.doc_id for r in b.collect()) == sorted(k for k, v in want.items() if k == v)

    c = stored(stages["pii"](spark, b, SF001), "t")
    old = {r.doc_id: r.text for r in b.collect()}
    for r in c.collect():
        assert not [s for s in sanitise.base_spans(r.text) if s[0] != "card"]
        if not sanitise.base_spans(old[r.doc_id]):
            assert r.text == old[r.doc_id]

    d = stored(stages["mixing"](spark, c, SF001), "t")
    assert a.columns == b.columns == c.columns == d.columns == columns
    assert {r.doc_id for r in d.collect()} <= {r.doc_id for r in c.collect()}

    e = stages["sentencepiece"](spark, d, SF001)
    lib = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_codec.MODEL_PATH)
    text = {r.doc_id: r.text for r in d.collect()}
    rows = e.collect()
    assert len(rows) == d.count() and all(r.exact and r.ids == lib.encode(text[r.doc_id]) for r in rows)


def test_edge_documents_and_empty_table(spark, edge_docs, no_docs):
    for docs in (edge_docs, no_docs):
        n, start = docs.count(), docs
        for name, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, SF001), "t")
            assert name == "sentencepiece" or docs.columns == start.columns
        assert (docs.count() > 0) == (n > 0)


def test_registered(spark):
    import __spark_entry__ as entry
    names = entry.queries()
    assert "pipeline" in names and all(any(q.startswith(f"op{i}_") for q in names) for i in range(1, 11))
    assert {"op4_license_scan", "op6_mixing"} <= set(entry.oracle_sql())
