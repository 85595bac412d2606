import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from roadsight.llm import sentencepiece_codec as sc
from .conftest import edge_documents


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=sc.MODEL_PATH)


CODEC = sc.Codec(sc.Vocabulary.from_file(sc.MODEL_PATH))


@given(st.text(st.sampled_from("abcdeinorst .,;:!?-_()éüñß▁\n\t0123456789АБ日\U0001F600"), max_size=60))
@settings(max_examples=200, deadline=None)
def test_ids_are_those_of_the_merges(text):
    lib = sentencepiece.SentencePieceProcessor(model_file=sc.MODEL_PATH)
    assert CODEC.encode(text) == lib.encode(text)


@given(st.text(max_size=80).filter(lambda t: "▁" not in t))
@settings(max_examples=200, deadline=None)
def test_round_trip(text):
    import numpy as np
    assert CODEC.decode(np.array(CODEC.encode(text), dtype=np.int64)) == text


def test_unigram_path_is_the_best_of_all_segmentations():
    pieces = ["<unk>", "▁", "a", "b", "ab", "ba", "▁a", "abb", "▁ab"]
    scores = [0.0, -3.0, -2.0, -2.5, -3.0, -3.2, -3.9, -4.4, -5.5]
    codec = sc.Codec(sc.Vocabulary(pieces, scores, ["unknown"] + ["normal"] * 8, unigram=True))

    def best(word):
        if not word:
            return 0.0
        return max([scores[pieces.index(p)] + best(word[len(p):]) for p in pieces[1:] if word.startswith(p)])

    for text in ("a", "ab", "abba", "abbabba", "bbb aab abb", "  ab"):
        got = sum(scores[i] for i in codec.encode(text))
        want = sum(best(u) for u in codec.units(text))
        assert abs(got - want) < 1e-9


def test_documents(spark, library, edge_docs, no_docs, sample_docs):
    for df in (edge_docs, sample_docs, no_docs):
        texts = df.select("doc_id", "text")
        got = sc.encode(df, keep=("doc_id", "text"))
        for r in got.collect():
            assert r.exact and r.ids == (None if r.text is None else library.encode(r.text))
        back = sc.decode(sc.encode(df))
        key = lambda r: (r.doc_id is not None, r.doc_id or 0, r.text is not None, r.text or "")
        assert sorted(map(key, back.collect())) == sorted(map(key, texts.collect()))


def test_words_are_found_again_when_the_memory_is_small(monkeypatch, library):
    monkeypatch.setattr(sc, "MEMO", 8)
    codec = sc.Codec(sc.Vocabulary.from_file(sc.MODEL_PATH))
    for _, text, *_ in edge_documents():
        if text is not None:
            assert codec.encode(text[:3000]) == library.encode(text[:3000])


def test_ids_out_of_range_decode_to_nothing():
    import numpy as np
    ids = np.array([-1, 10 ** 6, *CODEC.encode("pine river")])
    assert CODEC.decode(ids) == "pine river"


def test_long_words_share_deep_prefixes(library):
    import time
    base = "".join(chr(97 + (i * i) % 26) for i in range(300))
    words = [base[:k] + tail for k in (40, 63, 64, 65, 66, 130, 299) for tail in ("", "x", "ing", "zzz")]
    codec = sc.Codec(sc.Vocabulary.from_file(sc.MODEL_PATH))
    assert codec.encode_all(words) == [np.array(library.encode(w), dtype=np.int32).tobytes() for w in words]
    start = time.process_time()
    assert codec.decode(np.array(codec.encode(base * 3000))) == base * 3000
    assert time.process_time() - start < 30


def test_a_lost_character_is_told():
    pieces = ["<unk>", "\u2581", "a", "b", "\u2581a"]
    codec = sc.Codec(sc.Vocabulary(pieces, [0.0, -3.0, -2.0, -2.5, -3.9], ["unknown"] + ["normal"] * 4, unigram=True))
    texts = ["ab a", "a c", "c", "", None, "a\u2581b"]
    codec.encode_all(texts)
    assert [codec.decodes_to(t) for t in texts] == [True, False, False, True, True, False]


@pytest.fixture(scope="module")
def unigram_library():
    """The library's own Viterbi over the model's pieces with the query's scores."""
    from sentencepiece import sentencepiece_model_pb2 as pb
    model = pb.ModelProto()
    with open(sc.MODEL_PATH, "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.model_type = 1
    for piece, score in zip(model.pieces, sc.Vocabulary.from_file(sc.MODEL_PATH).with_scores().scores):
        piece.score = score
    return sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())


def test_query_runs_the_forward_scores_and_decodes(spark, edge_docs, tmp_path, unigram_library):
    """The best path is that of the library's Viterbi, its ids decode to the
    text, and the score is that of the path."""
    edge_docs.write.parquet(str(tmp_path / "documents.parquet"))
    texts = {r.doc_id: r.text for r in edge_docs.collect()}
    codec = sc.Codec(sc.Vocabulary.from_file(sc.MODEL_PATH).with_scores())
    rows, told = sc.op3_sentencepiece(spark, str(tmp_path)).collect(), 0
    assert len(rows) == edge_docs.count()
    for r in rows:
        text = texts[r.doc_id]
        if text is None:
            assert (r.best_ids, r.best_score) == (None, None)
            continue
        ids = np.array(r.best_ids, dtype=np.int32)
        assert codec.decode(ids) == text and r.best_score == pytest.approx(codec.id_score[ids].sum())
        theirs = np.array(unigram_library.encode(text), dtype=np.int32)
        assert r.best_score == pytest.approx(codec.id_score[theirs].sum(), rel=1e-5)
        told += len(ids) > 0 and r.best_ids != r.ids
    assert told > 0


def test_exact_comes_from_decoded_ids(monkeypatch):
    """Ids that decode to something else are not called exact."""
    codec = sc.Codec(sc.Vocabulary.from_file(sc.MODEL_PATH))
    texts = ["pine river", "", " \U0001F600x ", "  "]
    assert codec.decode_all(codec.encode_units(codec.cut(texts))[0]) == texts and codec.decodes_to("pine river")
    monkeypatch.setattr(codec, "encode_units", lambda units: [sc.Encoded(np.array([300, 301], np.int32), np.array([0, 2]))] * 2)
    assert not codec.decodes_to("pine river")
