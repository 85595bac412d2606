import hashlib
import math
import re

import pytest
from hypothesis import example, given, settings
from hypothesis import strategies as st

from roadsight.llm import sanitise as sa

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    odd = [int(d) for d in digits[-1::-2]]
    even = [sum(divmod(2 * int(d), 10)) for d in digits[-2::-2]]
    return (sum(odd) + sum(even)) % 10 == 0


def brute(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = "".join(c for c in m[0] if c in "0123456789")
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, *m.span()))
    return out


@given(st.text("ab.@-+0123 ()%é", max_size=40))
@example("a@b.c@d.e.f@.x@@y.z")
@example("4111 1111 1111 1111 and 4111111111111112 300.1.1.1 1.2.3.4.5")
@settings(max_examples=400, deadline=None)
def test_base_spans_are_those_of_the_patterns(text):
    assert sa.base_spans(text) == brute(text)


def test_long_runs_take_linear_time():
    assert sa.base_spans("a" * 300_000 + " " + "a.@" * 100_000) == []


def test_query_digest(spark, edge_docs, sample_docs, no_docs):
    for df in (edge_docs, sample_docs, no_docs):
        rows = sa.personal_spans(df).collect()
        assert len(rows) == df.count()
        texts = {}
        for r in df.collect():
            texts.setdefault(r.doc_id, []).append(brute(r.text))
        for r in rows:
            assert [(s.kind, s.start, s.end) for s in r.spans] in texts[r.doc_id]


def test_disclosing_terms_are_generalised_or_removed(spark):
    """A term that stands by an entity in several contexts, and seldom or
    never elsewhere, is a span; common words and words of other texts aren't."""
    rows = []
    for i in range(6):
        rows.append((i, f"w{i} x{i} the Zorro desk{i} q{i} owner bob@site.example.com sees y{i} z{i} v{i} u{i} t{i}"))
    rows.append((6, "Zorro the film"))
    rows += [(i, f"the plain text number w{i} owner of nothing the end") for i in range(7, 60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in sa.personal_spans(df).collect()}
    text = dict(rows)
    for i in range(6):
        added = {(s.kind, text[i][s.start:s.end]) for s in got[i].added}
        assert added == {("term", "Zorro"), ("sole", "sees")}
    assert all(not got[i].added and not got[i].spans for i in range(6, 60))
    clean = {r.doc_id: r.text for r in sa.sanitise(df).collect()}
    assert clean[0] == "w0 x0 the [TERM] desk0 q0 owner [EMAIL]  y0 z0 v0 u0 t0"
    assert all(clean[i] == text[i] for i in range(6, 60))


def test_copies_of_a_context_do_not_vote(spark):
    rows = [(i, "here rare word sits beside bob@site.example.com and more rare words") for i in range(40)]
    df = spark.createDataFrame(rows + [(99, "other text")], "doc_id long, text string")
    assert all(not r.added for r in sa.personal_spans(df).collect())


def brute_added(texts):
    """The added spans of each text, from the definition."""
    texts = list(dict.fromkeys(texts))
    words = {t: [(w.encode().lower(), m.start(), m.end()) for m in re.finditer(r"[^\x20\x09-\x0D]+", t) for w in [m[0]]] for t in texts}
    held = {t: {w for w, _, _ in words[t]} for t in texts}
    values = {t: {(k, t[a:b].lower()) for k, a, b in brute(t)} for t in texts}
    out = {t: {} for t in texts}
    for c in {v for vs in values.values() for v in vs}:
        with_c = [t for t in texts if c in values[t]]
        for w in {w for t in with_c for w in held[t]}:
            n_t, n_ct = sum(w in held[t] for t in texts), sum(w in held[t] for t in with_c)
            ic = math.log2(len(texts) / len(with_c))
            if ic <= 0 or math.log2(len(texts) * n_ct / ((len(with_c) + 1) * (n_t + 1))) < 0.8 * ic:
                continue
            for t in with_c:
                for x, a, b in words[t]:
                    if x == w and not any(s < b and a < e for _, s, e in brute(t)):
                        out[t][a, b] = min(out[t].get((a, b), "term"), "term" if n_t > n_ct else "sole")
    return {t: sorted((k, a, b) for (a, b), k in found.items()) for t, found in out.items()}


def test_entities_of_one_and_two_texts_are_protected(spark):
    """Far and near terms, copies, several entities of a text, a null id."""
    far = " ".join(f"plain{i % 9}" for i in range(40))
    texts = [f"Quagga {far} mail ann@one.example.com then Quagga end", f"Okapi two {far} bob@two.example.com 10.1.2.3", f"okapi {far} bob@two.example.com",
             f"zebra {far} tel 10.1.2.4 and 10.1.2.5 or 10.1.2.6 gnu", f"gnu {far}"]
    texts += [f"plain{i % 9} words number{i % 700} of text {i}" for i in range(1500)]
    rows = list(enumerate(texts)) + [(None, texts[0])] + [(5000 + i, texts[1]) for i in range(9)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want, text = brute_added(texts), dict(rows)
    got = [(r.doc_id, [tuple(s) for s in r.added]) for r in sa.personal_spans(df).collect()]
    assert len(got) == len(rows) and all(spans == want[text[i]] for i, spans in got)
    assert [texts[0][a:b] for _, a, b in want[texts[0]]].count("Quagga") == 2
    assert ("sole", 0, 5) in want[texts[1]]
    clean = {r.doc_id: r.text for r in sa.sanitise(df).collect()}
    assert all(clean[i] == sa.mask(text[i], brute(text[i]) + want[text[i]]) for i, _ in rows)


def test_sanitise_keeps_columns_and_counts_anew(edge_docs):
    out = sa.sanitise(edge_docs)
    assert out.schema == edge_docs.schema
    nine = [r for r in out.collect() if r.doc_id == 9]
    assert len(nine) == 2 and all(r.text.endswith("mail [EMAIL] and [PHONE] or [IP]") and r.n_chars == len(r.text) for r in nine)
    assert {r.doc_id: r.n_chars for r in out.collect()}[3] is None


def test_mask_of_overlapping_spans():
    assert sa.mask("abcdef", [("ip", 1, 3), ("card", 1, 5), ("phone", 4, 6)]) == "a[CARD]"      # what any span covers goes


def test_op5_columns(spark, tmp_path, edge_docs):
    edge_docs.write.parquet(str(tmp_path / "documents.parquet"))
    for r in sa.op5_pii(spark, str(tmp_path)).collect():
        text = {9: "naïve café ÀÉ 日本 mail x.y+z@mail.example.com and +1 (212) 555-0187 or 10.0.0.255"}.get(r.doc_id, "")
        base = ",".join(f"{k}:{a}:{b}" for k, a, b in brute(text))
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest() and r.spans.startswith(base)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == ((1, 1, 0, 1) if r.doc_id == 9 else (0, 0, 0, 0))


def test_runs_of_digits_take_linear_time():
    import time
    start = time.process_time()
    assert sa.base_spans("7" * 1_000_000) == []
    assert sa.base_spans("1." * 300_000 + "x") != []
    assert sa.base_spans(("9" * 300 + ".") * 3 + "x " + "8" * 400_000 + ".1.2") == []
    assert time.process_time() - start < 10


@pytest.mark.parametrize("text", ["1.2.3.4", "01.2.3.4.5.6.7.8", "11.22.33.256", "x1.2.3.4y", "1.2.3", "1..2.3.4.5", "256.1.1.1 9.9.9.9", "1.2.3.4.", ".1.2.3.4"])
def test_ip_matches_are_those_of_the_plain_pattern(text):
    plain = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    want = [m.span() for m in plain.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    assert [(a, b) for k, a, b in sa.base_spans(text) if k == "ip"] == want
