import re

import duckdb
import pytest

from roadsight.llm import license_scan as ls


def brute(text):
    """Dice of every unit against every template, without any pruning."""
    text = "".join(c.lower() if c.isascii() else c for c in text or "")
    found = {}
    for unit in {*text.split("\n"), *re.split(r"\n[ \t\r]*\n", text), text}:
        words = re.sub(r"[\W_]+", " ", unit).split()
        a = {f"{x} {y}" for x, y in zip(words, words[1:])}
        for name, template in ls.TEMPLATES:
            b = set(ls.template_bigrams(template))
            dice = 2 * len(a & b) / (len(a) + len(b))
            if dice >= ls.THRESHOLD:
                found[name] = max(found.get(name, 0), dice)
    return found


def rows(spark, texts):
    df = spark.createDataFrame([(i, t, "l", 1.0) for i, t in enumerate(texts)], "doc_id long, text string, license string, dice double")
    got = {}
    for r in ls.scan(df).collect():
        got[r.doc_id] = {}
        for m in r.matches:
            got[r.doc_id][m.license] = max(got[r.doc_id].get(m.license, 0), m.dice)
    return got


def test_matches_brute_force(spark, edge_docs):
    full = [t for _, t in ls.TEMPLATES]
    texts = [None, "", "\n\n", "plain prose about a license", *full, *(t.upper() for t in full),
             *(f"before\n{t}\nafter" for t in full), *(f"a\n\n{t}\n \nb" for t in full),
             *(" ".join(t.split()[1:]) for t in full), *(t.replace("the", "a") for t in full),
             "Licensed under CC BY-NC 4.0.\nReleased under the MIT License.\nReleased under the MIT License.",
             *(r.text for r in edge_docs.select("text").collect())]
    got = rows(spark, texts)
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        assert got[i] == pytest.approx(expected(t), abs=1e-12), t


def expected(text):
    units, windows = brute(text), brute_windows(text or "")
    return {k: max(units.get(k, 0), windows.get(k, 0)) for k in {**units, **windows}}


def brute_windows(text):
    """Best Dice of all windows that begin with a bigram of a template and have
    from its size to its upper bound."""
    words = re.sub(r"[\W_]+", " ", "".join(c.lower() if c.isascii() else c for c in text)).split()
    g, found = [f"{x} {y}" for x, y in zip(words, words[1:])], {}
    for name, template in ls.TEMPLATES:
        b = set(ls.template_bigrams(template))
        _, hi = ls.size_bounds(len(b), ls.THRESHOLD)
        for i in [i for i, x in enumerate(g) if x in b]:
            for size in range(len(b), hi + 1):
                start = max(0, min(i, len(g) - size))
                a = set(g[start:start + size])
                dice = 2 * len(a & b) / (len(a) + len(b))
                if dice >= ls.THRESHOLD:
                    found[name] = max(found.get(name, 0), dice)
    return found


def test_licences_within_longer_texts(spark):
    """Long templates in their real paragraphs inside 1,000 words, and every
    notice inside a longer line."""
    prose = [f"word{i}" for i in range(1000)]
    before, after = " ".join(prose[:500]), " ".join(prose[500:])
    breaks = ["Unless required", "This program is distributed", "You should have", "THE\nSOFTWARE IS", "THE SOFTWARE IS", "The above"]
    full = []
    for name, t in ls.TEMPLATES:
        if len(ls.template_bigrams(t)) > ls.NOTICE_BIGRAMS:
            for b in breaks:
                t = re.sub(re.escape(b), "\n\n" + b, t, count=1)
            full.append((name, f"{before}\n\n{t}\n\n{after}"))
        else:
            full.append((name, f"{before} this is it: {t} {after}"))
    got = rows(spark, [t for _, t in full])
    for i, (name, t) in enumerate(full):
        assert abs(got[i][name] - 1.0) < 1e-12      # though ISC's second paragraph is a lesser match by itself


def test_windows_match_brute_force(spark):
    pad = " ".join(f"word{i}" for i in range(30))
    notices = [t for _, t in ls.TEMPLATES if len(ls.template_bigrams(t)) <= ls.NOTICE_BIGRAMS]
    apache = next(t for _, t in ls.TEMPLATES[9:])
    texts = [f"{pad} {t} {pad}" for t in notices] + [f"{pad} {t.replace('the', 'the very')} {pad}" for t in notices]
    texts += [f"{pad} {' '.join(t.split()[:-1])} {pad}\n\n{t.split()[-1]}" for t in notices] + [f"{pad} {t} or {t} {pad}" for t in notices[:4]]
    texts += [f"{pad} {apache.replace('License', 'Lizenz', 3)} {pad} {pad}", f"{pad} {apache.replace('the', 'all the')} {pad} {pad}"]
    got = rows(spark, texts)
    for i, t in enumerate(texts):
        assert got[i] == pytest.approx(expected(t), abs=1e-12), t


def test_every_match_has_a_probe():
    for _, template in ls.TEMPLATES:
        grams = ls.template_bigrams(template)
        lo, _ = ls.size_bounds(len(grams), ls.THRESHOLD)
        words = ls.probe_words(grams, ls.THRESHOLD)
        assert sum(any(w in g.split() for w in words) for g in grams) >= len(grams) - lo + 1
        assert len(ls.probe_bigrams(grams, ls.THRESHOLD)) == len(grams) - lo + 1


def test_empty_table(no_docs):
    assert ls.scan(no_docs).collect() == []


def test_sql_has_long_texts_of_few_words():
    text = " ".join(["Released under the MIT License."] * 201)      # 1,005 words, 5 distinct bigrams
    db = duckdb.connect()
    db.execute("CREATE TABLE documents AS SELECT 1 AS doc_id, ? AS text", [text])
    ((_, name, dice, names),) = db.execute(ls.OP4_SQL).fetchall()
    assert (name, names) == ("MIT", "MIT") and abs(dice - expected(text)["MIT"]) < 1e-12


def test_a_text_of_many_licences_takes_time_in_proportion(spark):
    import time
    mit = max((t for n, t in ls.TEMPLATES if n == "MIT"), key=len)
    notes = lambda k: "\n\n".join(f"Part {i} of the product.\n{mit}" for i in range(k))
    rows(spark, [notes(1)])
    start = time.perf_counter()
    got = rows(spark, [notes(40)])
    took = time.perf_counter() - start
    assert got[0]["MIT"] == 1.0 == rows(spark, [notes(10)])[0]["MIT"]       # the best window, whatever the text's size
    assert took < 15


def test_best_of_units_and_windows(spark):
    text = "so it goes: Released under the MIT License. Enough said"
    assert rows(spark, [text])[0]["MIT"] == 1.0
    assert rows(spark, ["", None, "MIT", "the the the " * 50]) == {i: {} for i in range(4)}
