import re

from roadsight.llm import url_filter as uf

URLS = [None, "", "no scheme", "://", "http://", "http://A.Com", "http://a.com/", "HTTP://WWW.Example.COM/en/1?x=/", "https://example.com/en/",
        "https://example.com/en", "x://sub.example.com/en/q#a/b", "a://b.net/es/1", "a://net/fr/", "a://xnet/fr/", "a://b.net/ES/1",
        "a://b://c.com/d", "a://é.com/é?", "a://host#frag/com/", "a://h/" + "p" * 5000, "a://m.www.example.com/en/x", "a://a.com/\nline"]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), re.match(r"[^?#]*", rest[len(host):])[0]


def rule(host, path):
    fit = [r for r in uf.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fit, key=lambda r: len(r.name)) if fit else None


def test_parts_rules_and_verdicts(spark):
    df = spark.createDataFrame([(i, u, "x", 1.0) for i, u in enumerate(URLS)], "page_id long, url string, host string, label double")
    rows = {r.page_id: r for r in uf.judge(df).collect()}
    assert len(rows) == len(URLS)
    for i, u in enumerate(URLS):
        host, path = parts(u)
        assert (rows[i].host, rows[i].path) == (host, path), u
        r = rule(host, path)
        assert rows[i].rule == (r and r.name)
        want = r.verdict if r else "block" if rows[i].block_probability >= 0.5 else "allow"
        assert rows[i].verdict == want


def test_model_repeats_the_rules_on_urls_it_was_not_trained_on(spark):
    from tests.conftest import SF01
    pages = spark.read.parquet(f"{SF01}/pages.parquet")
    judged = uf.judge(pages, max_rows=20)          # trained on 40 urls at most
    known = judged.filter("rule is not null").collect()
    right = [(r.block_probability >= 0.5) == (r.verdict == "block") for r in known]
    assert len(right) > 80 and sum(right) > 0.9 * len(right)


def test_probability_is_that_of_the_coefficients(spark):
    """Scores against n-grams counted in Python."""
    from pyspark.ml.feature import HashingTF
    table = spark.createDataFrame([("good.org", "/a", 0.0), ("bad.biz", "/casino", 1.0), ("fine.org", "/b", 0.0)], "host string, path string, label double")
    model = uf.train(table)
    hasher = HashingTF(numFeatures=uf.DIMENSIONS)
    for host, path in (("new.biz", "/casino/x"), ("", "")):
        grams = [t + m[i:i + n] for t, m in (("h", f"^{host}$"), ("p", f"^{path}$")) for n in uf.GRAMS for i in range(max(len(m) - n + 1, 1))]
        z = model.intercept + sum(model.coefficients[hasher.indexOf(g)] for g in grams)
        row = model.transform(uf._featured(spark.createDataFrame([(host, path)], "host string, path string"))).first()
        assert abs(row.rawPrediction[1] - z) < 1e-9


def test_own_labelled_table_and_empty_tables(spark):
    own = spark.createDataFrame([("http://x.biz/casino", 1), ("http://x.org/news", 0)], "url string, label int")
    df = spark.createDataFrame([(1, "http://y.biz/casino"), (2, "http://y.org/news")], "page_id long, url string")
    assert {r.page_id: r.verdict for r in uf.judge(df, labelled=own).collect()} == {1: "block", 2: "allow"}
    assert uf.judge(df.limit(0)).collect() == []
    assert {r.verdict for r in uf.judge(df).collect()} == {"allow"}        # no labelled url at all
