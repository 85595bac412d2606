import base64
import gzip
import hashlib
import os

import pytest

from roadsight.llm import warc_archive as wa

PAGES = [(1, "http://a.com/x", "same"), (2, "http://b.org/", "same"), (3, None, None), (4, "http://a.com/x", ""), (5, "weird url\n\t", "other ünï"),
         (6, "http://a.com/x", "same"), (6, "http://a.com/x", "same"), (None, "http://c.net", "same"), (7, "http://a.com/y?q=1#f", "x" * 300_000),
         (8, "http://www.a.com/x", "later"), (0, "http://z.com", "later")]


def want(pages, least=0):
    first = {}
    for i, _, h in sorted(pages, key=lambda p: (p[0] is None, p[0] or 0)):
        first.setdefault(h or "", i)
    out = []
    for i, _, h in pages:
        data = (h or "").encode()
        again = len(data) >= least and first[h or ""] != i
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if again else "response", first[h or ""] if again else None))
    return sorted(out, key=str)


def read(spark, root, urls):
    rows = wa.read_records(wa.find_captures(spark, root, urls), root).collect()
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows), key=str)


@pytest.mark.parametrize("lines", [1, 2, 1024])
@pytest.mark.parametrize("least", [0, 5])
def test_write_look_up_read(spark, tmp_path, lines, least):
    df = spark.createDataFrame([(*p, "x") for p in PAGES], "page_id long, url string, html string, key string").repartition(3)
    root = str(tmp_path / "w")
    wa.write_archive(df, root, min_bytes=least, block_lines=lines)
    assert read(spark, root, df) == want(PAGES, least)
    one = read(spark, root, df.filter("url = 'http://a.com/x'").limit(1))
    assert sorted(str(r[0]) for r in one) == ["1", "4", "6", "6"]
    assert read(spark, root, spark.createDataFrame([("http://a.com/",), ("http://nowhere",)], "url string")) == []


def test_files_are_gzip_members_of_warc_records(spark, tmp_path):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string").coalesce(1)
    root = str(tmp_path / "w")
    wa.write_archive(df, root)
    kinds = []
    for name in os.listdir(f"{root}/warc"):
        data = gzip.open(f"{root}/warc/{name}").read()
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
            assert head.startswith(b"WARC/1.0\r\n") and rest[int(fields["Content-Length"]):].startswith(b"\r\n\r\n")
            data = rest[int(fields["Content-Length"]) + 4:]
            kinds.append(fields["WARC-Type"])
    assert kinds.count("response") + kinds.count("revisit") == len(PAGES) and "warcinfo" in kinds


def test_files_roll_and_empty_table(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    root = str(tmp_path / "e")
    wa.write_archive(df.limit(0), root)
    assert read(spark, root, df) == [] and read(spark, root, df.limit(0)) == []


def test_url_keys_sort_hosts_from_the_right():
    assert wa.url_key("https://WWW.Example.com/a b?q") == "com,example,www)/a%20b?q"
    assert wa.url_key("http://a.com") == "com,a)/"
    assert wa.url_key(None) == wa.url_key("") == ""
    assert "\t" not in wa.url_key("x\ty\n") and "\n" not in wa.url_key("http://h/\n")


def test_damaged_payload_is_noticed():
    record = wa.page_record(1, "http://a", b"payload", wa.payload_digest(b"other"), None, False)
    with pytest.raises(ValueError):
        wa.parse_record(record)
