import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from roadsight.llm import mixing


def targets(sizes):
    """The contract's own rounds: share by weight, stop at the limit, share the excess again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in capped)
        free = [s for s in names if s not in capped]
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] >= 3 * sizes[s]}
        if not over:
            return share | {s: 3 * sizes[s] for s in capped}
        capped |= over
        if len(capped) == len(names):
            return {s: 3 * sizes[s] for s in names}


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


@pytest.fixture(scope="module")
def hot_docs(spark):
    rows = [(i, " ".join(["w"] * (i % 37)), f"s{i % 6}" if i % 3 else "hot") for i in range(3000)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def check(spark, df, tmp_path):
    df.write.parquet(str(tmp_path / "documents.parquet"))
    got = mixing.op6_mixing(spark, str(tmp_path)).collect()
    docs = df.select("doc_id", "text", "source").collect()
    per = Counter()
    for d in docs:
        per[d.source] += size(d.text)
    assert Counter((r.doc_id, r.size) for r in got) == Counter((d.doc_id, size(d.text)) for d in docs)
    want = targets(per)
    source = {d.doc_id: d.source for d in docs}
    taken = Counter()
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == per[s] and abs(r.target - want[s]) < 1e-6 * max(1, want[s])
        assert r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
        taken[s] += r.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= max((size(d.text) for d in docs if d.source == s), default=0) / 2 + 1e-6
    again = mixing.op6_mixing(spark, str(tmp_path)).collect()
    assert Counter(again) == Counter(got)


def test_targets_and_taken_words(spark, edge_docs, tmp_path):
    check(spark, edge_docs, tmp_path)


def test_hot_source(spark, hot_docs, tmp_path):
    check(spark, hot_docs, tmp_path)


def test_empty_and_wordless_tables(spark, no_docs, tmp_path):
    no_docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert mixing.op6_mixing(spark, str(tmp_path)).collect() == []
    assert mixing.mixed_documents(no_docs).collect() == []
    blank = spark.createDataFrame([(1, None, "a"), (2, "", "a"), (2, " ", None)], "doc_id long, text string, source string")
    blank.write.parquet(str(tmp_path / "blank" / "documents.parquet"))
    assert [(r.size, r.target, r.taken) for r in mixing.op6_mixing(spark, str(tmp_path / "blank")).collect()] == [(0, 0.0, 0)] * 3


def test_split_quotas_keep_every_block_and_share_them_evenly(spark):
    quotas = {0: 500, 1: 130, 2: 1, 3: 0, 4: 393}
    df = spark.createDataFrame(list(quotas.items()), "sno long, quota long")
    leaves = mixing.split_quotas(df, 4).collect()
    sums, per_shard = Counter(), Counter()
    for r in leaves:
        sums[r.sno] += r.quota
        per_shard[r.shard] += r.quota
    assert sums == Counter({k: v for k, v in quotas.items() if v})
    assert set(per_shard) == set(range(16)) and set(per_shard.values()) == {64}
    big = [r.quota for r in leaves if r.sno == 0]       # hypergeometric: mean 31.25, deviation under 4
    assert 15 < min(big) and max(big) < 48 and len(set(big)) > 3


def test_shards_draw_disjoint_blocks(hot_docs, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_MASS", 64)
    drawn = mixing.mix(hot_docs, ["doc_id", "source"])
    rows = drawn.filter("shard is not null").select("row.doc_id", "row.source", "pass", "shard", "size").collect()
    assert max(Counter((r.doc_id, r["pass"]) for r in rows).values()) == 1
    shards = defaultdict(Counter)
    for r in rows:
        shards[r.shard][r.source] += r.size
    assert len(shards) >= 32 and sum(len(c) > 1 for c in shards.values()) > 0.9 * len(shards)


def test_mixed_documents_repeat_as_drawn(edge_docs):
    out = mixing.mixed_documents(edge_docs)
    assert out.schema.fieldNames() == edge_docs.columns
    drawn = mixing.mix(edge_docs, ["doc_id"]).filter("shard is not null")
    assert Counter(r.doc_id for r in out.collect()) == Counter(r[0] for r in drawn.select(F.col("row.doc_id")).collect())
