"""PII: information-theoretic sanitisation.

*Base.*  E-mail addresses, IPv4 addresses, payment cards and phone numbers are
found by fixed patterns, leftmost and non-overlapping per kind; a match that
fails its check is dropped without a retry.  Each found value is a protected
entity.

*Disclosure.*  Corpus co-occurrence tells how strongly a term gives an entity
away.  All counts are of distinct texts, so copies of a text don't vote.  With
N texts in the corpus, an entity c in n(c) of them, a term t in n(t) and both
together in n(c,t),

    IC(c)    = log2(N / n(c))                              what there is to learn about c
    PMI(c,t) = log2(N n(c,t) / ((n(c) + 1) (n(t) + 1)))    what t tells of it, at least

The PMI is a smoothed one, as if c and t had each been seen once more without
the other: the fewer texts speak for it, the lower it is.  t discloses c when
PMI >= ``DISCLOSURE`` x IC(c).  There is no least count: a term of one text may
disclose an entity of that text where the corpus is large enough (1,024 texts)
to make both rare.  Such a term is a span of its own wherever it stands in a
text with the entity: it is generalised to ``[TERM]`` (kind term) if it also
occurs in texts without any entity it discloses, and removed (kind sole) if not.

*Pruning, none of it lossy.*  n(c,t) is at most n(c) and n(t), so terms of more
than N^(1-d) n(c)^(1+d) / (n(c) + 1) texts can't disclose c, nor can terms of
more than the largest such bound disclose any entity.  Entities of the very
same texts have the same counts and are one group: a list of contacts makes one
pair a term, not one a term and contact.

*Scale.*  Texts are read where they lie: once for the base spans and the terms
of texts that have any, once for term counts, where a task sums its batch's
terms before the shuffle.  Only spans, term counts, the terms of texts with
entities and texts that repeat move.  ``sanitise`` joins the texts with their
added spans, which moves a text at most once.

Defined cases: a null or empty text has no spans; spans depend on the text
alone, so repeated rows and null ids are treated as any others.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import read_table, stored
from .text import RollingHash, as_bytes, joined_words

DISCLOSURE = 0.8

# The kinds in their order, and their patterns.
KINDS = ("email", "ip", "card", "phone")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
#: A match begins where a run of digits does and takes runs whole, so a run is
#: read once however long it is.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
MASKS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "term": "[TERM]", "sole": ""}
WORD = re.compile(r"[^\x20\x09-\x0D]+")
NOT_DIGIT = re.compile(r"[^0-9]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """As the whole pattern finds them, in one pass: the local part is the run
    of its characters before an @, cut where the previous match ended."""
    done, at = 0, text.find("@")
    floor = 0
    while at >= 0:
        before = text[max(done, floor):at]
        start = max(done, floor) + len(before.rstrip(LOCAL))
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        floor = at + 1
        at = text.find("@", max(at + 1, done))


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _short_number(part: str) -> bool:
    kept = part.lstrip("0")
    return len(kept) <= 3 and int(kept or 0) <= 255


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by kind and start."""
    out = [("email", a, b) for a, b in _emails(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(map(_short_number, m[0].split(".")))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(d := NOT_DIGIT.sub("", m[0])) <= 19 and _luhn(d):
            out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(NOT_DIGIT.sub("", m[0])) <= 15]
    return out


def _hash(s: str) -> int:
    return int.from_bytes(hashlib.blake2b(s.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def term_hashes(data: bytes) -> np.ndarray:
    """64-bit hashes of a text's lower-cased words, as the corpus counts have them."""
    joined, starts, ends = joined_words(data.lower())
    return RollingHash(joined).of(starts, ends).view(np.int64)


def entities(text: str, spans: list[tuple[str, int, int]]) -> list[int]:
    """The distinct values of the base spans."""
    out = {}
    for kind, a, b in spans:
        value = text[a:b].lower() if kind == "email" else text[a:b] if kind == "ip" else NOT_DIGIT.sub("", text[a:b])
        out[_hash(f"{kind}:{value}")] = None
    return list(out)


def terms(text: str, spans: list[tuple[str, int, int]]) -> list[dict]:
    """The distinct words of a text that are clear of every base span, each
    with all its places; none if there is no span."""
    if not spans:
        return []
    begins, ends = np.array([m.span() for m in WORD.finditer(text)]).T
    clear = np.ones(len(begins), dtype=bool)
    for _, a, b in spans:
        clear[np.searchsorted(ends, a, "right"):np.searchsorted(begins, b, "left")] = False
    places = {}
    for h, a, b in zip(term_hashes(as_bytes(text))[clear].tolist(), begins[clear].tolist(), ends[clear].tolist()):
        places.setdefault(h, []).append({"start": a, "end": b})
    return [{"term": h, "places": p} for h, p in places.items()]


_SPAN = "struct<kind:string,start:int,end:int>"
_TERMS = "array<struct<term:long,places:array<struct<start:int,end:int>>>>"
_SPAN_T = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
_TERMS_T = pa.list_(pa.struct([("term", pa.int64()), ("places", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))]))


def _text_hash(text_col: str):
    """128 bits: a text is told from every other, however many there are."""
    return F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))


def _short_hash(text_col: str):
    """64 bits, that equal texts share and few others do."""
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def base_findings(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text_hash, spans, entities, terms, short) for every row."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       _text_hash(text_col).alias("text_hash"), _short_hash(text_col).alias("short"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            spans, values, words = [], [], []
            for t in b.column(1):
                text = t.as_py() or ""
                found = base_spans(text)
                spans.append([{"kind": k, "start": a, "end": e} for k, a, e in found])
                values.append(entities(text, found))
                words.append(terms(text, found))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(spans, _SPAN_T), pa.array(values, pa.list_(pa.int64())),
                                              pa.array(words, _TERMS_T), b.column(3)], ["doc_id", "text_hash", "spans", "entities", "terms", "short"])

    return rows.mapInArrow(run, f"doc_id long, text_hash string, spans array<{_SPAN}>, entities array<long>, terms {_TERMS}, short long")


def distinct_texts(docs: DataFrame, found: DataFrame, text_col: str) -> DataFrame:
    """(text): each text of the corpus once.  Texts that don't repeat stay
    where they are."""
    again = stored(found.groupBy("short").agg(F.count("*").alias("rows")).filter("rows > 1").select("short"), "repeated-texts")
    rows = docs.select(_short_hash(text_col).alias("short"), F.col(text_col).alias("text"))
    once = rows.join(again, "short", "left_anti").select("text")
    more = rows.join(again, "short", "left_semi").withColumn("text_hash", _text_hash("text")).dropDuplicates(["text_hash"])
    return once.unionByName(more.select("text"))


def term_counts(docs: DataFrame, text_col: str) -> DataFrame:
    """(term, texts): in how many texts each term of the corpus occurs; the
    row of term null counts the texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held, size, texts = [], 0, 0
            for t in b.column(0):
                joined, starts, ends = joined_words(as_bytes(t.as_py()).lower())
                held.append(np.unique(RollingHash(joined).of(starts, ends)))
                size, texts = size + len(held[-1]), texts + 1
                if size > 1 << 21:
                    yield summed(held, texts)
                    held, size, texts = [], 0, 0
            yield summed(held, texts)

    def summed(held: list[np.ndarray], texts: int) -> pa.RecordBatch:
        terms, n = np.unique(np.concatenate([*held, np.zeros(0, np.uint64)]), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.concat_arrays([pa.array(terms.view(np.int64)), pa.array([None], pa.int64())]),
                                           pa.array(np.append(n, texts))], ["term", "texts"])

    return (docs.select(F.col(text_col)).mapInArrow(run, "term long, texts long")
            .groupBy("term").agg(F.sum("texts").alias("texts")))


def _most_texts(total: int, n_c, disclosure: float):
    """So many texts may a term of an entity in ``n_c`` texts have at most,
    with slack for rounding; it grows with n_c."""
    return F.lit(float(total)) ** (1 - disclosure) * n_c ** (1 + disclosure) / (n_c + 1) * (1 + 1e-9)


def added_spans(found: DataFrame, docs: DataFrame, text_col: str, disclosure: float = DISCLOSURE) -> DataFrame:
    """(text_hash, added): the places of the terms that give an entity of
    their text away, for texts that have any."""
    # from here on a text is its number
    having = found.filter(F.size("entities") > 0)
    numbers = stored(having.select("text_hash", "entities").dropDuplicates(["text_hash"]).withColumn("text", F.monotonically_increasing_id()),
                     "texts-with-values")
    mentions = stored(numbers.select("text", F.explode("entities").alias("entity")), "mentions")
    # entities of the same texts are one group
    same = mentions.groupBy("entity").agg(F.count("*").cast("double").alias("n_c"), F.bit_xor(F.xxhash64("text")).alias("x"),
                                          F.bit_xor(F.xxhash64("text", F.lit(1))).alias("y"))
    same = stored(same, "values")
    kinds = stored(same.select("n_c", "x", "y").distinct().withColumn("group", F.monotonically_increasing_id()), "value-groups")
    groups = mentions.join(same.join(kinds, ["n_c", "x", "y"]).select("entity", "group", "n_c"), "entity").select("text", "group", "n_c").distinct()
    groups = stored(groups, "entity-groups")
    most = groups.agg(F.max("n_c")).first()[0]
    counts = stored(term_counts(distinct_texts(docs, found, text_col), "text"), "term-counts")
    total = counts.filter("term is null").agg(F.sum("texts")).first()[0] or 0
    seldom = counts.filter(F.col("texts") + 1 <= _most_texts(total, F.lit(most or 0.0), disclosure))
    rare = (having.select("text_hash", "terms").dropDuplicates(["text_hash"]).join(numbers.select("text_hash", "text"), "text_hash")
            .select("text", F.explode("terms").alias("t"))
            .select("text", "t.term", "t.places").join(seldom, "term"))
    rare = stored(rare, "rare-terms")
    pairs = (rare.select("text", "term", "texts").join(groups, "text")
             .filter(F.col("texts") + 1 <= _most_texts(total, F.col("n_c"), disclosure)))
    pairs = stored(pairs, "term-pairs")
    ic = F.log2(F.greatest(F.lit(float(total)) / F.col("n_c"), F.lit(1.0)))
    pmi = F.log2(F.lit(float(total)) * F.col("n_ct") / ((F.col("n_c") + 1) * (F.col("texts") + 1)))
    telling = (pairs.groupBy("group", "term").agg(F.count("*").alias("n_ct"), F.first("n_c").alias("n_c"), F.first("texts").alias("texts"))
               .filter((ic > 0) & (pmi >= disclosure * ic))
               .select("group", "term", (F.col("texts") > F.col("n_ct")).alias("apart")))
    told = (pairs.select("text", "term", "group").join(telling, ["group", "term"])
            .groupBy("text", "term").agg(F.min("apart").alias("apart")))
    kind = F.when(F.col("apart"), "term").otherwise("sole").alias("kind")
    return (rare.join(told, ["text", "term"]).select("text", kind, F.explode("places").alias("p"))
            .groupBy("text").agg(F.sort_array(F.collect_list(F.struct("kind", "p.start", "p.end"))).alias("added"))
            .join(numbers.select("text", "text_hash"), "text").select("text_hash", "added"))


def personal_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", disclosure: float = DISCLOSURE) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_hash, ``spans`` (base) and
    ``added`` (disclosing terms), arrays of (kind, start, end)."""
    found = stored(base_findings(docs, id_col, text_col), "pii-spans")
    added = stored(added_spans(found, docs, text_col, disclosure), "added-spans")
    none = F.array().cast(f"array<{_SPAN}>")
    rows = found.select("doc_id", "text_hash", "spans")
    with_any = rows.filter(F.size("spans") > 0).join(added, "text_hash", "left")
    return (with_any.select("doc_id", "text_hash", "spans", F.coalesce("added", none).alias("added"))
            .unionByName(rows.filter(F.size("spans") == 0).withColumn("added", none)))


def mask(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span replaced by its mask; of overlapping spans the
    first, and of those the longest, stands for all."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if b <= at:
            continue
        if a >= at:
            out += [text[at:a], MASKS[kind]]
        at = b
    return "".join(out) + text[at:]


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """``docs`` with base spans masked and disclosing terms generalised or
    removed, and the code points of a changed text counted anew in
    ``length_col`` (if there is one).  Other columns stay."""
    found = stored(base_findings(docs, id_col, text_col), "pii-spans")
    added = stored(added_spans(found, docs, text_col).select(F.col("text_hash").alias("__hash"), F.col("added").alias("__added")), "added-spans")
    if added.isEmpty():
        joined = docs.withColumn("__added", F.lit(None).cast(f"array<{_SPAN}>"))
    else:
        joined = docs.join(added, _text_hash(text_col) == F.col("__hash"), "left").drop("__hash")
    names, lengths = docs.columns, docs.schema[length_col].dataType if length_col in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            columns, more = list(b.columns[:-1]), b.columns[-1]
            at = names.index(text_col)
            old, new = columns[at].to_pylist(), []
            for t, m in zip(old, more.to_pylist()):
                spans = base_spans(t) + [(s["kind"], s["start"], s["end"]) for s in m or ()] if t else ()
                new.append(mask(t, spans) if spans else t)
            columns[at] = pa.array(new, pa.string())
            if lengths is not None:
                k = names.index(length_col)
                kept = columns[k].to_pylist()
                columns[k] = pa.array([c if x == y else len(y) for c, x, y in zip(kept, old, new)], columns[k].type)
            yield pa.RecordBatch.from_arrays(columns, names)

    return joined.select(*names, "__added").mapInArrow(run, docs.schema)


def _number_of(kind: str):
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")


def op5_pii(spark, sf_dir: str) -> DataFrame:
    """Query: counts by kind, the digest of the base spans and all spans of every document."""
    found = personal_spans(read_table(spark, sf_dir, "documents"))
    word = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    base = F.array_join(F.transform("spans", word), ",")
    spans = F.concat("spans", "added")
    return found.select(
        "doc_id", *[_number_of(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(base, 256).alias("base_sha256"), F.array_join(F.transform(spans, word), ",").alias("spans"),
        F.size("added").alias("n_added"))
