"""SimHash near-duplicates through a byte-position inverted index.

A fingerprint has eight positional bytes.  Two fingerprints that differ in at
most ``max_bits`` (up to 4) bits differ in at most that many bytes, so they
share at least ``8 - max_bits`` positional bytes: the guaranteed minimum that
the count filter asks for.  A posting list per single (position, byte) would
hold 1/256 of all documents, so a list is kept per *triple* of positions
instead: the twenty triples of ``POSITION_TRIPLES`` meet every possible set of
four shared positions, so no pair is missed and a list holds about 2^-24 of the
fingerprints.  Inside a list the shared positional bytes of each pair are
tallied, pairs below the minimum are dropped and the rest are verified on the
exact bit distance.

Scale.  Texts are read once and never shuffled; equal fingerprints are folded
before indexing; a list is worked through as one run of a sorted partition and
hands on a spanning forest of its links, never all pairs.  A list longer than
``max_list`` is not compared pairwise at all: two of its members are within 4
bits exactly if some value lies within 2 bits of both, so each member is dealt
to the values in its radius-2 ball over the bytes the list leaves free, and
members that meet hang on the smallest of them.  That is linear in the list.

Defined cases: a null or empty text has the zero fingerprint and links like
any other; repeated rows of a doc_id are one document if their texts are equal,
else their fingerprints all count for it and each row keeps its own; a null
doc_id gets a fingerprint, links with nothing and has a null component_id.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .tables import read_table, stored
from .text import as_bytes, joined_words, shingle_bounds

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
MAX_LIST = 1 << 14
#: Shingles hashed at a time, which bounds the memory of a very long text.
CHUNK = 1 << 15


def _triples() -> list[tuple[int, int, int]]:
    """Position triples that meet every set of four of the eight positions:
    positions split into groups of 3, 3 and 2 placed in a ring; a triple within
    a group, or two of a group with one of the next, is taken."""
    group = [0, 0, 0, 1, 1, 1, 2, 2]
    out = []
    for t in combinations(range(8), 3):
        g = sorted(group[p] for p in t)
        for x in range(3):
            inside, after = g.count(x), g.count((x + 1) % 3)
            if inside == 3 or (inside == 2 and after == 1):
                out.append(t)
    return out


POSITION_TRIPLES = _triples()
_MASKS = np.array([sum(0xFF << (8 * p) for p in t) for t in POSITION_TRIPLES], dtype=np.uint64)


def fingerprint(data: bytes, size: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of the word shingles, repeats included."""
    joined, starts, ends = joined_words(data.lower())
    starts, ends = shingle_bounds(starts, ends, size)
    if len(starts) == 0:
        return 0
    ones, digest = np.zeros(64, dtype=np.int64), xxhash.xxh64_intdigest
    for k in range(0, len(starts), CHUNK):
        h = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts[k:k + CHUNK].tolist(), ends[k:k + CHUNK].tolist())),
                        dtype=np.uint64)
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view(np.uint64)[0])


def simhash_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         size: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp long: the fingerprint's bits) for every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((fingerprint(as_bytes(t.as_py()), size) for t in b.column(1)), dtype=np.uint64, count=b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def _linked(x: np.ndarray, y: np.ndarray, max_bits: int) -> np.ndarray:
    """Count filter, then the exact distance of the pairs (x[i], y[i]) that it
    leaves."""
    diff = np.ascontiguousarray(x ^ y)
    out = (diff.view(np.uint8).reshape(*diff.shape, 8) == 0).sum(axis=-1) >= 8 - max_bits
    left = np.flatnonzero(out)
    out[left] = np.bitwise_count(diff[left]) <= max_bits
    return out


def _run_forest(v: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """A spanning forest of the links within one posting list: grow each
    component breadth first, comparing a frontier member with what is left."""
    left, out = np.unique(v), []
    while len(left) > 1:
        frontier, left = [left[0]], left[1:]
        while frontier and len(left):
            x = frontier.pop()
            hit = _linked(np.full(len(left), x), left, max_bits)
            if hit.any():
                out += [(int(x), int(y)) for y in left[hit]]
                frontier += list(left[hit])
                left = left[~hit]
    return out


def _list_links(max_bits: int):
    """Links of partitions sorted by (triple, key): one run per posting list."""
    def batch(a: list, b: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.array(a, dtype=np.uint64).view(np.int64)),
                                           pa.array(np.array(b, dtype=np.uint64).view(np.int64))], ["a", "b"])

    def links(t: np.ndarray, key: np.ndarray, v: np.ndarray) -> Iterator[pa.RecordBatch]:
        cut = np.flatnonzero((t[1:] != t[:-1]) | (key[1:] != key[:-1])) + 1
        bounds = np.concatenate(([0], cut, [len(v)]))
        length = np.diff(bounds)
        two = bounds[:-1][length == 2]                      # most lists that have a pair have one
        hit = two[_linked(v[two], v[two + 1], max_bits)]
        a, b = v[hit].tolist(), v[hit + 1].tolist()
        for s, n in zip(bounds[:-1][length > 2], length[length > 2]):
            for x, y in _run_forest(v[s:s + n], max_bits):
                a.append(x)
                b.append(y)
        if a:
            yield batch(a, b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        for rb in batches:
            if not rb.num_rows:
                continue
            cols = [rb.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            cols[2] = cols[2].view(np.uint64)
            if held is not None:
                cols = [np.concatenate(x) for x in zip(held, cols)]
            t, key, v = cols
            last = np.flatnonzero((t != t[-1]) | (key != key[-1]))
            cut = last[-1] + 1 if len(last) else 0          # the last list may go on in the next batch
            if cut:
                yield from links(t[:cut], key[:cut], v[:cut])
            held = [c[cut:] for c in cols]
        if held is not None and len(held[0]):
            yield from links(*held)
    return run


def _ball_links(long_lists: DataFrame, radius: int) -> DataFrame:
    """Links of lists too long to compare pairwise: members of a list that
    have a value within ``radius`` bits of both in common hang on the smallest."""
    flips_of = []
    for m in map(int, _MASKS):       # the flips of up to ``radius`` bits that a triple leaves free
        free = [1 << b for b in range(64) if not m >> b & 1]
        flips_of.append(np.array([sum(c) for r in range(radius + 1) for c in combinations(free, r)], dtype=np.uint64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            t, key = rb.column(0).to_numpy(), rb.column(1).to_numpy()
            v = rb.column(2).to_numpy().view(np.uint64)
            for i in range(len(v)):
                flips = flips_of[t[i]]
                n = len(flips)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, t[i], dtype=np.int32)), pa.array(np.full(n, key[i], dtype=np.int64)),
                     pa.array((v[i] ^ flips).view(np.int64)), pa.array(np.full(n, v[i]).view(np.int64))],
                    ["t", "key", "z", "fp"])

    ball = long_lists.mapInArrow(run, "t int, key long, z long, fp long")
    low = ball.groupBy("t", "key", "z").agg(F.min("fp").alias("a"), F.count("*").alias("n")).filter("n > 1")
    return (ball.join(low, ["t", "key", "z"]).filter("fp != a")
            .select("a", F.col("fp").alias("b")).distinct())


def fingerprint_links(fps: DataFrame, max_bits: int = MAX_BITS, max_list: int = MAX_LIST) -> DataFrame:
    """(a, b): links between different fingerprints (column fp, distinct rows)
    whose components are those of the full link graph."""
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError("the positional index guarantees a match for up to 4 bits")
    entries = fps.select(F.col("fp"), F.explode(F.array(*[
        F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(int(np.uint64(m).view(np.int64)))).alias("key"))
        for i, m in enumerate(_MASKS)])).alias("e")).select("e.t", "e.key", "fp")
    parts = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    short, links = entries, None
    if max_bits % 2 == 0:     # the middle value of a pair exists for an even distance
        hot = stored(entries.groupBy("t", "key").agg(F.count("*").alias("n"))
                     .filter(F.col("n") > max_list).select("t", "key"), "long-lists")
        if not hot.isEmpty():
            short = entries.join(hot, ["t", "key"], "left_anti")
            links = _ball_links(entries.join(hot, ["t", "key"], "left_semi"), max_bits // 2)
    spread = short.repartition(parts, "t", "key").sortWithinPartitions("t", "key")
    near = spread.mapInArrow(_list_links(max_bits), "a long, b long")
    return near if links is None else near.unionByName(links)


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       size: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                       max_list: int = MAX_LIST) -> DataFrame:
    """One row per row of ``docs``: doc_id, fp and component_id, the smallest
    doc_id reachable over links of at most ``max_bits`` differing bits."""
    rows = stored(simhash_fingerprints(docs, id_col, text_col, size), "fingerprints")
    known = rows.filter("doc_id is not null")
    classes = stored(known.groupBy("fp").agg(F.min("doc_id").alias("low")), "fingerprint-classes")
    links = fingerprint_links(classes.select("fp"), max_bits, max_list)
    # a doc_id with several texts ties its fingerprints together
    several = (known.groupBy("doc_id").agg(F.min("fp").alias("a"), F.max("fp").alias("b")).filter("a != b"))
    ties = known.join(several, "doc_id").filter("fp != a").select("a", F.col("fp").alias("b"))
    comps = connected_components(links.unionByName(ties))
    named = (classes.join(comps, classes["fp"] == comps["id"], "left")
             .select("fp", "low", F.coalesce("component", "fp").alias("component")))
    # a second key, which the groupings don't have: a component or fingerprint
    # of very many rows is dealt for the join itself, and can be split
    least = named.groupBy(F.col("component").alias("of")).agg(F.min("low").alias("component_id"))
    of_fp = (named.join(least, (F.col("component") == F.col("of")) & (F.xxhash64("component") == F.xxhash64("of")))
             .select(F.col("fp").alias("fp_"), "component_id"))
    out = rows.join(of_fp, (rows["fp"] == F.col("fp_")) & (F.xxhash64(rows["fp"]) == F.xxhash64("fp_")), "left")
    return out.select("doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each group of near-duplicates, that of
    the smallest id; rows with a null id stay, of rows that repeat an id the
    first by text and then by the other columns does."""
    named = simhash_components(docs, id_col, text_col)
    later = stored(named.filter("doc_id != component_id").select(F.col("doc_id").alias("__later")).distinct(), "later-copies")
    kept = docs.join(later, docs[id_col].cast("long") == F.col("__later"), "left_anti")
    repeated = stored(docs.filter(docs[id_col].isNotNull()).groupBy(docs[id_col].alias("__id")).agg(F.count("*").alias("__n"))
                      .filter("__n > 1").select("__id"), "repeated-ids")
    if repeated.isEmpty():
        return kept
    single = kept.join(repeated, kept[id_col] == F.col("__id"), "left_anti")
    again = kept.join(repeated, kept[id_col] == F.col("__id"), "left_semi")
    order = [text_col, *(c for c in docs.columns if c != text_col)]
    first = again.groupBy(F.col(id_col).alias("__id")).agg(F.min(F.struct(*order)).alias("__row"))
    return single.unionByName(first.select(*[F.col("__row")[c].alias(c) for c in docs.columns]))


def op9_simhash_dedup(spark, sf_dir: str) -> DataFrame:
    """Query: doc_id, fingerprint (16 hex digits), component_id over ``documents``."""
    c = simhash_components(read_table(spark, sf_dir, "documents"))
    return c.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
