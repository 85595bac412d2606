"""Document fingerprints: threshold-scaled sketches of word shingles.

A sketch keeps every 64-bit shingle hash below a fixed fraction of the hash
range, so it grows with its document: the sketch of a book still holds
the hashes of any excerpt's sketch, and the share of the smaller sketch found in the
larger estimates containment between very unequal documents.  A text with no
hash below the threshold keeps its smallest hash.  Sketches merge: the sketch
of two texts together is the union of theirs, less a lone smallest hash that
lies above the threshold when the other has hashes below it
(``merge_sketches``).

A fingerprint is the sketch in ascending order, 16 hex digits a hash; equal
texts have equal fingerprints.  Words are lower-cased (A-Z) runs other than
space and 0x09-0x0D, five to a shingle; a shorter text is one shingle.

Scale.  To meet its successor each text moves once: exact quantiles-in-the-data
of the ids deal the documents out to id blocks, and the first row of a block is
copied to the block before it.  Within a block the rows stream in id order, one
pair of texts in memory at a time.

Defined cases: a null text is empty and its fingerprint the empty string; two
empty sketches are alike (1.0), an empty one and any other are not (0.0); rows
are ordered by doc_id, nulls first, then by text, so repeated ids have a fixed
order; a single document is its own successor.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import read_table
from .text import RollingHash, as_bytes, joined_words, shingle_bounds

SHINGLE_WORDS = 5
FRACTION = 1 / 8
#: Id blocks per shuffle partition, and at most; a block is streamed, never held.
BLOCKS_PER_PARTITION = 16
MOST_BLOCKS = 1 << 16
IDS_PER_BLOCK = 16


def _highest(fraction: float) -> np.uint64:
    return np.uint64(int(fraction * 2.0 ** 64) - 1)


def sketch(data: bytes, fraction: float = FRACTION, size: int = SHINGLE_WORDS) -> np.ndarray:
    """Ascending, distinct uint64 hashes of the text's sketch."""
    joined, starts, ends = joined_words(data.lower())
    starts, ends = shingle_bounds(starts, ends, size)
    if len(starts) == 0:
        return np.zeros(0, dtype=np.uint64)
    h = RollingHash(joined).of(starts, ends)
    low = h[h <= _highest(fraction)]
    return np.unique(low) if len(low) else h.min(keepdims=True)


def merge_sketches(a: np.ndarray, b: np.ndarray, fraction: float = FRACTION) -> np.ndarray:
    """The sketch of both texts' shingles together."""
    both = np.union1d(a, b)
    low = both[both <= _highest(fraction)]
    return low if len(low) else both[:1]


def likeness(a: np.ndarray, b: np.ndarray) -> tuple[float, float]:
    """Estimated resemblance (shared / all) and containment of the smaller."""
    if len(a) == 0 or len(b) == 0:
        same = float(len(a) == len(b))
        return same, same
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / (len(a) + len(b) - shared), shared / min(len(a), len(b))


def as_hex(s: np.ndarray) -> str:
    return s.astype(">u8").tobytes().hex()


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter of code points replaced by as many of
    the first of ``following`` (or all, if fewer)."""
    cut = len(text) // 4
    return text[:len(text) - cut] + following[:cut]


def _constant(values: list[int]) -> Column:
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def _block_of(x: Column, starts: list[int]) -> Column:
    """Index of the last of the ascending ``starts`` not above ``x``: a binary
    search written as a fold over the halving steps."""
    table, last = _constant(starts), len(starts) - 1
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(starts).bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda at, s: F.when(
        (at + s <= last) & (F.get(table, F.least(at + s, F.lit(last))) <= x), at + s).otherwise(at))


def with_successors(docs: DataFrame, id_col: str, text_col: str) -> DataFrame | None:
    """Rows (block, copy, doc_id, text) dealt to id blocks, a block's first
    id also to the block before it (the first block's to the last), in id
    order within each partition; None if there are no rows."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = min(parts * BLOCKS_PER_PARTITION, MOST_BLOCKS)
    null_id = -(1 << 63)       # orders nulls first
    rows = rows.withColumn("at", F.coalesce("doc_id", F.lit(null_id)))
    total, first = rows.agg(F.count(F.lit(1)), F.min("at")).first()
    if first is None:
        return None
    # where blocks begin is taken from about IDS_PER_BLOCK ids a block, drawn by
    # hash, so that what one task sees of the ids doesn't grow with the table
    every = max(1, total // (IDS_PER_BLOCK * n))
    drawn = rows.where(F.pmod(F.xxhash64("at"), F.lit(every)) == 0).select("at").distinct()
    cuts = drawn.agg(F.percentile_approx("at", [i / n for i in range(n)], 10 * n)).first()[0] or []
    starts = sorted({first, *cuts})
    dealt = rows.withColumn("own", _block_of(F.col("at"), starts))
    before = F.pmod(F.col("own") - 1, F.lit(len(starts)))
    begins = F.get(_constant(starts), F.col("own")) == F.col("at")
    places = F.when(begins, F.array(F.struct(F.col("own").alias("block"), F.lit(False).alias("copy")),
                                    F.struct(before.alias("block"), F.lit(True).alias("copy")))
                    ).otherwise(F.array(F.struct(F.col("own").alias("block"), F.lit(False).alias("copy"))))
    placed = dealt.select(F.explode(places).alias("p"), "doc_id", "text").select("p.block", "p.copy", "doc_id", "text")
    return placed.repartition(parts, "block").sortWithinPartitions("block", "copy", "doc_id", "text")


_SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double, contained_edited double, contained_next double")


def edit_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      fraction: float = FRACTION, size: int = SHINGLE_WORDS) -> DataFrame:
    """Fingerprints of every text and of its edited text, with their likeness
    to each other and to the next document."""
    placed = with_successors(docs, id_col, text_col)
    if placed is None:
        return docs.sparkSession.createDataFrame([], _SCHEMA)
    names = [f.split()[0] for f in _SCHEMA.split(", ")]

    def one(doc_id, text, mine, following, theirs):
        new = edited(text, following).encode("utf-8", "surrogatepass")
        changed = sketch(new, fraction, size)
        near, inside = likeness(mine, changed)
        near_next, inside_next = likeness(mine, theirs)
        return (doc_id, len(text), hashlib.sha256(new).hexdigest(), as_hex(mine), as_hex(changed),
                near, near_next, inside, inside_next)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), *[(n, pa.string()) for n in names[2:5]],
                           *[(n, pa.float64()) for n in names[5:]]])
        held, out, weight = None, [], 0
        for b in batches:
            for block, copy, doc_id, text in zip(*(c for c in b.columns)):
                block, copy, doc_id, text = block.as_py(), copy.as_py(), doc_id.as_py(), text.as_py()
                if held is not None and held[0] != block:
                    held = None
                if copy and held is None:       # a further row of a copied id
                    continue
                mine = sketch(as_bytes(text), fraction, size)
                if held is not None:
                    out.append(one(*held[1:], text, mine))
                    weight += len(out[-1][3]) + len(out[-1][4])
                    if weight > 1 << 22 or len(out) >= 4096:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out), kinds)], schema=kinds)
                        out, weight = [], 0
                held = None if copy else (block, doc_id, text, mine)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out), kinds)], schema=kinds)

    return placed.mapInArrow(run, _SCHEMA)


def op1_fingerprints(spark, sf_dir: str) -> DataFrame:
    """Query: every document of ``documents`` against its edited text and its successor."""
    return edit_fingerprints(read_table(spark, sf_dir, "documents"))
