"""Exact top-k inner products by a bit-sliced index.

*Index.*  Vectors are cut into blocks.  In a block every component is an
attribute: its integers, less the block's smallest, are laid out as bit slices,
one bitmap over the block's rows for each bit.

*Adding.*  The score of all rows of a block against a query is the sum, over
attributes and over the set bits of the query's component, of shifted slices;
for a negative component the complemented slices are added and a constant is
taken off.  Bitmaps of one weight are added three at a time by a full adder
(sum and carry), as many queries at once as fit the cache, so the result is the
score itself in bit slices.

*Selecting.*  From the most significant slice downward, rows whose slice is
set leave the tie of those that are equal so far, and are certain as long as
there are no more than k of them.  What is left at the end are the boundary
rows, whose scores all equal the k-th: of these the smallest ids are taken.
Nothing is approximate.

*Scale.*  A block is one row of at most ``BLOCK`` vectors and a query batch one
of at most ``QUERIES``.  Query batches go to every block (a stated query set
against all rows), blocks are moved once, and a task holds one block and one
batch at a time.  A block hands on at most k rows a query.

Defined cases: rows with a null id or vector, or with null or non-finite
components, take no part; a query is scored against the rows of its own length;
vectors without components all score 0; a row is left out of its own query by
its row and not by its id, so rows that repeat an id are rows of their own,
ranked among equal scores and ids in any order; components beyond the range of
``vectors`` are set to its ends.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import read_table, small_batches, stored
from .vectors import BLOCK, LEAST, cut_blocks, matrix, numbered, packed, pieces, quantised, unpacked

K, EVERY = 5, 50
QUERIES = 1 << 10
#: Words of a bitmap times queries that are added together.
WORDS = 1 << 13

_INDEX = "dim int, block long, ids binary, rids binary, low binary, width binary, slices binary"


def bit_slices(u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bits of each column of the non-negative matrix ``u``, and its bitmaps,
    lowest bit first, one 64-bit word for 64 rows."""
    rows, words = len(u), -(-len(u) // 64)
    width = np.array([int(m).bit_length() for m in u.max(axis=0)], dtype=np.int32) if u.shape[1] else np.zeros(0, np.int32)
    out = np.zeros((int(width.sum()), words * 8), dtype=np.uint8)
    at = 0
    for d, w in enumerate(width):
        for b in range(w):
            bits = np.packbits((u[:, d] >> b & 1).astype(np.uint8), bitorder="little")
            out[at, :len(bits)] = bits
            at += 1
    return width, out.view(np.uint64).reshape(len(out), words) if rows else out.view(np.uint64)


class Adder:
    """Bitmaps added by weight: at most two wait at each, a third makes a sum
    that stays and a carry for the next."""

    def __init__(self) -> None:
        self.waiting: list[list[np.ndarray]] = []

    def add(self, level: int, bits: np.ndarray) -> None:
        while True:
            while len(self.waiting) <= level:
                self.waiting.append([])
            here = self.waiting[level]
            if len(here) < 2:
                here.append(bits)
                return
            a, b = here
            either = a ^ b
            carry = a & b
            carry |= either & bits
            either ^= bits
            self.waiting[level] = [either]
            level, bits = level + 1, carry

    def total(self) -> list[np.ndarray | None]:
        """The sum's slices, lowest first (None: all zero)."""
        level, out = 0, []
        while level < len(self.waiting):
            here = self.waiting[level]
            if len(here) == 2:
                a, b = here
                out.append(a ^ b)
                self.waiting[level] = []
                self.add(level + 1, a & b)
            else:
                out.append(here[0] if here else None)
            level += 1
        return out


_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def scores(q: np.ndarray, low: np.ndarray, width: np.ndarray, slices: np.ndarray) -> tuple[list[np.ndarray | None], np.ndarray]:
    """Slices (queries x words) of each row's score less a constant a query,
    and that constant."""
    size, adder, at = np.abs(q), Adder(), 0
    constant = q @ low - np.where(q < 0, size, 0) @ ((np.int64(1) << width.astype(np.int64)) - 1)
    for d, w in enumerate(width):
        flip = np.where(q[:, d] < 0, _ALL, np.uint64(0))[:, None]
        parts = [(j, np.where(size[:, d] >> j & 1, _ALL, np.uint64(0))[:, None]) for j in range(int(size[:, d].max()).bit_length())]
        for b in range(w):
            bits = slices[at + b] ^ flip
            for j, wanted in parts:
                adder.add(b + j, bits & wanted)
        at += w
    return adder.total(), constant


def select(total: list[np.ndarray | None], allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows certainly among each query's first k, and the boundary rows."""
    sure, tied = np.zeros_like(allowed), allowed
    for bits in reversed(total):
        if bits is None:
            continue
        upper = tied & bits
        many = (np.bitwise_count(sure | upper).sum(axis=1) > k)[:, None]
        sure = np.where(many, sure, sure | upper)
        tied = np.where(many, upper, tied & ~bits)
    return sure, tied


def _rows_of(bits: np.ndarray) -> np.ndarray:
    words = np.flatnonzero(bits)
    one = np.unpackbits(bits[words].view(np.uint8).reshape(len(words), 8), axis=1, bitorder="little") if len(words) else np.zeros((0, 64))
    w, b = np.nonzero(one)
    return words[w] * 64 + b


def block_topk(q: np.ndarray, q_rids: np.ndarray, rids: np.ndarray, low: np.ndarray, width: np.ndarray, slices: np.ndarray,
               k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query, rows, scores): each query's first k rows of a block whose rows
    are in the order of their ids."""
    n = len(rids)
    words = -(-n // 64)
    whole = np.packbits(np.ones(n, np.uint8), bitorder="little")
    whole = np.concatenate([whole, np.zeros(words * 8 - len(whole), np.uint8)]).view(np.uint64)
    at = np.argsort(rids, kind="stable")
    found = np.searchsorted(rids[at], q_rids).clip(max=n - 1)
    own = np.where(rids[at][found] == q_rids, at[found], -1)
    step = max(1, WORDS // words)
    for s in range(0, len(q), step):
        part, mine = q[s:s + step], own[s:s + step]
        total, constant = scores(part, low, width, slices)
        allowed = np.repeat(whole[None, :], len(part), axis=0)
        has = np.flatnonzero(mine >= 0)
        allowed[has, mine[has] >> 6] &= ~(np.uint64(1) << (mine[has] & 63).astype(np.uint64))
        sure, tied = select(total, allowed, k)
        for i in range(len(part)):
            first = _rows_of(sure[i])
            rows = np.concatenate([first, _rows_of(tied[i])[:k - len(first)]])
            word, bit = rows >> 6, (rows & 63).astype(np.uint64)
            score = np.full(len(rows), constant[i])
            for level, bits in enumerate(total):
                if bits is not None:
                    score += ((bits[i, word] >> bit) & np.uint64(1)).astype(np.int64) << level
            yield s + i, rows, score


def build_index(rows: DataFrame, blocks: int) -> DataFrame:
    """One row per block of the numbered rows (vec_id, dim, c, rid)."""
    def block(key, t):
        ids, rids = t["vec_id"].to_numpy(), t["rid"].to_numpy()
        order = np.lexsort((rids, ids))
        c = matrix(t["c"].combine_chunks(), key[0].as_py())[order]
        low = c.min(axis=0) if c.shape[1] else np.zeros(0, np.int64)
        width, slices = bit_slices(c - low)
        return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([key[1].as_py()], pa.int64()), packed(ids[order], np.int64),
                         packed(rids[order], np.int64), packed(low, np.int64), packed(width, np.int32), packed(slices, np.uint64)],
                        ["dim", "block", "ids", "rids", "low", "width", "slices"])

    return (rows.select("dim", F.pmod(F.xxhash64("rid"), F.lit(blocks)).alias("block"), "vec_id", "rid", "c")
            .groupBy("dim", "block").applyInArrow(block, _INDEX))


def _query_batches(queries: DataFrame, batches: int) -> DataFrame:
    def batch(dim: int, t: pa.Table) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays(
            [pa.array([dim], pa.int32()), packed(t["vec_id"].to_numpy(), np.int64), packed(t["rid"].to_numpy(), np.int64),
             packed(matrix(t["c"].combine_chunks(), dim), np.int32)], ["dim", "q_ids", "q_rids", "q"])

    dealt = queries.select("dim", "vec_id", "rid", "c").repartitionByRange(batches, "dim", "rid").sortWithinPartitions("dim", "rid")
    return dealt.mapInArrow(cut_blocks(QUERIES, ["vec_id", "rid", "c"], batch), "dim int, q_ids binary, q_rids binary, q binary")


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            for row in rb.to_pylist():
                dim = row["dim"]
                ids, rids = unpacked(row, "ids", np.int64, -1), unpacked(row, "rids", np.int64, -1)
                q_ids, q_rids = unpacked(row, "q_ids", np.int64, -1), unpacked(row, "q_rids", np.int64, -1)
                q = unpacked(row, "q", np.int32, len(q_ids), dim).astype(np.int64)
                words = -(-len(ids) // 64)
                found = list(block_topk(q, q_rids, rids, unpacked(row, "low", np.int64, dim), unpacked(row, "width", np.int32, dim),
                                        unpacked(row, "slices", np.uint64, -1, words) if row["slices"] else np.zeros((0, words), np.uint64), k))
                who = np.repeat([i for i, _, _ in found], [len(r) for _, r, _ in found]).astype(np.int64)
                at = np.concatenate([r for _, r, _ in found]).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q_ids[who]), pa.array(q_rids[who]), pa.array(ids[at]), pa.array(rids[at]), pa.array(np.concatenate([s for _, _, s in found]))],
                    ["query_id", "q_rid", "vec_id", "rid", "score"])
    return run


def top_k(table: DataFrame, k: int = K, every: int = EVERY, id_col: str = "vec_id", vector_col: str = "embedding",
          block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose id is divisible by
    ``every``, the k other rows of the highest integer inner products."""
    spark = table.sparkSession
    small_batches(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = numbered(quantised(table, id_col, vector_col).drop("label"), "quantised-vectors")
    asked = rows.filter(F.col("vec_id") % every == 0)
    blocks = pieces(rows.count(), block, LEAST, parts)
    index = stored(build_index(rows, blocks), "bit-sliced-index")
    queries = _query_batches(asked, pieces(asked.count(), QUERIES, QUERIES // 4, parts))
    asks = queries.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    pairs = index.repartition(parts, "dim", "block").join(asks.repartition(parts, "dim", "block"), ["dim", "block"])
    best = pairs.mapInArrow(_search(k), "query_id long, q_rid long, vec_id long, rid long, score long")
    order = Window.partitionBy("q_rid").orderBy(F.desc("score"), "vec_id", "rid")
    return (best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op11_bit_sliced_topk(spark, sf_dir: str) -> DataFrame:
    """Query: query_id, rank, vec_id, score over ``embeddings``."""
    return top_k(read_table(spark, sf_dir, "embeddings"))


#: Integer vectors of the rows that take part, each row numbered.
INTEGER_VECTORS = """
v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e, row_number() OVER () AS rid FROM embeddings),
rows_ AS (
  SELECT vec_id, label, rid, len(e) AS dim, list_transform(e, lambda x: floor(256 * x)) AS c FROM v
  WHERE vec_id IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NOT NULL AND isfinite(x))) = len(e))"""

OP11_SQL = f"""
WITH {INTEGER_VECTORS},
scored AS (
  SELECT q.vec_id AS query_id, q.rid AS q_rid, r.vec_id, r.rid, coalesce(list_dot_product(q.c, r.c), 0)::BIGINT AS score
  FROM rows_ q JOIN rows_ r ON q.dim = r.dim AND q.rid <> r.rid WHERE q.vec_id % {EVERY} = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY q_rid ORDER BY score DESC, vec_id, rid) AS rank FROM scored)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= {K}
"""
