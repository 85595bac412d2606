"""Exact in-order positions and bounded look-back frames that never put a whole
key into one task.

A plain ``row_number().over(Window.partitionBy(key))`` sorts every row of a key
inside a single task; one hot key (a camera, a long track, a busy user) then
becomes the whole job.  Here every key is cut into *buckets* that are monotone
in the ordering (a frame range, an id range).  Only a small per-bucket summary
is ordered per key (in two levels where a key can have very many buckets, see
``exclusive_prefix``); rows are ranked inside their bucket, so the largest
task holds one bucket.  Bounded look-back frames (lag, the last n steps) then run
over fixed-size position blocks, each carrying the last ``halo`` rows of the
block before it as read-only context.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET = "_bkt"


def with_bucket(df: DataFrame, bucket: Column) -> DataFrame:
    return df.withColumn(BUCKET, bucket)


def exact_positions(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                    bucket: Column, pos_col: str = "pos",
                    keep_bucket: bool = False, two_level: bool = False) -> DataFrame:
    """1-based consecutive position of each row within its key, in ``order``.

    ``bucket`` must never decrease along ``order`` within a key (e.g. the frame
    index divided by a chunk width).  Keys must be non-null.  The per-key scan
    over bucket counts is one ordered window, or two levels (``two_level``)
    when a key can have very many buckets.  The offsets table
    is joined back on (key, bucket); AQE broadcasts it when its runtime size is
    small and otherwise plans a shuffle join on the same keys the ranking
    window needs, so the rows are shuffled once.
    """
    b = with_bucket(df, bucket)
    counts = b.groupBy(*keys, BUCKET).agg(F.count(F.lit(1)).alias("_n"))
    if two_level:   # when a key may have very many buckets
        offsets = exclusive_prefix(counts, keys, BUCKET, "_n", "_off").drop("_n")
    else:           # buckets per key are few: one ordered scan per key
        w = Window.partitionBy(*keys).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
        offsets = counts.select(*keys, BUCKET, F.coalesce(F.sum("_n").over(w), F.lit(0))
                                .cast("long").alias("_off"))
    wr = Window.partitionBy(*keys, BUCKET).orderBy(*order)
    out = (b.join(offsets, [*keys, BUCKET])
           .withColumn(pos_col, F.col("_off") + F.row_number().over(wr))
           .drop("_off"))
    return out if keep_bucket else out.drop(BUCKET)


def with_halo_blocks(df: DataFrame, pos_col: str, halo: int, block_rows: int,
                     block_col: str = "_blk", ctx_col: str = "_ctx") -> DataFrame:
    """Assign rows to blocks of ``block_rows`` positions; the last ``halo`` rows
    of each block are also emitted into the next block flagged as context.

    A window ``partitionBy(keys, block).orderBy(pos).rowsBetween(-halo, 0)``
    over the result sees exactly the rows the unsplit window would see; drop
    the context rows afterwards.  Extra rows: halo / block_rows of the input.
    """
    if block_rows <= halo:
        raise ValueError("block_rows must exceed the halo")
    p0 = F.col(pos_col) - 1
    blk = F.floor(p0 / F.lit(block_rows)).cast("long")
    in_tail = F.pmod(p0, F.lit(block_rows)) >= F.lit(block_rows - halo)
    own = F.struct(blk.alias("b"), F.lit(False).alias("c"))
    nxt = F.struct((blk + 1).alias("b"), F.lit(True).alias("c"))
    copies = F.when(in_tail, F.array(own, nxt)).otherwise(F.array(own))
    return (df.withColumn("_copy", F.explode(copies))
            .withColumn(block_col, F.col("_copy.b"))
            .withColumn(ctx_col, F.col("_copy.c"))
            .drop("_copy"))


# Two-level scans over a per-key table ordered by an integer column (a chunk
# index).  Rows are grouped into supers of ``fanout`` consecutive indices; the
# scan runs inside each (key, super) and then over the per-super summaries, so
# no task orders more than ``fanout`` rows or (rows / fanout) supers of a key.

SUPER = "_sup"


def _with_super(df: DataFrame, order_col: str, fanout: int) -> DataFrame:
    return df.withColumn(SUPER, F.floor(F.col(order_col) / F.lit(fanout)))


def previous_values(df: DataFrame, keys: Sequence[str], order_col: str,
                    cols: Sequence[str], out: str, fanout: int = 4096) -> DataFrame:
    """Adds struct ``out`` holding ``cols`` of the previous row of the same key
    (by ``order_col``), or null for a key's first row."""
    d = _with_super(df, order_col, fanout)
    wl = Window.partitionBy(*keys, SUPER).orderBy(order_col)
    vals = F.struct(*[F.col(c).alias(c) for c in cols])
    d = (d.withColumn("_local", F.when(F.lag(order_col).over(wl).isNotNull(),
                                       F.lag(vals).over(wl)))
         .withColumn("_is_last", F.lead(order_col).over(wl).isNull()))
    last = d.where("_is_last").select(*keys, SUPER, vals.alias("_v"))
    ws = Window.partitionBy(*keys).orderBy(SUPER)
    carry = last.select(*keys, SUPER, F.lag("_v").over(ws).alias("_carry"))
    return (d.join(carry, [*keys, SUPER])
            .withColumn(out, F.coalesce(F.col("_local"), F.col("_carry")))
            .drop("_local", "_is_last", "_carry", SUPER))


def exclusive_prefix(df: DataFrame, keys: Sequence[str], order_col: str,
                     value_col: str, out: str, fanout: int = 4096) -> DataFrame:
    """Adds ``out`` = sum of ``value_col`` over the key's earlier rows (0 first)."""
    d = _with_super(df, order_col, fanout)
    wl = (Window.partitionBy(*keys, SUPER).orderBy(order_col)
          .rowsBetween(Window.unboundedPreceding, -1))
    d = d.withColumn("_lp", F.coalesce(F.sum(value_col).over(wl), F.lit(0)))
    tot = d.groupBy(*keys, SUPER).agg(F.sum(value_col).alias("_st"))
    ws = Window.partitionBy(*keys).orderBy(SUPER).rowsBetween(Window.unboundedPreceding, -1)
    soff = tot.select(*keys, SUPER, F.coalesce(F.sum("_st").over(ws), F.lit(0)).alias("_so"))
    return (d.join(soff, [*keys, SUPER])
            .withColumn(out, (F.col("_so") + F.col("_lp")).cast("long"))
            .drop("_lp", "_so", SUPER))
