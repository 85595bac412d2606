"""Quantised vectors and blocks of them, shared by the operators on vectors.

A component x becomes the integer floor(256 * x).  Integers are held to a range
in which an inner product and a squared distance fit 64 bits: for vectors of d
components +-2^k with 2 k + log2(d) <= 60, that is +-2^27 at 64 components
(x up to 524,288); larger components, which no embedding has, are set to its
ends.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import stored

SCALE = 256
#: Rows of a block at most, and what a block should have at least before the
#: rows are cut further to keep all cores busy.
BLOCK, LEAST = 1 << 15, 1 << 11


def quantised(table: DataFrame, id_col: str, vector_col: str, label_col: str | None = None, named: bool = True) -> DataFrame:
    """vec_id, label, dim and c (array<int>) of the rows that take part: the
    id is not null (if ``named``), the vector is not null and all its components are finite.
    ``label`` is null without a label column, or where it is no integer."""
    v = F.col("v")
    label = table[label_col].try_cast("long") if label_col else F.lit(None).cast("long")
    rows = table.select(table[id_col].cast("long").alias("vec_id"), label.alias("label"), table[vector_col].cast("array<double>").alias("v"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = rows.filter((F.col("vec_id").isNotNull() | F.lit(not named)) & v.isNotNull() & F.coalesce(finite, F.lit(False))).withColumn("dim", F.size("v"))
    bits = F.floor((60 - F.ceil(F.log2(F.greatest("dim", F.lit(1))))) / 2)
    rows = rows.withColumn("most", F.pow(F.lit(2.0), bits))
    # clamped before the product as well, which may be infinite
    one = lambda x: F.floor(F.greatest(F.least(x, F.col("most")) * SCALE, -F.col("most")))
    return rows.select("vec_id", "label", "dim", F.transform(v, lambda x: F.least(one(x), F.col("most")).cast("int")).alias("c"))


def numbered(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` stored with a number ``rid`` of their own: rows of a repeated
    id are told apart by it, and it stays whatever is computed again."""
    return stored(rows.withColumn("rid", F.monotonically_increasing_id()), name)


def matrix(lists: pa.Array, dim: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), dim).astype(np.int64)


def pieces(n: int, most: int, least: int, parts: int) -> int:
    """Into how many blocks to cut n rows: of ``most`` rows at most, and more
    of them, down to ``least`` rows, where there are cores to use."""
    return max(1, -(-n // most), min(parts, -(-n // least)))


def cut_blocks(size: int, names: list[str], make: Callable[[int, pa.Table], Iterator[pa.RecordBatch]]):
    """A mapInArrow function over rows that come sorted by ``dim``: ``make`` is
    given runs of at most ``size`` rows of one length."""
    def flush(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if held:
            t = pa.Table.from_batches(held).select(names).combine_chunks()
            yield from make(held[0].column("dim")[0].as_py(), t)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for b in batches:
            dims, at = b.column("dim").to_numpy(), 0
            while at < b.num_rows:
                if held and (held[0].column("dim")[0].as_py() != dims[at] or rows == size):
                    yield from flush(held)
                    held, rows = [], 0
                same = int(np.argmax(dims[at:] != dims[at])) or b.num_rows - at
                n = min(same, size - rows)
                held.append(b.slice(at, n))
                rows, at = rows + n, at + n
        yield from flush(held)
    return run


def packed(a: np.ndarray, dtype) -> pa.Array:
    return pa.array([np.ascontiguousarray(a, dtype=dtype).tobytes()], pa.binary())


def unpacked(row: dict, name: str, dtype, *shape: int) -> np.ndarray:
    return np.frombuffer(row[name], dtype).reshape(*shape)
