"""Top-down calibration of every camera from its own point pairs.

A camera's table of pairs (pixel x, y and the plane's u, v; four or more) gives
its perspective map by least squares.  Two aggregates by camera do it, whatever
the number of pairs: the first gives centre and spread of the pixels and of the
plane, by which the pairs are normalised; the second the sums of products that
make up the normal equations.  What is solved is one 8 x 8 system a camera, a
batch of cameras at a time inside the tasks.  The eight coefficients are columns
that join the detections; nothing is solved on the driver.

Defined cases: pairs with a null or non-finite number are left out; a camera of
fewer than four pairs, or whose pairs don't fix a map (three on a line, all at
one place, a map through infinity) has null coefficients, and so null positions;
repeated pairs weigh as often as they stand there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import project

LEAST_PAIRS = 4
#: A normalised system worse conditioned than this fixes no map.
MOST_CONDITION = 1e12
COEFFICIENTS = [f"m{i}" for i in range(8)]
_XYUV = ["px", "py", "u", "v"]
# The two equations of a pair, coefficient by coefficient: x m0 + y m1 + m2 - x u m6 - y u m7 = u, and
# the same with m3, m4, m5 and v.
_ROW_U = ["px", "py", "one", None, None, None, "-px*u", "-py*u"]
_ROW_V = [None, None, None, "px", "py", "one", "-px*v", "-py*v"]


def _value(name: str):
    if name == "one":
        return F.lit(1.0)
    sign, name = (-1.0, name[1:]) if name.startswith("-") else (1.0, name)
    out = F.lit(sign)
    for part in name.split("*"):
        out = out * F.col(part)
    return out


def _normal_equations() -> list:
    """Sums of products: the upper triangle of A'A, then A'b."""
    out = []
    for i in range(8):
        for j in range(i, 8):
            terms = [_value(r[i]) * _value(r[j]) for r in (_ROW_U, _ROW_V) if r[i] and r[j]]
            out.append(F.sum(sum(terms[1:], terms[0])).alias(f"a{i}{j}") if terms else F.lit(0.0).alias(f"a{i}{j}"))
    for i in range(8):
        terms = [_value(r[i]) * F.col(t) for r, t in ((_ROW_U, "u"), (_ROW_V, "v")) if r[i]]
        out.append(F.sum(sum(terms[1:], terms[0])).alias(f"b{i}"))
    return out


def solve(a: np.ndarray, b: np.ndarray, n: np.ndarray, centre: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """Coefficients (cameras x 8) from the normal equations of normalised
    pairs; NaN where they fix no map."""
    out = np.full((len(b), 8), np.nan)
    able = (n >= LEAST_PAIRS) & np.isfinite(a).all(axis=(1, 2)) & (spread > 0).all(axis=1)
    able[able] = np.linalg.cond(a[able]) < MOST_CONDITION
    for k in np.flatnonzero(able):
        h = np.append(np.linalg.solve(a[k], b[k]), 1.0).reshape(3, 3)
        (cx, cy, cu, cv), (sx, sy, su, sv) = centre[k], spread[k]
        pixel = np.array([[1 / sx, 0, -cx / sx], [0, 1 / sy, -cy / sy], [0, 0, 1]])
        plane = np.array([[su, 0, cu], [0, sv, cv], [0, 0, 1]])
        h = plane @ h @ pixel
        if abs(np.linalg.det(h)) > 0 and abs(h[2, 2]) > 1e-12 * np.abs(h[2]).max():
            out[k] = (h / h[2, 2]).ravel()[:8]
    return out


def calibrate(pairs: DataFrame) -> DataFrame:
    """One row per camera (and session, if ``pairs`` has them): m0 .. m7."""
    keys = [k for k in ("session_id", "camera_id") if k in pairs.columns]
    num = [F.col(c).cast("double").alias(c) for c in _XYUV]
    good = [F.coalesce(F.abs(F.col(c)) < float("inf"), F.lit(False)) & ~F.isnan(c) for c in _XYUV]
    rows = pairs.select(*keys, *num)
    cameras = rows.select(*keys).distinct()
    rows = rows.where(good[0] & good[1] & good[2] & good[3])
    scale = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"c_{c}") for c in _XYUV],
                                    *[F.stddev_pop(c).alias(f"s_{c}") for c in _XYUV])
    # one row a camera: joined back to the pairs, and later to their sums
    near = rows.join(scale, keys).select(*keys, *[((F.col(c) - F.col(f"c_{c}")) / F.when(F.col(f"s_{c}") > 0, F.col(f"s_{c}")).otherwise(1.0)).alias(c)
                                                  for c in _XYUV])
    systems = near.groupBy(*keys).agg(*_normal_equations()).join(scale, keys)
    upper = [(i, j) for i in range(8) for j in range(i, 8)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            get = lambda name: rb.column(name).to_numpy(zero_copy_only=False).astype(float)
            a = np.zeros((rb.num_rows, 8, 8))
            for i, j in upper:
                a[:, i, j] = a[:, j, i] = get(f"a{i}{j}")
            b = np.stack([get(f"b{i}") for i in range(8)], axis=1)
            m = solve(a, b, get("n"), np.stack([get(f"c_{c}") for c in _XYUV], axis=1), np.stack([get(f"s_{c}") for c in _XYUV], axis=1))
            yield pa.RecordBatch.from_arrays([*(rb.column(k) for k in keys), *(pa.array(m[:, i], mask=np.isnan(m[:, i])) for i in range(8))],
                                             [*keys, *COEFFICIENTS])

    kinds = dict(pairs.dtypes)
    solved = systems.mapInArrow(run, ", ".join([*(f"{k} {kinds[k]}" for k in keys), *(f"{m} double" for m in COEFFICIENTS)]))
    return cameras.join(solved, keys, "left")


def positions(points: DataFrame, coefficients: DataFrame, x: str = "bx", y: str = "by") -> DataFrame:
    """``points`` with tx, ty by the coefficients of their camera; null where it
    has none, or where the point lies on the map's horizon."""
    keys = [k for k in ("session_id", "camera_id") if k in coefficients.columns]
    joined = points.drop("tx", "ty").join(coefficients, keys, "left")
    tx, ty = project(F.col(x).cast("double"), F.col(y).cast("double"), tuple(F.col(m) for m in COEFFICIENTS))
    den = F.col("m6") * F.col(x) + F.col("m7") * F.col(y) + 1.0
    return joined.withColumn("tx", F.when(den != 0, tx)).withColumn("ty", F.when(den != 0, ty)).drop(*COEFFICIENTS)
