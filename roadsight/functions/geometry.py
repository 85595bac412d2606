"""Pixel -> top-down road plane.

The 3x3 perspective matrix is solved once on the driver from four point pairs
(an 8x8 linear system) and enters the plan as eight double literals, so the
projection is plain Column arithmetic inside whole-stage codegen.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

# Road trapezoid in the camera picture (top-left, top-right,
# bottom-right, bottom-left), the top-down rectangle it maps to, and metres per
# top-down unit.
ROAD_POINTS_PX = [(713.0, 126.0), (1283.0, 126.0), (1903.0, 837.0), (180.0, 833.0)]
TOPDOWN_WIDTH = 800.0
TOPDOWN_HEIGHT = 1200.0
TOPDOWN_POINTS = [(0.0, 0.0), (TOPDOWN_WIDTH, 0.0),
                  (TOPDOWN_WIDTH, TOPDOWN_HEIGHT), (0.0, TOPDOWN_HEIGHT)]
METRES_PER_UNIT = 0.012


def solve_homography(src, dst) -> tuple[float, ...]:
    """Coefficients (m0..m7) of u=(m0x+m1y+m2)/(m6x+m7y+1), v=(m3x+m4y+m5)/(..)."""
    a = np.zeros((8, 8))
    b = np.zeros(8)
    for i, ((x, y), (u, v)) in enumerate(zip(src, dst)):
        a[2 * i] = [x, y, 1.0, 0.0, 0.0, 0.0, -x * u, -y * u]
        a[2 * i + 1] = [0.0, 0.0, 0.0, x, y, 1.0, -x * v, -y * v]
        b[2 * i] = u
        b[2 * i + 1] = v
    return tuple(float(m) for m in np.linalg.solve(a, b))


@lru_cache(maxsize=None)
def road_homography() -> tuple[float, ...]:
    return solve_homography(ROAD_POINTS_PX, TOPDOWN_POINTS)


def bottom_center_x(x1: Column, x2: Column) -> Column:
    """int((x1 + x2) / 2): true division, truncation toward zero."""
    return ((x1 + x2) / F.lit(2)).cast("int")


def project(x: Column, y: Column, m: tuple[float, ...] | None = None) -> tuple[Column, Column]:
    """Top-down (tx, ty) of pixel (x, y), by numbers or by columns of them."""
    m = m or road_homography()
    lit = [F.lit(v) for v in m]
    den = lit[6] * x + lit[7] * y + F.lit(1.0)
    tx = (lit[0] * x + lit[1] * y + lit[2]) / den
    ty = (lit[3] * x + lit[4] * y + lit[5]) / den
    return tx, ty


def sql_double(v: float) -> str:
    """A double literal that SQL engines read as DOUBLE, not DECIMAL."""
    r = repr(float(v))
    return r if ("e" in r or "E" in r) else r + "e0"
