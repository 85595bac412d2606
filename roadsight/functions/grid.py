"""Spatial grid keys: 0.1-degree cells named ``<lat_bin>_<lon_bin>``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: bins per degree.
BINS_PER_DEGREE = 10


def coord_bin(deg: Column) -> Column:
    """trunc(deg * 10) as int.  Truncation toward zero makes the cells that
    touch 0 twice as wide, as in the original; NaN or overflow gives null."""
    return (deg * F.lit(BINS_PER_DEGREE)).try_cast("int")


def grid_cell(lat_bin: Column, lon_bin: Column) -> Column:
    """``lat_lon``; a null part is skipped (``"-1"`` or ``""``)."""
    return F.concat_ws("_", lat_bin, lon_bin)
