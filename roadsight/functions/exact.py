"""Sums and means of doubles that do not depend on the order of rows.

A value becomes the nearest multiple of 2^-40 (1e-12), an integer; integers are
summed exactly, in any order, by any partial aggregation, and sums of parts add
up to the sum of the whole.  The mean is the integer quotient, which a double
holds exactly again.  Values beyond +-2^22 (no coordinate is) count as these;
null and NaN are left out.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNIT_BITS = 40
SCALE = float(1 << UNIT_BITS)
MOST = float(1 << 22)


def scaled(c: Column) -> Column:
    held = F.greatest(F.least(c, F.lit(MOST)), F.lit(-MOST))
    return F.when(c.isNotNull() & ~F.isnan(c), F.floor(held * F.lit(SCALE) + F.lit(0.5))).cast("decimal(19,0)")


def exact_sum(c: Column, times: Column | None = None) -> Column:
    """Aggregate: the sum in units, each value counted ``times`` times."""
    s = scaled(c)
    return F.sum((s if times is None else s * times.cast("decimal(19,0)")).cast("decimal(38,0)"))


def exact_count(c: Column, times: Column | None = None) -> Column:
    """Aggregate: how many values the sum holds."""
    one = F.lit(1) if times is None else times
    return F.sum(F.when(c.isNotNull() & ~F.isnan(c), one))


def mean_of(total: Column, count: Column) -> Column:
    """The mean of an exact sum and count; null where there is none."""
    return F.when(count > 0, F.call_function("div", total, count.cast("decimal(38,0)"))).cast("double") / F.lit(SCALE)
