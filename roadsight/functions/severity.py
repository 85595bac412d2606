"""Speeding severity score."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Percent-over-limit steps for scores 1..4; 5 above the last.
SEVERITY_STEPS_PCT = [10.0, 20.0, 30.0, 40.0]


def severity_score(speed: Column, limit: Column) -> Column:
    """0 at or under the limit; else 1..5 by how far over, in percent (5 over
    a limit of 0, which has no percentage)."""
    pct = F.try_divide(speed - limit, limit) * F.lit(100.0)
    expr = F.when(speed <= limit, F.lit(0))
    for score, step in enumerate(SEVERITY_STEPS_PCT, start=1):
        expr = expr.when(pct < F.lit(step), F.lit(score))
    return expr.otherwise(F.lit(5)).cast("int")


def severity_of(speed: float, limit: float) -> int:
    """``severity_score`` of one value."""
    if speed <= limit:
        return 0
    if not limit:
        return len(SEVERITY_STEPS_PCT) + 1
    over = (speed - limit) / limit * 100.0
    return 1 + sum(over >= step for step in SEVERITY_STEPS_PCT)
