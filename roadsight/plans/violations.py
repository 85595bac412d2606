"""Detections -> violation log -> cleaned fact -> hotspots (the flagship)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import aggregates as agg
from ..operators import tracking as trk
from ..operators.clean import clean_violations
from ..sources import fixtures


def violation_fact(detections: DataFrame, cameras: DataFrame) -> DataFrame:
    """The violation log of the detections as a cleaned fact, which keeps the
    session, camera and track of each row."""
    return clean_violations(trk.violation_log(detections, cameras), keys=trk.KEYS)


def hotspots(detections: DataFrame, cameras: DataFrame) -> DataFrame:
    return agg.grid_stats(violation_fact(detections, cameras))


def hotspots_from_detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hotspots(fixtures.detections(spark, sf_dir), fixtures.fixture_cameras(spark))
