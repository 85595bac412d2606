"""Cleaning of the violation fact (the producer the marts read from)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.time import parse_timestamp
from ..schema import VIOLATION_COLUMNS


def _as_timestamp(df: DataFrame, name: str):
    dt = df.schema[name].dataType
    if isinstance(dt, T.TimestampNTZType):
        return F.col(name)
    if isinstance(dt, T.TimestampType):
        return F.col(name).cast("timestamp_ntz")
    return parse_timestamp(F.col(name).cast("string"))


def _as(df: DataFrame, name: str, target: str):
    """Try-cast: a malformed value becomes null instead of failing the job, and
    so does a number that is none (NaN)."""
    c = F.col(name).try_cast(target) if df.schema[name].dataType.simpleString() != target \
        else F.col(name)
    return F.when(~F.isnan(c), c) if target == "double" else c


def standardize(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Coerce to the fact types (bad values -> null) and drop rows without an
    id; ``keys`` are further columns to keep.  Projection and filter only: no
    shuffle."""
    return df.select(
        F.col("Violation_ID").cast("string").alias("Violation_ID"),
        _as_timestamp(df, "Timestamp").alias("Timestamp"),
        _as(df, "Latitude", "double").alias("Latitude"),
        _as(df, "Longitude", "double").alias("Longitude"),
        F.col("Violation_Type").cast("string").alias("Violation_Type"),
        F.col("Vehicle_Type").cast("string").alias("Vehicle_Type"),
        _as(df, "Severity", "int").alias("Severity"),
        *keys,
    ).where(F.col("Violation_ID").isNotNull())


def clean_violations(df: DataFrame, dedupe: bool = True, keys: Sequence[str] = ()) -> DataFrame:
    """``standardize`` plus removal of exact duplicate rows (all seven columns
    and ``keys``; never by id alone, since ids repeat across sessions).  Give
    the session, camera and track as keys where the rows have them: two tracks
    at one spot and second are two violations.  The duplicate removal is a
    hash aggregate with map-side combine, so a row copied a billion times is
    collapsed before the shuffle."""
    out = standardize(df, keys)
    return out.dropDuplicates([*VIOLATION_COLUMNS, *keys]) if dedupe else out
