"""CSV scan of the violation table with the fixed seven-field schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import VIOLATION_COLUMNS, VIOLATION_CSV_SCHEMA

# Fixed value: the timestamp text the violation logger writes.
LOG_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
FULL_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def read_violations_csv(spark: SparkSession, path: str) -> DataFrame:
    """Header row, explicit schema (no inference pass), PERMISSIVE: a bad cell
    becomes null instead of failing the scan."""
    return (spark.read.schema(VIOLATION_CSV_SCHEMA).option("header", True)
            .option("mode", "PERMISSIVE").csv(path))


def with_timestamp_text(df: DataFrame, fmt: str = FULL_TIME_FORMAT) -> DataFrame:
    """Render the Timestamp column as text (nulls stay null)."""
    if dict(df.dtypes).get("Timestamp") == "string":
        return df
    return df.withColumn("Timestamp", F.date_format("Timestamp", fmt))


def write_violations_csv(df: DataFrame, path: str, mode: str = "overwrite",
                         fmt: str = FULL_TIME_FORMAT) -> None:
    """Write the seven columns as CSV with a header in every part file (the
    reader skips each file's header, so appends stay readable)."""
    (with_timestamp_text(df.select(*VIOLATION_COLUMNS), fmt)
     .write.mode(mode).option("header", True).csv(path))
