"""Exports of filtered rows and summaries (CSV with header, JSON lines), and
the violation log (append-only CSV)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clean import standardize
from ..schema import VIOLATION_COLUMNS, VIOLATION_CSV_SCHEMA
from .csv_source import FULL_TIME_FORMAT, LOG_TIME_FORMAT, read_violations_csv, write_violations_csv

# Fixed value: ISO timestamps with milliseconds in JSON records.
JSON_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS"


def export_csv(df: DataFrame, path: str) -> None:
    """Rows as CSV with a header and no index column; timestamps as
    ``yyyy-MM-dd HH:mm:ss.SSSSSS``."""
    (df.write.mode("overwrite").option("header", True)
     .option("timestampNTZFormat", FULL_TIME_FORMAT)
     .option("timestampFormat", FULL_TIME_FORMAT).csv(path))


def export_json(df: DataFrame, path: str) -> None:
    """Rows as JSON records (one per line) with ISO timestamps; null fields
    are written as null."""
    (df.write.mode("overwrite").option("ignoreNullFields", False)
     .option("timestampNTZFormat", JSON_TIME_FORMAT)
     .option("timestampFormat", JSON_TIME_FORMAT).json(path))


def read_export_csv(spark: SparkSession, path: str, schema=VIOLATION_CSV_SCHEMA) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def read_export_json(spark: SparkSession, path: str, schema=VIOLATION_CSV_SCHEMA) -> DataFrame:
    return spark.read.schema(schema).json(path)


def append_log(df: DataFrame, path: str) -> None:
    """Append violation rows to the log (seconds-resolution time text)."""
    write_violations_csv(df, path, mode="append", fmt=LOG_TIME_FORMAT)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return standardize(read_violations_csv(spark, path))


def log_tail(df: DataFrame, n: int = 10) -> DataFrame:
    """Latest n entries: files have no row order in Spark, so "last" means
    latest time, then id, then place (all descending)."""
    order: list[Column] = [F.col(c).desc_nulls_last() for c in
                           ("Timestamp", "Violation_ID", "Latitude", "Longitude",
                            "Violation_Type", "Vehicle_Type", "Severity")]
    return df.select(*VIOLATION_COLUMNS).orderBy(*order).limit(n)
