"""The cleaned violation fact as date-partitioned Parquet.

Partitioning by the event date lets the dashboard's date-range filter prune
whole directories (``PartitionFilters`` in the scan) on top of Parquet
row-group pushdown for the other predicates.  Rows without a time go to the
default partition and are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import VIOLATION_COLUMNS

DATE_COL = "event_date"


def write_fact(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write the fact partitioned by event date.

    Rows are range-partitioned on (date, row hash): the sampled bounds cut a
    busy date into as many tasks as its volume needs (a date holding a third
    of the rows is spread, not sent to one writer), while each task still
    covers one or two dates, so the table gets few, large files."""
    out = df.select(*VIOLATION_COLUMNS).withColumn(DATE_COL, F.to_date("Timestamp"))
    spread = F.xxhash64(*VIOLATION_COLUMNS)
    (out.repartitionByRange(F.col(DATE_COL), spread)
     .write.mode(mode).partitionBy(DATE_COL).parquet(path))


def read_fact(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def date_partition_filter(sel) -> F.Column | None:
    """The partition-column form of a selection's date range (pruning)."""
    if not (sel and sel.date_range and len(sel.date_range) == 2):
        return None
    s, e = sel.date_range
    return (F.col(DATE_COL) >= F.lit(s)) & (F.col(DATE_COL) <= F.lit(e))


def drop_date(spark: SparkSession, path: str, date) -> bool:
    """Remove a stored date (None: the rows without a time); False if absent."""
    name = "__HIVE_DEFAULT_PARTITION__" if date is None else str(date)
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{DATE_COL}={name}")
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
