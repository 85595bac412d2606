"""Reading of the text tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path


#: Rows and bytes of a batch that goes to Python: texts are long, and the
#: defaults (10,000 rows) make batches of tens of megabytes on either side.
BATCH_ROWS, BATCH_BYTES = 1_000, 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Bound the memory of the session's Python tasks."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the folder; bounds the session's batches for what reads it."""
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back: cuts
    the lineage, and what a lost executor held can be read again."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
