"""Sets of stored tables that change as one.

A set's data lie in folders that are written once and never changed; a manifest
says which of them make up a version.  Writing the manifest is one file that
appears at once when its write job commits, so a reader sees the version before
or the version after, whole, and a job killed in between leaves the old one
readable (with folders that no manifest names).  One writer at a time; a second
one that commits the same version fails.  Everything goes through Spark's
readers and writers, so any store that Spark reads will do.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_VERSION = T.StructField("version", T.LongType(), True)


def _folder(root: str) -> str:
    return f"{root.rstrip('/')}/manifests"


def missing(e: AnalysisException) -> bool:
    """Is there nothing at the path (and not something that can't be read)?"""
    return e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def _manifests(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame | None:
    try:
        return spark.read.schema(T.StructType([*schema.fields, T.StructField("is_row", T.BooleanType()), _VERSION])).parquet(_folder(root))
    except AnalysisException as e:
        if missing(e):
            return None
        raise


def current_version(spark: SparkSession, root: str) -> int:
    """The newest committed version, 0 if there is none."""
    found = _manifests(spark, root, T.StructType([]))
    return 0 if found is None else found.agg(F.max("version")).first()[0] or 0


def read_manifest(spark: SparkSession, root: str, schema: str | T.StructType, version: int | None = None) -> tuple[int, list]:
    """(version, its rows); (0, []) if nothing was committed."""
    schema = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    version = version or current_version(spark, root)
    if not version:
        return 0, []
    rows = _manifests(spark, root, schema).where((F.col("version") == version) & F.col("is_row"))
    return version, rows.select(*schema.names).collect()


def all_manifests(spark: SparkSession, root: str, schema: str | T.StructType) -> list:
    """The rows of every version, each with its ``version``."""
    schema = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    found = _manifests(spark, root, schema)
    return [] if found is None else found.where("is_row").select("version", *schema.names).collect()


def commit(spark: SparkSession, root: str, version: int, rows: list[tuple], schema: str | T.StructType) -> None:
    """Make ``rows`` version ``version`` of the set; fails if it exists."""
    schema = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    whole = T.StructType([*schema.fields, T.StructField("is_row", T.BooleanType())])
    # a row of its own, so that an empty version is one too
    marked = [(*r, True) for r in rows] + [(*[None] * len(schema), False)]
    spark.createDataFrame(marked, whole).coalesce(1).write.mode("error").parquet(f"{_folder(root)}/version={version}")
