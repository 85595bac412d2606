"""Mart sink and loader.

A mart job writes each mart to a new folder under the mart's own and then names
them all in a manifest (see ``versions``): readers find the set before or
the set after, never half of one, and a job killed between marts leaves the old
set readable.

The dashboard's loader gives None for a mart that can't be read, and says why;
jobs use ``read_mart``, which raises.
"""

from __future__ import annotations

import logging
import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, SparkRuntimeException as SparkException
from pyspark.sql import DataFrame, SparkSession

from .versions import commit, missing, read_manifest

log = logging.getLogger(__name__)

MANIFEST = "mart string, path string"

# Mart name -> path under the output root.
MART_PATHS = {
    "hourly": "time_based/hourly",
    "daily": "time_based/daily",
    "type_summary": "offense_type/type_summary",
    "type_hour_matrix": "offense_type/type_hour_matrix",
    "all_locations": "location_based/all_locations",
    "top_locations": "location_based/top_locations",
    "time_window": "advanced/time_window",
    "daytype": "advanced/daytype",
    "type_time": "advanced/type_time",
    "spatial_grid": "advanced/spatial_grid",
}
# The marts the dashboard reads, by its own short names.
DASHBOARD_MARTS = {
    "hour": "hourly",
    "day": "daily",
    "type": "type_summary",
    "top_loc": "top_locations",
    "all_loc": "all_locations",
    "grid": "spatial_grid",
    "type_time": "type_time",
}


def mart_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{MART_PATHS[name]}" if "://" in root \
        else os.path.join(root, MART_PATHS[name])


def write_marts(spark: SparkSession, marts: dict[str, DataFrame], root: str) -> dict[str, str]:
    """Write the marts as the newest set of ``root``; a missing mart (e.g. no
    grid) is skipped.  Returns the path of each."""
    version, _ = read_manifest(spark, root, MANIFEST)
    name_of_set = f"set={uuid.uuid4().hex[:12]}"
    paths = {name: f"{mart_path(root, name)}/{name_of_set}" for name, df in marts.items() if df is not None}
    for name, path in paths.items():
        marts[name].write.parquet(path)
    commit(spark, root, version + 1, list(paths.items()), MANIFEST)
    return paths


def current_marts(spark: SparkSession, root: str, version: int | None = None) -> dict[str, str]:
    """Path of each mart of the newest (or a given) set; empty without one."""
    return {r["mart"]: r["path"] for r in read_manifest(spark, root, MANIFEST, version)[1]}


def read_mart(spark: SparkSession, path: str) -> DataFrame:
    """A mart, for jobs: what can't be read raises."""
    return spark.read.parquet(path)


def try_parquet(spark: SparkSession, path: str) -> tuple[DataFrame | None, str | None]:
    """(table, None), or (None, why it can't be read): a Parquet file or
    directory of part files that is missing, empty or unreadable."""
    try:
        df = spark.read.parquet(path)
    except AnalysisException as e:
        return None, f"missing or empty: {path}" if missing(e) else f"unreadable: {path}: {e}"
    except (SparkException, Py4JJavaError) as e:      # no footer to read, no permission, a broken store
        return None, f"unreadable: {path}: {e}"
    return (df, None) if df.columns else (None, f"without columns: {path}")


def load_parquet(spark: SparkSession, path: str) -> DataFrame | None:
    """The table, or None with a warning that says why."""
    df, reason = try_parquet(spark, path)
    if reason:
        log.warning("no mart: %s", reason)
    return df


def load_all(spark: SparkSession, root: str) -> dict[str, DataFrame | None]:
    """The dashboard's marts of the newest set (of plain folders under the root
    where there is no set)."""
    paths = current_marts(spark, root)
    return {short: load_parquet(spark, paths.get(name) or mart_path(root, name)) for short, name in DASHBOARD_MARTS.items()}
