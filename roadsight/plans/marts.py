"""The ten marts, computed from two shared roll-ups instead of ten scans.

The fact is read once per roll-up: (type, hour, day) and (lat, lon), each a
partial-aggregated hash aggregate whose output is bounded by the key domain,
not by the row count.  Both are cut from their lineage with ``checkpoint()``
(reliable, in ``spark.checkpoint.dir``) so the ten mart writes reuse them and
a lost executor does not send the job back to the fact scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import exact, grid, time
from ..operators import aggregates as agg
from ..operators.aggregates import ALL_HOURS, N, NULL_COLUMN, by_count_desc
from ..schema import has_columns
from ..session import checkpoint_root
from ..sources.mart_store import current_marts, read_mart, write_marts


def time_rollup(fact: DataFrame) -> DataFrame:
    f = agg.ensure_time(fact)
    return agg.count_by(f, "Violation_Type", "hour", "day_of_week")


def location_rollup(fact: DataFrame) -> DataFrame:
    return agg.count_by(fact, "Latitude", "Longitude")


def _sum_by(r: DataFrame, *keys) -> DataFrame:
    return r.groupBy(*keys).agg(F.sum(N).cast("long").alias(N))


def _small_sorted(df: DataFrame, *order) -> DataFrame:
    """Total order for a mart bounded by a tiny key domain (hours, days,
    windows): one partition sorted locally, so no range-sampling job and no
    range exchange.  Marts keyed by type or place keep the global sort."""
    return df.coalesce(1).sortWithinPartitions(*order)


def time_marts(tr: DataFrame) -> dict[str, DataFrame]:
    tr = (tr.withColumn("day_type", time.day_type(F.col("day_of_week")))
          .withColumn("hour_window", time.hour_window(F.col("hour"))))
    cells = [F.sum(F.when(F.col("hour") == h, F.col(N)).otherwise(0)).cast("long").alias(str(h))
             for h in ALL_HOURS]
    cells.append(F.sum(F.when(F.col("hour").isNull(), F.col(N)).otherwise(0)).cast("long")
                 .alias(NULL_COLUMN))
    matrix = (tr.groupBy(F.coalesce(F.col("Violation_Type"), F.lit(NULL_COLUMN)).alias("Violation_Type_hour"))
              .agg(*cells).orderBy("Violation_Type_hour"))
    return {
        "hourly": _small_sorted(_sum_by(tr, "hour"), F.col("hour").asc_nulls_first()),
        "daily": _small_sorted(_sum_by(tr, "day_of_week"),
                               F.col("day_of_week").asc_nulls_first()),
        "type_summary": _sum_by(tr, "Violation_Type").orderBy(*by_count_desc("Violation_Type")),
        "type_hour_matrix": matrix,
        "time_window": _small_sorted(_sum_by(tr, "hour_window"),
                                     F.col("hour_window").asc_nulls_first()),
        "daytype": _small_sorted(_sum_by(tr, "day_type"), "day_type"),
        "type_time": _sum_by(tr, "Violation_Type", "hour_window").orderBy(
            F.col("Violation_Type").asc_nulls_first(), F.col("hour_window").asc_nulls_first()),
    }


def location_marts(lr: DataFrame) -> dict[str, DataFrame]:
    all_loc = lr.orderBy(*by_count_desc("Latitude", "Longitude"))
    lat, lon, n = F.col("Latitude"), F.col("Longitude"), F.col(N)
    g = (lr.withColumn("grid_cell", grid.grid_cell(grid.coord_bin(lat), grid.coord_bin(lon)))
         .groupBy("grid_cell")
         .agg(F.sum(N).cast("long").alias(N), exact.exact_sum(lat, n).alias("_a"), exact.exact_count(lat, n).alias("_an"),
              exact.exact_sum(lon, n).alias("_o"), exact.exact_count(lon, n).alias("_on"))
         .select("grid_cell", N, exact.mean_of(F.col("_a"), F.col("_an")).alias("avg_lat"),
                 exact.mean_of(F.col("_o"), F.col("_on")).alias("avg_lon"))
         .orderBy(*by_count_desc("grid_cell")))
    return {"all_locations": all_loc, "top_locations": all_loc.limit(10), "spatial_grid": g}


def build_marts(spark: SparkSession, fact: DataFrame, cut_lineage: bool = True) -> dict[str, DataFrame]:
    """The marts that the fact's columns allow: those of places need both
    coordinates, the others the time and type."""
    checkpoint_root(spark)
    keep = (lambda df: df.checkpoint()) if cut_lineage else (lambda df: df)
    tr = keep(time_rollup(fact)) if has_columns(fact, "Timestamp", "Violation_Type") else None
    lr = keep(location_rollup(fact)) if has_columns(fact, "Latitude", "Longitude") else None
    return {**(time_marts(tr) if tr is not None else {}), **(location_marts(lr) if lr is not None else {})}


def direct_marts(fact: DataFrame) -> dict[str, DataFrame]:
    """Each mart straight from the fact (one aggregate each); the plain
    shape the roll-up path must equal."""
    return {
        "hourly": agg.violations_per_hour(fact),
        "daily": agg.violations_per_day(fact),
        "type_summary": agg.violations_by_type(fact),
        "type_hour_matrix": agg.type_hour_matrix(fact),
        "all_locations": agg.violations_per_location(fact),
        "top_locations": agg.top_locations(fact),
        "time_window": agg.violations_by_window(fact),
        "daytype": agg.violations_by_daytype(fact),
        "type_time": agg.violations_type_time(fact),
        "spatial_grid": agg.grid_stats(fact),
    }


def run_mart_job(spark: SparkSession, fact: DataFrame, out_root: str) -> dict[str, str]:
    """Write all ten marts as the newest set under ``out_root``."""
    return write_marts(spark, build_marts(spark, fact), out_root)


def mart_summary(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """One row per mart read back: (mart, rows, total) where total is the sum
    of its counts (all hour cells for the cross-tab)."""
    parts = []
    for name in sorted(paths):
        df = read_mart(spark, paths[name])
        if name == "type_hour_matrix":
            total = sum((F.col(f"`{c}`") for c in df.columns if c != "Violation_Type_hour"),
                        F.lit(0))
        else:
            total = F.col(N)
        parts.append(df.agg(F.lit(name).alias("mart"), F.count(F.lit(1)).alias("rows"),
                            F.coalesce(F.sum(total), F.lit(0)).cast("long").alias("total")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def mart_values(spark: SparkSession, root: str) -> DataFrame:
    """(mart, key, total_violations, place) of the marts with a total per row;
    ``place`` is a row's position in the order it was written in: its place in
    its file plus the rows of the files before (a row a file; no row moves)."""
    keys = {"hourly": ["hour"], "daily": ["day_of_week"], "type_summary": ["Violation_Type"], "time_window": ["hour_window"],
            "daytype": ["day_type"], "type_time": ["Violation_Type", "hour_window"], "spatial_grid": ["grid_cell"],
            "all_locations": ["Latitude", "Longitude"], "top_locations": ["Latitude", "Longitude"]}
    parts, paths = [], current_marts(spark, root)
    for name, cols in keys.items():
        if name not in paths:
            continue
        df = read_mart(spark, paths[name]).select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
        text = [F.round(c, 2).cast("string") if c in ("Latitude", "Longitude") else F.col(c).cast("string") for c in cols]
        key = F.concat_ws("|", *text) if len(cols) > 1 else text[0]
        # files are named in partition order and a file keeps its rows' order
        files = df.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"))
        earlier = Window.partitionBy(F.lit(name)).orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
        before = files.select("_file", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
        parts.append(df.join(before, "_file").select(F.lit(name).alias("mart"), key.alias("key"), F.col(N),
                                                     (F.col("_before") + F.col("_row") + 1).cast("int").alias("place")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
