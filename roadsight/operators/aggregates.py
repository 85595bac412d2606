"""Count marts over the violation fact.

Every mart is ``mart(fact) -> DataFrame`` and lazy.  Each is one hash
aggregate with a map-side partial count, so a key holding a third of the rows
is pre-combined in every task before the shuffle; only the (small) aggregated
rows are exchanged.  Sorting happens on the aggregated rows only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exact import exact_count, exact_sum, mean_of
from .features import with_grid_features, with_time_features

N = "total_violations"
# The 24 hours of the type x hour cross-tab and the eight window
# starts of the type x window matrix; a "null" column counts missing times.
ALL_HOURS = list(range(24))
ALL_WINDOWS = list(range(0, 24, 3))
NULL_COLUMN = "null"


def ensure_time(df: DataFrame) -> DataFrame:
    return df if "hour_window" in df.columns else with_time_features(df)


def ensure_grid(df: DataFrame) -> DataFrame:
    return df if "grid_cell" in df.columns else with_grid_features(df)


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(N))


def by_count_desc(*tie_keys: str) -> list[Column]:
    """Descending count, then the keys ascending (nulls first) as tie-break."""
    return [F.col(N).desc()] + [F.col(k).asc_nulls_first() for k in tie_keys]


def violations_per_hour(df: DataFrame) -> DataFrame:
    return count_by(ensure_time(df), "hour").orderBy(F.col("hour").asc_nulls_first())


def violations_per_day(df: DataFrame) -> DataFrame:
    """Alphabetical day order (Fri, Mon, Sat, ...), as the original."""
    return count_by(ensure_time(df), "day_of_week").orderBy(F.col("day_of_week").asc_nulls_first())


def violations_by_type(df: DataFrame) -> DataFrame:
    return count_by(df, "Violation_Type").orderBy(*by_count_desc("Violation_Type"))


def _count_matrix(df: DataFrame, row_key: str, row_alias: str, col_key: str,
                  values: list[int]) -> DataFrame:
    """One pass of conditional counts: fixed columns, no distinct-values job,
    no driver-side table build.  Missing cells are 0."""
    cells = [F.count_if(F.col(col_key) == F.lit(v)).alias(str(v)) for v in values]
    cells.append(F.count_if(F.col(col_key).isNull()).alias(NULL_COLUMN))
    return df.groupBy(F.col(row_key).alias(row_alias)).agg(*cells)


def type_hour_matrix(df: DataFrame) -> DataFrame:
    """Cross-tab type x hour: ``Violation_Type_hour`` (null type -> "null"),
    then counts for hours "0".."23" and "null"."""
    df = ensure_time(df).withColumn(
        "_type", F.coalesce(F.col("Violation_Type"), F.lit(NULL_COLUMN)))
    return (_count_matrix(df, "_type", "Violation_Type_hour", "hour", ALL_HOURS)
            .orderBy("Violation_Type_hour"))


def violations_per_location(df: DataFrame) -> DataFrame:
    return (count_by(df, "Latitude", "Longitude")
            .orderBy(*by_count_desc("Latitude", "Longitude")))


def top_locations(df: DataFrame, n: int = 10) -> DataFrame:
    """Top-n: the sort and the limit stay adjacent -> TakeOrderedAndProject."""
    return violations_per_location(df).limit(n)


def violations_by_window(df: DataFrame) -> DataFrame:
    return count_by(ensure_time(df), "hour_window").orderBy(F.col("hour_window").asc_nulls_first())


def violations_by_daytype(df: DataFrame) -> DataFrame:
    return count_by(ensure_time(df), "day_type").orderBy("day_type")


def violations_type_time(df: DataFrame) -> DataFrame:
    return (count_by(ensure_time(df), "Violation_Type", "hour_window")
            .orderBy(F.col("Violation_Type").asc_nulls_first(),
                     F.col("hour_window").asc_nulls_first()))


def grid_stats(df: DataFrame) -> DataFrame:
    """Counts and mean coordinates per cell; means are exact integer sums (see
    ``functions.exact``), the same however the rows are partitioned."""
    lat, lon = F.col("Latitude"), F.col("Longitude")
    g = (ensure_grid(df).groupBy("grid_cell")
         .agg(F.count(F.lit(1)).alias(N), exact_sum(lat).alias("_a"), exact_count(lat).alias("_an"),
              exact_sum(lon).alias("_o"), exact_count(lon).alias("_on")))
    return (g.select("grid_cell", N, mean_of(F.col("_a"), F.col("_an")).alias("avg_lat"),
                     mean_of(F.col("_o"), F.col("_on")).alias("avg_lon"))
            .orderBy(*by_count_desc("grid_cell")))


def top_hotspots(df: DataFrame, n: int = 10) -> DataFrame:
    return grid_stats(df).limit(n)


def type_window_matrix(df: DataFrame) -> DataFrame:
    """Heatmap table: Violation_Type x window start, missing -> 0."""
    return (_count_matrix(ensure_time(df), "Violation_Type", "Violation_Type",
                          "hour_window", ALL_WINDOWS)
            .orderBy(F.col("Violation_Type").asc_nulls_first()))


def top_types(df: DataFrame, n: int = 15) -> DataFrame:
    return violations_by_type(df).limit(n)
