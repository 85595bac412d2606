"""Dashboard figures over the (filtered) fact: KPIs, filter options, map
centre, samples and the report summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exact import exact_sum, mean_of
from .aggregates import N, by_count_desc, count_by, grid_stats, violations_per_hour
from ..schema import VIOLATION_COLUMNS
from .selection import Selection, apply_selection, valid_coordinates

HIGH_SEVERITY = 4  # fixed value: "Sev 4+"


def kpi_summary(df: DataFrame) -> DataFrame:
    """One row: total violations, unique types, most common type (ties by
    name; "N/A" when empty), count with Severity >= 4.

    Two-level aggregate: a partial-aggregated roll-up by type, then a single
    group over that roll-up (one row per type)."""
    per_type = df.groupBy("Violation_Type").agg(
        F.count(F.lit(1)).alias(N),
        F.count_if(F.col("Severity") >= F.lit(HIGH_SEVERITY)).alias("_high"))
    return per_type.agg(
        F.coalesce(F.sum(N), F.lit(0)).cast("long").alias("total_violations"),
        F.count(F.lit(1)).alias("unique_types"),
        F.coalesce(F.min_by(F.col("Violation_Type"),
                            F.struct((-F.col(N)).alias("a"), F.col("Violation_Type").alias("b"))),
                   F.lit("N/A")).alias("most_common_type"),
        F.coalesce(F.sum("_high"), F.lit(0)).cast("long").alias("high_severity"),
    )


def filter_options_types(df: DataFrame) -> DataFrame:
    return (df.select("Violation_Type").where(F.col("Violation_Type").isNotNull())
            .distinct().orderBy("Violation_Type"))


def filter_options_severity(df: DataFrame) -> DataFrame:
    return (df.select("Severity").where(F.col("Severity").isNotNull())
            .distinct().orderBy("Severity"))


def filter_options_dates(df: DataFrame) -> DataFrame:
    return df.agg(F.to_date(F.min("Timestamp")).alias("min_date"),
                  F.to_date(F.max("Timestamp")).alias("max_date"))


def hotspot_locations(df: DataFrame, sel: Selection | None = None) -> DataFrame:
    """Filters on the fact, coordinate cleaning, then exact-location counts."""
    pts = valid_coordinates(apply_selection(df, sel))
    return count_by(pts, "Latitude", "Longitude").orderBy(*by_count_desc("Latitude", "Longitude"))


def top_hotspot_locations(df: DataFrame, sel: Selection | None = None, n: int = 10) -> DataFrame:
    return hotspot_locations(df, sel).limit(n)


def map_center(df: DataFrame, sel: Selection | None = None) -> DataFrame:
    """Unweighted mean of the aggregated locations (one vote per location)."""
    locs = count_by(valid_coordinates(apply_selection(df, sel)), "Latitude", "Longitude")
    s = locs.agg(exact_sum(F.col("Latitude")).alias("_a"), exact_sum(F.col("Longitude")).alias("_o"), F.count(F.lit(1)).alias("_n"))
    return s.select(mean_of(F.col("_a"), F.col("_n")).alias("mid_lat"), mean_of(F.col("_o"), F.col("_n")).alias("mid_lon"))


def map_points(df: DataFrame, sel: Selection | None = None, n: int = 1000) -> DataFrame:
    """First n aggregated locations in key order, renamed lat / lon."""
    locs = count_by(valid_coordinates(apply_selection(df, sel)), "Latitude", "Longitude")
    return (locs.orderBy("Latitude", "Longitude").limit(n)
            .select(F.col("Latitude").alias("lat"), F.col("Longitude").alias("lon"), N))


def hourly_filtered(df: DataFrame, sel: Selection | None = None) -> DataFrame:
    return violations_per_hour(apply_selection(df, sel))


def filtered_sample(df: DataFrame, sel: Selection | None = None, n: int = 200) -> DataFrame:
    """First n filtered rows in id order (remaining columns break ties)."""
    order = [F.col(c).asc_nulls_first() for c in
             ("Violation_ID", "Timestamp", "Latitude", "Longitude",
              "Violation_Type", "Vehicle_Type", "Severity")]
    return apply_selection(df, sel).select(*VIOLATION_COLUMNS).orderBy(*order).limit(n)


def record_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("record_count"))


def report_summary(df: DataFrame, n: int = 5) -> DataFrame:
    """Records analysed plus the top-n grid hotspots, one row per hotspot.

    The record count is a scalar subquery evaluated once, not a cross join."""
    total = df.select(F.count(F.lit(1))).scalar()
    top = grid_stats(df).limit(n)
    return top.select(total.alias("records_analyzed"), "grid_cell", N, "avg_lat", "avg_lon")
