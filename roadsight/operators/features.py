"""Derived columns of the fact: calendar features and grid keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import grid, time


def with_time_features(df: DataFrame, ts: str = "Timestamp") -> DataFrame:
    """hour, day_of_week, month, year, weekday, day_type, hour_window."""
    t = F.col(ts)
    return (df.withColumn("hour", time.hour_of(t))
            .withColumn("day_of_week", time.weekday_abbr(t))
            .withColumn("month", time.month_of(t))
            .withColumn("year", time.year_of(t))
            .withColumn("weekday", F.col("day_of_week"))
            .withColumn("day_type", time.day_type(F.col("day_of_week")))
            .withColumn("hour_window", time.hour_window(F.col("hour"))))


def with_grid_features(df: DataFrame, lat: str = "Latitude", lon: str = "Longitude") -> DataFrame:
    """lat_bin, lon_bin, grid_cell."""
    return (df.withColumn("lat_bin", grid.coord_bin(F.col(lat)))
            .withColumn("lon_bin", grid.coord_bin(F.col(lon)))
            .withColumn("grid_cell", grid.grid_cell(F.col("lat_bin"), F.col("lon_bin"))))
