"""Dashboard figures from a stored roll-up that follows the fact.

Two tables of counts per event date: *time* by (type, severity, hour) and
*place* by (type, severity, latitude, longitude), each bounded by its key
domain and not by the number of violations.  Every figure of a selection is an
aggregate of these few rows.

``refresh`` compares the fact's files with those the roll-up was made of, date
by date (path, length and modification time, a listing without opening a
file), and recomputes the dates that were added or changed; dates that are gone
leave the roll-up.  Only the changed dates' partitions are scanned.  The new
rows go to folders of their own and become visible together (see
``sources.versions``).

The date filter ends one second before midnight, so the rows of a date's last
second are counted apart (``last_second``): a selection leaves out those of its
end date.  Rows without a time are a date of their own (null).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exact, grid, time
from ..operators.aggregates import ALL_WINDOWS, N, NULL_COLUMN, by_count_desc
from ..operators.kpi import HIGH_SEVERITY
from ..operators.selection import Selection, valid_coordinates
from ..sources.fact_store import DATE_COL, read_fact
from ..sources.versions import commit, read_manifest

TIME_KEYS = [DATE_COL, "Violation_Type", "Severity", "last_second", "hour"]
PLACE_KEYS = [DATE_COL, "Violation_Type", "Severity", "last_second", "Latitude", "Longitude"]
#: A date, the fact's files of it, and the folder that holds its counts.
MANIFEST = "event_date date, files string, batch string, action string"


def _with_last_second(fact: DataFrame) -> DataFrame:
    ts = F.col("Timestamp")
    return fact.withColumn("last_second", F.coalesce(ts > time.day_end_inclusive(F.to_date(ts)), F.lit(False)))


def time_counts(fact: DataFrame) -> DataFrame:
    f = _with_last_second(fact).withColumn("hour", time.hour_of(F.col("Timestamp")))
    return f.groupBy(*TIME_KEYS).agg(F.count(F.lit(1)).alias(N))


def place_counts(fact: DataFrame) -> DataFrame:
    return _with_last_second(fact).groupBy(*PLACE_KEYS).agg(F.count(F.lit(1)).alias(N))


def fact_files(spark: SparkSession, fact_path: str) -> DataFrame:
    """(event_date, files): a digest of the data files of each stored date."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(fact_path)
             .select(F.col(DATE_COL).cast("date").alias(DATE_COL), F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)").alias("h")))
    return files.groupBy(DATE_COL).agg(F.concat_ws("-", F.count(F.lit(1)), F.sum("h")).alias("files"))


def _of_dates(df: DataFrame, dates: list) -> DataFrame:
    known = [d for d in dates if d is not None]
    wanted = F.col(DATE_COL).isin(known) if known else F.lit(False)
    return df.where(wanted | F.col(DATE_COL).isNull() if None in dates else wanted)


def refresh(spark: SparkSession, fact_path: str, root: str) -> int:
    """Bring the roll-up at ``root`` up to the fact stored at ``fact_path``;
    returns its version.  Nothing is written if no date changed."""
    version, held = read_manifest(spark, root, MANIFEST)
    old = {r[DATE_COL]: r for r in held if r["batch"] is not None}
    now = {r[DATE_COL]: r["files"] for r in fact_files(spark, fact_path).collect()}   # a row a date
    stale = [d for d, files in now.items() if d not in old or old[d]["files"] != files]
    gone = [d for d in old if d not in now]
    if version and not stale and not gone:
        return version
    batch = uuid.uuid4().hex[:12]
    if stale:
        fact = _of_dates(read_fact(spark, fact_path), stale)
        for name, counts in (("time", time_counts(fact)), ("place", place_counts(fact))):
            (counts.withColumn("batch", F.lit(batch)).hint("rebalance", DATE_COL)
             .write.mode("append").partitionBy(DATE_COL, "batch").parquet(f"{root}/{name}"))
    rows = [(d, files, batch if d in stale else old[d]["batch"], "kept" if d not in stale else "changed" if d in old else "added")
            for d, files in now.items()]
    rows += [(d, None, None, "deleted") for d in gone]
    commit(spark, root, version + 1, rows, MANIFEST)
    return version + 1


def _partition(value) -> str:
    return "__HIVE_DEFAULT_PARTITION__" if value is None else str(value)


def read_rollup(spark: SparkSession, root: str, name: str, version: int | None = None) -> DataFrame:
    """The ``time`` or ``place`` counts of a version (default: the newest)."""
    keys = TIME_KEYS if name == "time" else PLACE_KEYS
    kinds = {DATE_COL: "date", "Violation_Type": "string", "Severity": "int", "last_second": "boolean", "hour": "int",
             "Latitude": "double", "Longitude": "double"}
    schema = ", ".join(f"{k} {kinds[k]}" for k in keys) + f", {N} long, batch string"
    _, rows = read_manifest(spark, root, MANIFEST, version)
    paths = [f"{root}/{name}/{DATE_COL}={_partition(r[DATE_COL])}/batch={r['batch']}" for r in rows if r["batch"] is not None]
    if not paths:
        return spark.createDataFrame([], schema).drop("batch")
    return spark.read.schema(schema).option("basePath", f"{root}/{name}").parquet(*paths).drop("batch")


def refresh_log(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """(event_date, action) of a version: added, changed, kept or deleted."""
    version, rows = read_manifest(spark, root, MANIFEST, version)
    return spark.createDataFrame([(r[DATE_COL], r["action"]) for r in rows], "event_date date, action string")


# -- figures of a selection --

def select_counts(counts: DataFrame, sel: Selection | None) -> DataFrame:
    """The counts that a selection's rows make up."""
    if sel is None:
        return counts
    if sel.types:
        counts = counts.where(F.col("Violation_Type").isin(list(sel.types)))
    if sel.severities:
        counts = counts.where(F.col("Severity").isin([int(s) for s in sel.severities]))
    if sel.date_range and len(sel.date_range) == 2:
        start, end = (F.lit(d) for d in sel.date_range)
        counts = counts.where(F.col(DATE_COL).between(start, end) & ~((F.col(DATE_COL) == end) & F.col("last_second")))
    return counts


def _sum_by(counts: DataFrame, *keys) -> DataFrame:
    return counts.groupBy(*keys).agg(F.sum(N).alias(N))


def kpi_summary(counts: DataFrame) -> DataFrame:
    per_type = counts.groupBy("Violation_Type").agg(
        F.sum(N).alias(N), F.sum(F.when(F.col("Severity") >= HIGH_SEVERITY, F.col(N)).otherwise(0)).alias("_high"))
    most = F.min_by("Violation_Type", F.struct((-F.col(N)).alias("a"), F.col("Violation_Type").alias("b")))
    return per_type.agg(F.coalesce(F.sum(N), F.lit(0)).alias("total_violations"), F.count(F.lit(1)).alias("unique_types"),
                        F.coalesce(most, F.lit("N/A")).alias("most_common_type"), F.coalesce(F.sum("_high"), F.lit(0)).alias("high_severity"))


def hourly(counts: DataFrame) -> DataFrame:
    return _sum_by(counts, "hour").orderBy(F.col("hour").asc_nulls_first())


def by_type(counts: DataFrame) -> DataFrame:
    return _sum_by(counts, "Violation_Type").orderBy(*by_count_desc("Violation_Type"))


def _with_window(counts: DataFrame) -> DataFrame:
    return counts.withColumn("hour_window", time.hour_window(F.col("hour")))


def type_time(counts: DataFrame) -> DataFrame:
    return (_sum_by(_with_window(counts), "Violation_Type", "hour_window")
            .orderBy(F.col("Violation_Type").asc_nulls_first(), F.col("hour_window").asc_nulls_first()))


def type_window_matrix(counts: DataFrame) -> DataFrame:
    cell = lambda of: F.sum(F.when(of, F.col(N)).otherwise(0))
    w = F.col("hour_window")
    return (_with_window(counts).groupBy("Violation_Type")
            .agg(*[cell(w == v).alias(str(v)) for v in ALL_WINDOWS], cell(w.isNull()).alias(NULL_COLUMN))
            .orderBy(F.col("Violation_Type").asc_nulls_first()))


def hotspot_locations(counts: DataFrame) -> DataFrame:
    return _sum_by(valid_coordinates(counts), "Latitude", "Longitude").orderBy(*by_count_desc("Latitude", "Longitude"))


def map_center(counts: DataFrame) -> DataFrame:
    """Mean of the distinct places, one vote each."""
    lat, lon = F.col("Latitude"), F.col("Longitude")
    s = (_sum_by(valid_coordinates(counts), "Latitude", "Longitude")
         .agg(exact.exact_sum(lat).alias("a"), exact.exact_sum(lon).alias("o"), F.count(F.lit(1)).alias("n")))
    return s.select(exact.mean_of(F.col("a"), F.col("n")).alias("mid_lat"), exact.mean_of(F.col("o"), F.col("n")).alias("mid_lon"))


def map_points(counts: DataFrame, n: int = 1000) -> DataFrame:
    places = _sum_by(valid_coordinates(counts), "Latitude", "Longitude")
    return places.orderBy("Latitude", "Longitude").limit(n).select(F.col("Latitude").alias("lat"), F.col("Longitude").alias("lon"), N)


def grid_stats(counts: DataFrame) -> DataFrame:
    lat, lon, n = F.col("Latitude"), F.col("Longitude"), F.col(N)
    g = (counts.withColumn("grid_cell", grid.grid_cell(grid.coord_bin(lat), grid.coord_bin(lon))).groupBy("grid_cell")
         .agg(F.sum(N).alias(N), exact.exact_sum(lat, n).alias("a"), exact.exact_count(lat, n).alias("an"),
              exact.exact_sum(lon, n).alias("o"), exact.exact_count(lon, n).alias("on")))
    return g.select("grid_cell", N, exact.mean_of(F.col("a"), F.col("an")).alias("avg_lat"),
                    exact.mean_of(F.col("o"), F.col("on")).alias("avg_lon")).orderBy(*by_count_desc("grid_cell"))


def filter_options(counts: DataFrame) -> dict[str, DataFrame]:
    one = lambda c: counts.select(c).where(F.col(c).isNotNull()).distinct().orderBy(c)
    return {"options_types": one("Violation_Type"), "options_severity": one("Severity"),
            "options_dates": counts.agg(F.min(DATE_COL).alias("min_date"), F.max(DATE_COL).alias("max_date"))}


def dashboard(spark: SparkSession, root: str, sel: Selection | None = None) -> dict[str, DataFrame]:
    """Every figure of the dashboard but the row sample, which needs the fact."""
    times, places = read_rollup(spark, root, "time"), read_rollup(spark, root, "place")
    t, p = select_counts(times, sel), select_counts(places, sel)
    spots = hotspot_locations(p)
    return {"kpis": kpi_summary(t), "hourly": hourly(t), "types": by_type(t), "top_types": by_type(t).limit(15),
            "type_time": type_time(t), "heatmap": type_window_matrix(t), "hotspots": spots, "top_hotspots": spots.limit(10),
            "map_center": map_center(p), "map_points": map_points(p), "grid_stats": grid_stats(p), **filter_options(times)}


def summaries(spark: SparkSession, root: str, sel: Selection | None = None) -> dict[str, DataFrame]:
    """The tables of the summary exports."""
    d = dashboard(spark, root, sel)
    return {"violation_type_summary": d["types"], "hourly_summary": d["hourly"], "top_locations_data": d["top_hotspots"]}
