"""Registered queries on the stored roll-up.  The fact is stored without one
date and with half of another, rolled up, then the date is added, the other
completed and a third deleted, and the roll-up refreshed: its figures must be
those of the fact as it then is."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators.clean import clean_violations
from .plans import rollup
from .queries_params import DEMO_SELECTION, ROLLUP_ADDED, ROLLUP_CHANGED, ROLLUP_DROPPED
from .session import scratch_path
from .sources import fixtures
from .sources.exports import export_csv
from .sources.fact_store import drop_date, write_fact

_ROLLED: dict[tuple, str] = {}


def refreshed_rollup(spark: SparkSession, sf_dir: str) -> str:
    """Root of the roll-up, made once per session and state of the input."""
    key = fixtures.input_state(fixtures.table(spark, sf_dir, "events"))
    if key not in _ROLLED:
        path, root = scratch_path(spark, "rollup-fact"), scratch_path(spark, "rollup")
        fact, on = clean_violations(fixtures.violations(spark, sf_dir)), F.to_date("Timestamp")
        half = (on != ROLLUP_CHANGED) | (F.pmod(F.xxhash64("Violation_ID"), F.lit(2)) == 0)
        write_fact(fact.where(on.isNull() | ((on != ROLLUP_ADDED) & half)), path)
        rollup.refresh(spark, path, root)
        drop_date(spark, path, ROLLUP_CHANGED)
        drop_date(spark, path, ROLLUP_DROPPED)
        write_fact(fact.where(on.isin(ROLLUP_ADDED, ROLLUP_CHANGED)), path, mode="append")
        rollup.refresh(spark, path, root)
        _ROLLED[key] = root
    return _ROLLED[key]


def _figure(name: str, sel=DEMO_SELECTION):
    return lambda spark, sf_dir: rollup.dashboard(spark, refreshed_rollup(spark, sf_dir), sel)[name]


def q_filter_options(spark, sf_dir) -> DataFrame:
    o = rollup.filter_options(rollup.read_rollup(spark, refreshed_rollup(spark, sf_dir), "time"))
    row = lambda df, name, c: df.select(F.lit(name).alias("option"), F.col(c).cast("string").alias("value"))
    return (row(o["options_types"], "type", "Violation_Type").unionByName(row(o["options_severity"], "severity", "Severity"))
            .unionByName(row(o["options_dates"], "from", "min_date")).unionByName(row(o["options_dates"], "to", "max_date")))


def q_summaries(spark, sf_dir) -> DataFrame:
    """The three summary exports, written from the roll-up and read back."""
    out, root = None, scratch_path(spark, "rollup-summaries")
    keys = {"violation_type_summary": ["Violation_Type"], "hourly_summary": ["hour"], "top_locations_data": ["Latitude", "Longitude"]}
    for name, df in rollup.summaries(spark, refreshed_rollup(spark, sf_dir), DEMO_SELECTION).items():
        export_csv(df, f"{root}/{name}")
        back = spark.read.option("header", True).csv(f"{root}/{name}")
        cols = keys[name]
        key = [F.round(F.col(k).cast("double"), 2).cast("string") if len(cols) > 1 else F.col(k) for k in cols]
        part = back.select(F.lit(name).alias("summary"), F.concat_ws("|", *key).alias("key"), F.col("total_violations").cast("long").alias("total_violations"))
        out = part if out is None else out.unionByName(part)
    return out


def q_refresh_log(spark, sf_dir) -> DataFrame:
    return rollup.refresh_log(spark, refreshed_rollup(spark, sf_dir))


def rollup_queries():
    return {
        "rollup_kpi_summary": _figure("kpis"),
        "rollup_hourly": _figure("hourly"),
        "rollup_types": _figure("types"),
        "rollup_type_time": _figure("type_time"),
        "rollup_heatmap": _figure("heatmap"),
        "rollup_hotspots": _figure("hotspots"),
        "rollup_map_center": _figure("map_center"),
        "rollup_map_points": _figure("map_points"),
        "rollup_grid_stats": _figure("grid_stats", None),
        "rollup_filter_options": q_filter_options,
        "rollup_summaries": q_summaries,
        "rollup_refresh_log": q_refresh_log,
    }
