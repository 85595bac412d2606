"""The dashboard's query set for one filter selection, and its exports.

Every figure is computed from the *fact* after the selection, so filters reach
the scan and counts are violation counts.  Nothing is collected here; the
caller renders or exports the DataFrames.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators import aggregates as agg
from ..operators import kpi
from ..operators.selection import Selection, apply_selection
from ..schema import VIOLATION_COLUMNS
from ..sources.exports import export_csv, export_json


def dashboard(fact: DataFrame, sel: Selection | None = None) -> dict[str, DataFrame]:
    rows = apply_selection(fact, sel)
    return {
        "kpis": kpi.kpi_summary(rows),
        "hourly": agg.violations_per_hour(rows),
        "types": agg.violations_by_type(rows),
        "top_types": agg.top_types(rows),
        "type_time": agg.violations_type_time(rows),
        "heatmap": agg.type_window_matrix(rows),
        "hotspots": kpi.hotspot_locations(fact, sel),
        "top_hotspots": kpi.top_hotspot_locations(fact, sel),
        "map_center": kpi.map_center(fact, sel),
        "map_points": kpi.map_points(fact, sel),
        "sample": kpi.filtered_sample(fact, sel),
        "options_types": kpi.filter_options_types(fact),
        "options_severity": kpi.filter_options_severity(fact),
        "options_dates": kpi.filter_options_dates(fact),
    }


def export_filtered(fact: DataFrame, sel: Selection | None, path: str, fmt: str = "csv") -> None:
    """Full filtered rows (CSV with header, or JSON records)."""
    rows = apply_selection(fact, sel).select(*VIOLATION_COLUMNS)
    (export_csv if fmt == "csv" else export_json)(rows, path)


def export_summaries(fact: DataFrame, sel: Selection | None, root: str) -> dict[str, str]:
    """Type, hourly and top-location summaries of the selection as CSV."""
    rows = apply_selection(fact, sel)
    out = {"violation_type_summary": agg.violations_by_type(rows),
           "hourly_summary": agg.violations_per_hour(rows),
           "top_locations_data": kpi.top_hotspot_locations(fact, sel)}
    paths = {}
    for name, df in out.items():
        p = f"{root.rstrip('/')}/{name}"
        export_csv(df, p)
        paths[name] = p
    return paths
