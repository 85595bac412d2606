from roadsight.plans.dashboard import dashboard, export_filtered, export_summaries
from roadsight.queries import fact
from roadsight.queries_params import DEMO_SELECTION
from roadsight.sources.exports import read_export_csv, read_export_json

from .conftest import SF001


def test_dashboard_figures_follow_the_selection(spark):
    f = fact(spark, SF001)
    d = dashboard(f, DEMO_SELECTION)
    n = d["kpis"].first().total_violations
    assert n == f.where("Violation_Type in ('click','error','purchase')") \
        .where("Severity in (3,4,5)") \
        .where("Timestamp >= '2024-01-05' and Timestamp <= '2024-01-20 23:59:59'").count()
    assert d["hourly"].groupBy().sum("total_violations").first()[0] == n
    assert d["types"].groupBy().sum("total_violations").first()[0] == n
    for name, df in d.items():
        df.collect()   # every figure evaluates
    assert d["options_types"].count() == 5


def test_exports_round_trip(spark, tmp_path):
    f = fact(spark, SF001)
    export_filtered(f, DEMO_SELECTION, str(tmp_path / "rows.csv"))
    export_filtered(f, DEMO_SELECTION, str(tmp_path / "rows.json"), fmt="json")
    a = read_export_csv(spark, str(tmp_path / "rows.csv"))
    b = read_export_json(spark, str(tmp_path / "rows.json"))
    assert a.count() == b.count() > 0
    paths = export_summaries(f, DEMO_SELECTION, str(tmp_path / "summaries"))
    assert set(paths) == {"violation_type_summary", "hourly_summary", "top_locations_data"}
    types = spark.read.option("header", True).csv(paths["violation_type_summary"])
    assert types.columns == ["Violation_Type", "total_violations"]
