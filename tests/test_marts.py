import datetime as dt

import pytest
from pyspark.sql import functions as F

from roadsight.functions.severity import severity_score
from roadsight.operators import aggregates as agg
from roadsight.operators import clustering, kpi
from roadsight.operators.clean import clean_violations
from roadsight.operators.features import with_grid_features, with_time_features
from roadsight.operators.selection import Selection, apply_selection
from roadsight.plans.marts import build_marts, direct_marts
from roadsight.queries import fact
from roadsight.schema import VIOLATION_CSV_SCHEMA
from roadsight.sources.csv_source import read_violations_csv
from roadsight.sources.mart_store import load_parquet

from .conftest import SF01


@pytest.fixture(scope="module")
def fct(spark):
    return fact(spark, SF01)


def _rows(df):
    return sorted((tuple(r) for r in df.collect()),
                  key=lambda t: tuple((v is not None, v if v is not None else 0) for v in t))


def test_count_marts_sum_to_fact(fct):
    n = fct.count()
    for fn in (agg.violations_per_hour, agg.violations_per_day, agg.violations_by_type,
               agg.violations_per_location, agg.violations_by_window,
               agg.violations_by_daytype, agg.violations_type_time, agg.grid_stats):
        assert fn(fct).agg(F.sum(agg.N)).first()[0] == n, fn.__name__
    m = agg.type_hour_matrix(fct)
    assert m.select(sum(F.col(f"`{c}`") for c in m.columns[1:])).groupBy().sum().first()[0] == n


def test_rollup_marts_equal_direct(spark, fct):
    a, b = build_marts(spark, fct), direct_marts(fct)
    for name in b:
        da, db = a[name], b[name]
        if name == "spatial_grid":
            da = da.select("grid_cell", agg.N, F.round("avg_lat", 9), F.round("avg_lon", 9))
            db = db.select("grid_cell", agg.N, F.round("avg_lat", 9), F.round("avg_lon", 9))
        assert _rows(da) == _rows(db), name


def test_top_k_subset_of_full(fct):
    full = set(_rows(agg.violations_per_location(fct)))
    top = _rows(agg.top_locations(fct))
    assert len(top) == 10 and set(top) <= full
    counts = [r[2] for r in agg.top_locations(fct).collect()]
    assert counts == sorted(counts, reverse=True)


@pytest.mark.parametrize("speed,want", [(50.0, 0), (40.0, 0), (54.999, 1), (55.0, 2),
                                        (59.999, 2), (60.0, 3), (65.0, 4), (69.999, 4),
                                        (70.0, 5), (500.0, 5)])
def test_severity_boundaries(spark, speed, want):
    got = spark.range(1).select(severity_score(F.lit(speed), F.lit(50.0))).first()[0]
    assert got == want


def test_selection_semantics(spark):
    rows = [("a", dt.datetime(2024, 1, 5, 0, 0, 0), "x", 1),
            ("b", dt.datetime(2024, 1, 6, 23, 59, 59), "y", 4),
            ("c", dt.datetime(2024, 1, 6, 23, 59, 59, 500000), "x", 5),
            ("d", None, "x", None)]
    df = spark.createDataFrame(rows, "Violation_ID string, Timestamp timestamp_ntz, "
                                     "Violation_Type string, Severity int")
    assert apply_selection(df, Selection(types=(), severities=None)).count() == 4
    ids = lambda s: sorted(r.Violation_ID for r in apply_selection(df, s).collect())
    assert ids(Selection(types=("x",))) == ["a", "c", "d"]
    assert ids(Selection(severities=(4, 5))) == ["b", "c"]
    # inclusive end day stops at 23:59:59 (the .5 s after it is out)
    assert ids(Selection(date_range=(dt.date(2024, 1, 5), dt.date(2024, 1, 6)))) == ["a", "b"]


def test_features_edge_values(spark):
    df = spark.createDataFrame(
        [(None, None, None), (dt.datetime(2024, 1, 6, 23, 0), -0.25, 80.18),
         (dt.datetime(2024, 1, 8, 2, 0), 0.07, None)],
        "Timestamp timestamp_ntz, Latitude double, Longitude double")
    r = with_grid_features(with_time_features(df)).orderBy("Timestamp").collect()
    assert r[0].day_type == "Weekday" and r[0].hour is None and r[0].grid_cell == ""
    assert r[1].day_type == "Weekend" and r[1].hour_window == 21 and r[1].grid_cell == "-2_801"
    assert r[2].day_of_week == "Mon" and r[2].hour_window == 0 and r[2].grid_cell == "0"


def test_csv_ingest_bad_rows(spark, tmp_path):
    p = tmp_path / "traffic.csv"
    p.write_text("Violation_ID,Timestamp,Latitude,Longitude,Violation_Type,Vehicle_Type,Severity\n"
                 "1,2024-01-01 10:00:00,13.05,80.18,Speeding,car,3\n"
                 "2,not a time,13.05,80.18,Speeding,car,3\n"
                 "3,2024-01-01 11:00:00,north,80.18,Wrong Way,bus,5\n"
                 "4,2024-01-01 12:00:00,13.05,80.18,Speeding,car,high\n"
                 ",2024-01-01 13:00:00,13.05,80.18,Speeding,car,1\n"
                 "6,2024-01-01 14:00:00\n"
                 "1,2024-01-01 10:00:00,13.05,80.18,Speeding,car,3\n")
    raw = read_violations_csv(spark, str(p))
    assert raw.schema == VIOLATION_CSV_SCHEMA and raw.count() == 7
    clean = {r.Violation_ID: r for r in clean_violations(raw).collect()}
    assert sorted(clean) == ["1", "2", "3", "4", "6"]       # no id dropped, duplicate folded
    assert clean["1"].Timestamp == dt.datetime(2024, 1, 1, 10, 0)
    assert clean["2"].Timestamp is None
    assert clean["3"].Latitude is None and clean["4"].Severity is None
    assert clean["6"].Latitude is None and clean["6"].Severity is None


def test_load_parquet_missing_is_none(spark, tmp_path):
    assert load_parquet(spark, str(tmp_path / "nope")) is None


def test_kpis_empty_selection(fct):
    r = kpi.kpi_summary(apply_selection(fct, Selection(types=("no-such-type",)))).first()
    assert (r.total_violations, r.unique_types, r.most_common_type, r.high_severity) == \
        (0, 0, "N/A", 0)


def test_kmeans_guard_and_fit(spark):
    pts = [(13.0 + i * 0.01, 80.0 + (i % 5) * 0.02) for i in range(21)]
    schema = "Latitude double, Longitude double"
    twenty = spark.createDataFrame(pts[:20], schema)
    assert {r.cluster for r in clustering.kmeans_clusters(twenty).collect()} == {-1}
    assert clustering.kmeans_centers(spark, twenty).count() == 0
    full = spark.createDataFrame(pts, schema)
    fitted = clustering.fit_zones(full, starts=2)
    assert clustering.kmeans_centers(spark, full, fitted).count() == 5
    got = clustering.kmeans_clusters(full, fitted)
    assert got.count() == 21 and {r.cluster for r in got.collect()} <= set(range(5))


def test_entry_smoke(spark):
    import __spark_entry__ as entry
    df = entry.entry(spark)
    assert df.columns == ["grid_cell", "total_violations", "avg_lat", "avg_lon"]
    assert df.count() >= 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
