"""Inputs that are not what they should be."""

import json

import pytest
from pyspark.sql import functions as F

from roadsight.functions.severity import severity_of, severity_score
from roadsight.functions.time import parse_timestamp
from roadsight.operators import kpi
from roadsight.operators.clean import clean_violations
from roadsight.plans.marts import build_marts, mart_summary, run_mart_job
from roadsight.sources import exports
from roadsight.sources.mart_store import load_all, load_parquet, try_parquet, write_marts

FACT = "Violation_ID string, Timestamp string, Latitude double, Longitude double, Violation_Type string, Vehicle_Type string, Severity int"
NAN = float("nan")


def _fact(spark):
    return clean_violations(spark.createDataFrame([
        ("W1", "2024-03-10 02:30:00", 13.0, 80.0, "Speeding", "car", 3),
        ("W2", "2024-03-10 02:30:00", NAN, 80.0, "Speeding", "car", 3),
        ("W3", "nonsense", 13.0, NAN, None, None, None)], FACT))


def test_nan_coordinates_make_no_hotspot_and_no_centre(spark):
    fact = _fact(spark)
    assert [(r.Latitude, r.Longitude) for r in kpi.hotspot_locations(fact).collect()] == [(13.0, 80.0)]
    assert tuple(kpi.map_center(fact).first())[:2] == (13.0, 80.0)
    assert fact.where(F.isnan("Latitude") | F.isnan("Longitude")).count() == 0


def test_wall_clock_in_a_zone_that_skips_it(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        df = spark.createDataFrame([("2024-03-10 02:30:00",), ("2024-13-99",), (None,)], "t string")
        got = [r.p for r in df.select(parse_timestamp(F.col("t")).cast("string").alias("p")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == ["2024-03-10 02:30:00", None, None]


def test_unreadable_parquet_is_none(spark, tmp_path):
    (tmp_path / "bad.parquet").write_bytes(b"this is no parquet file")
    (tmp_path / "dir").mkdir()
    (tmp_path / "dir" / "part-0.parquet").write_bytes(b"PAR1 nor is this")
    for path in ("bad.parquet", "dir", "absent"):
        assert load_parquet(spark, str(tmp_path / path)) is None


def test_an_unreadable_mart_says_why_and_jobs_raise(spark, tmp_path, caplog):
    (tmp_path / "bad.parquet").write_bytes(b"this is no parquet file")
    assert try_parquet(spark, str(tmp_path / "absent"))[1].startswith("missing or empty")
    assert try_parquet(spark, str(tmp_path / "bad.parquet"))[1].startswith("unreadable")
    with caplog.at_level("WARNING"):
        assert load_parquet(spark, str(tmp_path / "bad.parquet")) is None
    assert "unreadable" in caplog.text
    with pytest.raises(Exception):
        mart_summary(spark, {"hourly": str(tmp_path / "bad.parquet")}).collect()


def test_a_job_killed_between_marts_leaves_the_old_set(spark, tmp_path):
    root, fact = str(tmp_path / "m"), _fact(spark)
    run_mart_job(spark, fact, root)
    before = {k: v.collect() for k, v in load_all(spark, root).items()}

    class Dies:
        @property
        def write(self):
            raise RuntimeError("killed")

    marts = build_marts(spark, fact.unionByName(fact))
    marts["spatial_grid"] = Dies()
    with pytest.raises(RuntimeError):
        write_marts(spark, marts, root)
    assert {k: v.collect() for k, v in load_all(spark, root).items()} == before
    run_mart_job(spark, fact.unionByName(fact), root)
    assert load_all(spark, root)["hour"].agg(F.sum("total_violations")).first()[0] == 6


def test_json_export_keeps_null_fields(spark, tmp_path):
    exports.export_json(_fact(spark), str(tmp_path / "j"))
    rows = [json.loads(line) for f in (tmp_path / "j").glob("part-*") for line in f.read_text().splitlines()]
    assert len(rows) == 3 and all(len(r) == 7 for r in rows)
    assert next(r for r in rows if r["Violation_ID"] == "W3")["Violation_Type"] is None


def test_marts_of_a_fact_without_coordinates(spark, tmp_path):
    fact = _fact(spark).drop("Latitude", "Longitude")
    assert set(build_marts(spark, fact)) == {"hourly", "daily", "type_summary", "type_hour_matrix", "time_window", "daytype", "type_time"}
    assert "spatial_grid" not in run_mart_job(spark, fact, str(tmp_path / "m"))
    assert set(build_marts(spark, _fact(spark).select("Latitude", "Longitude"))) == {"all_locations", "top_locations", "spatial_grid"}


def test_severity_of_equals_the_column(spark):
    pairs = [(s, limit) for limit in (0.0, 5.0, 50.0) for s in (0.0, 4.9, 5.0, 5.5, 6.0, 6.5, 7.0, 50.0, 55.0, 60.0, 70.0, 90.0)]
    df = spark.createDataFrame(pairs, "s double, l double").select("s", "l", severity_score(F.col("s"), F.col("l")).alias("x"))
    assert all(r.x == severity_of(r.s, r.l) for r in df.collect())


def test_preview_is_the_first_rows(spark, tmp_path):
    spark.range(100).coalesce(1).write.parquet(str(tmp_path / "p"))
    assert [r.id for r in load_parquet(spark, str(tmp_path / "p")).limit(5).collect()] == [0, 1, 2, 3, 4]
