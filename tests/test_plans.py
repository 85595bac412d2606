"""Plan shape checks: pruning, pushdown, no cross joins, hash aggregates."""

import pytest

import __spark_entry__ as entry
from roadsight import queries
from roadsight.operators import tracking as trk
from roadsight.sources import fixtures

from .conftest import SF001

IO_QUERIES = {"ingest_csv_roundtrip", "mart_roundtrip", "export_csv_roundtrip",
              "export_json_roundtrip", "log_tail10", "kmeans_clusters", "kmeans_centers",
              "stream_violations", "stream_violations_multi", "kmeans_separated", "mart_values",
              "export_summaries_roundtrip"}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_column_pruning_and_pushdown(spark):
    qs = entry.queries()
    by_type = _plan(qs["violations_by_type"](spark, SF001))
    assert "ReadSchema: struct<Violation_Type:string>" in by_type
    flt = _plan(qs["filter_combined"](spark, SF001))
    assert "In(Violation_Type" in flt and "In(Severity" in flt
    assert "PushedFilters: [IsNotNull(Timestamp)" in flt
    assert "PartitionFilters: [" in flt and "event_date" in flt.split("PartitionFilters: [")[1]


@pytest.mark.parametrize("name", sorted(set(queries.queries()) - IO_QUERIES))
def test_no_cross_or_nested_loop_join(spark, name):
    plan = _plan(entry.queries()[name](spark, SF001))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_tracking_steps_use_hash_aggregates(spark):
    det, cams = fixtures.detections(spark, SF001), fixtures.fixture_cameras(spark)
    plan = _plan(trk.steps(trk.sightings(det, cams)))
    assert "SortAggregate" not in plan


def test_executed_tracking_plan(spark):
    """After pass 1 is kept, what runs scans no detections again, and the
    steps move once more, into their blocks."""
    det, cams = fixtures.detections(spark, SF001), fixtures.fixture_cameras(spark)
    df = trk.track_states(det, cams)
    df.collect()
    plan = _plan(df)
    assert "isFinalPlan=true" in plan and "FileScan" not in plan
    final = plan.split("== Initial Plan ==")[0]
    assert 1 <= final.count("Scan ExistingRDD") <= 2      # pass 1, and the chunk summary


def test_date_filter_prunes_partitions(spark):
    df = entry.queries()["fact_partitioned_roundtrip"](spark, SF001)
    plan = _plan(df)
    assert "PartitionFilters: [" in plan and "event_date" in plan.split("PartitionFilters: [")[1]


def test_results_do_not_depend_on_session_zone(spark):
    qs = entry.queries()
    names = ["time_features", "filter_by_date", "violation_log", "ingest_csv_roundtrip"]

    def run():
        return {n: sorted(map(str, qs[n](spark, SF001).collect())) for n in names}

    base = run()
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        other = run()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert base == other
