import datetime as dt

import pytest
from pyspark.sql import functions as F

from roadsight.functions import exact
from roadsight.operators import aggregates as agg
from roadsight.operators import kpi
from roadsight.operators.clean import clean_violations
from roadsight.operators.selection import Selection, apply_selection
from roadsight.plans import rollup
from roadsight.sources import versions
from roadsight.sources.fact_store import drop_date, read_fact, write_fact

SCHEMA = ("Violation_ID string, Timestamp timestamp_ntz, Latitude double, Longitude double, Violation_Type string, "
          "Vehicle_Type string, Severity int")
DAYS = [dt.date(2024, 3, d) for d in (1, 2, 3, 4)]


def _rows(n, start=0):
    out = []
    for i in range(start, start + n):
        ts = None if i % 11 == 0 else dt.datetime.combine(DAYS[i % 3], dt.time(i % 24, i % 60, 59, (i % 2) * 500_000))
        if i % 13 == 0:
            ts = dt.datetime.combine(DAYS[i % 3], dt.time(23, 59, 59, 400_000 * (i % 3)))     # the last second of a date
        out.append((f"V{i}", ts, None if i % 7 == 0 else 13.0 + (i % 5) / 100, 80.0 + (i % 4) / 100 if i % 9 else 0.0,
                    [None, "Speeding", "Wrong Way"][i % 3], "car", [None, 1, 4, 5][i % 4]))
    return out


def _fact(spark, rows):
    return clean_violations(spark.createDataFrame(rows, SCHEMA))


def _collect(df):
    return sorted(map(tuple, df.collect()), key=str)


SELECTIONS = [None, Selection(types=("Speeding",)), Selection(severities=(4, 5)), Selection(date_range=(DAYS[0], DAYS[1])),
              Selection(types=("Wrong Way",), severities=(1,), date_range=(DAYS[1], DAYS[1])), Selection(types=("none",))]


def _assert_equal(spark, fact, root):
    for sel in SELECTIONS:
        rows, d = apply_selection(fact, sel), rollup.dashboard(spark, root, sel)
        direct = {"kpis": kpi.kpi_summary(rows), "hourly": agg.violations_per_hour(rows), "types": agg.violations_by_type(rows),
                  "type_time": agg.violations_type_time(rows), "heatmap": agg.type_window_matrix(rows), "grid_stats": agg.grid_stats(rows),
                  "hotspots": kpi.hotspot_locations(fact, sel), "map_center": kpi.map_center(fact, sel), "map_points": kpi.map_points(fact, sel)}
        for name, want in direct.items():
            assert d[name].columns == want.columns and _collect(d[name]) == _collect(want), (name, sel)
    o = rollup.filter_options(rollup.read_rollup(spark, root, "time"))
    assert _collect(o["options_types"]) == _collect(kpi.filter_options_types(fact))
    assert _collect(o["options_severity"]) == _collect(kpi.filter_options_severity(fact))
    assert _collect(o["options_dates"]) == _collect(kpi.filter_options_dates(fact))


def test_figures_follow_added_changed_and_deleted_dates(spark, tmp_path):
    path, root = str(tmp_path / "fact"), str(tmp_path / "rollup")
    write_fact(_fact(spark, _rows(200)), path)
    assert rollup.refresh(spark, path, root) == 1
    _assert_equal(spark, read_fact(spark, path), root)
    assert rollup.refresh(spark, path, root) == 1                       # nothing changed, nothing written
    batches = {r.event_date: r.batch for r in versions.read_manifest(spark, root, rollup.MANIFEST)[1]}
    more = [(f"N{i}", dt.datetime.combine(DAYS[3], dt.time(i % 24)), 13.0, 80.0, "Speeding", "bus", 3) for i in range(20)]
    more += [("X1", dt.datetime.combine(DAYS[1], dt.time(5)), 13.02, 80.03, "Speeding", "bus", 5)]
    write_fact(_fact(spark, more), path, mode="append")
    drop_date(spark, path, DAYS[2])
    assert rollup.refresh(spark, path, root) == 2
    _assert_equal(spark, read_fact(spark, path), root)
    assert {tuple(r) for r in rollup.refresh_log(spark, root).collect()} == {
        (DAYS[0], "kept"), (DAYS[1], "changed"), (DAYS[2], "deleted"), (DAYS[3], "added"), (None, "kept")}
    after = {r.event_date: r.batch for r in versions.read_manifest(spark, root, rollup.MANIFEST)[1]}
    assert after[DAYS[0]] == batches[DAYS[0]] and after[None] == batches[None] and after[DAYS[1]] != batches[DAYS[1]]
    # the version before is still whole
    assert rollup.read_rollup(spark, root, "time", version=1).agg(F.sum(agg.N)).first()[0] == 200
    drop_date(spark, path, None)
    rollup.refresh(spark, path, root)
    _assert_equal(spark, read_fact(spark, path), root)


def test_a_job_killed_before_its_manifest_changes_nothing(spark, tmp_path, monkeypatch):
    path, root = str(tmp_path / "fact"), str(tmp_path / "rollup")
    write_fact(_fact(spark, _rows(60)), path)
    rollup.refresh(spark, path, root)
    before = _collect(rollup.read_rollup(spark, root, "place"))
    write_fact(_fact(spark, _rows(60, 500)), path, mode="append")

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(rollup, "commit", killed)
        with pytest.raises(KeyboardInterrupt):
            rollup.refresh(spark, path, root)
    assert _collect(rollup.read_rollup(spark, root, "place")) == before
    assert rollup.refresh(spark, path, root) == 2
    _assert_equal(spark, read_fact(spark, path), root)


def test_versions_commit_once(spark, tmp_path):
    root = str(tmp_path / "set")
    assert versions.read_manifest(spark, root, "a string") == (0, [])
    versions.commit(spark, root, 1, [("x",)], "a string")
    versions.commit(spark, root, 2, [], "a string")
    assert versions.read_manifest(spark, root, "a string") == (2, [])
    assert [r.a for r in versions.read_manifest(spark, root, "a string", 1)[1]] == ["x"]
    with pytest.raises(Exception, match="(?i)exists"):
        versions.commit(spark, root, 2, [("y",)], "a string")


def test_exact_means_do_not_depend_on_partitions(spark):
    rows = [(float(f"{13 + i % 17 / 7}"), i % 3) for i in range(5000)] + [(None, 0), (float("nan"), 1), (-0.001, 2)]
    df = spark.createDataFrame(rows, "x double, k int")
    got = set()
    for parts in (1, 3, 16):
        shuffled = df.repartition(parts, F.rand(parts))
        a = shuffled.groupBy("k").agg(exact.exact_sum(F.col("x")).alias("s"), exact.exact_count(F.col("x")).alias("n"))
        got.add(tuple(sorted((r.k, r.m) for r in a.select("k", exact.mean_of(F.col("s"), F.col("n")).alias("m")).collect())))
    assert len(got) == 1
    want = {k: [x for x, g in rows if g == k and x is not None and x == x] for k in range(3)}
    assert all(abs(m - sum(want[k]) / len(want[k])) < 1e-11 for k, m in got.pop())
    none = spark.createDataFrame([(None, 0)], "x double, k int").agg(exact.exact_sum(F.col("x")).alias("s"), exact.exact_count(F.col("x")).alias("n"))
    assert none.select(exact.mean_of(F.col("s"), F.col("n"))).first()[0] is None
