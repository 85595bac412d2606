import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from roadsight.operators import tracking as trk
from roadsight.schema import (CAMERA_SCHEMA, DETECTION_SCHEMA, SESSION_CAMERA_SCHEMA,
                               SESSION_DETECTION_SCHEMA)
from roadsight.sources import fixtures

from .conftest import SF01
from .edge_rows import EDGE_CAMERAS, edge_detections
from . import tracking_sql


@pytest.fixture()
def edge(spark):
    rows = edge_detections()
    det = spark.createDataFrame([tuple(r[f.name] for f in DETECTION_SCHEMA.fields) for r in rows],
                                DETECTION_SCHEMA)
    cams = spark.createDataFrame([(k, *v) for k, v in EDGE_CAMERAS.items()], CAMERA_SCHEMA)
    return rows, det, cams


@pytest.fixture()
def tiny_chunks(monkeypatch):
    """Force many chunks and blocks so seeds and halos are exercised."""
    monkeypatch.setattr(trk, "CHUNK_FRAMES", 5)
    monkeypatch.setattr(trk, "BLOCK_STEPS", 130)


def _steps_map(df):
    return {(r.session_id, r.camera_id, r.track_id, r.frame_idx, r.det_idx):
            (r.step_no, r.smooth_kmh, r.net_dy, r.is_wrong_way, r.is_speeding)
            for r in df.collect()}


LOG = ["session_id", "camera_id", "Violation_ID", "Timestamp", "Violation_Type", "track_id", "Vehicle_Type",
       "Severity", "Latitude", "Longitude"]


def _same_states(got, want):
    assert got.keys() == want.keys()
    for k, w in want.items():
        g = got[k]
        assert g[0] == w[0] and g[3:] == w[3:], k
        assert math.isclose(g[1], w[1], rel_tol=1e-9, abs_tol=1e-9), k
        assert math.isclose(g[2], w[2], rel_tol=1e-9, abs_tol=1e-6), k


def _same_log(got, want):
    assert sorted(str([r[c] for c in LOG]) for r in got.collect()) == sorted(str([r[c] for c in LOG]) for r in want)


@pytest.mark.parametrize("chunk", [5, 4096])
def test_states_match_sql(edge, tiny_chunks, monkeypatch, chunk):
    monkeypatch.setattr(trk, "CHUNK_FRAMES", chunk)
    rows, det, cams = edge
    want = tracking_sql.states(rows, EDGE_CAMERAS)
    assert len(want) > 900
    _same_states(_steps_map(trk.track_states(det, cams)), want)


def test_log_matches_sql(edge, tiny_chunks):
    rows, det, cams = edge
    want = tracking_sql.log(rows, EDGE_CAMERAS)
    _same_log(trk.violation_log(det, cams), want)
    assert {r["Violation_Type"] for r in want} == {"Wrong Way", "Speeding"}


def _session_frames(spark, rows, cameras):
    det = spark.createDataFrame([tuple(r[f.name] for f in SESSION_DETECTION_SCHEMA.fields) for r in rows],
                                SESSION_DETECTION_SCHEMA)
    cams = spark.createDataFrame([(c, *v[:4], s, v[4]) for (s, c), v in cameras.items()], SESSION_CAMERA_SCHEMA)
    return det, cams


@pytest.fixture()
def sessions(spark):
    """The edge rows as recordings 0 and 1 of the same cameras, two cameras at one spot."""
    rows = [{**r, "session_id": s, "t_sec": r["t_sec"] + 2000.0 * s, "det_idx": r["det_idx"] + 10_000 * s}
            for s in (0, 1) for r in edge_detections()]
    cameras = {(s, c): (13.05, 80.18, limit + s, positive, dt.datetime(2024, 5, 1 + s))
               for s in (0, 1) for c, (_, _, limit, positive) in EDGE_CAMERAS.items()}
    return rows, cameras, *_session_frames(spark, rows, cameras)


def test_a_new_recording_starts_ids_clock_and_tracks_anew(sessions):
    rows, cameras, det, cams = sessions
    want = tracking_sql.log(rows, cameras)
    _same_log(trk.violation_log(det, cams), want)
    one = [r for r in want if r["session_id"] == 0]
    assert len(want) >= 2 * len(one) - 2 and {r["Timestamp"].month for r in want} == {5}
    assert {r["Violation_ID"][1:] for r in want if r["session_id"] == 1} >= {"0001", "0002"}


def test_two_tracks_at_one_spot_and_second_are_two_violations(sessions):
    from roadsight.plans.violations import violation_fact
    rows, cameras, det, cams = sessions
    assert violation_fact(det, cams).count() == len(tracking_sql.log(rows, cameras))


def test_limit_of_zero_scores_five(spark):
    rows = [dict(camera_id=0, track_id=1, frame_idx=f, t_sec=f / 25.0, det_idx=f, class_name="car", x1=900, x2=1000, y2=200 + 4 * f)
            for f in range(30)]
    det = spark.createDataFrame([tuple(r[f.name] for f in DETECTION_SCHEMA.fields) for r in rows], DETECTION_SCHEMA)
    cams = spark.createDataFrame([(0, 1.0, 1.0, 0.0, True)], CAMERA_SCHEMA)
    got = trk.violation_log(det, cams).collect()
    assert [(r.Violation_Type, r.Severity) for r in got] == [("Speeding", 5)]


def test_numbers_do_not_depend_on_the_ranges(spark, edge):
    _, det, cams = edge
    want = sorted(map(str, trk.violation_log(det, cams).collect()))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "17")
        assert sorted(map(str, trk.violation_log(det, cams).collect())) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_track_keys_include_camera(edge):
    _, det, cams = edge
    ev = trk.violation_events(trk.track_states(det, cams))
    cams_of_7 = {r.camera_id for r in ev.where("track_id = 7").collect()}
    assert cams_of_7 == {0, 1}


def test_single_sighting_and_non_vehicles_give_no_steps(edge):
    _, det, cams = edge
    st = trk.track_states(det, cams)
    assert st.where("track_id in (2, 5)").count() == 0


def test_annotation_flags(edge):
    _, det, cams = edge
    ann = trk.annotated(trk.track_states(det, cams, with_flag=True))
    r = ann.where("track_id = 3").orderBy("step_no").collect()
    first_wrong = next(x.step_no for x in r if x.is_wrong_way)
    for x in r:
        assert x.wrong_so_far == (x.step_no >= first_wrong)
        assert x.label.startswith(f"ID 3: ")
        assert x.label.endswith(" (WRONG)") == x.wrong_so_far


def test_fixture_counts_per_camera(spark):
    log = trk.violation_log(fixtures.detections(spark, SF01), fixtures.fixture_cameras(spark))
    got = {}
    for r in log.groupBy("camera_id", "Violation_Type").count().collect():
        got[(r.camera_id, r.Violation_Type)] = r["count"]
    want = {0: (27, 4), 1: (25, 4), 2: (19, 26), 3: (0, 4)}
    for cam, (sp, ww) in want.items():
        assert got.get((cam, "Speeding"), 0) == sp
        assert got.get((cam, "Wrong Way"), 0) == ww


def test_ids_are_padded_not_cut(spark):
    df = spark.range(1).select(F.format_string("%s%04d", F.lit("W"), F.lit(12345)).alias("id"))
    assert df.first().id == "W12345"


def test_stream_equals_batch(spark, edge, tmp_path):
    from roadsight.streaming.tracker import run_violation_stream
    _, det, cams = edge
    src = str(tmp_path / "src")
    for lo, hi in ((0, 150), (150, 700), (700, 5000)):   # three ordered files
        det.where(f"frame_idx >= {lo} and frame_idx < {hi}").coalesce(1) \
           .write.mode("append").parquet(src)
    sink = str(tmp_path / "sink")
    run_violation_stream(spark, src, sink, str(tmp_path / "ckpt"), cams,
                         max_files_per_trigger=1)
    got = {(r.camera_id, r.track_id, r.Violation_Type, r.frame_idx, r.Severity)
           for r in spark.read.parquet(sink).collect()}
    want = {(r.camera_id, r.track_id, r.Violation_Type, r.frame_idx, r.Severity)
            for r in trk.violation_events(trk.track_states(det, cams)).collect()}
    assert got == want and len(want) > 3


def test_annotation_matches_sql(edge, tiny_chunks):
    rows, det, cams = edge
    got = {(r.camera_id, r.track_id, r.step_no): r.wrong_so_far for r in
           trk.annotated(trk.track_states(det, cams, with_flag=True)).collect()}
    want = {(r["camera_id"], r["track_id"], r["step_no"]): bool(r["wrong"]) for r in tracking_sql.run(
        rows, EDGE_CAMERAS, "select camera_id, track_id, step_no, coalesce(step_no >= wstep, false) as wrong "
                            "from sm join fh using (session_id, camera_id, track_id)")}
    assert got == want and any(want.values())


def test_hot_track_at_default_sizes_matches_sql(spark):
    """Default chunk / block sizes: a 5,000-sighting track (2 frame chunks, 4
    step blocks)."""
    rows, did = [], 0
    for f in range(5000):                      # hot: slowly crawling, then fast, then back
        y = 200 + (f // 3 if f < 2500 else 833 + 3 * (f - 2500) if f < 4000 else 5333 - (f - 4000))
        rows.append(dict(camera_id=0, track_id=99, frame_idx=f, t_sec=f / 25.0, det_idx=did,
                         class_name="truck", x1=900, x2=1000, y2=y % 1100))
        did += 1
    for tid in range(3):
        for f in range(40):
            rows.append(dict(camera_id=1, track_id=tid, frame_idx=f, t_sec=f / 25.0,
                             det_idx=did, class_name="car", x1=880, x2=1000, y2=300 + 5 * f))
            did += 1
    det = spark.createDataFrame([tuple(r[fl.name] for fl in DETECTION_SCHEMA.fields)
                                 for r in rows], DETECTION_SCHEMA)
    cams = spark.createDataFrame([(k, *v) for k, v in EDGE_CAMERAS.items()], CAMERA_SCHEMA)
    _same_states(_steps_map(trk.track_states(det, cams)), tracking_sql.states(rows, EDGE_CAMERAS))
    _same_log(trk.violation_log(det, cams), tracking_sql.log(rows, EDGE_CAMERAS))


def _stream(spark, tmp_path, parts, cams):
    from roadsight.streaming import tracker
    src, sink = str(tmp_path / "src"), str(tmp_path / "sink")
    for p in parts:
        p.coalesce(1).write.mode("append").parquet(src)
    tracker.run_violation_stream(spark, src, sink, str(tmp_path / "ckpt"), cams, max_files_per_trigger=1)
    return sink


def test_stream_of_recordings_far_apart_in_time(spark, sessions, tmp_path):
    """A later recording is delivered first, and a camera long after another
    has moved on: nothing is lost, and the sink becomes the batch log."""
    from roadsight.streaming import tracker
    rows, cameras, det, cams = sessions
    sink = _stream(spark, tmp_path, [det.where(c) for c in (
        "session_id = 1 and camera_id = 0", "camera_id = 1", "session_id = 0 and camera_id = 0")], cams)
    _same_log(tracker.stream_log(spark, sink), tracking_sql.log(rows, cameras))
    assert tracker.late_rows(spark, sink).count() == 0


def test_rows_out_of_order_are_counted(spark, edge, tmp_path):
    from roadsight.streaming import tracker
    rows, det, cams = edge
    one = det.where("camera_id = 0 and track_id = 1")
    sink = _stream(spark, tmp_path, [one.where("frame_idx >= 150"), one.where("frame_idx < 150")], cams)
    late = tracker.late_rows(spark, sink).collect()
    assert [(r.camera_id, r.track_id, r.rows) for r in late] == [(0, 1, 150)]


def test_stream_ignores_replayed_rows(spark, edge, tmp_path):
    from roadsight.streaming.tracker import run_violation_stream
    _, det, cams = edge
    src = str(tmp_path / "src")
    parts = [det.where("frame_idx < 150"), det.where("frame_idx >= 150"),
             det.where("frame_idx < 150")]           # the first file delivered again
    for p in parts:
        p.coalesce(1).write.mode("append").parquet(src)
    sink = str(tmp_path / "sink")
    run_violation_stream(spark, src, sink, str(tmp_path / "ckpt"), cams,
                         max_files_per_trigger=1)
    from roadsight.streaming.tracker import late_rows, stream_hits
    got = sorted((r.camera_id, r.track_id, r.Violation_Type, r.frame_idx)
                 for r in stream_hits(spark, sink).collect())
    assert sum(r.rows for r in late_rows(spark, sink).collect()) > 0
    want = sorted((r.camera_id, r.track_id, r.Violation_Type, r.frame_idx)
                  for r in trk.violation_events(trk.track_states(det, cams)).collect())
    assert got == want
