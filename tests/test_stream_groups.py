"""The detector's state by groups of tracks."""

import math

import numpy as np
import pandas as pd
import pytest

from roadsight.operators import tracking as trk
from roadsight.schema import SESSION_CAMERA_SCHEMA, SESSION_DETECTION_SCHEMA
from roadsight.streaming import sessions, tracker

from .test_stream_sessions import START, _paths, _rows

TRACKS = 700


@pytest.fixture()
def many(spark):
    """Many short tracks of one camera, in three files of whole tracks."""
    cams = spark.createDataFrame([(0, 13.0, 80.0, 5.0, True, 0, START)], SESSION_CAMERA_SCHEMA)
    rows = [(0, t, f, f / 25.0, t, "car", 900, 1000, 200 + f * (t % 9) if t % 7 else 800 - f * 9, 0) for t in range(TRACKS) for f in range(6)]
    return spark.createDataFrame(rows, SESSION_DETECTION_SCHEMA).repartition(3, *trk.KEYS), cams


def test_state_and_calls_do_not_grow_with_the_tracks(spark, many, tmp_path):
    det, cams = many
    src, sink, ckpt = _paths(tmp_path)
    for cut in ("frame_idx < 3", "frame_idx >= 3"):
        det.where(cut).write.mode("append").parquet(src)
        query = tracker.run_violation_stream(spark, src, sink, ckpt, cams)
        assert 0 < query.lastProgress["stateOperators"][0]["numRowsTotal"] <= tracker.TRACK_GROUPS
    want = _rows(trk.violation_log(det, cams))
    assert len(want) > TRACKS // 2 and _rows(tracker.stream_log(spark, sink)) == want


def test_ended_state_and_timers_do_not_grow_with_the_tracks(spark, many, tmp_path):
    """A timer and an entry a group; several micro-batches hold all tracks
    between them."""
    det, cams = many
    src, sink, ckpt = _paths(tmp_path)
    det.write.parquet(src)
    query = sessions.start(spark, src, sink, ckpt, cams, grace_seconds=0.5, max_bytes_per_trigger=1)
    assert sessions.run_until_forgotten(query, 120)
    took = sessions.batches_with_rows(query)
    assert len(took) == 3
    states = {p["batchId"]: sum(op["numRowsTotal"] for op in p["stateOperators"]) for p in query.recentProgress}
    assert all(0 < states[b] < TRACKS for b in took)
    held = [sessions.held_tracks(spark, ckpt, b) for b in took]
    assert 0 < held[0].count() < TRACKS
    assert held[0].union(held[1]).union(held[2]).distinct().count() == TRACKS
    assert sessions.held_tracks(spark, ckpt).count() == 0
    assert _rows(tracker.stream_log(spark, sink)) == _rows(trk.violation_log(det, cams))


def _batch(rng, tracks, most):
    rows = []
    for t in tracks:
        frame = 0
        for _ in range(rng.integers(1, most)):
            frame += int(rng.integers(0, 3))
            rows.append(dict(session_id=0, session_start=START, camera_id=0, track_id=t, frame_idx=frame, det_idx=len(rows), t_sec=frame / 25.0,
                             class_name="car", tx=float(rng.normal()), ty=rng.normal(0, 7) if rng.random() < 0.998 else np.nan, flow_sign=1.0,
                             latitude=13.0, longitude=80.0, speed_limit_kmh=6.0))
    return pd.DataFrame(rows)


def _one_track(rows):
    """First hits of one track, step by step."""
    ema, dys, out, before = 0.0, [], {}, None
    for r in rows.itertuples():
        if before is not None and r.t_sec - before.t_sec > trk.DT_MIN:
            dx, dy, dt = r.tx - before.tx, r.ty - before.ty, r.t_sec - before.t_sec
            ema = 0.3 * (math.sqrt(dx * dx + dy * dy) * 0.012 / dt * 3.6) + 0.7 * ema
            dys.append(dy)
            for kind, hit in (("wrong", sum(dys[-15:]) < -20.0), ("over", ema > r.speed_limit_kmh)):
                if hit and kind not in out:
                    out[kind] = (len(dys), r.frame_idx, r.det_idx, ema)
        before = r
    return out


@pytest.mark.parametrize("cells", [16, 1 << 20])
def test_a_group_advances_like_its_tracks_one_by_one(monkeypatch, cells):
    monkeypatch.setattr(tracker, "_EMA_CELLS", cells)
    rng = np.random.default_rng(5)
    rows = _batch(rng, [*range(40), -7, 1 << 40], 90)
    held, got = tracker.unpacked(None), {}
    for lo in (0, 20, 25, 80):
        hi = {0: 20, 20: 25, 25: 80, 80: 1 << 30}[lo]
        held, emitted = tracker.advance(rows[(rows.frame_idx >= lo) & (rows.frame_idx < hi)].sample(frac=1, random_state=lo), held)
        for r in (r for e in emitted for r in e.itertuples()):
            assert (r.track_id, r.Violation_Type) not in got
            got[r.track_id, r.Violation_Type] = (r.step_no, r.frame_idx, r.det_idx, r.smooth_kmh)
    want = {(t, trk.KIND_WRONG_WAY if k == "wrong" else trk.KIND_SPEEDING): v for t, x in rows.groupby("track_id") for k, v in _one_track(x).items()}
    assert len(want) > 20 and got.keys() == want.keys()
    for k in want:
        assert got[k][:3] == want[k][:3] and got[k][3] == pytest.approx(want[k][3], nan_ok=True)
    assert held["track_id"].tolist() == sorted(rows.track_id.unique())


class _State:
    """Spark's group state at a time of its own."""

    def __init__(self):
        self.now, self.value, self.timeout, self.hasTimedOut = 0, None, None, False

    exists = property(lambda self: self.value is not None)
    get = property(lambda self: self.value)

    def getCurrentProcessingTimeMs(self):
        return self.now

    def update(self, value):
        self.value = value

    def remove(self):
        self.value = None

    def setTimeoutDuration(self, ms):
        self.timeout = self.now + ms


def test_idle_tracks_of_a_group_are_forgotten_one_by_one():
    rows, state = _batch(np.random.default_rng(1), [1, 2], 5), _State()

    def call(now, *tracks, timed_out=False):
        state.now, state.hasTimedOut = now, timed_out
        out = list(tracker.detect(None, [rows[rows.track_id.isin(tracks)]], state, idle_seconds=10))
        return out, tracker.unpacked(state.value[0])["track_id"].tolist() if state.exists else []

    assert call(1000, 1, 2)[1] == [1, 2] and state.timeout == 11_000
    late, held = call(6000, 2)                     # late rows keep their track
    assert sum(x.step_no.sum() for x in late) == (rows.track_id == 2).sum() and held == [1, 2] and state.timeout == 11_000
    assert call(11_500, timed_out=True)[1] == [2] and state.timeout == 16_000
    assert call(16_000, timed_out=True)[1] == []
    assert call(17_000, 1)[1] == [1]


def test_rows_without_a_number_come_first():
    rows = _batch(np.random.default_rng(2), [3], 9).assign(det_idx=np.nan)
    held, _ = tracker.advance(rows, tracker.unpacked(None))
    assert held["last_det"].tolist() == [-1]
