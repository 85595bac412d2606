"""Stateful violation detector over a detection stream.

``groupBy(session_id, camera_id, track_group).applyInPandasWithState``: the
tracks of a camera are dealt by a hash of their id to ``TRACK_GROUPS`` groups, for
a call of Python costs more than a track's few rows.  The state of a group is one
packed array with an entry a track: its last sighting, the EMA, the last 14 dy
values, the two "already logged" flags and when it last got rows.  A group's rows
of a micro-batch are sorted by track, frame_idx and det_idx, and all its tracks
advance together.  Every (track, kind) is emitted at most once.

Order.  Tracks don't wait for each other: there is no watermark, so a file of
one camera may come long after another camera has moved on.  Within a track
files must come in frame order, as a camera records; a row that is not newer
than its track's state (a file out of order, or one delivered again) can't
change what was emitted.  Such rows are counted, never dropped in silence: the
sink gets a ``LATE_ROWS`` row with their number in ``step_no``.  ``stream_hits``
and ``late_rows`` read the two kinds apart.

State is kept for good, as the original keeps it, unless ``idle_seconds`` is
given: then a track that got no rows for that long (processing time) is
forgotten, and would log anew if it came back.  ``streaming.sessions`` is the
same detector with state that ends with its recording.  A micro-batch writes the
state of the groups it has rows of, about 200 bytes a track.

Ids are not assigned here: ``streaming.numbering`` numbers the hits as they are
written, ``stream_log`` numbers a sink in batch.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from ..functions.geometry import METRES_PER_UNIT
from ..operators import tracking as trk
from ..functions.severity import severity_of
from ..schema import KIND_SPEEDING, KIND_WRONG_WAY, SESSION_DETECTION_SCHEMA

#: Longest slice of a track whose powers of 0.7 stay finite, and cells of a table of slices.
_EMA_SLICE, _EMA_CELLS = 1024, 1 << 20
LATE_ROWS = "Late Rows"
#: Files of a micro-batch, which bounds what one track can hand to one task.
MAX_FILES_PER_TRIGGER = 64
#: Groups that the tracks of a session and camera are dealt to; part of the
#: state's key, so a checkpoint belongs to one value.
TRACK_GROUPS = 128
GROUP = "track_group"

OUTPUT_SCHEMA = ("session_id long, camera_id int, track_id long, Violation_Type string, step_no long, "
                 "frame_idx int, det_idx long, t_sec double, class_name string, "
                 "smooth_kmh double, latitude double, longitude double, "
                 "speed_limit_kmh double, session_start timestamp_ntz, Severity int")
STATE_SCHEMA = "tracks binary"
_OUT_COLS = [c.strip().split(" ")[0] for c in OUTPUT_SCHEMA.split(",")]
_KEPT = trk.DIR_WINDOW - 1
#: What a track carries from one micro-batch to the next: ``dys`` are the last 14
#: dy (0 before the first step), with the next step they make the 15-step sum;
#: ``seen_ms`` and ``end_ms`` are processing times.
TRACK = np.dtype([("track_id", "<i8"), ("last_x", "<f8"), ("last_y", "<f8"), ("last_t", "<f8"), ("last_frame", "<i8"), ("last_det", "<i8"),
                  ("ema", "<f8"), ("steps", "<i8"), ("wrong_logged", "?"), ("speed_logged", "?"), ("seen_ms", "<i8"), ("end_ms", "<i8"),
                  ("dys", "<f8", (_KEPT,))])


def unpacked(data: bytes | None) -> np.ndarray:
    """A group's tracks, ascending by id."""
    return np.frombuffer(data or b"", TRACK)


def _ema_series(raw: np.ndarray, starts: np.ndarray, counts: np.ndarray, ema0: np.ndarray) -> np.ndarray:
    """s_k = 0.3 raw_k + 0.7 s_(k-1), s_0 = ema0, for all k of every track at
    once: the closed form 0.7^k (ema0 + sum_(i<=k) 0.3 * 0.7^(-i) raw_i), in
    slices short enough that 0.7^(-i) stays finite.  A track's steps are
    ``counts`` values of ``raw`` from ``starts`` on."""
    out, ema = np.empty(len(raw)), ema0.astype(float)
    a, d, lo = trk.EMA_ALPHA, 1 - trk.EMA_ALPHA, 0
    while len(live := np.flatnonzero(counts > lo)):
        width = max(16, min(_EMA_SLICE, int(counts.max()) - lo, _EMA_CELLS // len(live)))
        i = np.arange(1, width + 1, dtype=float)
        n = np.minimum(counts[live] - lo, width)
        at = (starts[live] + lo)[:, None] + np.arange(width)
        real = np.arange(width) < n[:, None]
        x = np.where(real, raw[np.minimum(at, len(raw) - 1)], 0.0)
        s = d ** i * (ema[live][:, None] + np.cumsum(a * d ** (-i) * x, axis=1))
        out[at[real]] = s[real]
        ema[live] = s[np.arange(len(live)), n - 1]
        lo += width
    return out


def _first_of(tracks: np.ndarray, hit: np.ndarray) -> np.ndarray:
    """The first hit of each track, as places; ``tracks`` ascends."""
    at = np.flatnonzero(hit)
    return at[np.unique(tracks[at], return_index=True)[1]]


def _hits(rows: pd.DataFrame, kind: str, **values) -> pd.DataFrame:
    return rows.assign(Violation_Type=kind, **values)[_OUT_COLS]


def advance(batch: pd.DataFrame, held: np.ndarray, now_ms: int = 0) -> tuple[np.ndarray, list[pd.DataFrame]]:
    """A group's rows of a micro-batch, in any order: steps, EMA, direction and
    first hits of all its tracks, continuing from their state.  Returns the new
    state and the rows to emit."""
    held = held.copy()
    if not len(batch):
        return held, []
    det = batch["det_idx"].fillna(-1).to_numpy("int64")       # a null comes first, as in the batch job
    batch = batch.assign(_det=det).iloc[np.lexsort((det, batch["frame_idx"].to_numpy(), batch["track_id"].to_numpy()))]
    emitted, held_ids = [], held["track_id"]

    def of_held(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(held):
            return np.zeros(len(ids), bool), np.zeros(len(ids), np.int64)
        at = np.minimum(np.searchsorted(held_ids, ids), len(held) - 1)
        return held_ids[at] == ids, at

    known, at = of_held(batch["track_id"].to_numpy())
    held["seen_ms"][at[known]] = now_ms       # late rows show that a track is still there
    if known.any():
        frame, det = batch["frame_idx"].to_numpy(), batch["_det"].to_numpy()
        was_frame, was_det = held["last_frame"][at], held["last_det"][at]
        late = known & ~((frame > was_frame) | ((frame == was_frame) & (det > was_det)))
        if late.any():
            rows = batch[late]
            first, n = np.unique(rows["track_id"].to_numpy(), return_index=True, return_counts=True)[1:]
            emitted.append(_hits(rows.iloc[first], LATE_ROWS, step_no=n, smooth_kmh=None, Severity=0))
            batch = batch[~late]
            if batch.empty:
                return held, emitted

    ids, begin, size = np.unique(batch["track_id"].to_numpy(), return_index=True, return_counts=True)
    known, at = of_held(ids)
    st = np.zeros(len(ids), TRACK)
    for name in ("last_x", "last_y", "last_t"):
        st[name] = np.nan
    st[known] = held[at[known]]
    st["track_id"] = ids

    track = np.repeat(np.arange(len(ids)), size)      # a row's track
    tx, ty, t = (batch[c].to_numpy(float) for c in ("tx", "ty", "t_sec"))

    def before(values: np.ndarray, seed: np.ndarray) -> np.ndarray:
        out = np.concatenate(([np.nan], values[:-1]))
        out[begin] = seed
        return out

    px, py, pt = before(tx, st["last_x"]), before(ty, st["last_y"]), before(t, st["last_t"])
    with np.errstate(invalid="ignore"):
        idx = np.flatnonzero(~np.isnan(pt) & ((t - pt) > trk.DT_MIN))
    if len(idx):
        dx, dy, dt = tx[idx] - px[idx], ty[idx] - py[idx], t[idx] - pt[idx]
        raw = np.sqrt(dx * dx + dy * dy) * METRES_PER_UNIT / dt * trk.KMH_PER_MPS
        of = track[idx]
        counts = np.bincount(of, minlength=len(ids))
        starts = np.cumsum(counts) - counts
        k = np.arange(len(idx)) - starts[of]            # a step's place among its track's
        ema = _ema_series(raw, starts, counts, st["ema"])
        place = np.arange(len(idx)) + _KEPT * (of + 1)    # every track's dy behind the 14 it had before
        hist = np.empty(len(idx) + _KEPT * len(ids))
        hist[(starts + _KEPT * np.arange(len(ids)))[:, None] + np.arange(_KEPT)] = st["dys"]
        hist[place] = dy
        net = np.lib.stride_tricks.sliding_window_view(hist, trk.DIR_WINDOW).sum(axis=1)[place - _KEPT]
        limit, flow = (batch[c].to_numpy(float)[begin][of] for c in ("speed_limit_kmh", "flow_sign"))
        wrong = (net * flow < -trk.WRONG_WAY_UNITS) & ~st["wrong_logged"][of]
        over = (ema > limit) & ~st["speed_logged"][of]
        step_no = st["steps"][of] + k + 1
        if wrong.any():
            f = _first_of(of, wrong)
            st["wrong_logged"][of[f]] = True
            emitted.append(_hits(batch.iloc[idx[f]], KIND_WRONG_WAY, step_no=step_no[f], smooth_kmh=ema[f], Severity=trk.WRONG_WAY_SEVERITY))
        if over.any():
            f = _first_of(of, over)
            st["speed_logged"][of[f]] = True
            emitted.append(_hits(batch.iloc[idx[f]], KIND_SPEEDING, step_no=step_no[f], smooth_kmh=ema[f],
                                 Severity=[severity_of(s, m) for s, m in zip(ema[f].tolist(), limit[f].tolist())]))
        stepped = np.flatnonzero(counts)
        ends = starts + counts
        st["ema"][stepped] = ema[ends[stepped] - 1]
        st["steps"] += counts
        st["dys"] = hist[(ends + _KEPT * np.arange(len(ids)))[:, None] + np.arange(_KEPT)]
    last = begin + size - 1
    st["last_x"], st["last_y"], st["last_t"] = tx[last], ty[last], t[last]
    st["last_frame"], st["last_det"] = batch["frame_idx"].to_numpy()[last], batch["_det"].to_numpy()[last]
    st["seen_ms"] = now_ms
    state = np.concatenate((np.delete(held, at[known]), st))
    return state[np.argsort(state["track_id"], kind="stable")], emitted


def one_frame(pdfs) -> pd.DataFrame:
    """A group's rows of a micro-batch, whose size the source's trigger bounds."""
    parts = [p for p in pdfs if len(p)]
    return pd.concat(parts, ignore_index=True) if parts else pd.DataFrame()


def waiting(held: np.ndarray, got: np.ndarray, deadline: np.ndarray, now_ms: int) -> np.ndarray:
    """The tracks that are kept: with rows now, or before their deadline."""
    return held[np.isin(held["track_id"], got) | (deadline > now_ms)]


def detect(key, pdfs, state, idle_seconds=None):
    """``advance`` over Spark's group state."""
    idle = int(idle_seconds * 1000) if idle_seconds else 0
    now = state.getCurrentProcessingTimeMs()
    held = unpacked(state.get[0]) if state.exists else unpacked(None)
    batch = pd.DataFrame() if state.hasTimedOut else one_frame(pdfs)
    if idle:
        held = waiting(held, batch["track_id"].to_numpy() if len(batch) else [], held["seen_ms"] + idle, now)
    held, emitted = advance(batch, held, now)
    if len(held):
        state.update((held.tobytes(),))
        if idle:
            state.setTimeoutDuration(max(1, int(held["seen_ms"].min()) + idle - now))
    elif state.exists:
        state.remove()
    yield from emitted


def dealt_tracks(s: DataFrame):
    """Sightings grouped by session, camera and ``TRACK_GROUPS`` of its tracks."""
    return s.withColumn(GROUP, F.pmod(F.hash("track_id"), F.lit(TRACK_GROUPS))).groupBy("session_id", "camera_id", GROUP)


def violation_stream(detections: DataFrame, cameras: DataFrame,
                     idle_seconds: float | None = None) -> DataFrame:
    """Streaming DataFrame of first hits per (track, kind), and late-row counts."""
    s = trk.sightings(detections, cameras).select(
        *trk.KEYS, "frame_idx", "det_idx", "t_sec", "class_name", "tx", "ty", "flow_sign",
        "latitude", "longitude", "speed_limit_kmh", "session_start")

    def run(key, pdfs, state):
        yield from detect(key, pdfs, state, idle_seconds)

    timeout = GroupStateTimeout.ProcessingTimeTimeout if idle_seconds else GroupStateTimeout.NoTimeout
    return dealt_tracks(s).applyInPandasWithState(run, OUTPUT_SCHEMA, STATE_SCHEMA, "append", timeout)


def run_violation_stream(spark, source_dir: str, sink_dir: str, checkpoint_dir: str,
                         cameras: DataFrame, max_files_per_trigger: int = MAX_FILES_PER_TRIGGER,
                         available_now: bool = True, idle_seconds: float | None = None):
    """Parquet detection files -> stateful detector -> Parquet sink (append).
    A source without ``session_id`` is one session."""
    reader = (spark.readStream.schema(SESSION_DETECTION_SCHEMA)
              .option("maxFilesPerTrigger", max_files_per_trigger))
    out = violation_stream(reader.parquet(source_dir), cameras, idle_seconds)
    w = (out.writeStream.format("parquet").option("path", sink_dir)
         .option("checkpointLocation", checkpoint_dir).outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q


def stream_hits(spark, sink_dir: str) -> DataFrame:
    """The violations in a stream's sink."""
    return spark.read.parquet(sink_dir).where(F.col("Violation_Type") != LATE_ROWS)


def late_rows(spark, sink_dir: str) -> DataFrame:
    """(session_id, camera_id, track_id, rows): rows that came too late to count."""
    return (spark.read.parquet(sink_dir).where(F.col("Violation_Type") == LATE_ROWS)
            .groupBy(*trk.KEYS).agg(F.sum("step_no").alias("rows")))


def stream_log(spark, sink_dir: str) -> DataFrame:
    """The numbered log of a stream's sink, as the batch job writes it; clean
    it with ``clean_violations(log, keys=KEYS)`` to get the marts' fact."""
    return trk.number_violations(stream_hits(spark, sink_dir))
