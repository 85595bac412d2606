"""The violation detector with state that ends with its recording.

``transformWithState``: the value state of a group of tracks (see
``streaming.tracker``) holds an entry a track, which ends with a timer.  A track
ends at the end of its recording (``session_end`` of the camera table, wall
clock) or at the arrival of its last rows, whichever is later, plus a grace
time; new rows move it.  A group's timer stands at the first such end of its
tracks; when it fires they are forgotten, and the group with its last track: state
does not grow with the number of recordings ever seen.  ``ttl_seconds`` is a
backstop that drops tracks nobody touched for so long, whatever their timer says.

Times are processing times, so recordings do not wait for one another and no row
is dropped as late by a watermark; rows that come after their track is forgotten
would start it anew, which the grace time is there to prevent.  The rules of
detection are those of ``streaming.tracker``.
"""

from __future__ import annotations

import calendar
import time
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators import tracking as trk
from ..schema import SESSION_DETECTION_SCHEMA
from .tracker import OUTPUT_SCHEMA, STATE_SCHEMA, advance, dealt_tracks, one_frame, unpacked, waiting

#: Seconds a track is kept after its recording's end or its last rows.
GRACE_SECONDS = 600.0
#: Seconds between micro-batches, which is how late a timer can fire.
TRIGGER_SECONDS = 2
#: Bytes of files of a micro-batch, which bounds what a track hands to a task.
MAX_BYTES_PER_TRIGGER = 256 << 20

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class TrackProcessor(StatefulProcessor):
    def __init__(self, grace_seconds: float, ttl_seconds: float | None) -> None:
        self.grace, self.ttl = int(grace_seconds * 1000), int(ttl_seconds * 1000) if ttl_seconds else None

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.tracks = handle.getValueState("tracks", STATE_SCHEMA, self.ttl)

    def _held(self, got, now_ms: int) -> np.ndarray:
        """The tracks that have not ended, or have rows now."""
        held = unpacked(self.tracks.get()[0]) if self.tracks.exists() else unpacked(None)
        if self.ttl:
            held = held[held["seen_ms"] + self.ttl > now_ms]
        return waiting(held, got, held["end_ms"], now_ms)

    def _keep(self, held: np.ndarray) -> None:
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old)
        if len(held):
            self.tracks.update((held.tobytes(),))
            self.handle.registerTimer(int(held["end_ms"].min()))
        else:
            self.tracks.clear()

    def handleInputRows(self, key, rows, timerValues):
        batch, now = one_frame(rows), timerValues.getCurrentProcessingTimeInMs()
        got = batch["track_id"].unique() if len(batch) else np.array([], np.int64)
        held, emitted = advance(batch, self._held(got, now), now)
        ends = [int(calendar.timegm(t.timetuple()) * 1000) for t in batch["session_end"].dropna()[:1]] if "session_end" in batch else []
        held["end_ms"][np.isin(held["track_id"], got)] = max([now, *ends]) + self.grace
        self._keep(held)
        yield from emitted

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self._keep(self._held([], timerValues.getCurrentProcessingTimeInMs()))
        yield pd.DataFrame()

    def close(self) -> None:
        pass


def violation_stream(detections: DataFrame, cameras: DataFrame, grace_seconds: float = GRACE_SECONDS,
                     ttl_seconds: float | None = None) -> DataFrame:
    """Streaming DataFrame of first hits per (track, kind), and late-row counts."""
    s = trk.sightings(detections, cameras)
    ends = ["session_end"] if "session_end" in s.columns else []
    s = s.select(*trk.KEYS, "frame_idx", "det_idx", "t_sec", "class_name", "tx", "ty", "flow_sign",
                 "latitude", "longitude", "speed_limit_kmh", "session_start", *ends)
    return dealt_tracks(s).transformWithStateInPandas(
        TrackProcessor(grace_seconds, ttl_seconds), OUTPUT_SCHEMA, "append", "ProcessingTime")


@contextmanager
def rocksdb(spark: SparkSession):
    """The state store that value and timer state need, for queries
    started inside; the session's own setting comes back afterwards."""
    old = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, old)


def start(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint_dir: str, cameras: DataFrame,
          grace_seconds: float = GRACE_SECONDS, ttl_seconds: float | None = None,
          max_bytes_per_trigger: int = MAX_BYTES_PER_TRIGGER, trigger_seconds: float = TRIGGER_SECONDS):
    """Parquet detection files -> detector -> Parquet sink.  Runs until it is
    stopped, for timers fire without new files too."""
    reader = spark.readStream.schema(SESSION_DETECTION_SCHEMA).option("maxBytesPerTrigger", max_bytes_per_trigger)
    out = violation_stream(reader.parquet(source_dir), cameras, grace_seconds, ttl_seconds)
    w = (out.writeStream.format("parquet").option("path", sink_dir).option("checkpointLocation", checkpoint_dir).outputMode("append"))
    with rocksdb(spark):
        return w.trigger(processingTime=f"{trigger_seconds} seconds").start()


def held_tracks(spark: SparkSession, checkpoint_dir: str, batch: int | None = None) -> DataFrame:
    """(session_id, camera_id, track_id) of the tracks whose state is held, by
    the state reader; as of a micro-batch if one is given."""
    reader = spark.read.format("statestore").option("path", checkpoint_dir).option("stateVarName", "tracks")
    if batch is not None:
        reader = reader.option("batchId", batch)
    with rocksdb(spark):
        groups = reader.load().select("key.session_id", "key.camera_id", "value.tracks")

    def tracks_of(pdfs):
        for p in pdfs:
            for session, camera, data in zip(p["session_id"], p["camera_id"], p["tracks"]):
                yield pd.DataFrame({"session_id": session, "camera_id": camera, "track_id": unpacked(data)["track_id"]})

    return groups.mapInPandas(tracks_of, "session_id long, camera_id int, track_id long")


def state_rows(query) -> int:
    """Rows of all the detector's state after the last micro-batch, timers included."""
    done = query.lastProgress
    return -1 if done is None else sum(op["numRowsTotal"] for op in done["stateOperators"])


def batches_with_rows(query) -> list[int]:
    """The micro-batches that took rows, of those whose progress is remembered;
    the first if none did."""
    return sorted({p["batchId"] for p in query.recentProgress if p["numInputRows"] > 0}) or [0]


def run_until_forgotten(query, limit_seconds: float) -> bool:
    """Let a running query go on until it has seen its files and holds no
    state, then stop it; False if that took too long."""
    end, empty = time.monotonic() + limit_seconds, False
    while time.monotonic() < end and query.isActive and not empty:
        time.sleep(0.2)
        # nothing held, and a batch after the one that took the files
        empty = state_rows(query) == 0 and query.lastProgress["batchId"] > 0
    gap = time.monotonic() + 10 * TRIGGER_SECONDS
    while query.isActive and query.status["isTriggerActive"] and time.monotonic() < gap:
        time.sleep(0.02)       # best stopped between two micro-batches
    failed = query.exception()
    query.stop()
    if failed is not None:
        raise failed
    return empty
