"""Adapters that turn the driver's ``events`` table into the engine's inputs.

No violation data ships with the original project, so the violation fact and
the detection rows are derived from ``events`` by fixed rules (one track per
user, 25 frames a second).  The same rules are written as SQL in
``roadsight.oracle`` so another engine can check every query.
"""

from __future__ import annotations

import datetime as _dt
import math
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geometry import TOPDOWN_POINTS, solve_homography
from ..functions.severity import severity_score
from ..operators.sequence import exact_positions
from ..schema import CAMERA_SCHEMA, DETECTION_SCHEMA, SESSION_CAMERA_SCHEMA, SESSION_DETECTION_SCHEMA
from ..session import scratch_path

# The camera settings of the four fixture cameras
# (camera_id, latitude, longitude, speed_limit_kmh, flow_positive_y).
FIXTURE_CAMERAS = [
    (0, 13.05, 80.18, 5.0, True),
    (1, 13.06, 80.19, 8.0, True),
    (2, 13.07, 80.20, 12.0, False),
    (3, 13.08, 80.21, 50.0, True),
]
# Frame rate of the fixture tracks, the limit used to score the
# event value as a speed, and the per-user vehicle classes.
FIXTURE_FPS = 25.0
# The recordings that the session fixture deals events out to,
# the seconds of media time each starts later than the one before, and the days
# between their starts.  Cameras 0 and 1 stand at one spot there.
FIXTURE_SESSIONS = 3
FIXTURE_SESSION_OFFSET = 3600.0
FIXTURE_SESSION_DAYS = 1
FIXTURE_FIRST_START = _dt.datetime(2024, 1, 1)
# Where each fixture camera sees the corners of its road (top-left,
# top-right, bottom-right, bottom-left; the plane is the same for all), and the
# points inside the plane that were measured too.  Camera 3 saw three corners.
FIXTURE_ROADS_PX = {
    0: [(713.0, 126.0), (1283.0, 126.0), (1903.0, 837.0), (180.0, 833.0)],
    1: [(600.0, 100.0), (1400.0, 110.0), (1850.0, 900.0), (150.0, 880.0)],
    2: [(820.0, 180.0), (1180.0, 170.0), (1700.0, 950.0), (260.0, 960.0)],
    3: [(700.0, 120.0), (1300.0, 120.0), (1900.0, 840.0)],
}
FIXTURE_INNER_POINTS = [(200.0, 300.0), (400.0, 600.0), (650.0, 900.0), (100.0, 1100.0)]
FIXTURE_VALUE_LIMIT = 50.0
FIXTURE_VEHICLE_BY_USER_MOD4 = ["car", "truck", "bus", "motorcycle"]
FIXTURE_CLASS_BY_USER_MOD5 = ["car", "truck", "bus", "motorcycle", "person"]

# Events of one user are ranked inside id ranges of at least this width.
EVENT_ID_BUCKET = 1 << 16


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _pick(values: list[str], idx) -> F.Column:
    expr = None
    for i, v in enumerate(values):
        expr = F.when(idx == i, F.lit(v)) if expr is None else expr.when(idx == i, F.lit(v))
    return expr


def violations_from_events(events: DataFrame) -> DataFrame:
    """The violation fact (M1 columns) derived row-for-row from ``events``."""
    uid, eid = F.col("user_id"), F.col("event_id")
    lat = (uid % 50 - 25).cast("double") / F.lit(100.0)
    lon = (F.lit(8000) + (uid * 7) % 60).cast("double") / F.lit(100.0)
    return events.select(
        F.format_string("%08d", eid).alias("Violation_ID"),
        F.when(eid % 101 == 0, F.lit(None)).otherwise(F.col("ts"))
        .cast("timestamp_ntz").alias("Timestamp"),
        F.when(uid % 37 == 5, F.lit(None).cast("double")).otherwise(lat).alias("Latitude"),
        F.when(uid % 37 == 6, F.lit(None).cast("double")).otherwise(lon).alias("Longitude"),
        F.col("event_type").alias("Violation_Type"),
        _pick(FIXTURE_VEHICLE_BY_USER_MOD4, uid % 4).alias("Vehicle_Type"),
        severity_score(F.col("value"), F.lit(FIXTURE_VALUE_LIMIT)).alias("Severity"),
    )


def detections_from_events(events: DataFrame, sessions: int = 0) -> DataFrame:
    """One track per user: frame f is the user's f-th event (0-based), steady
    motion with a small jitter; every seventh user moves up the picture and
    one user in five is not a vehicle.  With ``sessions``, event ids modulo
    that number name the recording, and frames count within it.

    The per-user frame number is an exact row number computed without sorting
    a whole user in one task (see ``exact_positions``).
    """
    ev = events.select("event_id", "user_id").where(F.col("user_id").isNotNull())
    ev = ev.withColumn("session_id", F.pmod("event_id", F.lit(max(1, sessions))))
    # Id ranges of max(2^16, sqrt(id span)): a user holding a third of all
    # events is ranked in ~sqrt(span) buckets of ~sqrt(span) ids each.
    lo, hi = ev.agg(F.min("event_id"), F.max("event_id")).first()
    width = max(EVENT_ID_BUCKET, math.isqrt(max(0, (hi or 0) - (lo or 0))) + 1)
    ranked = exact_positions(ev, ["user_id", "session_id"], [F.col("event_id")],
                             F.floor(F.col("event_id") / F.lit(width)), "pos")
    uid, eid, f = F.col("user_id"), F.col("event_id"), F.col("pos") - 1
    step = F.lit(1) + uid % 9
    jitter = eid % 3
    y2 = (F.when(uid % 7 == 0, F.lit(800) - f * step - jitter)
          .otherwise(F.lit(200) + f * step + jitter))
    return ranked.select(
        (uid % 4).cast("int").alias("camera_id"),
        uid.alias("track_id"),
        f.cast("int").alias("frame_idx"),
        (f.cast("double") / F.lit(FIXTURE_FPS)
         + F.col("session_id") * F.lit(FIXTURE_SESSION_OFFSET)).alias("t_sec"),
        eid.alias("det_idx"),
        _pick(FIXTURE_CLASS_BY_USER_MOD5, uid % 5).alias("class_name"),
        F.lit(900).cast("int").alias("x1"),
        (F.lit(1000) + uid % 50).cast("int").alias("x2"),
        y2.cast("int").alias("y2"),
        *(["session_id"] if sessions else []),
    )


def fixture_cameras(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(FIXTURE_CAMERAS, CAMERA_SCHEMA)


def camera_map(camera: int) -> tuple[float, ...]:
    """The map that a fixture camera's four corners fix."""
    return solve_homography(FIXTURE_ROADS_PX[camera], TOPDOWN_POINTS)


def calibration_pairs(spark: SparkSession) -> DataFrame:
    """Point pairs of the fixture cameras: corners, and inner points seen where
    the camera's map has them."""
    rows = []
    for camera, road in FIXTURE_ROADS_PX.items():
        rows += [(camera, *px, *uv) for px, uv in zip(road, TOPDOWN_POINTS)]
        if len(road) == 4:
            back = solve_homography(TOPDOWN_POINTS, road)
            for u, v in FIXTURE_INNER_POINTS:
                den = back[6] * u + back[7] * v + 1.0
                rows.append((camera, (back[0] * u + back[1] * v + back[2]) / den, (back[3] * u + back[4] * v + back[5]) / den, u, v))
    return spark.createDataFrame(rows, "camera_id int, px double, py double, u double, v double")


def violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return violations_from_events(table(spark, sf_dir, "events"))


def session_cameras(spark: SparkSession) -> DataFrame:
    """Settings per session: each a little faster than the one before."""
    spot = FIXTURE_CAMERAS[0]
    rows = [(cam, spot[1] if cam == 1 else lat, spot[2] if cam == 1 else lon, limit + s, positive, s,
             FIXTURE_FIRST_START + _dt.timedelta(days=s * FIXTURE_SESSION_DAYS))
            for s in range(FIXTURE_SESSIONS) for cam, lat, lon, limit, positive in FIXTURE_CAMERAS]
    return spark.createDataFrame(rows, SESSION_CAMERA_SCHEMA)


def long_track(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as the sightings of one track that goes to and fro."""
    ev = table(spark, sf_dir, "events").select("event_id").withColumn("one", F.lit(1))
    lo, hi = ev.agg(F.min("event_id"), F.max("event_id")).first()
    width = max(EVENT_ID_BUCKET, math.isqrt(max(0, (hi or 0) - (lo or 0))) + 1)
    f = F.col("pos") - 1
    return exact_positions(ev, ["one"], [F.col("event_id")], F.floor(F.col("event_id") / F.lit(width)), "pos").select(
        F.lit(0).alias("camera_id"), F.lit(1).cast("long").alias("track_id"), f.cast("int").alias("frame_idx"),
        (f.cast("double") / F.lit(FIXTURE_FPS)).alias("t_sec"), F.col("event_id").alias("det_idx"),
        F.lit("car").alias("class_name"), F.lit(900).alias("x1"), F.lit(1000).alias("x2"),
        (F.lit(200) + F.abs((f * 2) % 1600 - 800) + F.col("event_id") % 3).cast("int").alias("y2"))


_STORED_DETECTIONS: dict[tuple, str] = {}


def _stored_detections(spark: SparkSession, sf_dir: str, sessions: int) -> str:
    """The detection table derived from ``events``: written once per session
    and state of the input as Parquet in the shared checkpoint folder, then
    read like the real detection table it stands for."""
    events = table(spark, sf_dir, "events")
    key = (*input_state(events), sessions)
    path = _STORED_DETECTIONS.get(key)
    if path is None:
        path = scratch_path(spark, "detections")
        detections_from_events(events, sessions).write.parquet(path)
        _STORED_DETECTIONS[key] = path
    return path


def input_state(df: DataFrame) -> tuple:
    """What a stored copy of a table must be made anew for: the application
    and the table's files (a rewritten table has files of other names)."""
    return (df.sparkSession.conf.get("spark.app.id", ""), tuple(sorted(df.inputFiles())))


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(DETECTION_SCHEMA).parquet(_stored_detections(spark, sf_dir, 0))


def session_detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(SESSION_DETECTION_SCHEMA).parquet(_stored_detections(spark, sf_dir, FIXTURE_SESSIONS))


def write_frame_logs(detections: DataFrame, path: str, first_frame: int = 0) -> None:
    """Detections (frames from ``first_frame`` on) as box logs, one per session
    and camera, with a frame without boxes or a failed one now and then."""
    keys = ["session_id", "camera_id"]
    box = F.struct(F.col("track_id").alias("id"), F.col("class_name").alias("cls"),
                   F.array(F.col("x1"), F.lit(0), F.col("x2"), F.col("y2")).alias("xyxy"), F.col("det_idx").alias("n"))
    frames = (detections.groupBy(*keys, "frame_idx").agg(F.round(F.min("t_sec") * 1000.0).alias("msec"), F.sort_array(F.collect_list(box)).alias("boxes"))
              .withColumn("frame", F.col("frame_idx") - first_frame))
    line = frames.select(*keys, F.col("frame_idx").alias("at"), F.to_json(F.struct("frame", "msec", "boxes")).alias("value"))
    without = frames.where("frame_idx % 7 = 3").select(*keys, F.col("frame_idx").alias("at"), F.explode(F.array(
        F.lit(""), F.concat(F.lit('{"frame":'), F.col("frame"), F.lit(',"boxes":null}')))).alias("value"))
    head = detections.select(*keys).distinct().select(*keys, F.lit(-1).alias("at"), F.to_json(F.struct(
        *keys, F.lit(FIXTURE_FPS).alias("fps"), F.lit(first_frame).alias("first_frame"))).alias("value"))
    (head.unionByName(line).unionByName(without).repartition(*keys).sortWithinPartitions(*keys, "at")
     .select(*[F.col(k).alias(f"of_{k}") for k in keys], "value").write.mode("append").partitionBy(*[f"of_{k}" for k in keys]).text(path))
