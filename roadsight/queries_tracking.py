"""Registered tracking queries: detections (derived from ``events``) ->
steps -> speeds, direction -> violations -> log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.geometry import bottom_center_x
from .functions.severity import severity_score
from .operators import tracking as trk
from .operators.calibration import calibrate, positions
from .plans.violations import hotspots
from .sources import fixtures

R = 4  # digits kept of floating track values
K = ["camera_id", "track_id", "frame_idx", "det_idx"]
DET_COLS = ["camera_id", "track_id", "frame_idx", "t_sec", "det_idx", "class_name",
            "x1", "x2", "y2"]
HIT_COLS = ["camera_id", "track_id", "Violation_Type", "step_no", "frame_idx", "det_idx",
            "t_sec", "class_name", "smooth_kmh", "latitude", "longitude", "speed_limit_kmh",
            "Severity"]


def _inputs(spark: SparkSession, sf_dir: str):
    return fixtures.detections(spark, sf_dir), fixtures.fixture_cameras(spark)


def _r(c: str):
    return F.round(F.col(c), R).alias(c)


def states(spark, sf_dir) -> DataFrame:
    return trk.track_states(*_inputs(spark, sf_dir))


def q_detections_scan(spark, sf_dir):
    return fixtures.detections(spark, sf_dir)


def q_vehicle_detections(spark, sf_dir):
    return trk.vehicle_detections(fixtures.detections(spark, sf_dir)).select(*DET_COLS)


def q_camera_enriched(spark, sf_dir):
    return trk.camera_enriched(*_inputs(spark, sf_dir)).select(
        *DET_COLS, "latitude", "longitude", "speed_limit_kmh", "flow_positive_y")


def q_bottom_center(spark, sf_dir):
    return trk.sightings(*_inputs(spark, sf_dir)).select(*K, "bx", "by")


def q_topdown_positions(spark, sf_dir):
    return trk.sightings(*_inputs(spark, sf_dir)).select(*K, _r("tx"), _r("ty"))


def q_track_steps(spark, sf_dir):
    st = trk.steps(trk.sightings(*_inputs(spark, sf_dir)))
    return st.select(*K, "step_no", _r("dt"), _r("dx"), _r("dy"))


def q_raw_speed(spark, sf_dir):
    st = trk.steps(trk.sightings(*_inputs(spark, sf_dir)))
    return st.select(*K, "step_no", _r("dist_m"), _r("raw_kmh"))


def q_smoothed_speed(spark, sf_dir):
    return states(spark, sf_dir).select(*K, "step_no", _r("smooth_kmh"))


def q_net_direction(spark, sf_dir):
    return states(spark, sf_dir).select(*K, "step_no", _r("net_dy"), "is_wrong_way")


def q_severity_score(spark, sf_dir):
    return states(spark, sf_dir).select(
        *K, "step_no", _r("smooth_kmh"),
        severity_score(F.col("smooth_kmh"), F.col("speed_limit_kmh")).alias("severity"))


def _hits(df: DataFrame) -> DataFrame:
    return df.select(*[_r(c) if c == "smooth_kmh" else F.col(c) for c in HIT_COLS])


def q_speeding_violations(spark, sf_dir):
    return _hits(trk.speeding_violations(states(spark, sf_dir)))


def q_wrong_way_violations(spark, sf_dir):
    return _hits(trk.wrong_way_violations(states(spark, sf_dir)))


def q_violation_log(spark, sf_dir):
    return trk.violation_log(*_inputs(spark, sf_dir)).drop("session_id")


def q_violation_log_sessions(spark, sf_dir):
    """Several recordings of each camera: ids, settings and clocks by session."""
    return trk.violation_log(fixtures.session_detections(spark, sf_dir), fixtures.session_cameras(spark))


def q_session_hotspots(spark, sf_dir):
    """Violations of two cameras at one spot both count."""
    return hotspots(fixtures.session_detections(spark, sf_dir), fixtures.session_cameras(spark))


def q_long_track_states(spark, sf_dir):
    """All events as one track: many chunks and blocks of a single key."""
    sm = trk.track_states(fixtures.long_track(spark, sf_dir), fixtures.fixture_cameras(spark), with_flag=True)
    return sm.select(*K, "step_no", _r("smooth_kmh"), _r("net_dy"), "wrong_so_far")


def q_annotated_tracks(spark, sf_dir):
    sm = trk.track_states(*_inputs(spark, sf_dir), with_flag=True)
    return trk.annotated(sm).select(
        *K, "step_no", "wrong_so_far", "flag", "label")


def q_calibrated_topdown(spark, sf_dir):
    """Positions by each camera's own calibration; null for a camera without."""
    s = trk.camera_enriched(*_inputs(spark, sf_dir)).withColumn("bx", bottom_center_x(F.col("x1"), F.col("x2"))).withColumn("by", F.col("y2"))
    return positions(s, calibrate(fixtures.calibration_pairs(spark))).select(*K, _r("tx"), _r("ty"))


def q_calibrated_violations(spark, sf_dir):
    """The log where every camera has its own map."""
    return trk.violation_log(*_inputs(spark, sf_dir), calibration=calibrate(fixtures.calibration_pairs(spark))).drop("session_id")


def tracking_queries():
    return {
        "calibrated_topdown": q_calibrated_topdown,
        "calibrated_violations": q_calibrated_violations,
        "detections_scan": q_detections_scan,
        "vehicle_detections": q_vehicle_detections,
        "camera_enriched": q_camera_enriched,
        "bottom_center": q_bottom_center,
        "topdown_positions": q_topdown_positions,
        "track_steps": q_track_steps,
        "raw_speed": q_raw_speed,
        "smoothed_speed": q_smoothed_speed,
        "net_direction": q_net_direction,
        "severity_score": q_severity_score,
        "speeding_violations": q_speeding_violations,
        "wrong_way_violations": q_wrong_way_violations,
        "violation_log": q_violation_log,
        "annotated_tracks": q_annotated_tracks,
        "violation_log_sessions": q_violation_log_sessions,
        "session_hotspots": q_session_hotspots,
        "long_track_states": q_long_track_states,
    }
