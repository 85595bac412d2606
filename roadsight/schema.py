"""Types of the violation fact, the detection rows and the camera dimension."""

from __future__ import annotations

from pyspark.sql import types as T

# Column order and names of the violation fact / log (fixed values: the log
# header and the CSV ingest contract).
VIOLATION_COLUMNS = ["Violation_ID", "Timestamp", "Latitude", "Longitude",
                     "Violation_Type", "Vehicle_Type", "Severity"]

# The CSV contract: Timestamp arrives as text and is parsed during cleaning.
VIOLATION_CSV_SCHEMA = T.StructType([
    T.StructField("Violation_ID", T.StringType(), True),
    T.StructField("Timestamp", T.StringType(), True),
    T.StructField("Latitude", T.DoubleType(), True),
    T.StructField("Longitude", T.DoubleType(), True),
    T.StructField("Violation_Type", T.StringType(), True),
    T.StructField("Vehicle_Type", T.StringType(), True),
    T.StructField("Severity", T.IntegerType(), True),
])

# One row per (camera, frame, tracked box).  y1 only feeds drawing: dropped.
DETECTION_SCHEMA = T.StructType([
    T.StructField("camera_id", T.IntegerType(), True),
    T.StructField("track_id", T.LongType(), True),
    T.StructField("frame_idx", T.IntegerType(), True),
    T.StructField("t_sec", T.DoubleType(), True),
    T.StructField("det_idx", T.LongType(), True),
    T.StructField("class_name", T.StringType(), True),
    T.StructField("x1", T.IntegerType(), True),
    T.StructField("x2", T.IntegerType(), True),
    T.StructField("y2", T.IntegerType(), True),
])

# Detections of several recordings: track ids start anew with each session.
SESSION_DETECTION_SCHEMA = T.StructType([*DETECTION_SCHEMA.fields,
                                         T.StructField("session_id", T.LongType(), True)])

CAMERA_SCHEMA = T.StructType([
    T.StructField("camera_id", T.IntegerType(), False),
    T.StructField("latitude", T.DoubleType(), True),
    T.StructField("longitude", T.DoubleType(), True),
    T.StructField("speed_limit_kmh", T.DoubleType(), True),
    T.StructField("flow_positive_y", T.BooleanType(), True),
])

# Camera settings per session, with the wall-clock start of each.
SESSION_CAMERA_SCHEMA = T.StructType([
    *CAMERA_SCHEMA.fields,
    T.StructField("session_id", T.LongType(), False),
    T.StructField("session_start", T.TimestampNTZType(), True),
])

# Vehicle classes that are tracked, and the two violation kinds.
VEHICLE_CLASSES = ["car", "truck", "bus", "motorcycle"]
KIND_WRONG_WAY = "Wrong Way"
KIND_SPEEDING = "Speeding"


def has_columns(df, *names: str) -> bool:
    """Schema-only guard (no job): are all the named columns present?"""
    return set(names) <= set(df.columns)
