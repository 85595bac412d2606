"""The tracking rules in SQL, run by DuckDB over hand-made rows: an engine of
its own to hold the Spark plans against."""

from __future__ import annotations

import datetime as dt

import duckdb
import pandas as pd

from roadsight.operators.tracking import SESSION_START
from roadsight.oracle import _tracking_ctes

START = dt.datetime.isoformat(SESSION_START, sep=" ")


def run(rows, cameras, body):
    """Rows of ``body`` over the tracking CTEs.  ``rows``: dicts of detections
    (``session_id`` 0 unless given); ``cameras``: {camera: settings} or
    {(session, camera): settings + (start,)}."""
    con = duckdb.connect()
    dets = pd.DataFrame([{"session_id": 0, **r} for r in rows])
    cams = []
    for key, (lat, lon, limit, positive, *start) in cameras.items():
        session, camera = key if isinstance(key, tuple) else (0, key)
        cams.append((camera, lat, lon, limit, positive, session, start[0] if start else SESSION_START))
    cams = pd.DataFrame(cams, columns=["camera_id", "latitude", "longitude", "speed_limit_kmh",
                                       "flow_positive_y", "session_id", "session_start"])
    con.register("given_dets", dets)
    con.register("given_cams", cams)
    ctes = _tracking_ctes(0, "select * from given_dets", "select * from given_cams")
    cur = con.execute(f"with {ctes}\n{body}")
    names = [c[0] for c in cur.description]
    return [dict(zip(names, r)) for r in cur.fetchall()]


def states(rows, cameras):
    out = run(rows, cameras, "select * from sm")
    return {(r["session_id"], r["camera_id"], r["track_id"], r["frame_idx"], r["det_idx"]):
            (r["step_no"], r["smooth_kmh"], r["net_dy"], r["is_wrong_way"], r["is_speeding"]) for r in out}


def log(rows, cameras):
    return run(rows, cameras, "select * from logv")


def hits(rows, cameras):
    return run(rows, cameras, "select * from ev")
