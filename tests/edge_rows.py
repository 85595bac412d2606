"""Hand-made detection rows covering the edge cases of the tracking rules."""

from __future__ import annotations


def _det(cam, tid, f, t, did, cls, x1, x2, y2):
    return dict(camera_id=cam, track_id=tid, frame_idx=f, t_sec=t, det_idx=did,
                class_name=cls, x1=x1, x2=x2, y2=y2)


def edge_detections():
    rows, did = [], 0

    def add(*a):
        nonlocal did
        rows.append(_det(*a[:4], did, *a[4:]))
        did += 1

    # camera 0 (limit 5, flow +y): a 400-frame fast track down the picture,
    # with a repeated time and a 0.0001 s step in it
    for f in range(400):
        t = f / 25.0
        if f == 50:
            t = 49 / 25.0           # same t_sec as the previous frame
        if f == 51:
            t = 49 / 25.0 + 0.0001  # dt of exactly 0.0001
        add(0, 1, f, t, "car", 900, 1000, 200 + 2 * f)
    add(0, 2, 10, 0.4, "truck", 900, 1010, 300)           # one sighting only
    for f in range(0, 300, 3):                             # moves up: wrong way
        add(0, 3, f, f / 25.0, "bus", 880, 1000, 900 - 3 * f)
    for f in range(0, 2000, 37):                           # sparse frames: many empty chunks
        add(0, 4, f, f / 25.0, "motorcycle", 700, 760, 250 + f // 4)
    for f in range(60):                                    # not a vehicle
        add(0, 5, f, f / 25.0, "person", 900, 1000, 200 + 5 * f)
    for cam in (0, 1):                                     # same id under two cameras
        for f in range(200):
            add(cam, 7, f, f / 25.0, "car", 900 + cam, 1000, 400 + 4 * f)
    return rows


EDGE_CAMERAS = {0: (13.05, 80.18, 5.0, True), 1: (13.06, 80.19, 8.0, False)}
