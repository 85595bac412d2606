import math

import numpy as np

from roadsight.functions.geometry import ROAD_POINTS_PX, TOPDOWN_POINTS, road_homography, solve_homography
from roadsight.operators import calibration as cal

SCHEMA = "camera_id int, px double, py double, u double, v double"


def _pairs(camera, px, uv):
    return [(camera, *p, *q) for p, q in zip(px, uv)]


def _maps(spark, rows, schema=SCHEMA):
    return {r.camera_id: [r[m] for m in cal.COEFFICIENTS] for r in cal.calibrate(spark.createDataFrame(rows, schema)).collect()}


def test_four_pairs_give_the_exact_map(spark):
    got = _maps(spark, _pairs(7, ROAD_POINTS_PX, TOPDOWN_POINTS))[7]
    np.testing.assert_allclose(got, road_homography(), rtol=1e-8, atol=1e-9)


def test_many_cameras_and_noisy_pairs_are_least_squares(spark):
    r, rows, want = np.random.default_rng(1), [], {}
    for camera in range(12):
        h = np.array(road_homography()) * (1 + r.normal(size=8) * 0.01)
        px = r.uniform((200, 150), (1800, 830), (40, 2))
        den = px @ h[6:8] + 1
        uv = np.stack([(px @ h[0:2] + h[2]) / den, (px @ h[3:5] + h[5]) / den], axis=1) + r.normal(size=(40, 2)) * 0.5
        rows += _pairs(camera, px.tolist(), uv.tolist())
        # the same least squares of normalised pairs, solved without normal equations
        (cp, sp), (cu, su) = ((x.mean(0), x.std(0)) for x in (px, uv))
        x, u = (px - cp) / sp, (uv - cu) / su
        a = np.zeros((80, 8))
        a[0::2, 0:2], a[0::2, 2], a[0::2, 6:8] = x, 1, -x * u[:, :1]
        a[1::2, 3:5], a[1::2, 5], a[1::2, 6:8] = x, 1, -x * u[:, 1:]
        m = np.append(np.linalg.lstsq(a, u.ravel(), rcond=None)[0], 1).reshape(3, 3)
        m = np.array([[su[0], 0, cu[0]], [0, su[1], cu[1]], [0, 0, 1]]) @ m @ np.array([[1 / sp[0], 0, -cp[0] / sp[0]], [0, 1 / sp[1], -cp[1] / sp[1]], [0, 0, 1]])
        want[camera] = (m / m[2, 2]).ravel()[:8]
    got = _maps(spark, rows)
    for camera, m in want.items():
        np.testing.assert_allclose(got[camera], m, rtol=1e-6, atol=1e-9)


def test_pairs_that_fix_no_map_give_null(spark):
    line = [(100.0 * i, 50.0 * i) for i in range(6)]
    rows = _pairs(1, ROAD_POINTS_PX[:3], TOPDOWN_POINTS) + _pairs(2, line, line) + _pairs(3, [(5.0, 5.0)] * 6, TOPDOWN_POINTS + TOPDOWN_POINTS[:2])
    rows += _pairs(4, ROAD_POINTS_PX, TOPDOWN_POINTS) + [(4, math.nan, 1.0, 2.0, 3.0), (4, None, 1.0, 2.0, 3.0), (4, math.inf, 1.0, 2.0, 3.0)]
    rows += [(5, None, None, None, None)] + _pairs(6, [(0.0, 0.0), (1.0, 0.0), (2.0, 0.0), (5.0, 9.0)], TOPDOWN_POINTS)
    got = _maps(spark, rows)
    assert all(got[c] == [None] * 8 for c in (1, 2, 3, 5, 6))
    np.testing.assert_allclose(got[4], road_homography(), rtol=1e-8, atol=1e-9)
    assert _maps(spark, []) == {}


def test_positions_by_session_and_for_unknown_cameras(spark):
    other = solve_homography([(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0)], TOPDOWN_POINTS)
    rows = [(0, *r) for r in _pairs(1, ROAD_POINTS_PX, TOPDOWN_POINTS)] + [(1, *r) for r in _pairs(1, [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0)], TOPDOWN_POINTS)]
    c = cal.calibrate(spark.createDataFrame(rows, "session_id long, " + SCHEMA))
    pts = spark.createDataFrame([(0, 1, 713, 126), (1, 1, 5, 5), (0, 2, 713, 126)], "session_id long, camera_id int, bx int, by int")
    got = {(r.session_id, r.camera_id): (r.tx, r.ty) for r in cal.positions(pts, c).collect()}
    assert got[0, 2] == (None, None)
    np.testing.assert_allclose(got[0, 1], (0.0, 0.0), atol=1e-6)
    np.testing.assert_allclose(got[1, 1], ((other[0] * 5 + other[1] * 5 + other[2]), (other[3] * 5 + other[4] * 5 + other[5])), rtol=1e-9)
