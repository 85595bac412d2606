"""Rows and helpers shared by the tests of the operators on vectors."""

import math

SCHEMA = "vec_id long, embedding array<float>, label int"


def integers(v):
    """floor(256 x) of each component, None for a vector that takes no part."""
    if v is None or any(x is None or not math.isfinite(x) for x in v):
        return None
    return [math.floor(256 * x) for x in v]


def edge_vectors():
    nan, inf = float("nan"), float("inf")
    return [(1, [1.0, 0.0], 0), (2, [2.0, -0.25], 0), (3, [1.0, 0.0], None), (4, None, 0), (5, [], 0), (6, [0.0, 0.0], 0), (7, [nan, 1.0], 0),
            (8, [inf, 1.0], 0), (9, [None, 1.0], 0), (10, [1.0, 0.0, 0.0], 0), (11, [1.0, 0.0, 0.125], 0), (12, [1.0, 0.0], 1), (13, [-0.0, -1.0], 0),
            (14, [], 1), (None, [1.0, 0.0], 0), (2, [2.0, -0.25], 0), (2, [0.5, 0.25], 0), (15, [0.75, 0.001], 1), (16, [0.5, -0.5], 2)]
