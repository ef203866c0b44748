"""Boxes, pitch coordinates and 3x3 homographies as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

PITCH_LENGTH, PITCH_WIDTH = 105.0, 68.0


def _box(prefix: str) -> tuple[Column, Column, Column, Column]:
    return tuple(F.col(f"{prefix}{k}") for k in ("x1", "y1", "x2", "y2"))


def intersection(a: str = "a.", b: str = "b.") -> Column:
    ax1, ay1, ax2, ay2 = _box(a)
    bx1, by1, bx2, by2 = _box(b)
    return F.greatest(F.least(ax2, bx2) - F.greatest(ax1, bx1), F.lit(0.0)) * F.greatest(F.least(ay2, by2) - F.greatest(ay1, by1), F.lit(0.0))


def area(p: str) -> Column:
    x1, y1, x2, y2 = _box(p)
    return (x2 - x1) * (y2 - y1)


def iou(a: str = "a.", b: str = "b.") -> Column:
    common = intersection(a, b)
    return common / (area(a) + area(b) - common + F.lit(1e-9))


def on_pitch(x: Column, y: Column, margin: float = 0.0) -> Column:
    return (F.abs(x) <= PITCH_LENGTH / 2 + margin) & (F.abs(y) <= PITCH_WIDTH / 2 + margin)


def camera_homography(cx: float, cy: float, cz: float, pan: float, tilt: float, f: float, w: float, h: float) -> list[float]:
    """Pitch plane to image, row-major: K [R | -RC] without the height column; pan 0 looks along +y, tilt > 0 down."""
    ct, st, cp, sp = math.cos(tilt), math.sin(tilt), math.cos(pan), math.sin(pan)
    mul = lambda a, b: [[sum(a[i][k] * b[k][j] for k in range(3)) for j in range(len(b[0]))] for i in range(3)]
    rotation = mul(mul([[1, 0, 0], [0, ct, -st], [0, st, ct]], [[1, 0, 0], [0, 0, -1], [0, 1, 0]]), [[cp, -sp, 0], [sp, cp, 0], [0, 0, 1]])
    shift = mul(rotation, [[-cx], [-cy], [-cz]])
    plane = [[rotation[i][0], rotation[i][1], shift[i][0]] for i in range(3)]
    return [v for row in mul([[f, 0, w / 2], [0, f, h / 2], [0, 0, 1]], plane) for v in row]


def camera_up(tilt: float, f: float, w: float, h: float) -> list[float]:
    """The image of the vertical direction, the column that camera_homography leaves out."""
    ct, st = math.cos(tilt), math.sin(tilt)
    return [-st * w / 2, -f * ct - st * h / 2, -st]


def inverse(h: list) -> list:
    """The adjugate, which as a homography is the inverse; of numbers or columns."""
    a, b, c, d, e, f, g, k, m = h
    return [e * m - f * k, c * k - b * m, b * f - c * e, f * g - d * m, a * m - c * g, c * d - a * f, d * k - e * g, b * g - a * k, a * e - b * d]


def apply_homography(h: list, x: Column, y: Column) -> tuple[Column, Column]:
    """Null where the point has no image."""
    w = h[6] * x + h[7] * y + h[8]
    w = F.when(F.abs(w) > 1e-12, w)
    return (h[0] * x + h[1] * y + h[2]) / w, (h[3] * x + h[4] * y + h[5]) / w


# Human limits in metres and seconds, and a body's height.
FASTEST, HARDEST, BODY = 9.5, 7.0, 1.8


def motion_log_likelihood(x: Column, y: Column, vx: Column, vy: Column, height: Column, gap: Column, to_x: Column, to_y: Column, fps: float = 25.0) -> Column:
    """How well a start at (to_x, to_y) continues a track that was at (x, y) with a velocity, `gap` frames before."""
    gap = F.greatest(gap, F.lit(1.0))
    slowed = F.least(F.lit(1.0), (FASTEST * height / BODY / fps) / F.greatest(F.hypot(vx, vy), F.lit(1e-12)))
    dx, dy = x + vx * slowed * gap - to_x, y + vy * slowed * gap - to_y
    reach = 0.5 * (HARDEST * height / BODY / (fps * fps)) * gap * gap + 0.3 * height
    return -0.5 * (dx * dx + dy * dy) / ((0.15 * height) * (0.15 * height) + reach * reach)
