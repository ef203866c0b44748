"""Calibration as tables: cameras as columns, validity, merging, keyframes, closure, and points of the pitch's lines."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import geometry as g
from . import series

# What a calibration must reach to be valid.
LEAST_COVERAGE, MOST_ERROR, LEAST_EXPLAINED = 0.30, 3.5, 0.30
# The pitch's markings in metres.
AREAS = ((16.5, 20.16), (5.5, 9.16))
SPOT, CIRCLE = 11.0, 9.15
ARC_POINTS, CIRCLE_POINTS = 40, 120
LEAST_POINTS = 10


def is_valid(coverage: Column, err_px: Column, explained: Column) -> Column:
    return (coverage >= LEAST_COVERAGE) & (err_px <= MOST_ERROR) & (explained >= LEAST_EXPLAINED)


def camera_sql(width: float, height: float) -> list[str]:
    """The nine entries of the pitch-to-image homography as SQL over cx, cy, cz, pan, tilt, f (radians, pixels)."""
    turned = {
        "x0": "cos(pan)", "x1": "(-sin(pan))", "y0": "(-sin(tilt) * sin(pan))", "y1": "(-sin(tilt) * cos(pan))", "y2": "(-cos(tilt))",
        "z0": "(cos(tilt) * sin(pan))", "z1": "(cos(tilt) * cos(pan))", "z2": "(-sin(tilt))",
    }
    shift = {
        "x": f"(-({turned['x0']} * cx + {turned['x1']} * cy))",
        "y": f"(-({turned['y0']} * cx + {turned['y1']} * cy + {turned['y2']} * cz))",
        "z": f"(-({turned['z0']} * cx + {turned['z1']} * cy + {turned['z2']} * cz))",
    }
    rows = {a: (turned[f"{a}0"], turned[f"{a}1"], shift[a]) for a in "xyz"}
    scaled = [f"(f * {rows['x'][k]} + {width / 2!r} * {rows['z'][k]})" for k in range(3)]
    scaled += [f"(f * {rows['y'][k]} + {height / 2!r} * {rows['z'][k]})" for k in range(3)]
    return [*scaled, *rows["z"]]


def with_camera(cameras: DataFrame, width: float, height: float, prefix: str = "h") -> DataFrame:
    """cameras (cx, cy, cz, pan, tilt, f, ...) with the homography's entries as columns h0 to h8."""
    return cameras.withColumns({f"{prefix}{k}": F.expr(x) for k, x in enumerate(camera_sql(width, height))})


def on_ground(rows: DataFrame, x: Column, y: Column, prefix: str = "h") -> tuple[Column, Column]:
    """Where image points of rows with camera columns lie on the pitch; null without a camera."""
    return g.apply_homography(g.inverse([F.col(f"{prefix}{k}") for k in range(9)]), x, y)


def merged(files: list[DataFrame], distrusted: DataFrame | None = None) -> DataFrame:
    """Valid frames of several calibration tables (frame, valid, ...): a later table's row replaces an earlier one's, and
    distrusted frames (frame) are left out. ord: which table a row is from."""
    rows = files[0].withColumn("ord", F.lit(1))
    for k, more in enumerate(files[1:], 2):
        rows = rows.unionByName(more.withColumn("ord", F.lit(k)))
    rows = rows.filter("valid")
    columns = [c for c in rows.columns if c not in ("frame", "valid", "ord")]
    last = rows.groupBy("frame").agg(F.max_by(F.struct("ord", *columns), "ord").alias("r")).select("frame", "r.*")
    return last if distrusted is None else last.join(distrusted, "frame", "left_anti")


def per_frame(frames: DataFrame, keyframes: DataFrame, keys: list[str], values: list[str], every: int) -> DataFrame:
    """keyframes (keys, frame, values...) -> a row a frame: each value interpolated between keyframes (constant beyond the
    ends), and valid: whether a keyframe is at most `every` frames away."""
    out = None
    for v in values:
        one = series.between(frames.select(*keys, "frame").distinct(), keyframes, keys, "frame", v)
        valid = F.coalesce(F.col("distance") <= every, F.lit(False)).alias("valid")
        one = one.select(*keys, "frame", *([valid] if out is None else []), F.col("value").alias(v))
        out = one if out is None else out.join(one, [*keys, "frame"])
    return out


def closure(keyframes: DataFrame, keys: list[str]) -> DataFrame:
    """keyframes (keys, frame, pan, tilt, moved_pan, moved_tilt: the camera's motion from the one before) -> keys, closure:
    the 90th percentile of how far each keyframe lies from its predecessor moved on; infinite under two pairs."""
    w = Window.partitionBy(*keys).orderBy("frame")
    off = F.abs(F.lag("pan").over(w) + F.col("moved_pan") - F.col("pan")) + F.abs(F.lag("tilt").over(w) + F.col("moved_tilt") - F.col("tilt"))
    per = keyframes.withColumn("_e", off).groupBy(*keys).agg(F.count("_e").alias("n"), F.percentile("_e", 0.9).alias("c"))
    return per.select(*keys, "n", F.when(F.col("n") >= 2, F.col("c")).otherwise(float("inf")).alias("closure"))


MOVED = ("moved_pan", "moved_tilt", "moved_zoom")


def travelled(motion: DataFrame, keys: list[str]) -> DataFrame:
    """motion (keys, frame, moved_pan, moved_tilt, moved_zoom: from a frame to the next; null where it isn't known, the zoom
    as a logarithm) with to_pan, to_tilt and to_zoom: the sums of the frames before."""
    w = Window.partitionBy(*keys).orderBy("frame").rowsBetween(Window.unboundedPreceding, -1)
    return motion.withColumns({m.replace("moved", "to"): F.coalesce(F.sum(F.coalesce(F.col(m), F.lit(0.0))).over(w), F.lit(0.0)) for m in MOVED})


def chained(motion: DataFrame, keyframes: DataFrame, keys: list[str]) -> DataFrame:
    """A camera a frame of motion: keyframes (keys, frame, cx, cy, cz, pan, tilt, f) as they are; between two of them the one
    before moved on and the one behind moved back, blended by time (the focal length by its logarithm); beyond the ends
    moved from the nearest. Positions are those of the next keyframe, or the last. Sums stand for chains of steps."""
    rows = travelled(motion, keys).join(keyframes.withColumn("_key", F.lit(True)), [*keys, "frame"], "left")
    known = F.when(F.col("_key"), F.struct("frame", "cx", "cy", "cz", "pan", "tilt", "f", "to_pan", "to_tilt", "to_zoom"))
    w = Window.partitionBy(*keys)
    past, future = (w.orderBy(o).rowsBetween(Window.unboundedPreceding, 0) for o in (F.col("frame").asc(), F.col("frame").desc()))
    rows = rows.withColumn("_c", known).withColumn("p", F.last("_c", True).over(past)).withColumn("q", F.last("_c", True).over(future))
    share = F.coalesce((F.col("frame") - F.col("p.frame")) / F.nullif(F.col("q.frame") - F.col("p.frame"), F.lit(0)), F.lit(0.0))

    def blended(start: Column, end: Column) -> Column:
        return F.coalesce((1 - share) * start + share * end, start, end)

    moved = lambda side, c, to: F.col(f"{side}.{c}") + F.col(f"to_{to}") - F.col(f"{side}.to_{to}")
    focal = lambda side: F.log(F.col(f"{side}.f")) + F.col("to_zoom") - F.col(f"{side}.to_zoom")
    place = [F.coalesce(f"q.{c}", f"p.{c}").alias(c) for c in ("cx", "cy", "cz")]
    turned = [blended(moved("p", c, c), moved("q", c, c)).alias(c) for c in ("pan", "tilt")]
    return rows.select(*keys, "frame", *place, *turned, F.exp(blended(focal("p"), focal("q"))).alias("f"))


def outliers(motion: DataFrame, keyframes: DataFrame, keys: list[str], tolerance: float) -> DataFrame:
    """Keyframes that the motion from both neighbours contradicts, while these agree: keys, frame and the pan, tilt and focal
    length that they foretell."""
    rows = keyframes.join(travelled(motion, keys), [*keys, "frame"])
    w = Window.partitionBy(*keys).orderBy("frame")
    told = {}
    for name, step in (("fwd", F.lag), ("bwd", F.lead)):
        for c in ("pan", "tilt"):
            told[f"{name}_{c}"] = step(F.col(c) - F.col(f"to_{c}")).over(w) + F.col(f"to_{c}")
        told[f"{name}_f"] = F.exp(step(F.log("f") - F.col("to_zoom")).over(w) + F.col("to_zoom"))
    rows = rows.withColumns(told)
    off = lambda a, b: F.greatest(F.abs(F.col(f"{a}pan") - F.col(f"{b}pan")), F.abs(F.col(f"{a}tilt") - F.col(f"{b}tilt")))
    rows = rows.filter((off("fwd_", "") > tolerance) & (off("bwd_", "") > tolerance) & (off("fwd_", "bwd_") <= tolerance))
    mean = [((F.col(f"fwd_{c}") + F.col(f"bwd_{c}")) / 2).alias(c) for c in ("pan", "tilt")]
    return rows.select(*keys, "frame", *mean, F.sqrt(F.col("fwd_f") * F.col("bwd_f")).alias("f"))


def pitch_lines() -> list[list[tuple[float, float]]]:
    """Points along the lines, areas, arcs and the circle of the pitch, about a metre apart on straight lines."""
    x, y = g.PITCH_LENGTH / 2, g.PITCH_WIDTH / 2

    def line(a: tuple[float, float], b: tuple[float, float]) -> list[tuple[float, float]]:
        n = max(2, int(math.dist(a, b)))
        return [(a[0] + (b[0] - a[0]) * k / (n - 1), a[1] + (b[1] - a[1]) * k / (n - 1)) for k in range(n)]

    def arc(centre: float, start: float, end: float, n: int) -> list[tuple[float, float]]:
        turns = [start + (end - start) * k / (n - 1) for k in range(n)]
        return [(centre + CIRCLE * math.cos(t), CIRCLE * math.sin(t)) for t in turns]

    lines = [line((-x, s * y), (x, s * y)) for s in (-1, 1)] + [line((s * x, -y), (s * x, y)) for s in (-1, 0, 1)]
    lines.append(arc(0.0, 0.0, 2 * math.pi, CIRCLE_POINTS))
    for side in (-1, 1):
        for depth, half in AREAS:
            inner = side * (x - depth)
            lines += [line((side * x, s * half), (inner, s * half)) for s in (-1, 1)] + [line((inner, -half), (inner, half))]
        reach = math.acos((AREAS[0][0] - SPOT) / CIRCLE)
        middle = math.pi if side > 0 else 0.0
        lines.append(arc(side * (x - SPOT), middle - reach, middle + reach, ARC_POINTS))
    return lines


def pitch_points(spark: SparkSession) -> DataFrame:
    """line, k, x, y: a table of about a thousand rows, the same for every video."""
    rows = [(i, k, px, py) for i, line in enumerate(pitch_lines()) for k, (px, py) in enumerate(line)]
    return spark.createDataFrame(rows, "line int, k int, x double, y double")


def displacement(cameras: DataFrame, points: DataFrame, width: float, height: float, keys: list[str]) -> DataFrame:
    """cameras (keys, h0..h8, o0..o8) -> keys, n, median_px: how far the points in view of the first lie in the second;
    infinite where fewer than LEAST_POINTS are in view. points is a bounded table (pitch_points) and broadcast."""
    both = cameras.crossJoin(F.broadcast(points))
    sides = []
    for p in "ho":
        w = F.col(f"{p}6") * F.col("x") + F.col(f"{p}7") * F.col("y") + F.col(f"{p}8")
        w = F.when(w > 1e-6, w)
        sides.append([(F.col(f"{p}{3 * k}") * F.col("x") + F.col(f"{p}{3 * k + 1}") * F.col("y") + F.col(f"{p}{3 * k + 2}")) / w for k in (0, 1)])
    (ax, ay), (bx, by) = sides
    seen = (ax >= 0) & (ax < width) & (ay >= 0) & (ay < height) & bx.isNotNull()
    off = both.select(*keys, F.when(seen, F.hypot(ax - bx, ay - by)).alias("_d"))
    per = off.groupBy(*keys).agg(F.count("_d").alias("n"), F.percentile("_d", 0.5).alias("m"))
    return per.select(*keys, "n", F.when(F.col("n") >= LEAST_POINTS, F.col("m")).otherwise(float("inf")).alias("median_px"))


def diverse(candidates: DataFrame, keys: list[str], parameters: dict[str, float], cost: str, most: int) -> DataFrame:
    """Per key by rising cost (ties by parameters) up to `most` candidates, each at least one unit from those kept in some
    parameter. A key's candidates are a grid of bounded size and one task's work."""
    names, scale = list(parameters), list(parameters.values())

    def keep(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values([cost, *names])
        points, kept = group[names].to_numpy(float) / scale, []
        for k in range(len(group)):
            if len(kept) == most:
                break
            if not kept or (abs(points[kept] - points[k]).max(1) >= 1).all():
                kept.append(k)
        return group.iloc[kept]

    return candidates.groupBy(*keys).applyInPandas(keep, candidates.schema)


def best_finalist(candidates: DataFrame, keys: list[str], quick: str, sharp: str, tie: str, finalists: int) -> DataFrame:
    """Of the `finalists` candidates of least quick cost the one of least sharp cost."""
    order = Window.partitionBy(*keys).orderBy(quick, tie)
    last = candidates.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= finalists)
    order = Window.partitionBy(*keys).orderBy(sharp, tie)
    return last.withColumn("_r", F.row_number().over(order)).filter("_r = 1").drop("_r")


def sampled(points: DataFrame, keys: list[str], identity: str, most: int, seed: int = 0) -> DataFrame:
    """At most `most` rows a key without replacement: those with the least hashes of seed and identity."""
    order = Window.partitionBy(*keys).orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col(identity).cast("string")).cast("binary")), identity)
    return points.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= most).drop("_r")
