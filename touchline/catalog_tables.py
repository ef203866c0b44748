"""Queries over calibration, tracklet, identity and document tables, and their SQL twins. Imported by the catalog."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .catalog import _LINKS, query
from .functions import geometry as g
from .functions.vectors import l1
from .operators import assembly, calibration, crossings, identity, sequence, series
from .sources import adapter as src
from .sources import files

# Calibration

_VALID = "coverage >= 0.30 AND err_px <= 3.5 AND explained >= 0.30"
_CAMERAS = f"cam AS (SELECT *, {_VALID} AS valid FROM ({src.CALIBRATION} FROM (SELECT DISTINCT frame FROM detections) d) c)"
_MERGED = f"""{_CAMERAS},
files AS (SELECT *, 1 AS ord FROM cam UNION ALL SELECT * REPLACE (pan + 0.05 AS pan), 2 AS ord FROM cam WHERE frame % 3 = 0),
merged AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY frame ORDER BY ord DESC) AS rn FROM files WHERE valid) q WHERE rn = 1 AND frame %
  7 <> 0)"""
_H = ", ".join(f"{x} AS h{k}" for k, x in enumerate(calibration.camera_sql(src.WIDTH, src.HEIGHT)))
_INVERSE = ("h4*h8-h5*h7", "h2*h7-h1*h8", "h1*h5-h2*h4", "h5*h6-h3*h8", "h0*h8-h2*h6", "h2*h3-h0*h5", "h3*h7-h4*h6", "h1*h6-h0*h7", "h0*h4-h1*h3")


def _ground_sql(x: str, y: str) -> tuple[str, str]:
    row = lambda k: f"(({_INVERSE[k]})*({x}) + ({_INVERSE[k + 1]})*({y}) + ({_INVERSE[k + 2]}))"
    return f"{row(0)} / nullif({row(6)}, 0)", f"{row(3)} / nullif({row(6)}, 0)"


_PX, _PY = _ground_sql("(x1 + x2) / 2", "y2")


def _merged(spark, d) -> DataFrame:
    cam = src.calibration(spark, d).withColumn("valid", calibration.is_valid(F.col("coverage"), F.col("err_px"), F.col("explained")))
    again = cam.filter("frame % 3 = 0").withColumn("pan", F.col("pan") + 0.05)
    distrusted = src.detections(spark, d).filter("frame % 7 = 0").select("frame").distinct()
    return calibration.merged([cam, again], distrusted)


def _metres(c) -> F.Column:
    return F.round(c, 6) + F.lit(0.0)  # no negative zeros


@query(f"WITH {_CAMERAS} SELECT frame, coverage, err_px, explained, valid FROM cam")
def calib_validity(spark, d):
    valid = calibration.is_valid(F.col("coverage"), F.col("err_px"), F.col("explained"))
    return src.calibration(spark, d).select("frame", "coverage", "err_px", "explained", valid.alias("valid"))


@query(f"WITH {_MERGED} SELECT frame, ord, round(pan, 6) AS pan FROM merged")
def calib_merged(spark, d):
    """Valid frames of two calibrations, the later one first, without distrusted frames."""
    return _merged(spark, d).select("frame", "ord", F.round("pan", 6).alias("pan"))


@query(f"""WITH {_MERGED}, hs AS (SELECT frame, {_H} FROM merged),
t AS (SELECT det_id, d.frame, cls, {_PX} AS px, {_PY} AS py FROM detections d LEFT JOIN hs ON hs.frame = d.frame)
SELECT det_id, frame, round(px, 6) + CAST(0 AS DOUBLE) AS px, round(py, 6) + CAST(0 AS DOUBLE) AS py,
  coalesce(abs(px) <= CASE WHEN cls = 'ball' THEN 67.5 ELSE 58.5 END AND abs(py) <= CASE WHEN cls = 'ball' THEN 49.0 ELSE 40.0 END, false) AS kept
    FROM t""")
def pitch_by_calib(spark, d):
    """Feet in metres by each frame's own camera, null without one, and whether they lie near the pitch (the ball may be
    further off)."""
    cameras = calibration.with_camera(_merged(spark, d), src.WIDTH, src.HEIGHT).select("frame", *(f"h{k}" for k in range(9)))
    rows = src.detections(spark, d).join(cameras, "frame", "left")
    px, py = calibration.on_ground(rows, (F.col("x1") + F.col("x2")) / 2, F.col("y2"))
    rows = rows.withColumns({"px": px, "py": py})
    beyond = F.when(F.col("cls") == "ball", 15.0).otherwise(6.0)
    kept = (F.abs("px") <= g.PITCH_LENGTH / 2 + beyond) & (F.abs("py") <= g.PITCH_WIDTH / 2 + beyond)
    return rows.select("det_id", "frame", _metres(F.col("px")).alias("px"), _metres(F.col("py")).alias("py"), F.coalesce(kept, F.lit(False)).alias("kept"))


@query(f"""WITH {_MERGED}, hs AS (SELECT frame, {_H} FROM merged),
p AS (SELECT det_id, d.frame, CAST(x1 AS BIGINT) % 3 <> 0 AS grass, hs.frame IS NOT NULL AS known, {_PX} AS px, {_PY} AS py
  FROM detections d LEFT JOIN hs ON hs.frame = d.frame WHERE cls <> 'ball'),
k AS (SELECT *, CASE WHEN known THEN coalesce(abs(px) <= 53.5 AND abs(py) <= 35.0, false) END AS calib FROM p),
n AS (SELECT *, sum(CASE WHEN grass THEN 1 ELSE 0 END) OVER (PARTITION BY frame) AS g, sum(CASE WHEN grass AND calib THEN 1 ELSE 0 END) OVER
  (PARTITION BY frame) AS b FROM k)
SELECT det_id, frame, known, known AND g >= 6 AND g - b > 0.5 * g AS distrusted FROM n
WHERE CASE WHEN NOT known OR (g >= 6 AND g - b > 0.5 * g) THEN grass ELSE calib END""")
def off_pitch_by_calib(spark, d):
    """The off-pitch filter with a camera a frame: frames without one keep what stands on grass."""
    cameras = calibration.with_camera(_merged(spark, d), src.WIDTH, src.HEIGHT).select("frame", *(f"h{k}" for k in range(9)))
    rows = src.detections(spark, d).filter("cls <> 'ball'").join(cameras, "frame", "left").withColumn("known", F.col("h0").isNotNull())
    px, py = calibration.on_ground(rows, (F.col("x1") + F.col("x2")) / 2, F.col("y2"))
    rows = rows.withColumn("calib", F.coalesce(g.on_pitch(px, py, 1.0), F.lit(False))).withColumn("grass", F.expr("CAST(x1 AS BIGINT) % 3 <> 0"))
    w = Window.partitionBy("frame")
    grass, both = F.sum(F.col("grass").cast("int")).over(w), F.sum((F.col("grass") & F.col("calib")).cast("int")).over(w)
    rows = rows.withColumn("distrusted", F.col("known") & (grass >= 6) & (grass - both > 0.5 * grass))
    kept = F.when(~F.col("known") | F.col("distrusted"), F.col("grass")).otherwise(F.col("calib"))
    return rows.filter(kept).select("det_id", "frame", "known", "distrusted")


@query(f"""WITH {_CAMERAS}, k AS (SELECT * FROM cam WHERE valid AND frame % 5 = 0), f AS (SELECT DISTINCT frame FROM detections),
pq AS (SELECT f.frame, max(k1.frame) AS p, any_value(q) AS q FROM f LEFT JOIN (SELECT f.frame, min(k.frame) AS q FROM f JOIN k ON k.frame >= f.frame
  GROUP BY 1) n ON n.frame = f.frame
  LEFT JOIN k k1 ON k1.frame <= f.frame GROUP BY f.frame)
SELECT pq.frame, coalesce(least(coalesce(pq.frame - p, 1000000), coalesce(q - pq.frame, 1000000)) <= 10, false) AS valid,
  round(coalesce(a.pan + (b.pan - a.pan) * (CAST(pq.frame - p AS DOUBLE) / nullif(q - p, 0)), a.pan, b.pan), 6) AS pan,
  round(coalesce(a.err_px + (b.err_px - a.err_px) * (CAST(pq.frame - p AS DOUBLE) / nullif(q - p, 0)), a.err_px, b.err_px), 6) AS err_px
FROM pq LEFT JOIN k a ON a.frame = p LEFT JOIN k b ON b.frame = q""")
def calib_per_frame(spark, d):
    """Cameras of valid keyframes, interpolated to a row a frame."""
    cam = src.calibration(spark, d)
    keys = cam.filter(calibration.is_valid(F.col("coverage"), F.col("err_px"), F.col("explained")) & (F.col("frame") % 5 == 0)).withColumn("video", F.lit(1))
    return calibration.per_frame(cam.withColumn("video", F.lit(1)), keys, ["video"], ["pan", "err_px"], 10).drop("video")


@query(f"""WITH {_CAMERAS}, k AS (SELECT *, CAST(floor(frame / 100) AS BIGINT) AS shot_no, CAST(frame % 5 - 2 AS DOUBLE) / 100 AS mp, CAST(frame % 3 -
  1 AS DOUBLE) / 100 AS mt FROM cam WHERE valid),
e AS (SELECT shot_no, abs(lag(pan) OVER w + mp - pan) + abs(lag(tilt) OVER w + mt - tilt) AS e FROM k WINDOW w AS (PARTITION BY shot_no ORDER BY
  frame))
SELECT shot_no, count(e) AS n, CASE WHEN count(e) >= 2 THEN round(quantile_cont(e, 0.9), 6) ELSE CAST('Infinity' AS DOUBLE) END AS closure FROM e
  GROUP BY 1""")
def pan_closure(spark, d):
    """How far the keyframes of a shot lie from where the camera's motion would bring their predecessors."""
    cam = src.calibration(spark, d).filter(calibration.is_valid(F.col("coverage"), F.col("err_px"), F.col("explained")))
    moved = cam.selectExpr("*", "frame div 100 AS shot_no", "CAST(frame % 5 - 2 AS DOUBLE) / 100 AS moved_pan", "CAST(frame % 3 - 1 AS DOUBLE) / 100 AS moved_tilt")
    return calibration.closure(moved, ["shot_no"]).withColumn("closure", F.round("closure", 6))


_SHOT = "CAST(floor(frame / 100) AS BIGINT) AS shot_no"
_MOVED = "CAST(frame % 5 - 2 AS DOUBLE) / 100 AS moved_pan, CAST(frame % 3 - 1 AS DOUBLE) / 100 AS moved_tilt, CAST(frame % 7 - 3 AS DOUBLE) / 1000 AS moved_zoom"
_CHAIN = f"""{_CAMERAS}, m AS (SELECT frame, {_SHOT}, {_MOVED} FROM cam),
t AS (SELECT shot_no, frame, coalesce(sum(moved_pan) OVER w, 0) AS tp, coalesce(sum(moved_tilt) OVER w, 0) AS tt, coalesce(sum(moved_zoom) OVER w, 0)
  AS tz
  FROM m WINDOW w AS (PARTITION BY shot_no ORDER BY frame ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
k AS (SELECT t.*, pan, tilt + CAST(t.frame % 4 AS DOUBLE) / 50 AS tilt, f + t.frame % 9 AS f, cx + t.frame % 2 AS cx FROM t JOIN cam ON cam.frame =
  t.frame WHERE valid AND t.frame % 3 = 0)"""


def _motion(spark, d) -> tuple[DataFrame, DataFrame]:
    cam = src.calibration(spark, d).withColumn("valid", calibration.is_valid(F.col("coverage"), F.col("err_px"), F.col("explained")))
    cam = cam.withColumn("shot_no", F.floor(F.col("frame") / 100))
    keys = cam.filter("valid AND frame % 3 = 0").selectExpr("shot_no", "frame", "cx + frame % 2 AS cx", "cy", "cz", "pan", "tilt + CAST(frame % 4 AS DOUBLE) / 50 AS tilt", "f + frame % 9 AS f")
    return cam.selectExpr("shot_no", "frame", *_MOVED.split(", ")), keys


@query(f"""WITH {_CHAIN}, pq AS (SELECT t.*, max(a.frame) AS p FROM t LEFT JOIN k a ON a.shot_no = t.shot_no AND a.frame <= t.frame GROUP BY ALL),
r AS (SELECT pq.*, min(b.frame) AS q FROM pq LEFT JOIN k b ON b.shot_no = pq.shot_no AND b.frame >= pq.frame GROUP BY ALL),
x AS (SELECT r.*, coalesce(CAST(r.frame - p AS DOUBLE) / nullif(q - p, 0), 0) AS w, a.pan + r.tp - a.tp AS fp, b.pan + r.tp - b.tp AS bp, a.tilt +
  r.tt - a.tt AS ft, b.tilt + r.tt - b.tt AS bt,
  ln(a.f) + r.tz - a.tz AS ff, ln(b.f) + r.tz - b.tz AS bf, coalesce(b.cx, a.cx) AS cx FROM r LEFT JOIN k a ON a.shot_no = r.shot_no AND a.frame = p
    LEFT JOIN k b ON b.shot_no = r.shot_no AND b.frame = q)
SELECT shot_no, frame, cx, round(coalesce((1 - w) * fp + w * bp, fp, bp), 6) + CAST(0 AS DOUBLE) AS pan, round(coalesce((1 - w) * ft + w * bt, ft,
  bt), 6) + CAST(0 AS DOUBLE) AS tilt, round(exp(coalesce((1 - w) * ff + w * bf, ff, bf)), 5) AS f FROM x""")
def camera_chaining(spark, d):
    """A camera a frame from keyframes and the motion between frames."""
    found = calibration.chained(*_motion(spark, d), ["shot_no"])
    return found.select("shot_no", "frame", "cx", _metres(F.col("pan")).alias("pan"), _metres(F.col("tilt")).alias("tilt"), F.round("f", 5).alias("f"))


@query(f"""WITH {_CHAIN}, n AS (SELECT *, lag(pan - tp) OVER w + tp AS fp, lead(pan - tp) OVER w + tp AS bp, lag(tilt - tt) OVER w + tt AS ft,
  lead(tilt - tt) OVER w + tt AS bt,
  exp(lag(ln(f) - tz) OVER w + tz) AS ff, exp(lead(ln(f) - tz) OVER w + tz) AS bf FROM k WINDOW w AS (PARTITION BY shot_no ORDER BY frame))
SELECT shot_no, frame, round((fp + bp) / 2, 6) + CAST(0 AS DOUBLE) AS pan, round((ft + bt) / 2, 6) AS tilt, round(sqrt(ff * bf), 5) AS f FROM n
WHERE greatest(abs(fp - pan), abs(ft - tilt)) > 0.05 AND greatest(abs(bp - pan), abs(bt - tilt)) > 0.05 AND greatest(abs(fp - bp), abs(ft - bt)) <=
  0.05""")
def camera_outliers(spark, d):
    """Keyframes that the motion from both neighbours contradicts."""
    found = calibration.outliers(*_motion(spark, d), ["shot_no"], 0.05)
    return found.select("shot_no", "frame", _metres(F.col("pan")).alias("pan"), F.round("tilt", 6).alias("tilt"), F.round("f", 5).alias("f"))


_X, _Y, _C = g.PITCH_LENGTH / 2, g.PITCH_WIDTH / 2, calibration.CIRCLE
_STRAIGHT = [
    *((-_X, s * _Y, _X, s * _Y) for s in (-1, 1)), *((s * _X, -_Y, s * _X, _Y) for s in (-1, 0, 1)),
    *(v for s in (-1, 1) for depth, half in calibration.AREAS for v in (*((s * _X, t * half, s * (_X - depth), t * half) for t in (-1, 1)), (s * (_X - depth), -half, s * (_X - depth), half))),
]
_TURN = math.acos((calibration.AREAS[0][0] - calibration.SPOT) / _C)
_ARCS = [(0.0, 0.0, 2 * math.pi, calibration.CIRCLE_POINTS), *((s * (_X - calibration.SPOT), (math.pi if s > 0 else 0.0) - _TURN, (math.pi if s > 0 else 0.0) + _TURN, calibration.ARC_POINTS) for s in (-1, 1))]
_POINTS = f"""straight(x0, y0, x1, y1) AS (VALUES {", ".join(f"({a!r}, {b!r}, {c!r}, {e!r})" for a, b, c, e in _STRAIGHT)}),
arcs(c, t0, t1, n) AS (VALUES {", ".join(f"({a!r}, {b!r}, {c!r}, {n})" for a, b, c, n in _ARCS)}),
ns AS (SELECT *, greatest(2, CAST(floor(sqrt((x1-x0)*(x1-x0) + (y1-y0)*(y1-y0))) AS BIGINT)) AS n FROM straight),
pts AS (SELECT x0 + (x1 - x0) * k / (n - 1) AS x, y0 + (y1 - y0) * k / (n - 1) AS y FROM (SELECT *, unnest(range(n)) AS k FROM ns) q
  UNION ALL SELECT c + {_C} * cos(t0 + (t1 - t0) * k / (n - 1)), {_C} * sin(t0 + (t1 - t0) * k / (n - 1)) FROM (SELECT *, unnest(range(n)) AS k FROM
    arcs) q)"""


@query(f"WITH {_POINTS} SELECT round(x, 6) + CAST(0 AS DOUBLE) AS x, round(y, 6) + CAST(0 AS DOUBLE) AS y FROM pts")
def pitch_model(spark, d):
    """Points of the pitch's markings."""
    return calibration.pitch_points(spark).select(_metres(F.col("x")).alias("x"), _metres(F.col("y")).alias("y"))


def _image_sql(p: str) -> tuple[str, str]:
    w = f"CASE WHEN {p}6*x+{p}7*y+{p}8 > 1e-6 THEN {p}6*x+{p}7*y+{p}8 END"
    return f"({p}0*x+{p}1*y+{p}2)/({w})", f"({p}3*x+{p}4*y+{p}5)/({w})"


_O = _H.replace(" AS h", " AS o")


@query(f"""WITH {_CAMERAS}, {_POINTS}, c1 AS (SELECT frame, {_H} FROM cam WHERE frame % 10 = 0), c2 AS (SELECT frame, {_O} FROM (SELECT * REPLACE (pan
  + 0.01 AS pan) FROM cam WHERE frame % 10 = 0) q),
im AS (SELECT c1.frame, {_image_sql("h")[0]} AS ax, {_image_sql("h")[1]} AS ay, {_image_sql("o")[0]} AS bx, {_image_sql("o")[1]} AS by_ FROM c1 JOIN
  c2 ON c1.frame = c2.frame, pts),
e AS (SELECT frame, CASE WHEN ax >= 0 AND ax < {src.WIDTH} AND ay >= 0 AND ay < {src.HEIGHT} AND bx IS NOT NULL THEN
  sqrt((ax-bx)*(ax-bx)+(ay-by_)*(ay-by_)) END AS e FROM im)
SELECT frame, count(e) AS n, CASE WHEN count(e) >= 10 THEN round(quantile_cont(e, 0.5), 5) ELSE CAST('Infinity' AS DOUBLE) END AS median_px FROM e
  GROUP BY 1""")
def camera_displacement(spark, d):
    """How far the pitch's markings move in the image between two cameras of each tenth frame."""
    cam = src.calibration(spark, d).filter("frame % 10 = 0")
    both = calibration.with_camera(cam, src.WIDTH, src.HEIGHT).withColumn("pan", F.col("pan") + 0.01)
    both = calibration.with_camera(both, src.WIDTH, src.HEIGHT, "o")
    return calibration.displacement(both, calibration.pitch_points(spark), src.WIDTH, src.HEIGHT, ["frame"]).withColumn("median_px", F.round("median_px", 5))


@query("""WITH c AS (SELECT shot_no, det_id, score AS quick, CAST((det_id * 7) % 1000 AS DOUBLE) / 1000 AS sharp FROM detections),
q AS (SELECT *, row_number() OVER (PARTITION BY shot_no ORDER BY quick, det_id) AS r FROM c), s AS (SELECT *, row_number() OVER (PARTITION BY shot_no
  ORDER BY sharp, det_id) AS k FROM q WHERE r <= 5)
SELECT shot_no, det_id, quick, sharp FROM s WHERE k = 1""")
def finalists(spark, d):
    """Of each shot's five candidates of least quick cost the one of least sharp cost."""
    c = src.detections(spark, d).selectExpr("shot_no", "det_id", "score AS quick", "CAST((det_id * 7) % 1000 AS DOUBLE) / 1000 AS sharp")
    return calibration.best_finalist(c, ["shot_no"], "quick", "sharp", "det_id", 5)


@query()
def diverse_candidates(spark, d):
    """Up to 20 candidates a shot by score, apart from one another by 60 pixels in some coordinate."""
    c = src.detections(spark, d).select("shot_no", "det_id", "x1", "y1", "score")
    return calibration.diverse(c, ["shot_no"], {"x1": 60.0, "y1": 60.0}, "score", 20)


@query("""WITH r AS (SELECT shot_no, det_id, row_number() OVER (PARTITION BY shot_no ORDER BY md5('0:' || CAST(det_id AS VARCHAR)), det_id) AS k FROM
  detections)
SELECT shot_no, det_id FROM r WHERE k <= 15""")
def sampled_points(spark, d):
    return calibration.sampled(src.detections(spark, d).select("shot_no", "det_id"), ["shot_no"], "det_id", 15)


# Shots and frames


@query("""WITH n AS (SELECT unnest(range((SELECT max(shot_no) + 3 FROM detections))) AS shot_no), s AS (SELECT shot_no, quantile_cont(score * 0.9,
  0.5) AS green FROM detections GROUP BY 1)
SELECT 'shot_' || lpad(CAST(n.shot_no AS VARCHAR), 4, '0') AS shot_id, round(coalesce(green, 0), 6) AS green,
  CASE WHEN coalesce(green, 0) > 0.45 THEN 'main' WHEN coalesce(green, 0) > 0.20 THEN 'closeup' ELSE 'other' END AS shot_type FROM n LEFT JOIN s ON
    s.shot_no = n.shot_no""")
def shot_types(spark, d):
    """Types of all shots by their median share of green; shots without frames are other."""
    rows = src.detections(spark, d)
    spine = rows.agg((F.max("shot_no") + 2).alias("last")).select(F.explode(F.sequence(F.lit(0).cast("long"), F.col("last"))).alias("shot_no"))
    per = spine.join(rows.groupBy("shot_no").agg(F.percentile(F.col("score") * 0.9, 0.5).alias("green")), "shot_no", "left")
    green = F.coalesce("green", F.lit(0.0))
    kind = F.when(green > 0.45, "main").when(green > 0.20, "closeup").otherwise("other")
    return per.select(F.format_string("shot_%04d", "shot_no").alias("shot_id"), F.round(green, 6).alias("green"), kind.alias("shot_type"))


@query("""SELECT det_id, t.shot_no, frame FROM tracks t JOIN (SELECT shot_no, min(frame) AS start FROM detections GROUP BY 1) s ON s.shot_no =
  t.shot_no
WHERE (frame - start) % 5 = 0 AND occl < 0.5""")
def visible_crops(spark, d):
    """Every fifth frame from a shot's start on, boxes that are hardly hidden."""
    start = src.detections(spark, d).groupBy("shot_no").agg(F.min("frame").alias("start"))
    return src.tracks(spark, d).join(F.broadcast(start), "shot_no").filter("(frame - start) % 5 = 0 AND occl < 0.5").select("det_id", "shot_no", "frame")  # one row a shot


@query("""WITH p AS (SELECT det_id, 480 + (det_id % 5) * 240 AS height, CAST(25 + (det_id % 3) AS DOUBLE) AS fps_nominal, 25 + CAST(det_id % 7 AS
  DOUBLE) / 50 AS fps_avg FROM detections),
v AS (SELECT *, fps_nominal > 0 AND abs(fps_nominal - fps_avg) / fps_nominal > 0.002 AS vfr FROM p)
SELECT det_id, vfr, height > 1080 OR abs(fps_avg - 25) > 0.05 OR vfr AS encode FROM v""")
def encode_decisions(spark, d):
    """Which videos need encoding: too high, off the frame rate, or of a variable one."""
    p = src.detections(spark, d).selectExpr("det_id", "480 + (det_id % 5) * 240 AS height", "CAST(25 + (det_id % 3) AS DOUBLE) AS fps_nominal", "25 + CAST(det_id % 7 AS DOUBLE) / 50 AS fps_avg")
    p = p.withColumn("vfr", (F.col("fps_nominal") > 0) & (F.abs(F.col("fps_nominal") - F.col("fps_avg")) / F.col("fps_nominal") > 0.002))
    return p.select("det_id", "vfr", ((F.col("height") > 1080) | (F.abs(F.col("fps_avg") - 25) > 0.05) | F.col("vfr")).alias("encode"))


@query("""SELECT det_id, round_even(x1 / 4, 1) + CAST(0 AS DOUBLE) AS pitch, round_even(CAST(det_id % 100 AS DOUBLE) / 8, 2) AS conf, round_even((y1 +
  1) / 16, 3) AS beyond FROM detections""")
def rounding_policy(spark, d):
    """Ties go to the even digit, one, two and three digits behind the point."""
    return src.detections(spark, d).select("det_id", F.bround(F.col("x1") / 4, 1).alias("pitch"), F.bround((F.col("det_id") % 100) / 8, 2).alias("conf"), F.bround((F.col("y1") + 1) / 16, 3).alias("beyond"))


# Tracklets and identities

_SURE = "CASE WHEN det_id % 11 = 0 THEN CAST(0.3 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END"
_TRACKLETS = f"""{_CAMERAS}, ch AS (SELECT frame, valid, {_H} FROM cam),
r AS (SELECT t.*, {_SURE} AS swap_conf, valid, CASE WHEN valid THEN {_PX} END AS px, CASE WHEN valid THEN {_PY} END AS py FROM tracks t LEFT JOIN ch
  ON ch.frame = t.frame),
per AS (SELECT shot_no, track_id, min(frame) AS start_frame, max(frame) AS end_frame, count(*) AS n_frames, arg_min(cls, frame) AS cls, arg_min([x1,
  y1, x2, y2], frame) AS fb, arg_max([x1, y1, x2, y2], frame) AS lb,
  min(swap_conf) AS min_swap_conf, avg(margin) AS mm, avg(CAST(CASE WHEN occl > 0.3 THEN 1 ELSE 0 END AS DOUBLE)) AS fo, avg(y2 - y1) AS mh,
  coalesce(avg(CAST(CASE WHEN valid THEN 1 WHEN NOT valid THEN 0 END AS DOUBLE)), 0) AS cf, max_by({{'p': px, 'q': py}}, -frame) AS fp,
    max_by({{'p': px, 'q': py}}, frame) AS lp,
  CASE WHEN count(px) >= 10 THEN round_even(avg(CAST(CASE WHEN px IS NULL THEN NULL WHEN abs(px) > 52.7 OR abs(py) > 34.2 THEN 1 ELSE 0 END AS
    DOUBLE)), 3) ELSE -1 END AS beyond_frac FROM r GROUP BY 1, 2),
tt AS (SELECT shot_no, track_id, start_frame, end_frame, n_frames, cls, CASE WHEN track_id % 3 <> 0 THEN CAST(to_json([round_even(CAST(track_id AS
  DOUBLE) / 32, 5), round_even(1 - CAST(track_id AS DOUBLE) / 32, 5)]) AS VARCHAR) ELSE '[0.0]' END AS app_embedding,
  CASE WHEN track_id % 3 <> 0 THEN CAST(track_id AS DOUBLE) / 10 ELSE 0 END AS app_weight, CAST(to_json(fb) AS VARCHAR) AS first_box, CAST(to_json(lb)
    AS VARCHAR) AS last_box,
  round(fp.p, 6) + CAST(0 AS DOUBLE) AS first_px, round(fp.q, 6) + CAST(0 AS DOUBLE) AS first_py, round(lp.p, 6) + CAST(0 AS DOUBLE) AS last_px,
    round(lp.q, 6) + CAST(0 AS DOUBLE) AS last_py,
  CASE WHEN track_id % 4 <> 1 THEN CAST(to_json([round_even(CAST(track_id AS DOUBLE) / 64, 4)]) AS VARCHAR) END AS reid_embedding, min_swap_conf,
  CASE WHEN track_id % 5 = 0 THEN CAST(to_json([track_id + 1, track_id + 2]) AS VARCHAR) END AS split_candidates, CAST(CASE WHEN track_id % 5 = 0 THEN
    shot_no * 100 + 50 ELSE -1 END AS BIGINT) AS split_frame,
  round(mm, 6) AS mean_margin, round(fo, 6) AS frac_occluded, round(mh, 6) AS mean_height_px, round(cf, 6) AS calib_frac, beyond_frac FROM per)"""


def _tracks(spark, d) -> DataFrame:
    return src.tracks(spark, d).withColumn("swap_conf", F.expr(_SURE))


def _tracklet_table(spark, d) -> DataFrame:
    t = _tracks(spark, d)
    one = t.select("shot_no", "track_id").distinct()
    app = one.filter("track_id % 3 <> 0").selectExpr("shot_no", "track_id", "array(CAST(track_id AS DOUBLE) / 32, 1 - CAST(track_id AS DOUBLE) / 32) AS app_embedding", "CAST(track_id AS DOUBLE) / 10 AS app_weight")
    reid = one.filter("track_id % 4 <> 1").selectExpr("shot_no", "track_id", "array(CAST(track_id AS DOUBLE) / 64) AS reid_embedding")
    split = one.filter("track_id % 5 = 0").selectExpr("shot_no", "track_id", "shot_no * 100 + 50 AS split_frame", "array(track_id + 1, track_id + 2) AS cands")
    cam = src.calibration(spark, d).withColumn("valid", calibration.is_valid(F.col("coverage"), F.col("err_px"), F.col("explained")))
    cam = calibration.with_camera(cam, src.WIDTH, src.HEIGHT).select("frame", "valid", *(f"h{k}" for k in range(9)))
    out = assembly.tracklet_table(t, app, reid, split, cam)
    out = out.withColumns({c: F.round(c, 6) for c in ("mean_margin", "frac_occluded", "mean_height_px", "calib_frac")})
    return out.withColumns({c: _metres(F.col(c)) for c in ("first_px", "first_py", "last_px", "last_py")})


@query(f"WITH {_TRACKLETS} SELECT * FROM tt")
def tracklet_table(spark, d):
    """The whole tracklet summary, with defaults where other tables know nothing of a tracklet."""
    return _tracklet_table(spark, d)


@query(f"WITH {_TRACKLETS} SELECT shot_no, track_id, n_frames, beyond_frac FROM tt WHERE beyond_frac >= 0.7 AND n_frames >= 10")
def staff_table(spark, d):
    return assembly.staff(_tracklet_table(spark, d)).select("shot_no", "track_id", "n_frames", "beyond_frac")


@query("SELECT row_number() OVER (ORDER BY start_frame, shot_no, track_id) - 1 AS node, shot_no, track_id, start_frame FROM tracklets")
def node_ids(spark, d):
    return _nodes(spark, d).select("node", "shot_no", "track_id", "start_frame")


def _nodes(spark, d) -> DataFrame:
    t = identity.summarize(src.tracks(spark, d))
    t = t.withColumn("_place", F.struct("start_frame", "shot_no", "track_id"))
    return assembly.numbered(t, "_place", "node", 0).drop("_place")


_SPLIT = "track_id % 10 = 3"


@query(f"""WITH {_LINKS} SELECT team, shot_a, track_a, shot_b, track_b, belief FROM bl WHERE belief > 0 AND NOT
  ({_SPLIT.replace("track_id", "track_a")}) AND NOT ({_SPLIT.replace("track_id", "track_b")})""")
def link_edges_unsplit(spark, d):
    """Candidate links between tracklets that no crossing has split."""
    t = identity.summarize(src.tracks(spark, d)).filter(f"NOT ({_SPLIT})")
    return identity.link_edges(t, src.vectors(spark, d))


# Rounds of mutual best edges, which take what a pass by falling belief would.
_GREEDY = f"""{_LINKS}, e AS (SELECT *, row_number() OVER (ORDER BY belief DESC, shot_a, track_a, shot_b, track_b) AS place FROM bl WHERE belief >=
  0.55),
rem AS (SELECT *, false AS taken FROM e UNION ALL
  SELECT team, shot_a, track_a, shot_b, track_b, belief, place, hit AS taken FROM (
    SELECT *, bool_or(hit) OVER (PARTITION BY shot_a, track_a) AS ga, bool_or(hit) OVER (PARTITION BY shot_b, track_b) AS gb FROM (
      SELECT *, place = min(place) OVER (PARTITION BY shot_a, track_a) AND place = min(place) OVER (PARTITION BY shot_b, track_b) AS hit FROM rem
        WHERE NOT taken) h) g
  WHERE hit OR NOT (ga OR gb)),
links AS (SELECT shot_a, track_a, shot_b, track_b, belief FROM rem WHERE taken)"""
_IDENT = f"""{_GREEDY}, nodes AS (SELECT row_number() OVER (ORDER BY start_frame, shot_no, track_id) - 1 AS node, t.* FROM tracklets t),
nl AS (SELECT a.node AS pred, b.node AS node, belief FROM links JOIN nodes a ON a.shot_no = shot_a AND a.track_id = track_a JOIN nodes b ON b.shot_no
  = shot_b AND b.track_id = track_b),
ch(node, root, confidence) AS (SELECT node, node, CAST(1 AS DOUBLE) FROM nodes WHERE node NOT IN (SELECT node FROM nl)
  UNION ALL SELECT nl.node, ch.root, least(ch.confidence, nl.belief) FROM ch JOIN nl ON nl.pred = ch.node),
lab AS (SELECT n.*, dense_rank() OVER (ORDER BY root) AS identity_id, confidence, count(*) OVER (PARTITION BY root) = 1 AND n_frames < 15 AS short
  FROM ch JOIN nodes n ON n.node = ch.node),
st AS (SELECT team, frame, sum(step) AS step FROM (SELECT team, start_frame AS frame, 1 AS step FROM lab WHERE NOT short UNION ALL SELECT team,
  end_frame + 1, -1 FROM lab WHERE NOT short) s GROUP BY 1, 2),
ac AS (SELECT team, frame, sum(step) OVER w AS active, lead(frame) OVER w - 1 AS upto FROM st WINDOW w AS (PARTITION BY team ORDER BY frame)),
bad AS (SELECT team, min(frame) AS f0, max(upto) AS f1 FROM ac WHERE active > 11 GROUP BY 1),
wk AS (SELECT node, row_number() OVER (PARTITION BY lab.team ORDER BY confidence, node) AS r, count(*) OVER (PARTITION BY lab.team) AS n FROM lab JOIN
  bad ON bad.team = lab.team AND start_frame <= f1 AND end_frame >= f0 WHERE NOT short),
ident AS (SELECT lab.node, shot_no, track_id, identity_id, team, confidence, short OR coalesce(r <= greatest(1, n - 11), false) AS abstained,
  start_frame, end_frame, lx, ly FROM lab LEFT JOIN wk ON wk.node = lab.node)"""


def _links(spark, d) -> DataFrame:
    return identity.greedy_chain(identity.link_edges(identity.summarize(src.tracks(spark, d)), src.vectors(spark, d)))


def _identities(spark, d) -> DataFrame:
    nodes = files.settle(_nodes(spark, d), "nodes")
    side = lambda s, n: nodes.select(F.col("shot_no").alias(f"shot_{s}"), F.col("track_id").alias(f"track_{s}"), F.col("node").alias(n))
    links = _links(spark, d).join(side("a", "pred"), ["shot_a", "track_a"]).join(side("b", "node"), ["shot_b", "track_b"]).select("node", "pred", "belief")
    found = assembly.identities(nodes.select("node", "team", "n_frames", "start_frame", "end_frame"), links)
    return found.join(nodes.select("node", "shot_no", "track_id", "lx", "ly"), "node")


@query(f"WITH {_GREEDY} SELECT shot_a, track_a, shot_b, track_b, belief FROM links")
def greedy_links(spark, d):
    """The links that a pass by falling belief takes, one successor and one predecessor a tracklet."""
    return _links(spark, d).select("shot_a", "track_a", "shot_b", "track_b", "belief")


@query(f"WITH {_IDENT} SELECT shot_no, track_id, identity_id, team, confidence, abstained FROM ident")
def identities(spark, d):
    """Identities of all tracklets by the links found, with abstention and no more than eleven a team at once."""
    return _identities(spark, d).select("shot_no", "track_id", "identity_id", "team", "confidence", "abstained")


@query(f"""WITH {_IDENT}, sp AS (SELECT * FROM ident WHERE NOT abstained), fr AS (SELECT unnest(range((SELECT min(start_frame) FROM sp), (SELECT
  max(end_frame) FROM sp) + 1, 5)) AS frame),
j AS (SELECT frame, identity_id, min(team) AS team, bool_or(frame BETWEEN start_frame AND end_frame) AS seen, max(CASE WHEN end_frame < frame THEN
  start_frame END) AS s FROM fr JOIN sp ON start_frame <= frame GROUP BY 1, 2)
SELECT j.frame, j.identity_id, j.team, CASE WHEN seen THEN 'visible' WHEN j.frame - end_frame > 250 THEN 'uncertain' ELSE 'off_frame' END AS state, lx
  AS last_x, ly AS last_y,
  CAST(CASE WHEN seen THEN 0 ELSE j.frame - end_frame END AS BIGINT) AS frames_since_seen FROM j LEFT JOIN sp ON sp.identity_id = j.identity_id AND
    sp.start_frame = s""")
def roster_by_identity(spark, d):
    """The state of every identity at each fifth frame."""
    return assembly.roster(_identities(spark, d).filter("NOT abstained"))


@query(f"""WITH {_IDENT}, i AS (SELECT *, row_number() OVER (PARTITION BY identity_id ORDER BY start_frame, shot_no, track_id) > 1 AS later FROM
  ident)
SELECT det_id, t.frame, CASE WHEN abstained THEN -1 ELSE identity_id END AS identity_id, CASE WHEN abstained THEN 0 ELSE least(confidence, {_SURE})
  END AS conf,
  round(greatest(least(0.5 * exp(-6 * margin), 0.5), 0.01), 6) AS link_err_p, CASE WHEN later AND NOT abstained AND row_number() OVER (PARTITION BY
    t.shot_no, t.track_id ORDER BY t.frame) = 1 THEN 1 ELSE 0 END AS reentry
FROM tracks t JOIN i ON i.shot_no = t.shot_no AND i.track_id = t.track_id""")
def fused_identities(spark, d):
    """Tracks under their identities, as sure as the identity and the row are."""
    t = _tracks(spark, d)
    known = _identities(spark, d).select("shot_no", "track_id", "identity_id", "team", "confidence", "abstained", "start_frame")
    rows = assembly.fused(t, known).join(t.select("shot_no", "track_id", "frame", "det_id"), ["shot_no", "track_id", "frame"])
    return rows.select("det_id", "frame", "identity_id", "conf", F.round("link_err_p", 6).alias("link_err_p"), "reentry")


# Relabelling

_CURRENT = "CASE WHEN frame % 100 >= 60 AND track_id % 4 = 1 THEN track_id + 1000 WHEN frame % 100 >= 60 AND track_id % 4 = 2 THEN track_id - 1 + 1000 ELSE track_id END"


@query(f"""WITH m AS (SELECT shot_no, track_id AS raw, {_CURRENT} AS id FROM tracks), app AS (SELECT shot_no, track_id, CAST(track_id AS DOUBLE) / 8
  AS weight, count(*) AS n_frames FROM tracks WHERE track_id % 3 <> 0 GROUP BY 1, 2),
c AS (SELECT shot_no, id, raw, count(*) AS n FROM m GROUP BY 1, 2, 3), p AS (SELECT *, row_number() OVER (PARTITION BY shot_no, id ORDER BY n DESC,
  raw) AS r, sum(n) OVER (PARTITION BY shot_no, id) AS total FROM c)
SELECT shot_no, track_id, weight, n_frames FROM app UNION ALL
SELECT p.shot_no, p.id, a.weight, CAST(total AS BIGINT) FROM p JOIN app a ON a.shot_no = p.shot_no AND a.track_id = p.raw WHERE r = 1 AND NOT EXISTS
  (SELECT 1 FROM app b WHERE b.shot_no = p.shot_no AND b.track_id = p.id)""")
def inherited_appearance(spark, d):
    """Appearance rows, with those that new labels inherit from the raw track most of their rows come from."""
    t = src.tracks(spark, d)
    app = t.filter("track_id % 3 <> 0").groupBy("shot_no", "track_id").agg(F.count("*").alias("n_frames")).selectExpr("shot_no", "track_id", "CAST(track_id AS DOUBLE) / 8 AS weight", "n_frames")
    rows = t.selectExpr("shot_no", "track_id AS raw_track_id", f"{_CURRENT} AS track_id")
    return crossings.inherited(app, rows)


@query(f"""WITH s AS (SELECT DISTINCT shot_no, track_id + 1000 AS track_id, shot_no * 100 + 60 AS split_frame FROM tracks)
SELECT s.shot_no, s.track_id, split_frame FROM s WHERE EXISTS (SELECT 1 FROM tracks t WHERE t.shot_no = s.shot_no AND {_CURRENT} = s.track_id)""")
def split_exists(spark, d):
    """Split ids that still name rows."""
    t = src.tracks(spark, d)
    s = t.select("shot_no", (F.col("track_id") + 1000).alias("track_id"), (F.col("shot_no") * 100 + 60).alias("split_frame")).distinct()
    now = t.selectExpr("shot_no", f"{_CURRENT} AS track_id").distinct()
    return s.join(now, ["shot_no", "track_id"], "left_semi")


@query("""SELECT shot_no, track_id FROM tracks WHERE occl > 0.5 EXCEPT SELECT shot_no, track_id FROM tracks WHERE margin < 0.2""")
def given_not_received(spark, d):
    t = src.tracks(spark, d)
    return t.filter("occl > 0.5").select("shot_no", "track_id").subtract(t.filter("margin < 0.2").select("shot_no", "track_id"))


_GAP = "greatest(b.start_frame - a.end_frame, 1)"


@query(f"""WITH e AS (SELECT shot_no, track_id, start_frame, end_frame, fx, fy, lx, ly, greatest(mean_height_px, 20) AS h, coalesce(vx, 0) AS vx,
  coalesce(vy, 0) AS vy FROM tracklets JOIN (
  SELECT shot_no, track_id, CASE WHEN count(*) >= 3 THEN regr_slope((x1+x2)/2, frame) END AS vx, CASE WHEN count(*) >= 3 THEN regr_slope(y2, frame)
    END AS vy FROM tracks GROUP BY 1, 2) v USING (shot_no, track_id)),
p AS (SELECT a.track_id, a.shot_no AS shot_a, b.shot_no AS shot_b, CAST({_GAP} AS DOUBLE) AS gap, a.h, a.lx, a.ly, b.fx, b.fy, least(1, (9.5 * a.h /
  1.8 / 25) / greatest(sqrt(a.vx*a.vx+a.vy*a.vy), 1e-12)) AS s, a.vx, a.vy
  FROM e a JOIN e b ON a.track_id = b.track_id AND b.shot_no = a.shot_no + 1)
SELECT track_id, shot_a, shot_b, round(-0.5 * ((lx+vx*s*gap-fx)*(lx+vx*s*gap-fx) + (ly+vy*s*gap-fy)*(ly+vy*s*gap-fy)) / ((0.15*h)*(0.15*h) +
  (0.5*(7.0*h/1.8/625)*gap*gap + 0.3*h)*(0.5*(7.0*h/1.8/625)*gap*gap + 0.3*h)), 4) + CAST(0 AS DOUBLE) AS loglik FROM p""")
def motion_scores(spark, d):
    """How well a track's tracklet in the next shot continues it, by human limits of motion."""
    t = src.tracks(spark, d)
    slope = lambda y: F.coalesce(F.when(F.count("*") >= 3, F.regr_slope(y, F.col("frame").cast("double"))), F.lit(0.0))
    v = t.groupBy("shot_no", "track_id").agg(slope((F.col("x1") + F.col("x2")) / 2).alias("vx"), slope(F.col("y2")).alias("vy"))
    e = identity.summarize(t).join(v, ["shot_no", "track_id"]).withColumn("h", F.greatest("mean_height_px", F.lit(20.0)))
    a = e.select("track_id", F.col("shot_no").alias("shot_a"), "lx", "ly", "vx", "vy", "h", "end_frame")
    b = e.select("track_id", F.col("shot_no").alias("shot_b"), "fx", "fy", "start_frame")
    pairs = a.join(b, (a["track_id"] == b["track_id"]) & (b["shot_b"] == a["shot_a"] + 1)).drop(b["track_id"])
    gap = (F.col("start_frame") - F.col("end_frame")).cast("double")
    told = g.motion_log_likelihood(*(F.col(c) for c in ("lx", "ly", "vx", "vy", "h")), gap, F.col("fx"), F.col("fy"))
    return pairs.select("track_id", "shot_a", "shot_b", (F.round(told, 4) + F.lit(0.0)).alias("loglik"))


# Teams


@query("""WITH v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v, CAST(vec_id % 7 + 1 AS DOUBLE) AS w FROM
  embeddings),
e AS (SELECT label, i, sum(w * v[i]) / sum(w) AS c FROM v, (SELECT unnest(range(1, 65)) AS i) GROUP BY 1, 2)
SELECT label, CAST(i AS INTEGER) AS i, round(c, 6) + CAST(0 AS DOUBLE) AS c FROM e""")
def weighted_centroids(spark, d):
    """The weighted mean vector of each label, one row a component."""
    v = src.table(spark, d, "embeddings").select("label", (F.col("vec_id") % 7 + 1).cast("double").alias("w"), F.posexplode(F.col("embedding").cast("array<double>")).alias("i", "x"))
    per = v.groupBy("label", "i").agg((F.sum(F.col("w") * F.col("x")) / F.sum("w")).alias("c"))
    return per.select("label", (F.col("i") + 1).alias("i"), _metres(F.col("c")).alias("c"))


@query("""WITH m AS (SELECT label, sum(CAST(vec_id % 7 + 1 AS DOUBLE)) AS mass FROM embeddings GROUP BY 1)
SELECT label, mass, row_number() OVER (ORDER BY mass DESC, label) - 1 AS team FROM m""")
def cluster_mass(spark, d):
    """Clusters by falling mass: the heaviest is team 0."""
    m = src.table(spark, d, "embeddings").groupBy("label").agg(F.sum((F.col("vec_id") % 7 + 1).cast("double")).alias("mass"))
    return m.select("label", "mass", (F.row_number().over(Window.orderBy(F.col("mass").desc(), "label")) - 1).cast("long").alias("team"))  # one row a cluster


@query("""WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: abs(CAST(x AS DOUBLE))) AS a FROM embeddings), h AS (SELECT vec_id,
  list_transform(a, lambda x: x / list_sum(a)) AS q FROM v),
c AS (SELECT max(CASE WHEN vec_id = 0 THEN q END) AS q0, max(CASE WHEN vec_id = 1 THEN q END) AS q1 FROM h),
x AS (SELECT vec_id, 0.5 * list_sum(list_transform(list_zip(q, q0), lambda z: abs(z[1] - z[2]))) AS d0, 0.5 * list_sum(list_transform(list_zip(q, q1),
  lambda z: abs(z[1] - z[2]))) AS d1 FROM h, c)
SELECT vec_id, CASE WHEN d0 < 0.9 * d1 THEN 0 WHEN d1 < 0.9 * d0 THEN 1 ELSE -1 END AS team FROM x""")
def ratio_teams(spark, d):
    """The clearly nearer of two centres, else -1."""
    v = src.vectors(spark, d)
    centres = v.filter("vec_id < 2").agg(F.max_by("hist", -F.col("vec_id")).alias("q0"), F.max_by("hist", "vec_id").alias("q1"))
    x = v.crossJoin(F.broadcast(centres)).select("vec_id", l1("hist", "q0").alias("d0"), l1("hist", "q1").alias("d1"))  # one row of centres
    return x.select("vec_id", F.when(F.col("d0") < 0.9 * F.col("d1"), 0).when(F.col("d1") < 0.9 * F.col("d0"), 1).otherwise(-1).alias("team"))


@query()
def tiles_and_nms(spark, d):
    """Detections of whole frames and of an enlarged tile, stacked and thinned."""
    full = src.detections(spark, d)
    tile = full.filter("y1 < 200").selectExpr("det_id + 100000000 AS det_id", "frame", "shot_no", "track_id", "x1 + 1 AS x1", "y1 + 1 AS y1", "x2 + 1 AS x2", "y2 + 1 AS y2", "score * 0.9 AS score", "cls")
    return sequence.nms(full.unionByName(tile), ["shot_no", "frame"], 0.6)
