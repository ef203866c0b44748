"""Queries over the ball, the pitch view, overlays, reports, documents and run folders, and their SQL twins. Imported by the
catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .catalog import _FILL, _FUSED, _filled, _fused, query
from .functions import geometry as g
from .operators import drawing, identity, pitch, projection, series
from .sources import adapter as src
from .sources import files

_FLIGHT = f"""{_FILL}, dd AS (SELECT *, lead(y) OVER w - 2 * y + lag(y) OVER w AS b FROM filled WINDOW w AS (PARTITION BY shot_no ORDER BY frame)),
c AS (SELECT *, count(b) OVER w AS n, avg(b) OVER w AS m, min(b) OVER w AS lo FROM dd WINDOW w AS (PARTITION BY shot_no ORDER BY frame ROWS BETWEEN 3
  PRECEDING AND 3 FOLLOWING)),
flown AS (SELECT shot_no, frame, x, y, score, CASE WHEN state = 'visible' AND n = 7 AND m > 0.35 AND lo > -0.2 THEN 'in_flight' ELSE state END AS
  state FROM c)"""
_CODE = "CASE state WHEN 'visible' THEN 0 WHEN 'occluded' THEN 1 WHEN 'in_flight' THEN 2 WHEN 'held' THEN 3 ELSE 4 END"


def _flown(spark, d) -> DataFrame:
    return series.in_flight(_filled(spark, d), ["shot_no"])


@query(f"WITH {_FLIGHT} SELECT frame, state, CAST({_CODE} AS INTEGER) AS code, round(frame / CAST(25 AS DOUBLE), 2) AS seconds FROM flown")
def ball_codes(spark, d):
    """The ball's state as a number, and a frame's time in seconds."""
    return _flown(spark, d).select("frame", "state", pitch.ball_code(F.col("state")).alias("code"), pitch.seconds(F.col("frame"), src.FPS).alias("seconds"))


# Smoothing of known identities; unknown rows pass as they are.
_SMOOTH = f"""{_FUSED}, f AS (SELECT frame, identity_id, team, conf, px, py FROM j WHERE abs(px) <= 58.5 AND abs(py) <= 40),
b AS (SELECT *, CASE WHEN frame - lag(frame) OVER (PARTITION BY identity_id ORDER BY frame, px, py) = 1 THEN 0 ELSE 1 END AS n FROM f WHERE
  identity_id >= 0),
r AS (SELECT *, sum(n) OVER (PARTITION BY identity_id ORDER BY frame, px, py ROWS UNBOUNDED PRECEDING) AS run FROM b),
sm AS (SELECT frame, identity_id, team, conf, round(avg(px) OVER w, 9) AS x, round(avg(py) OVER w, 9) AS y FROM r WINDOW w AS (PARTITION BY
  identity_id, run ORDER BY frame, px, py ROWS BETWEEN 4 PRECEDING AND 4 FOLLOWING)
  UNION ALL SELECT frame, identity_id, team, conf, px, py FROM f WHERE identity_id < 0)"""


def _smooth(spark, d) -> DataFrame:
    rows = _fused(spark, d).filter("abs(px) <= 58.5 AND abs(py) <= 40")
    return pitch.smoothed(rows.select("frame", "identity_id", "team", "conf", "px", "py"))


@query(f"WITH {_SMOOTH} SELECT frame, identity_id, team, conf, x, y FROM sm")
def smoothed_positions(spark, d):
    """Positions averaged over nine rows of a run of an identity; those of unknown players as they are."""
    return _smooth(spark, d)


@query(f"""WITH {_SMOOTH} SELECT frame, CAST(to_json(list([CAST(identity_id AS DOUBLE), CAST(team AS DOUBLE), round_even(x, 1) + CAST(0 AS DOUBLE),
  round_even(y, 1) + CAST(0 AS DOUBLE), round_even(conf, 2)]
  ORDER BY identity_id, team, x, y)) AS VARCHAR) AS players FROM sm GROUP BY frame""")
def pitch2d_json(spark, d):
    """Per frame a JSON list of players: identity, team, position and confidence."""
    return pitch.players(_smooth(spark, d))


_BALL_XY = f"""{_FLIGHT}, g AS (SELECT frame, state, {g.inverse(projection.reference_camera(src.WIDTH, src.HEIGHT))!r} AS i, x, y FROM flown WHERE x IS NOT NULL),
w AS (SELECT frame, state, i[1]*x+i[2]*y+i[3] AS gx, i[4]*x+i[5]*y+i[6] AS gy, i[7]*x+i[8]*y+i[9] AS gw FROM g)"""


@query(f"""WITH {_BALL_XY} SELECT frame, round_even(gx / gw, 1) + CAST(0 AS DOUBLE) AS x, round_even(gy / gw, 1) + CAST(0 AS DOUBLE) AS y,
  CAST({_CODE} AS INTEGER) AS code FROM w WHERE gw <> 0 AND abs(gx / gw) <= 67.5 AND abs(gy / gw) <= 49""")
def pitch2d_ball(spark, d):
    """The ball on the ground plane with its state's number, as far as it lies near the pitch."""
    inverse = g.inverse(projection.reference_camera(src.WIDTH, src.HEIGHT))
    return pitch.ball_on_ground(_flown(spark, d), inverse)


@query()
def pitch2d_views(spark, d):
    """What the camera sees of the pitch, each fifth frame, as JSON polygons."""
    pan = src.detections(spark, d).filter("frame % 5 = 0").groupBy("frame").agg((F.avg("score") - 0.5).alias("pan"))
    seen = projection.footprints(pan.selectExpr("frame", "pan", "0.28D AS tilt", "900D AS focal", "0D AS cx", "-60D AS cy", "18D AS cz"), src.WIDTH, src.HEIGHT)
    return seen.select("frame", F.to_json(F.transform("polygon", lambda p: F.transform(p, lambda v: F.bround(v, 1)))).alias("view"))


@query("""WITH t AS (SELECT frame, track_id, (x1 + x2) / 2 AS x, y2 AS y FROM tracks)
SELECT frame, track_id, CAST(to_json(list([CAST(x AS DOUBLE), y]) OVER w) AS VARCHAR) AS trail FROM t WINDOW w AS (PARTITION BY track_id ORDER BY
  frame RANGE BETWEEN 50 PRECEDING AND CURRENT ROW)""")
def trail_positions(spark, d):
    """Where each track was in the last two seconds, in order of time."""
    t = src.tracks(spark, d).select("frame", "track_id", ((F.col("x1") + F.col("x2")) / 2).alias("x"), F.col("y2").alias("y"))
    return pitch.trails(t, ["track_id"], 2 * int(src.FPS))


@query(f"""WITH {_FLIGHT}, t AS (SELECT shot_no, frame, x, y FROM flown WHERE x IS NOT NULL)
SELECT shot_no, frame, CAST(to_json(list([x, y]) OVER w) AS VARCHAR) AS trail FROM t WINDOW w AS (PARTITION BY shot_no ORDER BY frame RANGE BETWEEN 25
  PRECEDING AND CURRENT ROW)""")
def ball_trail(spark, d):
    """Where the ball was in the last second."""
    t = _flown(spark, d).filter("x IS NOT NULL").select("shot_no", "frame", "x", "y")
    return pitch.trails(t, ["shot_no"], int(src.FPS))


# Overlays


@query(f"""WITH {_FUSED}, {_FLIGHT}, n AS (SELECT frame, count(*) AS n, sum(CASE WHEN identity_id = -1 THEN 1 ELSE 0 END) AS u FROM j GROUP BY frame)
SELECT b.frame, CASE WHEN x IS NULL THEN 'text' ELSE 'circle' END AS kind, CASE WHEN x IS NULL THEN 'ball: ' || state ELSE state END AS label,
  CAST(floor(x) AS BIGINT) AS x, CAST(floor(y) AS BIGINT) AS y FROM flown b
UNION ALL SELECT frame, 'footer', 'frame ' || frame || '  tracks ' || n || '  unknown ' || CAST(u AS BIGINT), NULL, NULL FROM n""")
def overlay_texts(spark, d):
    """The ball's mark and state, and a footer with each frame's counts."""
    return drawing.ball_marks(_flown(spark, d)).unionByName(drawing.footers(_fused(spark, d)))


@query("""WITH s AS (SELECT frame, team_online AS team, track_id, margin FROM tracks WHERE frame % 5 = 0), r AS (SELECT *, row_number() OVER
  (PARTITION BY frame ORDER BY team, track_id) AS line FROM s)
SELECT frame, line, team, track_id FROM r WHERE line <= 14""")
def roster_panel(spark, d):
    """The lines of the roster panel by team and identity, as many as fit."""
    rows = src.tracks(spark, d).filter("frame % 5 = 0").select("frame", F.col("team_online").alias("team"), "track_id")
    return drawing.panel(rows, "track_id", src.HEIGHT).select("frame", "line", "team", "track_id")


# Reports


@query("""WITH m AS (SELECT shot_no, 'detect' AS stage, 'n' AS k, CAST(count(*) AS DOUBLE) AS v FROM detections GROUP BY 1 UNION ALL SELECT shot_no,
  'track', 'tracks', CAST(count(DISTINCT track_id) AS DOUBLE) FROM tracks GROUP BY 1
  UNION ALL SELECT shot_no, 'track', 'frames', CAST(count(DISTINCT frame) AS DOUBLE) FROM tracks GROUP BY 1), l AS (SELECT stage, k, max_by(v,
    shot_no) AS v FROM m GROUP BY 1, 2)
SELECT max(CASE WHEN stage = 'detect' AND k = 'n' THEN v END) AS detect_n, max(CASE WHEN stage = 'track' AND k = 'tracks' THEN v END) AS track_tracks,
  max(CASE WHEN stage = 'track' AND k = 'frames' THEN v END) AS track_frames FROM l""")
def quality_card(spark, d):
    """The last shot's metrics as one row, from a manifest of stages."""
    det, t = src.detections(spark, d), src.tracks(spark, d)
    manifest = det.groupBy("shot_no").agg(F.create_map(F.lit("n"), F.count("*").cast("double")).alias("metrics")).withColumn("stage", F.lit("detect"))
    more = t.groupBy("shot_no").agg(F.create_map(F.lit("tracks"), F.countDistinct("track_id").cast("double"), F.lit("frames"), F.countDistinct("frame").cast("double")).alias("metrics"))
    manifest = manifest.unionByName(more.withColumn("stage", F.lit("track")))
    each = manifest.select("shot_no", "stage", F.explode("metrics").alias("k", "v"))
    last = each.groupBy(F.concat_ws("_", "stage", "k").alias("name")).agg(F.max_by("v", "shot_no").alias("v"))
    return last.groupBy().pivot("name", ["detect_n", "track_tracks", "track_frames"]).agg(F.first("v"))


# Files


@query("SELECT shot_no, track_id, team, n_frames, mean_margin FROM tracklets")
def table_sink(spark, d):
    """A table written, replaced and read back."""
    path = files.fresh(spark, "sink")
    rows = identity.summarize(src.tracks(spark, d)).select("shot_no", "track_id", "team", "n_frames", "mean_margin")
    files.write_table(rows.limit(1), path)
    files.write_table(rows, path)
    return spark.read.parquet(path)


@query("SELECT shot_no, track_id, n_frames, [lx, ly] AS last FROM tracklets")
def json_documents(spark, d):
    """Rows as JSON documents and back, arrays included."""
    path = files.fresh(spark, "json")
    rows = identity.summarize(src.tracks(spark, d)).select("shot_no", "track_id", "n_frames", F.array("lx", "ly").alias("last"))
    files.write_json(rows, path)
    return spark.read.schema(rows.schema).json(path)


@query("""SELECT 'shot_' || lpad(CAST(shot_no AS VARCHAR), 4, '0') AS shot_id, CASE WHEN shot_no % 2 = 0 THEN 's5_reid' ELSE 's4_track' END AS stage,
  count(*) AS n, min(frame) AS first_frame FROM tracks GROUP BY 1, 2""")
def shot_folders(spark, d):
    """Tables of many shot folders as one, shot and stage taken from the paths."""
    root = files.fresh(spark, "run")
    rows = src.tracks(spark, d).select("frame", "track_id", "shot_no")
    stage = F.when(F.col("shot_no") % 2 == 0, "s5_reid").otherwise("s4_track")
    rows = rows.withColumn("shot", F.format_string("shot_%04d", "shot_no")).withColumn("stage", stage).drop("shot_no")
    rows.repartition("shot").write.partitionBy("shot", "stage").parquet(root)
    read = files.read_tables(spark, root, rows.drop("shot", "stage").schema)
    per = read.groupBy("shot_id", "stage").agg(F.count("*").alias("n"), F.min("frame").alias("first_frame"))
    return per.select(F.regexp_replace("shot_id", "^.*=", "").alias("shot_id"), F.regexp_replace("stage", "^.*=", "").alias("stage"), "n", "first_frame")


@query("""SELECT 'shot_' || lpad(CAST(shot_no AS VARCHAR), 4, '0') AS shot_id, min(frame) AS start_frame, max(frame) AS end_frame FROM detections
  GROUP BY shot_no""")
def shots_table(spark, d):
    """Shots as JSON documents, read as a table."""
    path = files.fresh(spark, "shots")
    rows = src.detections(spark, d).groupBy("shot_no").agg(F.min("frame").alias("start_frame"), F.max("frame").alias("end_frame"))
    rows = rows.select(F.format_string("shot_%04d", "shot_no").alias("shot_id"), "start_frame", "end_frame")
    files.write_json(rows, path)
    return spark.read.schema(rows.schema).json(path)


@query("""SELECT shot_no, count(*) AS n, bit_xor(CAST('0x' || substr(md5(frame || '|' || track_id || '|' || CAST(x1 AS BIGINT) || '|' || CAST(y1 AS
  BIGINT)), 1, 15) AS BIGINT)) AS hash FROM tracks GROUP BY 1""")
def content_hash(spark, d):
    """A hash of each shot's boxes that the order of rows doesn't change."""
    t = src.tracks(spark, d).selectExpr("shot_no", "frame", "track_id", "CAST(x1 AS BIGINT) AS x1", "CAST(y1 AS BIGINT) AS y1")
    return files.content_hash(t, ["frame", "track_id", "x1", "y1"], ["shot_no"])


@query("""SELECT n_name || CASE WHEN n_nationkey % 3 = 0 THEN '/x' WHEN n_nationkey % 3 = 1 THEN '..' ELSE '' END AS run, n_nationkey % 3 = 2 AS
  valid, 'gs://runs/' || n_name || '/tier_a' AS path FROM nation""")
def run_paths(spark, d):
    """Which names of runs are safe, and paths below them."""
    n = src.table(spark, d, "nation")
    run = F.concat("n_name", F.when(F.col("n_nationkey") % 3 == 0, "/x").when(F.col("n_nationkey") % 3 == 1, "..").otherwise(""))
    return n.select(run.alias("run"), files.valid_run_id(run).alias("valid"), F.concat_ws("/", F.lit(files.joined("gs://runs/")), "n_name", F.lit("tier_a")).alias("path"))


@query("SELECT * FROM (VALUES ('events.parquet', 'PAR1', 'PAR1'), ('embeddings.parquet', 'PAR1', 'PAR1')) AS t(name, head, tail)")
def file_ends(spark, d):
    """The first and last bytes of files, by ranges; a table in a folder has a row for each kind of ends among all its files."""
    rows = []
    for name in ("events.parquet", "embeddings.parquet"):
        for path in files.parts(spark, files.joined(d, name)):
            n = files.size(spark, path)
            ends = (files.read_range(spark, path, 0, 3), files.read_range(spark, path, max(n - 4, 0), n + 99))
            rows.append((name, *(b.decode(errors="replace") for b in ends)))
    rows = sorted(set(rows), reverse=True)
    return spark.createDataFrame(rows, "name string, head string, tail string")
