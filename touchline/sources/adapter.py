"""Tracking tables derived from an event table: events play the role of raw detections."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WIDTH, HEIGHT, FPS = 640, 360, 25.0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").selectExpr("event_id AS det_id", "event_id div 10 AS frame", "event_id div 1000 AS shot_no", "user_id % 40 AS track_id", "event_type")
    return e.selectExpr(
        "det_id", "frame", "shot_no", "track_id",
        "CAST((track_id * 43 + frame * 3) % 600 + (det_id * 29) % 25 AS DOUBLE) AS x1",
        "CAST((track_id * 61 + frame) % 300 + (det_id * 47) % 15 AS DOUBLE) AS y1",
        "18 + det_id % 30 AS w", "44 + det_id % 60 AS h",
        "CAST((det_id * 31) % 100 AS DOUBLE) / CAST(100 AS DOUBLE) AS score",
        "CASE WHEN event_type = 'signup' THEN 'ball' ELSE 'player' END AS cls",
    ).selectExpr("det_id", "frame", "shot_no", "track_id", "x1", "y1", "x1 + w AS x2", "y1 + h AS y2", "score", "cls")


def tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best person box of each frame and track."""
    best = Window.partitionBy("frame", "track_id").orderBy(F.col("score").desc(), "det_id")
    rows = detections(spark, sf_dir).filter("cls <> 'ball'").withColumn("rn", F.row_number().over(best)).filter("rn = 1").drop("rn")
    return rows.withColumns({
        "occl": F.expr("CAST((det_id * 17) % 100 AS DOUBLE) / CAST(100 AS DOUBLE)"),
        "margin": F.expr("CAST((det_id * 13) % 100 AS DOUBLE) / CAST(100 AS DOUBLE)"), "team_online": F.expr("track_id % 2"),
    })


def balls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best ball of each frame at a score of 0.2 or more, over the dense frames of each shot; null where none is seen."""
    d = detections(spark, sf_dir)
    best = Window.partitionBy("frame").orderBy(F.col("score").desc(), "det_id")
    seen = d.filter("cls = 'ball' AND score >= 0.2").withColumn("rn", F.row_number().over(best)).filter("rn = 1")
    seen = seen.selectExpr("frame", "(x1 + x2) / 2 AS x", "(y1 + y2) / 2 AS y", "score")
    spine = d.groupBy("shot_no").agg(F.min("frame").alias("a"), F.max("frame").alias("b")).select("shot_no", F.explode(F.sequence("a", "b")).alias("frame"))
    return spine.join(seen, "frame", "left").select("shot_no", "frame", "x", "y", "score")


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, v (unit vectors as doubles), hist (their absolute values, normalised to sum 1)."""
    v = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    total = F.aggregate("v", F.lit(0.0), lambda s, x: s + F.abs(x))
    return v.withColumn("_t", total).select("vec_id", "v", F.transform("v", lambda x: F.abs(x) / F.col("_t")).alias("hist"))


#: A camera a frame, turning to and fro, and how well it fits: the same expressions for Spark and DuckDB.
CAMERA_COLUMNS = (
    "frame", "CAST(0 AS DOUBLE) AS cx", "CAST(-60 AS DOUBLE) AS cy", "CAST(18 AS DOUBLE) AS cz", "(CAST((frame * 37) % 100 AS DOUBLE) - 50) / 200 AS pan", "CAST(0.28 AS DOUBLE) AS tilt",
    "CAST(900 AS DOUBLE) AS f", "CAST((frame * 41) % 100 AS DOUBLE) / 100 AS coverage", "CAST((frame * 13) % 50 AS DOUBLE) / 10 AS err_px", "CAST((frame * 29) % 100 AS DOUBLE) / 100 AS explained",
)
CALIBRATION = f"SELECT {', '.join(CAMERA_COLUMNS)}"


def calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detections(spark, sf_dir).select("frame").distinct().selectExpr(*CAMERA_COLUMNS)


#: The same tables as common table expressions for DuckDB.
VIEWS = """
detections AS (SELECT det_id, frame, shot_no, track_id, x1, y1, x1+w AS x2, y1+h AS y2, score, cls FROM (
 SELECT event_id AS det_id, CAST(floor(event_id/10) AS BIGINT) AS frame, CAST(floor(event_id/1000) AS BIGINT) AS shot_no, user_id%40 AS track_id,
  CAST(((user_id%40)*43+CAST(floor(event_id/10) AS BIGINT)*3)%600+(event_id*29)%25 AS DOUBLE) AS x1,
  CAST(((user_id%40)*61+CAST(floor(event_id/10) AS BIGINT))%300+(event_id*47)%15 AS DOUBLE) AS y1,
  18+event_id%30 AS w, 44+event_id%60 AS h, CAST((event_id*31)%100 AS DOUBLE)/CAST(100 AS DOUBLE) AS score,
  CASE WHEN event_type='signup' THEN 'ball' ELSE 'player' END AS cls FROM events) d0),
tracks AS (SELECT det_id,frame,shot_no,track_id,x1,y1,x2,y2,score,cls, CAST((det_id*17)%100 AS DOUBLE)/CAST(100 AS DOUBLE) AS occl,
  CAST((det_id*13)%100 AS DOUBLE)/CAST(100 AS DOUBLE) AS margin, track_id%2 AS team_online
 FROM (SELECT *, row_number() OVER (PARTITION BY frame,track_id ORDER BY score DESC, det_id) rn FROM detections WHERE cls<>'ball') q WHERE rn=1),
spine AS (SELECT shot_no, unnest(range(a, b+1)) AS frame FROM (SELECT shot_no, min(frame) a, max(frame) b FROM detections GROUP BY shot_no)),
balls AS (SELECT s.shot_no, s.frame, x, y, score FROM spine s LEFT JOIN (SELECT frame, (x1+x2)/2 AS x, (y1+y2)/2 AS y, score FROM (
  SELECT *, row_number() OVER (PARTITION BY frame ORDER BY score DESC, det_id) rn FROM detections WHERE cls='ball' AND score>=0.2) WHERE rn=1) b ON s.frame=b.frame),
tracklets AS (SELECT shot_no, track_id, min(team_online) team, min(frame) start_frame, max(frame) end_frame, count(*) n_frames, arg_min(cls, frame) cls,
  round(avg(margin),6) mean_margin, round(avg(CAST(CASE WHEN occl>0.3 THEN 1 ELSE 0 END AS DOUBLE)),6) frac_occluded, round(avg(y2-y1),6) mean_height_px,
  max_by(x1+x2,frame)/2 lx, max_by(y2,frame) ly, min_by(x1+x2,frame)/2 fx, min_by(y2,frame) fy FROM tracks t GROUP BY shot_no, track_id)
"""
