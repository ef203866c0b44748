"""A match from detections to identities, rosters and fused rows, as stages of a run folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import assembly, crossings, identity, sequence, series
from .runner import Stage

#: What a match's configuration may set, with what holds otherwise.
DEFAULTS = {
    "width": 1920, "height": 1080, "fps": 25, "person_min_height_px": 30.0, "score_high": 0.5, "ball_score": 0.2, "ball_gap": 20, "teams": 2,
    "link_max_gap_frames": 750, "abstain_below": 0.55, "max_per_team": 11, "crossing_look": 100, "swap_margin": 1.5, "swap_motion_weight": 0.03,
}


def _detections(spark: SparkSession, _: dict[str, DataFrame], c: dict) -> DataFrame:
    rows = spark.read.parquet(c["detections"])
    return rows.filter((F.col("cls") == "ball") | (F.col("y2") - F.col("y1") >= c["person_min_height_px"]))


def _tracks(spark: SparkSession, t: dict[str, DataFrame], c: dict) -> DataFrame:
    return sequence.track(t["detections"].filter("cls <> 'ball'"), high=c["score_high"])


def _ball(spark: SparkSession, t: dict[str, DataFrame], c: dict) -> DataFrame:
    """The ball's place and state in every frame of a shot."""
    seen = sequence.gate_ball(t["detections"].filter((F.col("cls") == "ball") & (F.col("score") >= c["ball_score"])))
    spine = t["detections"].groupBy("shot_no").agg(F.min("frame").alias("a"), F.max("frame").alias("b")).select("shot_no", F.explode(F.sequence("a", "b")).alias("frame"))
    filled = series.fill_gaps(spine.join(seen, ["shot_no", "frame"], "left"), ["shot_no"], c["ball_gap"], c["width"], c["height"])
    return series.in_flight(filled, ["shot_no"])


def _outcomes(spark: SparkSession, t: dict[str, DataFrame], c: dict) -> DataFrame:
    """Decisions on crossings, and the rows of tracks under the labels they give. Appearance vectors (emb) are optional."""
    rows = t["tracks"] if "emb" in t["tracks"].columns else t["tracks"].withColumn("emb", F.lit(None).cast("array<double>"))
    windows = crossings.ambiguous(rows, keys=("shot_no",))
    return crossings.resolve(rows.select("shot_no", "frame", "track_id", "x1", "y1", "x2", "y2", "emb"), windows, c["crossing_look"], c["swap_margin"], c["swap_motion_weight"])


def _relabelled(spark: SparkSession, t: dict[str, DataFrame], c: dict) -> DataFrame:
    """Tracks under their new labels, with the confidence that crossings leave them."""
    new = crossings.relabelled(t["outcomes"]).withColumnRenamed("track_id", "_new")
    own = t["tracks"].withColumnRenamed("track_id", "raw_track_id").withColumn("cls", F.lit("player"))
    return own.join(new, ["shot_no", "frame", "raw_track_id"]).withColumnRenamed("_new", "track_id").withColumnRenamed("team_online", "_team").withColumn("team_online", F.col("_team")).drop("_team")


def _appearance(spark: SparkSession, t: dict[str, DataFrame], c: dict) -> DataFrame:
    """One row a label: its colours and their weight; labels that crossings made inherit them."""
    rows = t["relabelled"]
    app = t["tracks"].filter("app IS NOT NULL").select("shot_no", "track_id", F.col("app").alias("hist"), F.col("app_weight").alias("weight"))
    app = app.join(t["tracks"].groupBy("shot_no", "track_id").agg(F.count("*").alias("n_frames")), ["shot_no", "track_id"])
    return crossings.inherited(app, rows.select("shot_no", "raw_track_id", "track_id"))


def _tracklets(spark: SparkSession, t: dict[str, DataFrame], c: dict) -> DataFrame:
    """Summaries with node numbers in order of their starts, colours, and teams by weighted clusters of the colours."""
    rows = identity.summarize(t["relabelled"]).drop("team").join(t["appearance"].drop("n_frames"), ["shot_no", "track_id"])
    rows = assembly.numbered(rows.withColumn("_place", F.struct("start_frame", "shot_no", "track_id")), "_place", "node", 0).drop("_place")
    teams = sequence.cluster_teams(rows.select(F.col("node").alias("vec_id"), F.col("hist").alias("v"), F.col("weight").alias("w")), c["teams"])
    return rows.join(teams.withColumnsRenamed({"vec_id": "node"}), "node")


def _links(spark: SparkSession, t: dict[str, DataFrame], c: dict) -> DataFrame:
    rows = t["tracklets"].withColumn("v", F.lit(None).cast("array<double>"))
    split = crossings.splits(t["outcomes"]).select("shot_no", "track_id")
    free = rows.join(split, ["shot_no", "track_id"], "left_anti")
    edges = identity.believed(identity.candidates(free, c["link_max_gap_frames"]), reid=False)
    return identity.greedy_chain(edges, c["abstain_below"])


def _identities(spark: SparkSession, t: dict[str, DataFrame], c: dict) -> DataFrame:
    nodes = t["tracklets"]
    side = lambda s, n: nodes.select(F.col("shot_no").alias(f"shot_{s}"), F.col("track_id").alias(f"track_{s}"), F.col("node").alias(n))
    links = t["links"].join(side("a", "pred"), ["shot_a", "track_a"]).join(side("b", "node"), ["shot_b", "track_b"]).select("node", "pred", "belief")
    cut = crossings.splits(t["outcomes"]).join(nodes, ["shot_no", "track_id"]).select("node")
    found = assembly.identities(nodes.select("node", "team", "n_frames", "start_frame", "end_frame"), links, cut, c["teams"], c["max_per_team"])
    return found.join(nodes.select("node", "shot_no", "track_id", "lx", "ly"), "node")


def _roster(spark: SparkSession, t: dict[str, DataFrame], c: dict) -> DataFrame:
    return assembly.roster(t["identities"].filter("NOT abstained"))


def _fused(spark: SparkSession, t: dict[str, DataFrame], c: dict) -> DataFrame:
    known = t["identities"].select("shot_no", "track_id", "identity_id", "team", "confidence", "abstained", "start_frame")
    return assembly.fused(t["relabelled"], known)


_STEPS = (
    ("detections", _detections, ()), ("tracks", _tracks, ("detections",)), ("ball", _ball, ("detections",)), ("outcomes", _outcomes, ("tracks",)), ("relabelled", _relabelled, ("tracks", "outcomes")),
    ("appearance", _appearance, ("tracks", "relabelled")), ("tracklets", _tracklets, ("relabelled", "appearance")), ("links", _links, ("tracklets", "outcomes")),
    ("identities", _identities, ("tracklets", "links", "outcomes")), ("roster", _roster, ("identities",)), ("fused", _fused, ("relabelled", "identities")),
)


def stages(config: dict) -> list[Stage]:
    """The stages of a match; config has detections (a path to det_id, shot_no, frame, boxes, score, cls, hist) and what differs from DEFAULTS."""
    whole = DEFAULTS | config
    return [Stage(name, run, reads, whole) for name, run, reads in _STEPS]
