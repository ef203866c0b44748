"""From tracks to identities and positions: the tracklet table, staff, identities, rosters by identity, and fused rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as g
from . import calibration, identity

# Staff stand beyond the lines in this share of at least so many frames; metres beyond a line that count as
# beyond; rows under which a lone tracklet is unknown; the most confidence of an unresolved split; players a team.
STAFF_SHARE, STAFF_FRAMES, BEYOND = 0.7, 10, 0.2
SHORT, SPLIT_CONFIDENCE, MOST_A_TEAM = 15, 0.3, 11
LINK_SHARPNESS, LEAST_LINK, MOST_LINK = 6.0, 0.01, 0.5


def tracklet_table(tracks: DataFrame, appearance: DataFrame, reid: DataFrame, splits: DataFrame, calib: DataFrame) -> DataFrame:
    """One row a tracklet of tracks (shot_no, track_id, frame, boxes, cls, margin, occl, swap_conf), with what other tables
    know of it, or defaults: appearance (app_embedding, app_weight), reid (reid_embedding), splits (split_frame, cands); and
    from calib (frame, valid, h0..h8) where it begins and ends on the pitch and its share of frames beyond the lines."""
    keys = ["shot_no", "track_id"]
    x, y = calibration.on_ground(calib, (F.col("x1") + F.col("x2")) / 2, F.col("y2"))
    rows = tracks.join(calib, "frame", "left").withColumns({"px": F.when(F.col("valid"), x), "py": F.when(F.col("valid"), y)})
    box = F.array("x1", "y1", "x2", "y2")
    beyond = (F.abs("px") > g.PITCH_LENGTH / 2 + BEYOND) | (F.abs("py") > g.PITCH_WIDTH / 2 + BEYOND)
    at = lambda f, c: f(F.struct(box.alias("box"), "px", "py", "cls"), "frame").alias(c)
    per = rows.groupBy(*keys).agg(
        F.min("frame").alias("start_frame"), F.max("frame").alias("end_frame"), F.count("*").alias("n_frames"), at(F.min_by, "a"), at(F.max_by, "b"),
        F.min("swap_conf").alias("min_swap_conf"), F.avg("margin").alias("mean_margin"), F.avg((F.col("occl") > 0.3).cast("double")).alias("frac_occluded"),
        F.avg(F.col("y2") - F.col("y1")).alias("mean_height_px"), F.coalesce(F.avg(F.col("valid").cast("double")), F.lit(0.0)).alias("calib_frac"),
        F.when(F.count("px") >= 10, F.bround(F.avg(beyond.cast("double")), 3)).otherwise(-1.0).alias("beyond_frac"),
    )
    out = per.join(appearance, keys, "left").join(reid, keys, "left").join(splits, keys, "left")
    return out.select(
        *keys, "start_frame", "end_frame", "n_frames", "a.cls", F.to_json(F.coalesce(F.transform("app_embedding", lambda v: F.bround(v, 5)), F.array(F.lit(0.0)))).alias("app_embedding"),
        F.coalesce("app_weight", F.lit(0.0)).alias("app_weight"), F.to_json("a.box").alias("first_box"), F.to_json("b.box").alias("last_box"),
        F.col("a.px").alias("first_px"), F.col("a.py").alias("first_py"), F.col("b.px").alias("last_px"), F.col("b.py").alias("last_py"),
        F.to_json(F.transform("reid_embedding", lambda v: F.bround(v, 4))).alias("reid_embedding"), "min_swap_conf", F.to_json("cands").alias("split_candidates"), F.coalesce("split_frame", F.lit(-1)).cast("long").alias("split_frame"),
        "mean_margin", "frac_occluded", "mean_height_px", "calib_frac", "beyond_frac",
    )


def staff(tracklets: DataFrame) -> DataFrame:
    """The tracklets that are staff; the others are what a left_anti join leaves."""
    return tracklets.filter((F.col("beyond_frac") >= STAFF_SHARE) & (F.col("n_frames") >= STAFF_FRAMES))


def identities(tracklets: DataFrame, links: DataFrame, unresolved: DataFrame | None = None, teams: int = 2, most: int = MOST_A_TEAM) -> DataFrame:
    """tracklets (node, team, n_frames, start_frame, end_frame), links (node, pred, belief) -> node, identity_id (1 to n, in
    order of the identities' first nodes), confidence (the least belief up to the node) and abstained.

    A tracklet alone in its identity abstains if it is short; of a team that has more than `most` at once the least
    confident that overlap the span of violations abstain too (officials' teams aside). unresolved (node): segments of
    crossings without a predecessor, of low confidence."""
    labels = identity.chain_labels(tracklets.select("node"), links)
    # Roots are few against rows, but not bounded: their order is a window over one row an identity, by ranges of nodes.
    roots = numbered(labels.select("root").distinct(), "root", "identity_id")
    out = labels.join(roots, "root").join(tracklets, "node")
    confidence = F.col("confidence")
    if unresolved is not None:
        out = out.join(unresolved.select("node").distinct().withColumn("_cut", F.lit(True)), "node", "left")
        confidence = F.when(F.col("_cut") & (F.col("node") == F.col("root")), F.least(confidence, F.lit(SPLIT_CONFIDENCE))).otherwise(confidence)
    alone = F.count("*").over(Window.partitionBy("identity_id")) == 1
    out = out.withColumn("confidence", confidence).withColumn("abstained", alone & (F.col("n_frames") < SHORT))
    players = out.filter(~F.col("abstained") & F.col("team").between(0, teams - 1))
    # A step of the sweep holds until the next one: the span of violations ends a frame before it falls.
    steps = identity.concurrency(players).withColumn("_next", F.lead("frame").over(Window.partitionBy("team").orderBy("frame")))
    bad = steps.filter(F.col("active") > most).groupBy("team").agg(F.min("frame").alias("f0"), F.max(F.col("_next") - 1).alias("f1"))
    over = players.join(F.broadcast(bad), "team").filter("start_frame <= f1 AND end_frame >= f0")  # one row a team
    of = Window.partitionBy("team")
    weak = over.withColumn("_n", F.count("*").over(of)).withColumn("_r", F.row_number().over(of.orderBy("confidence", "node")))
    weak = weak.filter(F.col("_r") <= F.greatest(F.lit(1), F.col("_n") - most)).select("node", F.lit(True).alias("_weak"))
    out = out.join(weak, "node", "left").withColumn("abstained", F.col("abstained") | F.coalesce("_weak", F.lit(False)))
    return out.select("node", "identity_id", "team", "confidence", "abstained", "n_frames", "start_frame", "end_frame")


def numbered(rows: DataFrame, order: str, name: str, first: int = 1) -> DataFrame:
    """rows with their places in the order of a column of distinct values, without bringing them to one task."""
    from ..sources.files import settle

    ranged = settle(rows.repartitionByRange(order).withColumn("_part", F.spark_partition_id()), "numbered")
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = ranged.groupBy("_part").agg(F.count("*").alias("_n")).withColumn("_before", F.coalesce(before, F.lit(0)))  # one row a range
    placed = ranged.join(F.broadcast(offsets.drop("_n")), "_part")
    place = F.row_number().over(Window.partitionBy("_part").orderBy(order)) + F.col("_before") + (first - 1)
    return placed.withColumn(name, place.cast("long")).drop("_part", "_before")


def roster(spans: DataFrame, stride: int = 5, uncertain: int = 250) -> DataFrame:
    """spans (identity_id, team, start_frame, end_frame, lx, ly), which may overlap -> a row every stride-th frame from an
    identity's first appearance on to the last frame of all: its state, and where and how long ago an earlier span ended.

    Spans and frames meet in one window an identity and chunk of frames; the last ended span is carried over."""
    lo, hi = spans.agg(F.min("start_frame"), F.max("end_frame")).first()
    if lo is None:
        return spans.sparkSession.createDataFrame([], "frame long, identity_id long, team long, state string, last_x double, last_y double, frames_since_seen long")
    first = spans.groupBy("identity_id").agg(F.min("start_frame").alias("_from"), F.min_by("team", "start_frame").alias("team"))
    grid = first.withColumn("frame", F.explode(F.sequence(F.lit(lo).cast("long"), F.lit(hi).cast("long"), F.lit(stride).cast("long")))).filter(F.col("frame") >= F.col("_from"))
    # Of the spans that have begun by a frame: the furthest end (visible if not yet reached), and of the ended ones in order of
    # their starts the last one.
    events = grid.select("identity_id", "team", F.col("frame").alias("at"), F.lit(2).alias("kind"), F.lit(None).cast("long").alias("start"), F.lit(None).cast("long").alias("end"), F.lit(None).cast("double").alias("lx"), F.lit(None).cast("double").alias("ly"))
    begun = spans.select("identity_id", F.lit(None).cast("long").alias("team"), F.col("start_frame").alias("at"), F.lit(0).alias("kind"), F.col("start_frame").alias("start"), F.col("end_frame").alias("end"), "lx", "ly")
    ended = begun.withColumn("at", F.col("end") + 1).withColumn("kind", F.lit(1))
    rows = events.unionByName(begun).unionByName(ended)
    past = Window.partitionBy("identity_id").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, 0)
    reach = F.max(F.when(F.col("kind") == 0, F.col("end"))).over(past)
    last = F.max(F.when(F.col("kind") == 1, F.struct("start", "end", "lx", "ly"))).over(past)
    rows = rows.withColumn("_reach", reach).withColumn("_last", last).filter("kind = 2")
    seen = F.col("_reach") >= F.col("at")
    since = F.when(seen, 0).otherwise(F.col("at") - F.col("_last.end"))
    state = F.when(seen, "visible").when(since > uncertain, "uncertain").otherwise("off_frame")
    return rows.select(F.col("at").alias("frame"), "identity_id", "team", state.alias("state"), F.col("_last.lx").alias("last_x"), F.col("_last.ly").alias("last_y"), since.cast("long").alias("frames_since_seen"))


def fused(tracks: DataFrame, known: DataFrame) -> DataFrame:
    """tracks (shot_no, track_id, frame, boxes, margin, swap_conf), known (shot_no, track_id, identity_id, team, confidence,
    abstained, start_frame) -> a row a box: identity -1 and confidence 0 where abstained; reentry on the first row of an
    identity's later tracklets. Tracks without an identity are left out."""
    later = F.row_number().over(Window.partitionBy("identity_id").orderBy("start_frame", "shot_no", "track_id")) > 1
    rows = tracks.join(known.withColumn("_later", later), ["shot_no", "track_id"])
    first = F.row_number().over(Window.partitionBy("shot_no", "track_id").orderBy("frame")) == 1
    err = F.greatest(F.least(MOST_LINK * F.exp(-LINK_SHARPNESS * F.col("margin")), F.lit(MOST_LINK)), F.lit(LEAST_LINK))
    out = F.col("abstained")
    return rows.select(
        "shot_no", "track_id", "frame", F.when(out, F.lit(-1)).otherwise(F.col("identity_id")).cast("long").alias("identity_id"), "team", "x1", "y1", "x2", "y2",
        F.when(out, 0.0).otherwise(F.least("confidence", "swap_conf")).alias("conf"), err.alias("link_err_p"), (F.col("_later") & ~out & first).cast("int").alias("reentry"),
    )
