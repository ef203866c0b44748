"""Linking tracklets into identities: belief, range-bucketed candidates, chains, cardinality and roster."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.vectors import dot, l1
from ..sources.files import settle

MOST_GAP = 750
ABSTAIN = 0.55


def summarize(tracks: DataFrame) -> DataFrame:
    """One row a tracklet."""
    return tracks.groupBy("shot_no", "track_id").agg(
        F.min("team_online").alias("team"), F.min("frame").alias("start_frame"), F.max("frame").alias("end_frame"), F.count("*").alias("n_frames"), F.min_by("cls", "frame").alias("cls"),
        F.round(F.avg("margin"), 6).alias("mean_margin"), F.round(F.avg(F.when(F.col("occl") > 0.3, 1.0).otherwise(0.0)), 6).alias("frac_occluded"), F.round(F.avg(F.col("y2") - F.col("y1")), 6).alias("mean_height_px"),
        (F.max_by(F.col("x1") + F.col("x2"), "frame") / 2).alias("lx"), F.max_by("y2", "frame").alias("ly"), (F.min_by(F.col("x1") + F.col("x2"), "frame") / 2).alias("fx"), F.min_by("y2", "frame").alias("fy"),
    )


def candidates(tracklets: DataFrame, most: int = MOST_GAP) -> DataFrame:
    """Pairs of one team in which b starts within `most` frames after a ends: an equi-join on team and frame bucket."""
    a = tracklets.withColumn("_bucket", F.floor(F.col("end_frame") / most))
    b = tracklets.withColumn("_bucket", F.explode(F.array(F.floor(F.col("start_frame") / most), F.floor(F.col("start_frame") / most) - 1)))
    gap = F.col("b.start_frame") - F.col("a.end_frame")
    return a.alias("a").join(b.alias("b"), (F.col("a.team") == F.col("b.team")) & (F.col("a._bucket") == F.col("b._bucket")) & gap.between(1, most)).withColumn("gap", gap)


def belief(gap, colour, cosine, dist, shorter):
    """The link belief; 0 where the colours are too far apart."""
    s_col = 1 - colour / 0.45
    s_reid = F.greatest(F.least((cosine - 0.75) / (0.92 - 0.75), F.lit(1.0)), F.lit(0.0))
    app = F.when(cosine.isNotNull(), 0.3 * s_col + 0.7 * s_reid).otherwise(s_col)
    near = F.exp(-F.greatest(dist - 12 * gap, F.lit(0.0)) / 300)
    raw = F.greatest(F.least(0.55 * app + 0.25 * F.exp(-gap / 250) + 0.20 * near, F.lit(1.0)), F.lit(0.0))
    return F.when(colour > 0.45, 0.0).otherwise(raw * (0.5 + 0.5 * F.least(F.lit(1.0), shorter / 15)))


def link_edges(tracklets: DataFrame, vectors: DataFrame, reid: bool = True) -> DataFrame:
    """Candidate links with a belief above 0: tracklets joined with vectors, pairs by team and bucket, each pair's distances
    computed once."""
    v = tracklets.join(vectors, F.pmod(F.col("track_id") * 7 + F.col("shot_no"), F.lit(500)) == F.col("vec_id"))
    return believed(candidates(v), reid)


def believed(pairs: DataFrame, reid: bool = True) -> DataFrame:
    """Pairs a, b with v and hist -> team, shot_a, track_a, shot_b, track_b, belief, where belief is above 0."""
    cosine = dot("a.v", "b.v") if reid else F.lit(None).cast("double")
    # The generator keeps the filter below from being pushed into the join, where the distances would be computed again.
    once = F.explode(F.array(F.struct(l1("a.hist", "b.hist").alias("colour"), cosine.alias("cosine"))))
    pairs = pairs.select(
        F.col("a.team").alias("team"), F.col("a.shot_no").alias("shot_a"), F.col("a.track_id").alias("track_a"), F.col("b.shot_no").alias("shot_b"), F.col("b.track_id").alias("track_b"),
        F.col("gap").cast("double").alias("gap"), F.hypot(F.col("a.lx") - F.col("b.fx"), F.col("a.ly") - F.col("b.fy")).alias("dist"),
        F.least("a.n_frames", "b.n_frames").cast("double").alias("shorter"), once.alias("x"),
    )
    value = belief(F.col("gap"), F.col("x.colour"), F.col("x.cosine"), F.col("dist"), F.col("shorter"))
    return pairs.filter("x.colour <= 0.45").select("team", "shot_a", "track_a", "shot_b", "track_b", F.round(value, 6).alias("belief")).filter("belief > 0")


#: Edges that the last, sequential step of a greedy choice takes at most, in one task.
LAST_EDGES = 50_000


def greedy_chain(edges: DataFrame, least: float = ABSTAIN, splits: DataFrame | None = None, segments: DataFrame | None = None) -> DataFrame:
    """Links by descending belief, each tracklet with one successor and one predecessor.

    Rounds of mutual best edges choose what a pass in order of belief would (ties by shots and tracks, so the order is
    total): an edge that is the best of both its ends is taken by that pass, whatever lies elsewhere. A round settles what
    is left; the rest is finished in order, once it is no more than LAST_EDGES.

    splits: links of crossings, like edges with their place in the order of decisions; they are committed first, whatever
    their belief and teams. segments (shot_no, track_id): what crossings split; only such links join them to others."""
    if segments is not None:
        for side in "ab":
            edges = edges.join(segments.select(F.col("shot_no").alias(f"shot_{side}"), F.col("track_id").alias(f"track_{side}")), [f"shot_{side}", f"track_{side}"], "left_anti")
    if splits is not None:
        # A segment is one link's successor, so links meet only at a predecessor.
        first = Window.partitionBy("shot_a", "track_a").orderBy("place", "shot_b", "track_b")
        splits = splits.withColumn("_k", F.row_number().over(first)).filter("_k = 1").select(*edges.columns)
        for side in "ab":
            edges = edges.join(splits.select(f"shot_{side}", f"track_{side}"), [f"shot_{side}", f"track_{side}"], "left_anti")
    columns = ["team", "shot_a", "track_a", "shot_b", "track_b", "belief"]
    left = settle(edges.select(*columns).filter(F.col("belief") >= least), "greedy-edges")
    place = F.struct(-F.col("belief"), "shot_a", "track_a", "shot_b", "track_b")
    chosen = []
    while left.count() > LAST_EDGES:
        of_a, of_b = Window.partitionBy("shot_a", "track_a"), Window.partitionBy("shot_b", "track_b")
        ranked = left.withColumn("_p", place).withColumn("_a", F.min("_p").over(of_a)).withColumn("_b", F.min("_p").over(of_b))
        ranked = ranked.withColumn("_taken", (F.col("_p") == F.col("_a")) & (F.col("_p") == F.col("_b")))
        ranked = ranked.withColumn("_gone", F.max("_taken").over(of_b)).withColumn("_gone", F.col("_gone") | F.max("_taken").over(of_a))
        ranked = settle(ranked.filter("_taken OR NOT _gone").select(*columns, "_taken"), "greedy-round")
        chosen.append(ranked.filter("_taken").select(*columns))
        left = ranked.filter("NOT _taken").select(*columns)

    def choose(group: pd.DataFrame) -> pd.DataFrame:
        after, before, kept = set(), set(), []
        order = group.sort_values(["belief", "shot_a", "track_a", "shot_b", "track_b"], ascending=[False, True, True, True, True])
        for k, r in zip(order.index, order.itertuples(), strict=True):
            a, b = (r.shot_a, r.track_a), (r.shot_b, r.track_b)
            if a not in after and b not in before:
                after.add(a)
                before.add(b)
                kept.append(k)
        return group.loc[sorted(kept)]

    out = left.withColumn("_all", F.lit(0)).groupBy("_all").applyInPandas(lambda g: choose(g.drop(columns="_all")), left.schema)
    for part in chosen:
        out = out.unionByName(part)
    return out if splits is None else out.unionByName(splits)


def chain_labels(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """nodes (node), links (node, pred, belief) -> node, root, confidence (the least belief from the root), by pointer
    jumping: each round doubles how far a node sees."""
    now = nodes.join(links, "node", "left").select("node", F.coalesce("pred", "node").alias("root"), F.coalesce("belief", F.lit(1.0)).alias("confidence"))
    now = settle(now, "chains")
    while True:
        up = now.select(F.col("node").alias("root"), F.col("root").alias("_r"), F.col("confidence").alias("_c"))
        then = now.join(up, "root").select("node", F.col("_r").alias("root"), F.least("confidence", "_c").alias("confidence"), (F.col("_r") != F.col("root")).alias("_moved"))
        then = settle(then, "chains")
        if not then.filter("_moved").limit(1).count():
            return then.drop("_moved")
        now = then.drop("_moved")


def concurrency(tracklets: DataFrame) -> DataFrame:
    """How many tracklets of a team run from each frame on: a sweep over starts and ends."""
    steps = tracklets.selectExpr("team", "start_frame AS frame", "1 AS step").unionAll(tracklets.selectExpr("team", "end_frame + 1", "-1"))
    steps = steps.groupBy("team", "frame").agg(F.sum("step").alias("step"))
    return steps.select("team", "frame", F.sum("step").over(Window.partitionBy("team").orderBy("frame").rowsBetween(Window.unboundedPreceding, 0)).alias("active"))


def demoted(tracklets: DataFrame, most: int, strength: str = "mean_margin") -> DataFrame:
    """Where a team has more than `most` at once, the weakest of those that overlap the span of violations, at least one."""
    bad = concurrency(tracklets).filter(F.col("active") > most).groupBy("team").agg(F.min("frame").alias("f0"), F.max("frame").alias("f1"))
    hit = tracklets.join(F.broadcast(bad), "team").filter("start_frame <= f1 AND end_frame >= f0")  # one row a team
    w = Window.partitionBy("team")
    ranked = hit.withColumn("n", F.count("*").over(w)).withColumn("rn", F.row_number().over(w.orderBy(strength, "shot_no", "track_id")))
    return ranked.filter(F.col("rn") <= F.greatest(F.lit(1), F.col("n") - most)).select("team", "shot_no", "track_id", strength)


def roster(tracklets: DataFrame, stride: int = 5, uncertain: int = 250) -> DataFrame:
    """State of each track at every stride-th frame: visible, off_frame or uncertain, with where it was last seen."""
    spans = tracklets.select("track_id", "team", "start_frame", "end_frame", "lx", "ly")
    w = Window.partitionBy("track_id").orderBy("start_frame")
    spans = spans.withColumn("until", F.coalesce(F.lead("start_frame").over(w) - 1, F.lit(1 << 60)))
    for c in ("end_frame", "lx", "ly"):
        spans = spans.withColumn(f"prev_{c}", F.lag(c).over(w))
    # Spans of a track follow one another, so each frame falls in one interval from a start to the next.
    hi = tracklets.agg(F.max("end_frame")).first()[0]
    spans = spans.withColumn("frame", F.explode(F.sequence("start_frame", F.least("until", F.lit(hi).cast("long"))))).filter(F.col("frame") % stride == 0)
    seen = F.col("frame") <= F.col("end_frame")
    since = F.when(seen, 0).otherwise(F.col("frame") - F.col("end_frame"))
    state = F.when(seen, "visible").when(since > uncertain, "uncertain").otherwise("off_frame")
    return spans.select("frame", "track_id", "team", state.alias("state"), F.when(seen, F.col("prev_lx")).otherwise(F.col("lx")).alias("last_x"), F.when(seen, F.col("prev_ly")).otherwise(F.col("ly")).alias("last_y"), since.cast("long").alias("frames_since_seen"))
