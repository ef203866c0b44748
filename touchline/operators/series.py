"""Ordered operators on frame series: islands, folds, gap filling, rolling means, as-of and nearest look-ups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def islands(rows: DataFrame, keys: list[str], at: str, gap: int) -> DataFrame:
    """One row an island: keys, f0, f1; frames at most `gap` apart are of one island."""
    w = Window.partitionBy(*keys).orderBy(at)
    broken = F.when(F.col(at) - F.lag(at).over(w) <= gap, 0).otherwise(1)
    marked = rows.withColumn("_new", broken).withColumn("_island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(*keys, "_island").agg(F.min(at).alias("f0"), F.max(at).alias("f1")).drop("_island")


def thinned_cuts(cuts: DataFrame, keys: list[str], at: str, least: int) -> DataFrame:
    """Cuts that are at least `least` frames after the last accepted bound (0 at first): an ordered fold, not a lag."""
    fold = F.aggregate(
        F.array_sort(F.collect_set(at)), F.array(F.lit(0).cast("long")),
        lambda kept, c: F.when(c - F.element_at(kept, -1) >= least, F.concat(kept, F.array(c))).otherwise(kept),
    )
    return cuts.groupBy(*keys).agg(fold.alias("bounds"))


def fill_gaps(rows: DataFrame, keys: list[str], most: int, width: int, height: int, edge: float = 0.06) -> DataFrame:
    """Ball positions with a state: visible, occluded (interpolated over at most `most` frames), out_of_frame (lost near an
    edge) or unknown."""
    w = Window.partitionBy(*keys)
    # What follows is what precedes in falling order: a frame that ends at the partition's end would start anew at each row.
    past, future = (w.orderBy(o).rowsBetween(Window.unboundedPreceding, 0) for o in (F.col("frame").asc(), F.col("frame").desc()))
    seen = F.when(F.col("x").isNotNull(), F.struct("frame", "x", "y"))
    rows = rows.withColumn("_s", seen).withColumn("_p", F.last("_s", True).over(past)).withColumn("_q", F.last("_s", True).over(future))
    rows = rows.select("*", *(F.col(f"_{k}.{c}").alias(n) for k in "pq" for c, n in (("frame", k), ("x", f"{k}x"), ("y", f"{k}y"))))
    near = F.least(F.col("px"), F.lit(width) - F.col("px"), F.col("py"), F.lit(height) - F.col("py")) < edge * min(width, height)
    inside = F.col("p").isNotNull() & F.col("q").isNotNull()
    state = F.when(F.col("x").isNotNull(), "visible").when(inside & (F.col("q") - F.col("p") <= most), "occluded").when(inside & near, "out_of_frame").otherwise("unknown")
    share = (F.col("frame") - F.col("p")).cast("double") / F.nullif(F.col("q") - F.col("p"), F.lit(0)).cast("double")
    lerp = lambda c: F.when(F.col(c).isNotNull(), F.col(c)).when(F.col("state") == "occluded", F.col(f"p{c}") + (F.col(f"q{c}") - F.col(f"p{c}")) * share)
    return rows.withColumn("state", state).select(*keys, "frame", F.round(lerp("x"), 6).alias("x"), F.round(lerp("y"), 6).alias("y"), F.coalesce("score", F.lit(0.0)).alias("score"), "state")


def in_flight(filled: DataFrame, keys: list[str]) -> DataFrame:
    """Visible rows whose heights curve like a ball's flight over nine frames become in_flight."""
    w = Window.partitionBy(*keys).orderBy("frame")
    bend = F.lead("y").over(w) - 2 * F.col("y") + F.lag("y").over(w)
    around = w.rowsBetween(-3, 3)
    rows = filled.withColumn("_d", bend)
    curve = (F.count("_d").over(around) == 7) & (F.avg("_d").over(around) > 0.35) & (F.min("_d").over(around) > -0.2)
    return rows.withColumn("_c", curve).withColumn("state", F.when((F.col("state") == "visible") & F.col("_c"), "in_flight").otherwise(F.col("state"))).drop("_d", "_c")


def rolling_mean(rows: DataFrame, keys: list[str], columns: list[str], half: int = 4) -> DataFrame:
    """Centred means within runs of consecutive frames."""
    w = Window.partitionBy(*keys).orderBy("frame")
    rows = rows.withColumn("_b", F.when(F.col("frame") - F.lag("frame").over(w) == 1, 0).otherwise(1))
    rows = rows.withColumn("run", F.sum("_b").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_b")
    run = Window.partitionBy(*keys, "run").orderBy("frame").rowsBetween(-half, half)
    return rows.withColumns({c: F.round(F.avg(c).over(run), 6) for c in columns})


def asof(left: DataFrame, right: DataFrame, keys: list[str], at: str, columns: list[str]) -> DataFrame:
    """The last right row at or before each left row: a union and one window, no inequality join."""
    tagged = left.withColumn("_left", F.lit(1)).unionByName(right.select(*keys, at, F.struct(F.col(at).alias("at"), *columns).alias("_r")).withColumn("_left", F.lit(0)), allowMissingColumns=True)
    w = Window.partitionBy(*keys).orderBy(at, "_left").rowsBetween(Window.unboundedPreceding, 0)
    out = tagged.withColumn("_r", F.last("_r", True).over(w)).filter("_left = 1")
    return out.select(*left.columns, F.col("_r.at").alias("matched_at"), *[F.col(f"_r.{c}").alias(c) for c in columns])


def between(rows: DataFrame, knots: DataFrame, keys: list[str], at: str, value: str, chunk: int = 10_000) -> DataFrame:
    """For each row its knots before and after, the nearest one's distance, and the piecewise linear value (constant beyond the ends).

    Windows run over chunks of `chunk` frames; what a chunk gets from the ones before and behind it comes from a table of
    the chunks' first and last knots."""
    knot = F.struct(F.col(at).cast("long").alias("at"), F.col(value).cast("double").alias("v"))
    both = rows.select(*keys, at).withColumn("_k", F.lit(None).cast("struct<at:bigint,v:double>")).withColumn("_row", F.lit(1))
    both = both.unionByName(knots.select(*keys, at, knot.alias("_k")).withColumn("_row", F.lit(0))).withColumn("_chunk", F.floor(F.col(at) / chunk))
    per = both.groupBy(*keys, "_chunk").agg(F.min("_k").alias("_first"), F.max("_k").alias("_last"))
    order = Window.partitionBy(*keys)
    up, down = order.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1), order.orderBy(F.col("_chunk").desc()).rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(*keys, "_chunk", F.last("_last", True).over(up).alias("_before"), F.last("_first", True).over(down).alias("_behind"))
    w = Window.partitionBy(*keys, "_chunk")
    past, future = w.orderBy(at).rangeBetween(Window.unboundedPreceding, 0), w.orderBy(F.col(at).desc()).rangeBetween(Window.unboundedPreceding, 0)
    both = both.withColumn("p", F.max("_k").over(past)).withColumn("q", F.min("_k").over(future)).filter("_row = 1").join(per, [*keys, "_chunk"])
    both = both.withColumns({"p": F.coalesce("p", "_before"), "q": F.coalesce("q", "_behind")})
    share = (F.col(at) - F.col("p.at")).cast("double") / F.nullif(F.col("q.at") - F.col("p.at"), F.lit(0)).cast("double")
    lerp = F.coalesce(F.col("p.v") + (F.col("q.v") - F.col("p.v")) * share, "p.v", "q.v")
    near = F.least(F.col(at) - F.col("p.at"), F.col("q.at") - F.col(at))
    following = F.coalesce("q.at", "p.at")
    return both.select(*keys, at, near.alias("distance"), following.alias("next_or_last"), F.round(lerp, 6).alias("value"))
