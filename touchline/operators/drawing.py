"""Overlays as tables: one row a primitive, for any renderer."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# The confidence above which boxes are thick, and the link error above which a box gets a dot.
THICK_FROM, DOT_FROM = 0.75, 0.25


def draw_list(fused: DataFrame, fps: int = 25) -> DataFrame:
    """fused (frame, identity_id, team, x1 .. y2, conf, link_err_p, reentry) -> boxes, flashes and dots, with labels.

    Abstained rows (identity -1) have the team colour -1, a thin box and "?". An identity's rows flash from a re-entry on
    for `fps` of its rows. percent: the confidence a label shows, in hundredths; null for abstained rows.
    """
    known = F.col("identity_id") != -1
    # Abstained rows never flash: they needn't meet in one partition.
    order = Window.partitionBy("identity_id", F.when(known, 0).otherwise(F.col("frame"))).orderBy("frame", "x1", "y1", "x2", "y2")
    past = order.rowsBetween(Window.unboundedPreceding, 0)
    rows = fused.withColumn("_n", F.row_number().over(order))
    rows = rows.withColumn("_since", F.col("_n") - F.max(F.when(F.col("reentry") == 1, F.col("_n"))).over(past))
    rows = rows.withColumn("_flash", F.coalesce(known & (F.col("_since") < fps), F.lit(False)))
    colour = F.when(known, F.col("team")).otherwise(-1)
    label = F.when(~known, "?").otherwise(F.concat(F.when(F.col("_flash"), "<- ").otherwise(""), F.col("identity_id").cast("string")))
    box = F.struct(F.lit("box").alias("kind"), F.when(known & (F.col("conf") > THICK_FROM), 2).otherwise(1).alias("thickness"), label.alias("label"))
    more = lambda kind, n: F.struct(F.lit(kind).alias("kind"), F.lit(n).alias("thickness"), F.lit(None).cast("string").alias("label"))
    parts = F.array_compact(F.array(box, F.when(F.col("_flash"), more("flash", 2)), F.when(known & (F.col("link_err_p") > DOT_FROM), more("dot", 1))))
    told = rows.withColumn("_p", F.explode(parts))
    pad = F.when(F.col("_p.kind") == "flash", 4).otherwise(0)
    percent = F.when((F.col("_p.kind") == "box") & known, F.floor(F.col("conf") * 100 + 0.5))
    return told.select("frame", "identity_id", colour.alias("colour"), F.col("_p.kind").alias("kind"), F.col("_p.thickness").alias("thickness"), F.col("_p.label").alias("label"), percent.alias("percent"),
        (F.col("x1") - pad).alias("x1"), (F.col("y1") - pad).alias("y1"), (F.col("x2") + pad).alias("x2"), (F.col("y2") + pad).alias("y2"))


# The roster panel's first line, its line height and what it leaves free below, in pixels.
FIRST_LINE, LINE, BELOW = 50, 18, 70


def ball_marks(balls: DataFrame) -> DataFrame:
    """balls (frame, x, y, state) -> a circle with the state where the ball is, else a line of text."""
    seen = F.col("x").isNotNull()
    return balls.select(
        "frame", F.when(seen, "circle").otherwise("text").alias("kind"), F.when(seen, F.col("state")).otherwise(F.concat(F.lit("ball: "), "state")).alias("label"), F.floor("x").alias("x"), F.floor("y").alias("y"),
    )


def footers(fused: DataFrame) -> DataFrame:
    """A line a frame: how many tracks it has, and how many of them are unknown."""
    per = fused.groupBy("frame").agg(F.count("*").alias("n"), F.sum((F.col("identity_id") == -1).cast("long")).alias("u"))
    label = F.format_string("frame %d  tracks %d  unknown %d", "frame", "n", "u")
    none = F.lit(None).cast("long")
    return per.select("frame", F.lit("footer").alias("kind"), label.alias("label"), none.alias("x"), none.alias("y"))


def panel(rows: DataFrame, identity: str, height: int) -> DataFrame:
    """rows (frame, team, identity, ...) with line, their place in the frame's roster panel, as far as the panel goes."""
    lines = (height - BELOW - FIRST_LINE) // LINE + 1
    order = Window.partitionBy("frame").orderBy("team", identity)
    return rows.withColumn("line", F.row_number().over(order).cast("long")).filter(F.col("line") <= lines)
