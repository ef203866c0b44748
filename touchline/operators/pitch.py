"""The pitch view: smoothed positions, players and ball per frame, trails."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as g

# Numbers of the ball's states, the last for all others; metres beyond the lines at which a ball is shown.
BALL_CODES, OTHER_CODE = {"visible": 0, "occluded": 1, "in_flight": 2, "held": 3}, 4
BALL_MARGIN = 15.0


def ball_code(state: Column) -> Column:
    code = F.lit(OTHER_CODE)
    for name, n in BALL_CODES.items():
        code = F.when(state == name, n).otherwise(code)
    return code


def seconds(frame: Column, fps: float) -> Column:
    return F.round(frame / F.lit(float(fps)), 2)


def smoothed(rows: DataFrame, half: int = 4) -> DataFrame:
    """rows (frame, identity_id, team, conf, px, py) -> x, y: of known identities the mean of 2 * half + 1 rows of a run of
    consecutive frames; unknown rows as they are. One pass of windows: unknown rows are runs of their own."""
    known = F.col("identity_id") >= 0
    order = ["frame", "px", "py"]
    # Unknown rows have one identity: the frame keeps them apart.
    own = F.when(known, 0).otherwise(F.col("frame"))
    w = Window.partitionBy("identity_id", own).orderBy(*order)
    broken = F.when(F.col("frame") - F.lag("frame").over(w) == 1, 0).otherwise(1)
    rows = rows.withColumn("_b", broken).withColumn("_run", F.sum("_b").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    run = Window.partitionBy("identity_id", own, "_run").orderBy(*order).rowsBetween(-half, half)
    mean = lambda c: F.when(known, F.round(F.avg(c).over(run), 9)).otherwise(F.col(c))
    return rows.select("frame", "identity_id", "team", "conf", mean("px").alias("x"), mean("py").alias("y"))


def players(rows: DataFrame) -> DataFrame:
    """rows (frame, identity_id, team, conf, x, y) -> frame, players: JSON lists of numbers in a fixed order."""
    one = F.array(F.col("identity_id").cast("double"), F.col("team").cast("double"), F.bround("x", 1) + F.lit(0.0), F.bround("y", 1) + F.lit(0.0), F.bround("conf", 2))
    per = rows.groupBy("frame").agg(F.array_sort(F.collect_list(F.struct("identity_id", "team", "x", "y", one.alias("one")))).alias("p"))
    return per.select("frame", F.to_json(F.transform("p", lambda s: s["one"])).alias("players"))


def ball_on_ground(balls: DataFrame, inverse: list[float]) -> DataFrame:
    """balls (frame, x, y, state) -> frame, x, y in metres, code; where the ball has a place near the pitch."""
    px, py = g.apply_homography([F.lit(v) for v in inverse], F.col("x"), F.col("y"))
    rows = balls.filter("x IS NOT NULL").withColumns({"px": px, "py": py})
    rows = rows.filter((F.abs("px") <= g.PITCH_LENGTH / 2 + BALL_MARGIN) & (F.abs("py") <= g.PITCH_WIDTH / 2 + BALL_MARGIN))
    return rows.select("frame", (F.bround("px", 1) + F.lit(0.0)).alias("x"), (F.bround("py", 1) + F.lit(0.0)).alias("y"), ball_code(F.col("state")).alias("code"))


def trails(rows: DataFrame, keys: list[str], frames: int) -> DataFrame:
    """rows (keys, frame, x, y) -> keys, frame, trail: a JSON list of the places of the last `frames` frames."""
    w = Window.partitionBy(*keys).orderBy("frame").rangeBetween(-frames, 0)
    return rows.select(*keys, "frame", F.to_json(F.collect_list(F.array(F.col("x").cast("double"), F.col("y").cast("double"))).over(w)).alias("trail"))
