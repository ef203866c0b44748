"""Streams of detections: windowed activity with watermarks, and causal ball gating with kept state (extensions)."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.sequence import BALL_REACH, BallPath


def activity(events: DataFrame, window: str = "10 minutes", late: str = "30 minutes") -> DataFrame:
    """Rows by window and event type; events later than the watermark are dropped."""
    rows = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    return rows.groupBy(F.window("ts", window).alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "event_type", "n")


def gated_balls(balls: DataFrame, speed: float = BALL_REACH) -> DataFrame:
    """(shot_no, frame, x, y, score) in frame order -> accepted positions; the last position and velocity are a shot's state."""

    def step(key, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        path, out = BallPath(*(state.get if state.exists else ()), reach=speed), []
        for batch in batches:
            batch = batch.sort_values("frame", ignore_index=True)
            points, scores = batch[["x", "y"]].to_numpy(float), batch["score"].to_numpy(float)
            for frame, at in batch.groupby("frame").indices.items():
                if frame > path.last and path.choose(int(frame), points[at], scores[at]) is not None:
                    out.append((key[0], path.last, *map(float, path.place)))
        state.update(path.state())
        yield pd.DataFrame(out, columns=["shot_no", "frame", "x", "y"])

    return balls.groupBy("shot_no").applyInPandasWithState(step, "shot_no long, frame long, x double, y double", "x double, y double, vx double, vy double, last long", "append", "NoTimeout")
