"""Where perception plugs in: detectors, encoders, masks and camera solvers as functions of batches, by name.

A plug-in maps a pandas frame to a pandas frame of its kind's columns; Spark runs it batch by batch on the executors, where
make() is called once a task (to load a model).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

#: Columns that the plug-ins of a kind give.
KINDS = {
    "detector": "shot_no long, frame long, x1 double, y1 double, x2 double, y2 double, score double, cls string",
    "encoder": "shot_no long, frame long, track_id long, emb array<double>",
    "mask": "det_id long, grass boolean",
    "camera": "shot_no long, frame long, cx double, cy double, cz double, pan double, tilt double, f double, coverage double, err_px double, explained double",
    "motion": "shot_no long, frame long, moved_pan double, moved_tilt double, moved_zoom double",
}
_PLUGINS: dict[tuple[str, str], Callable[[], Callable[[pd.DataFrame], pd.DataFrame]]] = {}


def register(kind: str, name: str, make: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]]) -> None:
    if kind not in KINDS:
        raise ValueError(f"{kind} is none of {', '.join(KINDS)}")
    _PLUGINS[kind, name] = make


def names(kind: str) -> list[str]:
    return sorted(n for k, n in _PLUGINS if k == kind)


def apply(rows: DataFrame, kind: str, name: str) -> DataFrame:
    """What a plug-in makes of rows."""
    if (kind, name) not in _PLUGINS:
        raise ValueError(f"no {kind} {name}; there are {', '.join(names(kind)) or 'none'}")
    make, columns = _PLUGINS[kind, name], [c.split()[0] for c in KINDS[kind].split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = make()
        for batch in batches:
            yield found(batch)[columns]

    return rows.mapInPandas(run, KINDS[kind])


# Videos


def rate(text: str) -> float:
    """A frame rate as probes write it: 30000/1001, or 0 where it is 0/0."""
    over, _, under = text.partition("/")
    return float(Fraction(int(over), int(under or 1))) if int(under or 1) else 0.0


def probed(stream: dict) -> dict:
    """Size and rates of a video stream as a probe describes it."""
    nominal, average = rate(stream.get("r_frame_rate", "0/0")), rate(stream.get("avg_frame_rate", "0/0"))
    return {"width": int(stream["width"]), "height": int(stream["height"]), "fps_nominal": nominal, "fps_avg": average or nominal}


def needs_encoding(height: Column, fps_nominal: Column, fps_avg: Column, most_height: int = 1080, fps: float = 25.0) -> Column:
    variable = (fps_nominal > 0) & (F.abs(fps_nominal - fps_avg) / fps_nominal > 0.002)
    return (height > most_height) | (F.abs(fps_avg - fps) > 0.05) | variable


class _ShotPartition(InputPartition):
    def __init__(self, shot_no: int, start: int, end: int) -> None:
        self.shot_no, self.start, self.end = shot_no, start, end


class _FrameReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.path, self.decoder = options["path"], options["decoder"]
        shots = [tuple(map(int, s.split("-"))) for s in options["shots"].split(",") if s]
        self.shots = [_ShotPartition(k, a, b) for k, (a, b) in enumerate(shots)]

    def partitions(self) -> list[InputPartition]:
        return self.shots

    def read(self, partition: _ShotPartition) -> Iterator[tuple]:
        import importlib

        module, _, name = self.decoder.partition(":")
        frames = getattr(importlib.import_module(module), name)
        for frame, width, height, pixels in frames(self.path, partition.start, partition.end):
            yield partition.shot_no, frame, width, height, pixels


class FrameSource(DataSource):
    """spark.read.format("frames") with options path, shots ("0-99,100-180", both ends included) and decoder
    ("module:function", which yields frame, width, height and pixels of a stretch): a partition a shot."""

    @classmethod
    def name(cls) -> str:
        return "frames"

    def schema(self) -> str:
        return "shot_no long, frame long, width int, height int, pixels binary"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _FrameReader(self.options)
