"""A decoder without a video, for trying out frame sources."""

from __future__ import annotations

from collections.abc import Iterator


def frames(path: str, start: int, end: int, width: int = 4, height: int = 2) -> Iterator[tuple[int, int, int, bytes]]:
    """Frames of one grey, their number modulo 256."""
    for frame in range(start, end + 1):
        yield frame, width, height, bytes([frame % 256]) * (width * height * 3)
