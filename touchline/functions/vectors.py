"""Dense vectors as arrays of doubles, in built-in higher-order functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: str | Column, b: str | Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)


def l1(a: str | Column, b: str | Column) -> Column:
    """Half the sum of absolute differences: a distance of histograms from 0 to 1."""
    return F.lit(0.5) * F.aggregate(F.zip_with(a, b, lambda x, y: F.abs(x - y)), F.lit(0.0), lambda s, v: s + v)


def unit(v: str | Column) -> Column:
    return F.transform(v, lambda x: x / (F.sqrt(dot(v, v)) + F.lit(1e-9)))
