"""Connected components of an edge table by alternating star contractions, on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, lookup, settle


def _least(pairs: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """(u, v) with m, the least of u and its v: hubs are met by salted or broadcast lookups; and the settled minima."""
    least = settle(pairs.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")), name)
    return lookup(pairs, least, "u", "n").withColumn("m", F.least("u", "m")), least


def components(edges: DataFrame) -> DataFrame:
    """(a, b) -> node, root: the least node of each node's component, for all nodes in an edge but the roots.

    Large stars link the larger neighbours of a node to its least neighbour, small stars the others; both keep the
    components, and the rounds, logarithmic in number, end when the edges stay as they are. A round's tables are deleted
    once the next one's are settled. Edges with a null end or to themselves link nothing; repeated ones count once; no
    edges give no rows.
    """
    known = edges.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    now = settle(known.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    while True:
        mark = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if mark == before or not mark[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = mark
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large, least = _least(both, "stars")
        large = settle(large.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct(), "edges")
        discard(now, least)
        small, least = _least(large, "stars")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
        now = settle(small.filter("u <> v").distinct(), "edges")
        discard(large, least)
