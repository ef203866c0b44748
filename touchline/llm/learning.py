"""Bounded labelled samples and a small logistic calibration, shared by the classifiers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import remainder, settle

#: Bytes of text a class may bring to a labelled sample; with the number of rows, the bound on what the driver learns from.
SAMPLE_BYTES = 16 << 20


def labelled_sample(docs: DataFrame, labels: DataFrame, target: str, mod: int, out: int, each: int, most_bytes: int = SAMPLE_BYTES, seed: int = 11) -> DataFrame:
    """At most `each` labelled documents of either class and `most_bytes` of their texts, of ids whose crc32 mod `mod` isn't
    `out`: doc_id, text (binary), label, part (0-2).

    Ids are taken in order of their hashes, so reruns take the same ones. An id counts once, with the least of its texts if
    it repeats; of the chosen, those are kept whose texts and all before them fit in the bytes (a text beyond a sixteenth of
    them isn't taken). Null ids and labels take no part; an id labelled both ways counts as 1. The chosen ids
    (2 * each) are broadcast against the documents.
    """
    one = labels.filter(F.col("doc_id").isNotNull() & F.col(target).isin(0, 1) & ~held_out("doc_id", mod, out))
    one = one.groupBy("doc_id").agg(F.max(target).cast("int").alias("label")).withColumn("_order", F.xxhash64("doc_id", F.lit(seed)))
    parts = [one.filter(F.col("label") == k).orderBy("_order", "doc_id").limit(each) for k in (0, 1)]
    chosen = parts[0].unionByName(parts[1])
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))
    rows = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label", "_order").agg(F.min("text").alias("text"))
    rows = rows.withColumn("_n", F.octet_length("text")).filter(F.col("_n") <= most_bytes // 16)
    before = Window.partitionBy("label").orderBy("_order", "doc_id")  # at most `each` rows a class
    rows = rows.withColumn("_upto", F.sum("_n").over(before)).filter(F.col("_upto") <= most_bytes)
    # Settled, so the documents are scanned once for all that is learnt.
    return settle(rows.select("doc_id", "text", "label", F.pmod("_order", F.lit(3)).cast("int").alias("part")), "labelled-sample")


def logistic(x: np.ndarray, y: np.ndarray, l2: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Weights of a logistic regression, the last one the intercept; Newton steps with a ridge on the others."""
    a = np.column_stack([x, np.ones(len(x))])
    w, ridge = np.zeros(a.shape[1]), np.diag([l2] * x.shape[1] + [1e-6])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + ridge, a.T @ (y - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def held_out(doc_id: Column | str, mod: int, out: int) -> Column:
    return remainder(doc_id, mod) == out
