"""Stages over a run folder: fingerprints, cached outputs, an append-only manifest, and a partial-failure policy."""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


def fingerprint(config: dict) -> str:
    """The first ten hex digits of the SHA-1 of canonical JSON, the key runtime left out."""
    kept = {k: v for k, v in config.items() if k != "runtime"}
    return hashlib.sha1(json.dumps(kept, sort_keys=True, separators=(",", ":")).encode()).hexdigest()[:10]


@dataclass
class Stage:
    """A step from input tables to one output. reads: stages whose outputs it takes; config: what its result depends on."""

    name: str
    run: Callable[[SparkSession, dict[str, DataFrame], dict], DataFrame]
    reads: tuple[str, ...] = ()
    config: dict = field(default_factory=dict)


class Runner:
    """Runs stages in order under a folder; a stage whose fingerprint (its own config and all upstream) has an output is read, not run."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def _done(self, path: str) -> bool:
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(p)

    def run(self, stages: list[Stage]) -> dict[str, DataFrame]:
        prints: dict[str, str] = {}
        tables: dict[str, DataFrame] = {}
        failed: list[str] = []
        for s in stages:
            if any(r in failed for r in s.reads):
                failed.append(s.name)
                continue
            prints[s.name] = fingerprint({"own": s.config, "upstream": [prints[r] for r in s.reads], "stage": s.name})
            path, began, cached = f"{self.folder}/{s.name}/{prints[s.name]}", time.time(), True
            try:
                if not self._done(path):
                    cached = False
                    s.run(self.spark, {r: tables[r] for r in s.reads}, s.config).write.mode("overwrite").parquet(path)
                tables[s.name] = self.spark.read.parquet(path)
                self._append(s.name, prints[s.name], path, time.time() - began, "cached" if cached else "done")
            except Exception as e:
                failed.append(s.name)
                self._append(s.name, prints[s.name], path, time.time() - began, f"failed: {type(e).__name__}: {str(e)[:500]}")
        if failed and not tables:
            raise RuntimeError(f"all stages failed: {', '.join(failed)}")
        return tables

    def _append(self, stage: str, print_: str, path: str, seconds: float, status: str) -> None:
        row = [(stage, print_, path, float(seconds), status, float(time.time()))]
        self.spark.createDataFrame(row, "stage string, fingerprint string, output string, seconds double, status string, at double").coalesce(1).write.mode("append").parquet(f"{self.folder}/manifest")

    def manifest(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/manifest")
