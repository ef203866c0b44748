"""Size-tiered compaction of immutable Parquet shards under versioned manifests.

A store is a folder: shards/ holds immutable files in FOLDERS subfolders, manifests/ a Parquet table per version (one row a
shard: name, rows, bytes of rows, tier), versions/ one small JSON file a committed version, which names its manifest, and
pending/ one file a writer at work. A version is committed by a rename that doesn't overwrite, so of two writers one
wins and the other plans anew; readers take the highest committed version and never see half of one. Shards of failed
task attempts are in no manifest.

Arrivals are appended as small shards, cut by each task as rows come. Compaction works by tiers: a shard's tier is the
logarithm of its size over the arrival size to base FANOUT. Shards of one tier are packed in order of their names into
runs of the target size; runs of at least FANOUT shards, or that reach the target, are merged, others wait. Shards of half
the target are done. A merge streams its shards' row groups into a new file, without a shuffle, and the rounds end when
no run is left. Planning is a window over the manifest by tier and slice, where slices grow with the number of shards; a
version is read by tasks that each open some of its shards. So neither one task nor the driver holds the plan or the list
of shards. Sizes are Arrow bytes of the rows, which don't depend on compression.

Every listed version stays readable until expire() takes it off the list. vacuum() then deletes the shards that no listed
version names, but none younger than an age limit and none younger than any writer at work, so it may run at any time
beside writers.

Rows pass through whole, nulls, bytes that are no UTF-8, repeats and extra columns of any name included; a row longer than
a shard is a shard of its own. An empty table makes a version without shards.
"""

from __future__ import annotations

import contextlib
import json
import time
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StringType, StructType

from .common import delete, fresh_path, lookup, numbered, tidy, unused
from .stores import attempt_name, commit_once, join, names, open_store, read_text, write_text, writing

ARRIVAL_BYTES = 4 << 20
TARGET_BYTES = 64 << 20
FANOUT = 4
#: About so many shards are planned by one task.
SLICE_SHARDS = 4_096
#: Subfolders of shards/, each listed by a task.
FOLDERS = 256
#: Seconds: the age below which no file is deleted, and the age from which a writer that never ended no longer counts.
LEAST_AGE, ABANDONED = 7 * 86_400, 30 * 86_400
MANIFEST = "shard string, rows long, bytes long, tier int"


class ShardStore:
    """A folder of shards of one schema."""

    def __init__(self, spark: SparkSession, folder: str, arrival: int = ARRIVAL_BYTES, target: int = TARGET_BYTES, fanout: int = FANOUT) -> None:
        self.spark, self.folder, self.arrival, self.target, self.fanout = spark, folder.rstrip("/"), arrival, target, fanout

    # Versions

    def versions(self) -> list[int]:
        return [int(n.removesuffix(".json")) for n in names(self.spark, f"{self.folder}/versions") if n.endswith(".json") and not n.startswith(".")]

    def manifest(self, version: int | None = None) -> DataFrame:
        """The shards of a version, by default of the last."""
        version = max(self.versions(), default=0) if version is None else version
        if not version:
            return self.spark.createDataFrame([], MANIFEST)
        told = json.loads(read_text(self.spark, f"{self.folder}/versions/{version:08d}.json"))
        return self.spark.read.schema(MANIFEST).parquet(f"{self.folder}/manifests/{told['manifest']}")

    def commit(self, shards: DataFrame, after: int) -> int | None:
        """Write a manifest and make it version after + 1; None if another writer did so before."""
        name = f"m-{uuid.uuid4().hex}"
        shards.write.parquet(f"{self.folder}/manifests/{name}")
        told = json.dumps({"version": after + 1, "parent": after, "manifest": name})
        return after + 1 if commit_once(self.spark, f"{self.folder}/versions/{after + 1:08d}.json", told) else None

    def tier(self):
        ratio = F.greatest(F.col("bytes").cast("double") / self.arrival, F.lit(1.0))
        return F.floor(F.log(ratio) / F.log(F.lit(float(self.fanout)))).cast("int")

    @contextlib.contextmanager
    def _at_work(self):
        """While this is open, vacuum() deletes nothing written since."""
        path = f"{self.folder}/pending/{uuid.uuid4().hex}.json"
        write_text(self.spark, path, json.dumps({"since": time.time()}))
        try:
            yield
        finally:
            delete(self.spark, path)

    # Writing

    def append(self, rows: DataFrame) -> int:
        """Rows as small shards in a new version."""
        folder, most, columns = f"{self.folder}/shards", self.arrival, rows.columns

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, size, k = [], 0, 0
            for batch in batches:
                for piece in _pieces(batch.rename_columns(columns), most):
                    if held and size + piece.nbytes > most:
                        yield _told(*_write(folder, attempt_name("arrival", k, ".parquet"), held))
                        held, size, k = [], 0, k + 1
                    held.append(piece)
                    size += piece.nbytes
            if held:
                yield _told(*_write(folder, attempt_name("arrival", k, ".parquet"), held))
            held = []
            tidy()

        with self._at_work():
            # Written before any commit, and once: what is read back names finished attempts' shards only.
            fresh = self._settled(numbered(rows).mapInArrow(cut, "shard string, rows long, bytes long"))
            while True:
                last = max(self.versions(), default=0)
                done = self.commit(self.manifest(last).unionByName(fresh.withColumn("tier", self.tier())), last)
                if done:
                    return done

    def _settled(self, shards: DataFrame) -> DataFrame:
        path = f"{self.folder}/manifests/draft-{uuid.uuid4().hex}"
        shards.write.parquet(path)
        return self.spark.read.schema(shards.schema).parquet(path)

    def plan(self, shards: DataFrame) -> DataFrame:
        """The shards to merge, with a run id each."""
        slices = max(1, shards.count() // SLICE_SHARDS)
        small = shards.filter(2 * F.col("bytes") < self.target).withColumn("slice", F.pmod(F.xxhash64("shard"), F.lit(slices)))
        order = Window.partitionBy("tier", "slice").orderBy("shard")
        upto = F.sum("bytes").over(order.rowsBetween(Window.unboundedPreceding, 0))
        small = small.withColumn("run", F.floor((upto - F.col("bytes")) / self.target))
        run = Window.partitionBy("tier", "slice", "run")
        small = small.withColumn("n", F.count("*").over(run)).withColumn("total", F.sum("bytes").over(run))
        ready = small.filter((F.col("n") >= self.fanout) | ((F.col("n") > 1) & (F.col("total") >= self.target)))
        return ready.select(F.concat_ws("-", "tier", "slice", "run").alias("run"), "shard")

    def compact(self) -> int:
        """Merge until no run is left; returns the last version. A version that another writer made first is planned anew."""
        while True:
            last = max(self.versions(), default=0)
            shards = self.manifest(last)
            runs = self._settled(self.plan(shards).groupBy("run").agg(F.array_sort(F.collect_list("shard")).alias("shards")))
            n = runs.count()
            if not n:
                return last
            with self._at_work():
                merged = self._settled(self._merge(runs, n)).withColumn("tier", self.tier())
                gone = runs.select(F.explode("shards").alias("shard"))
                self.commit(shards.join(gone, "shard", "left_anti").unionByName(merged), last)

    def _merge(self, runs: DataFrame, n: int) -> DataFrame:
        folder = f"{self.folder}/shards"

        def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            k = 0
            for batch in batches:
                for shards in batch.column("shards").to_pylist():
                    yield _told(*_write(folder, attempt_name("merged", k, ".parquet"), _read(folder, shards)))
                    k += 1
            tidy()

        # A run is a bounded number of bytes; one or a few runs a task.
        return runs.select("shards").repartition(min(n, 10_000)).mapInArrow(merge, "shard string, rows long, bytes long")

    # Upkeep

    def expire(self, keep: int = 1) -> list[int]:
        """Take all versions but the last `keep` off the list; their shards go with the next vacuum() of enough age."""
        old = sorted(self.versions())[: -max(keep, 1)]
        for v in old:
            delete(self.spark, f"{self.folder}/versions/{v:08d}.json")
        return old

    def vacuum(self, least_age: float = LEAST_AGE, abandoned: float = ABANDONED) -> int:
        """Delete the shards that no listed version names, if older than least_age and than every writer at work; returns how
        many. A writer that began `abandoned` seconds ago and never ended is taken for dead."""
        now = time.time()
        before = now - least_age
        for name in names(self.spark, f"{self.folder}/pending"):
            with contextlib.suppress(Exception):  # it ended since it was listed
                since = json.loads(read_text(self.spark, f"{self.folder}/pending/{name}"))["since"]
                if since > now - abandoned:
                    before = min(before, since)
        folder = f"{self.folder}/shards"

        def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            fs, path = open_store(folder)
            for batch in batches:
                for k in batch["id"]:
                    files = fs.get_file_info(pafs.FileSelector(f"{path}/{k:02x}", allow_not_found=True))
                    yield pd.DataFrame({"shard": [f"{k:02x}/{f.base_name}" for f in files if f.is_file and f.mtime_ns / 1e9 < before]}, dtype="string")

        def gone(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            fs, path = open_store(folder)
            for batch in batches:
                for name in batch["shard"]:
                    if fs.get_file_info(join(path, name)).type != pafs.FileType.NotFound:  # a task that runs again finds them gone
                        fs.delete_file(join(path, name))
                yield batch

        old = self.spark.range(FOLDERS, numPartitions=min(FOLDERS, 64)).mapInPandas(found, "shard string")
        for v in self.versions():
            old = old.join(self.manifest(v).select("shard"), "shard", "left_anti")
        return self._settled(old.mapInPandas(gone, "shard string")).count()

    # Reading

    def read(self, schema: StructType, version: int | None = None, columns: list[str] | None = None, shard_column: str = "_shard") -> DataFrame:
        """The rows of a version: the columns (all by default) and shard_column, which must not be one of them: the shard each
        row is in."""
        folder = f"{self.folder}/shards"
        fields = [f for f in schema.fields if columns is None or f.name in columns]
        if shard_column.lower() in {f.name.lower() for f in fields}:
            raise ValueError(f"the rows have a column {shard_column}")
        want, out = to_arrow_schema(StructType(fields)), StructType(fields).add(shard_column, StringType())

        def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for name in batch.column("shard").to_pylist():
                    for rows in _read(folder, [name], want.names):
                        held = [c if c.type == t else c.cast(t) for c, t in zip((rows.column(n) for n in want.names), want.types, strict=True)]
                        yield pa.RecordBatch.from_arrays([*held, pa.array([name] * rows.num_rows, pa.string())], names=[*want.names, shard_column])
            tidy()

        shards = self.manifest(version).select("shard")
        return shards.repartition(min(max(shards.count(), 1), 10_000)).mapInArrow(load, out)


def _pieces(batch: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    """A batch in slices of about an eighth of a shard."""
    rows = max(1, batch.num_rows * (most // 8) // max(batch.nbytes, 1))
    for k in range(0, batch.num_rows, rows):
        yield batch.slice(k, rows)


def _write(folder: str, name: str, batches) -> tuple[str, int, int]:
    name = f"{zlib.crc32(name.encode()) % FOLDERS:02x}/{name}"
    writer, rows, size = None, 0, 0
    with writing(folder, name) as out:
        for batch in batches:
            writer = writer or pq.ParquetWriter(out, batch.schema, compression="zstd")
            writer.write_batch(batch)
            rows += batch.num_rows
            size += batch.nbytes
        if writer:
            writer.close()
    return name, rows, size


def _read(folder: str, shards: list[str], columns: list[str] | None = None) -> Iterator[pa.RecordBatch]:
    fs, path = open_store(folder)
    for name in shards:
        with fs.open_input_file(join(path, name)) as file:
            parquet = pq.ParquetFile(file)
            for k in range(parquet.num_row_groups):
                yield from parquet.read_row_group(k, columns).to_batches()


def _told(name: str, rows: int, size: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"shard": [name], "rows": [rows], "bytes": [size]}, schema=pa.schema([("shard", pa.string()), ("rows", pa.int64()), ("bytes", pa.int64())]))


def shard(docs: DataFrame, folder: str | None = None, **sizes) -> ShardStore:
    """Append all rows to a store and compact it. Both versions stay listed: expire() and vacuum() are the caller's."""
    store = ShardStore(docs.sparkSession, folder or fresh_path(docs.sparkSession, "shards"), **sizes)
    store.append(docs)
    store.compact()
    return store


def report(docs: DataFrame, **sizes) -> DataFrame:
    """One row a row of docs, read back: doc_id, n_bytes, shard, shard_rows, shard_bytes, tier, version."""
    name = unused(docs, "_shard") + "_shard"
    store = shard(docs, **sizes)
    rows = store.read(docs.schema, columns=["doc_id", "text"], shard_column=name)
    rows = rows.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), F.col(name).alias("shard"))
    shards = store.manifest().selectExpr("shard", "rows AS shard_rows", "bytes AS shard_bytes", "tier", "rows AS n")
    return lookup(rows, shards, "shard", "n").withColumn("version", F.lit(max(store.versions(), default=0)).cast("long"))
