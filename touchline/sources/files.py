"""Files and folders: tables, JSON and YAML documents, listings with path parts, byte ranges, copies and whole writes.

Paths are Hadoop paths: a scheme (file, hdfs, s3a, gs, abfs) needs its connector among Spark's jars and its settings under
spark.hadoop.*; nothing here depends on which. Small documents go through the driver; tables never do.
"""

from __future__ import annotations

import json
import re
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_WORK: dict[str, str] = {}


def work_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or in one process without it a temporary one."""
    told = spark.conf.get("spark.checkpoint.dir", None)
    if not told:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        app = spark.sparkContext.applicationId
        told = _WORK.get(app) or _WORK.setdefault(app, f"file://{tempfile.mkdtemp(prefix='touchline-')}")
    return told.rstrip("/")


def fresh(spark: SparkSession, name: str) -> str:
    return f"{work_dir(spark)}/tables/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = fresh(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Paths


def joined(root: str, *parts: str) -> str:
    """A path below root, with one slash between parts."""
    return "/".join([root.rstrip("/"), *(p.strip("/") for p in parts)])


def is_remote(uri: str) -> bool:
    return bool(re.match(r"[a-z][a-z0-9+.-]*://", uri)) and not uri.startswith("file://")


def bucket_and_key(uri: str) -> tuple[str, str]:
    scheme, _, rest = uri.partition("://")
    if not rest:
        raise ValueError(f"{uri} has no scheme")
    bucket, _, key = rest.partition("/")
    return f"{scheme}://{bucket}", key


def valid_run_id(run: Column) -> Column:
    """Whether a run's name is safe as one part of a path."""
    return run.isNotNull() & (F.length(run) > 0) & ~run.contains("/") & ~run.contains("..")


def _fs(spark: SparkSession, uri: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(uri)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, uri: str) -> bool:
    fs, path = _fs(spark, uri)
    return fs.exists(path)


def size(spark: SparkSession, uri: str) -> int:
    fs, path = _fs(spark, uri)
    return fs.getFileStatus(path).getLen()


def parts(spark: SparkSession, uri: str) -> list[str]:
    """The data files of a table, in order of names: the file itself, or all under its folder but those that Spark takes for hidden."""
    fs, path = _fs(spark, uri)
    if not fs.getFileStatus(path).isDirectory():
        return [uri]
    shown = lambda name: not name.startswith(".") and (not name.startswith("_") or "=" in name)
    below = sorted(x.getPath().toString() for x in fs.listStatus(path) if shown(x.getPath().getName()))
    return [f for b in below for f in parts(spark, b)]


def read_range(spark: SparkSession, uri: str, start: int, end: int) -> bytes:
    """Bytes start to end, both included, as far as the file goes."""
    fs, path = _fs(spark, uri)
    n = max(0, min(end + 1, fs.getFileStatus(path).getLen()) - start)
    stream = fs.open(path)
    try:
        stream.seek(start if n else 0)
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream, n)) if n else b""
    finally:
        stream.close()


def put(spark: SparkSession, uri: str, data: bytes) -> None:
    """A file appears whole or not at all: written beside its place, then renamed over it."""
    fs, path = _fs(spark, uri)
    draft = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{uri}.{uuid.uuid4().hex}.draft")
    out = fs.create(draft, False)
    out.write(bytearray(data))
    out.close()
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(path.toUri(), conf).rename(draft, path, options)


def localize(spark: SparkSession, uri: str, folder: str) -> str:
    """A copy of a file in a local folder of the driver; its path."""
    fs, path = _fs(spark, uri)
    target = str(Path(folder) / uri.rstrip("/").rpartition("/")[2])
    fs.copyToLocalFile(False, path, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target), True)
    return target


def upload(spark: SparkSession, local: str, uri: str) -> None:
    fs, path = _fs(spark, uri)
    fs.copyFromLocalFile(False, True, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(local), path)


def listed(spark: SparkSession, root: str, suffix: str = "") -> DataFrame:
    """path, size of all files under root whose names end with suffix, by Spark's own (parallel) listing."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{suffix}").load(root)
    return rows.select("path", F.col("length").alias("size"))


# Tables and documents


def write_table(df: DataFrame, uri: str, files: int | None = None) -> None:
    """One table, replacing what is there; in a number of files if told."""
    (df if files is None else df.coalesce(files)).write.mode("overwrite").parquet(uri)


def read_tables(spark: SparkSession, root: str, schema: StructType, suffix: str = "*.parquet") -> DataFrame:
    """All tables under root as one, with shot_id and stage, the folders two above and one above a file (.../shot/stage/file).

    The schema is given, so that a root without files is an empty table."""
    if not exists(spark, root):
        return spark.createDataFrame([], StructType([*schema.fields]).add("shot_id", "string").add("stage", "string"))
    rows = spark.read.schema(schema).option("recursiveFileLookup", "true").option("pathGlobFilter", suffix).parquet(root)
    parts = F.split(F.col("_metadata.file_path"), "/")
    return rows.select(*schema.names, F.element_at(parts, -3).alias("shot_id"), F.element_at(parts, -2).alias("stage"))


def write_json(df: DataFrame, uri: str) -> None:
    """One compact JSON document a row."""
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.mode("overwrite").text(uri)


def read_json(spark: SparkSession, uri: str, schema: StructType | str) -> DataFrame:
    """JSON documents, a row each, whether a line or a file holds one."""
    return spark.read.schema(schema).option("multiLine", "true").json(uri)


def read_document(spark: SparkSession, uri: str) -> object:
    """A small JSON or YAML document (by its suffix) as Python values; YAML needs the yaml package."""
    text = read_range(spark, uri, 0, size(spark, uri) - 1).decode()
    if not uri.endswith((".yaml", ".yml")):
        return json.loads(text)
    import yaml

    return yaml.safe_load(text)


def content_hash(rows: DataFrame, columns: list[str], keys: list[str] | None = None) -> DataFrame:
    """keys, n, hash: a hash of the rows of each key that doesn't depend on their order; rows must be distinct."""
    text = F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in columns))
    one = F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")
    return rows.groupBy(*(keys or [])).agg(F.count("*").alias("n"), F.bit_xor(one).alias("hash"))
