"""Files in the shared folder, from the driver and from executors."""

from __future__ import annotations

import contextlib

import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import SparkSession


def open_store(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a URI or plain path, and the path in it."""
    if "://" in uri:
        return pafs.FileSystem.from_uri(uri)
    return pafs.LocalFileSystem(), uri.removeprefix("file:")


def attempt_name(prefix: str, k: int, suffix: str) -> str:
    """A file name that no other attempt of this task uses; only files that a finished attempt has told of count."""
    at = TaskContext.get()
    return f"{prefix}-{at.partitionId():05d}-{at.taskAttemptId()}-{k:05d}{suffix}"


def join(folder: str, name: str) -> str:
    return f"{folder.rstrip('/')}/{name}"


@contextlib.contextmanager
def writing(folder: str, name: str):
    """An output stream of a new file in the folder."""
    fs, path = open_store(folder)
    whole = join(path, name)
    fs.create_dir(whole.rpartition("/")[0], recursive=True)
    with fs.open_output_stream(whole) as out:
        yield out


def commit_once(spark: SparkSession, uri: str, text: str) -> bool:
    """Make a file appear whole under its name, or not at all if the name is taken (a rename that doesn't overwrite)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(uri)
    fs = path.getFileSystem(conf)
    fs.mkdirs(path.getParent())
    draft = jvm.org.apache.hadoop.fs.Path(path.getParent(), f".{path.getName()}.{jvm.java.util.UUID.randomUUID()}")
    out = fs.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(path.toUri(), conf).rename(draft, path, options)
    except Exception as e:  # py4j wraps FileAlreadyExistsException
        fs.delete(draft, False)
        if "FileAlreadyExists" in str(e):
            return False
        raise
    return True


def names(spark: SparkSession, uri: str) -> list[str]:
    """The sorted names of the files in a folder; none if there is no such folder."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(uri)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(x.getPath().getName() for x in fs.listStatus(path)) if fs.exists(path) else []


def write_text(spark: SparkSession, uri: str, text: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(uri)
    out = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path, False)
    out.write(bytearray(text.encode()))
    out.close()


def read_text(spark: SparkSession, uri: str) -> str:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(uri)
    stream = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(path)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
