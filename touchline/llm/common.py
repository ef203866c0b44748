"""What the corpus operators share: work folders, table readers, checked broadcasts and byte tokenisers."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructField, StructType

#: Rows and bytes of keys a side may have at most to be broadcast; beyond either, joins shuffle.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 16 << 20

#: Bytes of a batch that Python works on at once.
PIECE_BYTES = 8 << 20

#: Bytes that end a white-space token: 0x20 and 0x09-0x0D, which bytes.split() uses too.
SPACE_TOKEN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_TEMPORARY: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or where the session has none and all runs in one
    process (tests), a temporary one."""
    told = spark.conf.get("spark.checkpoint.dir", None)
    if not told:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        app = spark.sparkContext.applicationId
        told = _TEMPORARY.get(app) or _TEMPORARY.setdefault(app, f"file://{tempfile.mkdtemp(prefix='touchline-')}")
    return told.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path in this application's own part of the shared folder."""
    return f"{shared_dir(spark)}/touchline/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def delete(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def release(spark: SparkSession) -> None:
    """Delete what this application's operators have left in the shared folder: once their results are written."""
    delete(spark, f"{shared_dir(spark)}/touchline/{spark.sparkContext.applicationId}")


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.settled_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete settled tables that nothing reads any more, once what was made of them is settled itself."""
    for t in tables:
        delete(t.sparkSession, t.settled_at)


def unused(df: DataFrame, *names: str) -> str:
    """A prefix that makes none of the names, put behind it, a column of df (whatever the case)."""
    prefix, taken = "", {c.lower() for c in df.columns}
    while any((prefix + n).lower() in taken for n in names):
        prefix += "_"
    return prefix


def own(df: DataFrame) -> list[Column]:
    """All columns of df, also those with dots in their names."""
    return [F.col(f"`{c.replace('`', '``')}`") for c in df.columns]


def is_small(df: DataFrame, key: str | None = None) -> bool:
    """Whether df may be broadcast: counted rows, and counted bytes of a key that has no fixed width."""
    wide = key is not None and df.schema[key].dataType.typeName() in ("string", "binary")
    size = F.sum(F.octet_length(key)) if wide else F.lit(0)
    rows, held = df.limit(BROADCAST_ROWS + 1).agg(F.count("*"), size).first()
    return rows <= BROADCAST_ROWS and (held or 0) <= BROADCAST_BYTES


def remainder(doc_id: Column | str, mod: int) -> Column:
    """crc32 of the id as text, modulo mod; a null id counts as remainder -1, which no split uses."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % mod, F.lit(-1)).cast("int")


def lookup(left: DataFrame, right: DataFrame, key: str, weight: str | None = None, salts: int = 32, hot: int = 1000) -> DataFrame:
    """Left join on key, where right has one row a key and left may have a third of its rows under one.

    A right side of BROADCAST_ROWS rows and BROADCAST_BYTES of keys at most is broadcast. Otherwise its heavy keys (column weight over hot: how many
    left rows have the key) go to each salt, all others to salt 0, and the left rows of heavy keys are dealt over the
    salts. The heavy keys are few by arithmetic (left rows / hot) but not bounded, so they are broadcast only when counted.
    """
    right = right.dropDuplicates([key]) if weight is None else right
    if is_small(right, key):
        return left.join(F.broadcast(right.drop(weight) if weight else right), key, "left")
    p = unused(left, "_hash", "_salt", "_salts", "_weight")
    hash_, salt, salts_ = (p + n for n in ("_hash", "_salt", "_salts"))
    if weight is None:
        weight = p + "_weight"
        right = right.join(left.groupBy(key).agg(F.count("*").alias(weight)), key, "left").fillna({weight: 0})
    while not is_small(right.filter(F.col(weight) > hot), key):
        hot *= 4
    heavy = right.filter(F.col(weight) > hot).select(F.col(key), F.lit(salts).alias(salts_))
    spread = F.explode(F.sequence(F.lit(0), F.when(F.col(weight) > hot, salts - 1).otherwise(0)))
    # A row's salt is a hash of the row, so a task that runs again deals it alike.
    hashed = [c for c, f in zip(own(left), left.schema, strict=True) if "map<" not in f.dataType.simpleString()]
    dealt = left.withColumn(hash_, F.xxhash64(*hashed)).join(F.broadcast(heavy), key, "left")
    dealt = dealt.withColumn(salt, F.pmod(hash_, F.coalesce(salts_, F.lit(1))).cast("int")).drop(salts_, hash_)
    return dealt.join(right.withColumn(salt, spread).drop(weight), [key, salt], "left").drop(salt)


def space_tokens(text: bytes | None) -> list[bytes]:
    """Lower-case A-Z, then the runs of bytes other than 0x20 and 0x09-0x0D."""
    return text.lower().split() if text else []


#: Maps bytes so that split() leaves runs of [0-9a-z] and non-ASCII bytes, A-Z lower-cased.
WORD_BYTES = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def words(text: bytes | None) -> list[bytes]:
    """Lower-case A-Z, then the runs of [0-9a-z] and characters beyond ASCII."""
    return text.translate(WORD_BYTES).split() if text else []


def with_computed(df: DataFrame, inputs: list[str], outputs: str, make: Callable[[], Callable[..., list[list]]], drop: tuple[str, ...] = ()) -> DataFrame:
    """df with columns (outputs: DDL) that Python computes from the inputs; all others pass through as Arrow, untouched.

    make() runs once a task and returns what maps lists of input values to a list of values for each output. Strings are
    given as bytes, since a string column may hold bytes that are no UTF-8. Columns to drop aren't sent back. A column of
    df with an output's name is an error: choose names by unused().
    """
    added = StructType.fromDDL(outputs)
    if clash := {c.lower() for c in df.columns} & {n.lower() for n in added.names}:
        raise ValueError(f"columns {sorted(clash)} are in the table already")
    types = [to_arrow_type(f.dataType) for f in added]

    def values(column: pa.Array) -> list:
        return (column.cast(pa.binary()) if pa.types.is_string(column.type) else column).to_pylist()

    names = df.columns
    place = [names.index(c) for c in inputs]
    kept = [k for k, c in enumerate(names) if c not in drop]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        for batch in (piece for whole in batches for piece in slices(whole, PIECE_BYTES)):
            new = compute(*(values(batch.column(k)) for k in place))
            arrays = [pa.array(x, type=t) for x, t in zip(new, types, strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in kept), *arrays], names=[*(f"c{k}" for k in kept), *added.names])
        tidy()

    schema = StructType([*(StructField(f"c{k}", df.schema[k].dataType) for k in kept), *added.fields])
    return numbered(df).mapInArrow(run, schema).toDF(*(names[k] for k in kept), *added.names)


def tidy() -> None:
    """Hand memory that is free back to the system: workers are kept between tasks, whose next one may need it elsewhere."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def slices(batch: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
    """A batch in pieces of about `size` bytes."""
    rows = max(1, int(batch.num_rows * size / max(batch.nbytes, 1)))
    for k in range(0, batch.num_rows, rows):
        yield batch.slice(k, rows)


def numbered(df: DataFrame) -> DataFrame:
    """df with its columns called c0, c1 and so on: mapInArrow takes no names with dots."""
    return df.toDF(*(f"c{k}" for k in range(len(df.columns))))
