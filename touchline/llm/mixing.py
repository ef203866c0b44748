"""Mixing sources to target weights, with DataFrame functions only.

Sizes are white-space tokens. Each source's share of the total follows its weight, but no source is repeated beyond a
limit; what is over the limit goes to the other sources by weight, until none is above (water filling, solved in closed
form by a running sum over the sources in order of limit / weight). A document is emitted floor(rate) times, and once
more if a hash of its id and the seed falls below the fraction of the rate.

The seed of a source is the one of SEEDS listed seeds whose copies come nearest to the source's target; that choice is one
aggregation over (id, source, size) and matters where a source has few documents.

Null texts and texts without tokens have size 0. A null source is a source of its own, ordered last. Rows that repeat an
id are decided alike. Long texts are counted whole, and bytes that are no UTF-8 are parts of tokens. An empty table gives
an empty result. Other columns pass through whatever their names: mix() takes a prefix for its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE_TOKEN, lookup, own, settle, unused

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
SEED, SEEDS = "mix-1", 16
ADDED = ("_size", "_source_size", "_target", "_rate", "_copies", "_taken")


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(SPACE_TOKEN)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """(source, size) rows -> one row a source: source, source_size, target.

    The windows without a partition run over one row a source, after aggregation.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    per = per.withColumn("_w", F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (rank % len(weights) + 1).cast("int")).cast("long"))
    per = per.withColumn("_cap", most * F.col("source_size"))
    order = Window.orderBy((F.col("_cap").cast("double") / F.col("_w")).asc(), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(Window.partitionBy()) - F.coalesce(F.sum("_cap").over(before), F.lit(0))
    weight_left = F.sum("_w").over(Window.partitionBy()) - F.coalesce(F.sum("_w").over(before), F.lit(0))
    big = lambda c: F.col(c).cast("decimal(19,0)")
    per = per.withColumn("_left", left).withColumn("_weight_left", weight_left)
    per = per.withColumn("_capped", big("_cap") * big("_weight_left") <= big("_w") * big("_left"))
    # Capped sources come first in this order; the level of the first uncapped one holds for all that follow.
    level = lambda c: F.first(F.when(~F.col("_capped"), F.col(c)), ignorenulls=True).over(Window.partitionBy())
    share = F.col("_w").cast("double") * level("_left").cast("double") / level("_weight_left").cast("double")
    return per.select("source", "source_size", F.when(F.col("_capped"), F.col("_cap").cast("double")).otherwise(share).alias("target"))


def unit_hash(doc_id: Column, seed: str, k: Column) -> Column:
    """A number in [0, 1) from the id and the k-th seed alone: 52 bits of an MD5, which gives two seeds theirs."""
    text = F.concat(F.lit(seed + ":"), F.floor(k / 2).cast("string"), F.lit(":"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    digest = F.md5(text.cast("binary"))
    return F.conv(F.substr(digest, (k % 2 * 16 + 1).cast("int"), F.lit(13)), 16, 10).cast("double") / F.lit(float(1 << 52))


def _source_key(source: Column) -> Column:
    """A source as a text that is never null."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("null"))


def source_rates(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_REPEATS, seed: str = SEED, seeds: int = SEEDS) -> DataFrame:
    """Settled (doc_id, source, size) rows -> one row a source: key, n, source_size, target, rate, k (its seed)."""
    n = sizes.groupBy("source").agg(F.count("*").alias("n"))
    per = source_targets(sizes, weights, most)
    per = per.join(n, per["source"].eqNullSafe(n["source"])).select(_source_key(per["source"]).alias("key"), "n", "source_size", "target")
    per = settle(per.withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)), "mixing-sources")
    rated = lookup(sizes.select("doc_id", "size", _source_key(F.col("source")).alias("key")), per.select("key", "n", "rate"), "key", "n")
    part = F.col("rate") - F.floor("rate")
    extra = [F.sum(F.when(unit_hash(F.col("doc_id"), seed, F.lit(k)) < part, F.col("size")).otherwise(0)).alias(f"x{k}") for k in range(seeds)]
    tried = per.join(rated.groupBy("key").agg(*extra), "key")
    whole = F.floor("rate").cast("double") * F.col("source_size").cast("double")
    off = [F.struct(F.abs(whole + F.col(f"x{k}").cast("double") - F.col("target")).alias("off"), F.lit(k).alias("k")) for k in range(seeds)]
    return settle(tried.select("key", "n", "source_size", "target", "rate", F.array_min(F.array(*off))["k"].alias("k")), "mixing-seeds")


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_REPEATS, seed: str = SEED, seeds: int = SEEDS, prefix: str = "") -> DataFrame:
    """docs (doc_id, text, source, ...) with _size, _source_size, _target, _rate, _copies and _taken, with the prefix before
    their names; docs must not have columns of these names."""
    if unused(docs, *(prefix + n for n in ADDED)):
        raise ValueError(f"the table has columns among {', '.join(prefix + n for n in ADDED)}")
    size, source_size, target, rate, copies, taken = (prefix + n for n in ADDED)
    # The sizes are counted once for the statistics and once where the rows are emitted; texts are never written.
    sizes = settle(docs.select("doc_id", "source", size_of(F.col("text")).alias("size")), "mixing-sizes")
    per = source_rates(sizes, weights, most, seed, seeds)
    p = unused(docs, "_key", "_k")
    key, k = p + "_key", p + "_k"
    per = per.select(F.col("key").alias(key), "n", F.col("source_size").alias(source_size), F.col("target").alias(target), F.col("rate").alias(rate), F.col("k").alias(k))
    per = per.withColumnRenamed("n", p + "_n_of_key")
    joined = lookup(docs.withColumns({size: size_of(F.col("text")), key: _source_key(F.col("source"))}), per, key, p + "_n_of_key").drop(key)
    whole = F.floor(rate)
    extra = (unit_hash(F.col("doc_id"), seed, F.col(k)) < F.col(rate) - whole).cast("long")
    joined = joined.withColumn(copies, whole.cast("long") + extra).withColumn(taken, F.col(copies) * F.col(size))
    return joined.select(*own(docs), size, source_size, target, rate, copies, taken)


def emit(mixed: DataFrame, prefix: str = "") -> DataFrame:
    """Each row as many times as its copies say, without the added columns."""
    copies, each = prefix + "_copies", unused(mixed, "_copy") + "_copy"
    return mixed.filter(F.col(copies) > 0).withColumn(each, F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies)))).drop(each, *(prefix + n for n in ADDED))


def mixture(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """The mixed documents, with their own columns."""
    prefix = unused(docs, *ADDED)
    return emit(mix(docs, weights, most, prefix=prefix), prefix)


def report(docs: DataFrame) -> DataFrame:
    """One row a document: doc_id, size, source_size, target, taken."""
    return mix(docs.select("doc_id", "text", "source")).selectExpr("doc_id", "_size AS size", "_source_size AS source_size", "_target AS target", "_taken AS taken")


def mixing_sql(seed: str = SEED, most: int = MOST_REPEATS, weights: Sequence[int] = WEIGHTS, seeds: int = SEEDS) -> str:
    """The same as DuckDB SQL over the view documents."""
    cases = " ".join(f"WHEN {k} THEN {w}" for k, w in enumerate(weights))
    return f"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size FROM documents),
per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % {len(weights)} {cases} END AS w
  FROM sized GROUP BY source),
filled AS (
  SELECT *, {most} * source_size AS cap,
    CAST(sum(source_size) OVER () AS BIGINT) - CAST(coalesce(sum({most} * source_size) OVER before, 0) AS BIGINT) AS total_left,
    CAST(sum(w) OVER () AS BIGINT) - CAST(coalesce(sum(w) OVER before, 0) AS BIGINT) AS weight_left
  FROM per
  WINDOW before AS (ORDER BY CAST({most} * source_size AS DOUBLE) / w, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
first_free AS (
  SELECT CAST(max_by(total_left, weight_left) AS DOUBLE) AS total_left, CAST(max(weight_left) AS DOUBLE) AS weight_left
  FROM filled WHERE cap * weight_left > w * total_left),
targets AS (
  SELECT source, source_size,
    CASE WHEN cap * f.weight_left <= w * f.total_left THEN CAST(cap AS DOUBLE)
         ELSE CAST(w AS DOUBLE) * g.total_left / g.weight_left END AS target
  FROM filled f CROSS JOIN first_free g),
rated AS (
  SELECT doc_id, s.source, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
tried AS (
  SELECT *, CASE WHEN CAST(CAST('0x' || substr(md5('{seed}:' || (k // 2) || ':' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1 + 16 * (k % 2), 13) AS BIGINT) AS DOUBLE)
    / 4503599627370496.0 < rate - floor(rate) THEN size ELSE 0 END AS extra
  FROM rated, range({seeds}) t(k)),
sums AS (
  SELECT source, k, abs(floor(any_value(rate)) * CAST(any_value(source_size) AS DOUBLE) + CAST(sum(extra) AS DOUBLE) - any_value(target)) AS off FROM tried GROUP BY source, k),
chosen AS (SELECT source, k FROM sums QUALIFY row_number() OVER (PARTITION BY source ORDER BY off, k) = 1)
SELECT doc_id, size, source_size, target, CAST(floor(rate) AS BIGINT) * size + extra AS taken
FROM tried t JOIN chosen c ON t.source IS NOT DISTINCT FROM c.source AND t.k = c.k"""
