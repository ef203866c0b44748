"""Exact top-k search by distributed histogram selection.

Everything is scored against everything that is asked for; what travels are histograms. Each round splits every query's
open interval of scores into BINS; tasks count their scores, the counts are summed, and the bin that holds the k-th best
becomes the next interval, until it is one score wide. A last pass keeps what scores above it, and of what ties with it
the smallest ids. A task sends no bin below the one where its own scores already make up k (the global k-th best can't
be lower), and no more ties than are wanted, so neither grows with the number of rows or of equal vectors.

Queries lie in the shared folder in blocks of about QUERY_BLOCK, a row each with its matrix and intervals; a round is one
job for all blocks: a task takes some of its candidates into memory and streams the blocks past them. The candidates are
scored in place and never shuffled; the driver sees neither queries nor scores. Work grows with queries times candidates.

Components are floor(1024 * x), kept as doubles, which hold them exactly. Scores are exact integers of any size: large
factors are multiplied as 64-bit or unbounded integers; a score beyond a long counts as the nearest long. Rows with a
null id, a null vector, or components that are null or not finite (or not so 1024-fold) take no part; candidates of
another length than the query's are passed over. Rows repeated with id and vector are one query but each a candidate. A
query's own id is no candidate of it. Fewer than k candidates give fewer rows; an empty table gives an empty result. Only
vec_id and embedding are read, and is_query may refer to vec_id alone, so other columns can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import settle
from .stores import open_store

SCALE = 1024
BINS = 256
QUERY_BLOCK = 1024
#: Candidates scored at once, and bytes of candidates a task holds while the blocks pass.
CHUNK, HELD_BYTES = 2048, 32 << 20
#: Candidates' largest component and queries' sums of components up to which a product is exact in doubles.
PLAIN_CANDIDATE, PLAIN_QUERY = float(1 << 20), float(1 << 32)

_LEAST, _MOST = -(1 << 63), (1 << 63) - 1
_SIGN = np.uint64(1 << 63)
_STATE = "block long, dim int, open boolean, ids binary, matrix binary, low binary, high binary, above binary"


def quantise(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, embedding) -> vec_id, dim, v: the valid rows, components as packed doubles."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids, dims, packed = [], [], []
            for i, x in zip(batch["vec_id"], batch["embedding"], strict=True):
                with np.errstate(over="ignore"):
                    x = np.floor(scale * np.array(x, dtype=np.float64))  # a null component becomes NaN
                if np.isfinite(x).all():
                    ids.append(int(i))
                    dims.append(len(x))
                    packed.append(x.tobytes())
            yield pd.DataFrame({"vec_id": np.array(ids, np.int64), "dim": np.array(dims, np.int32), "v": packed})

    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    return rows.filter("vec_id IS NOT NULL AND embedding IS NOT NULL").mapInPandas(pack, "vec_id long, dim int, v binary")


def _ordered(scores: np.ndarray) -> np.ndarray:
    """Longs as unsigned integers in the same order, so that differences don't overflow."""
    return scores.view(np.uint64) ^ _SIGN


def _wide(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products of large factors: exact, and the nearest long where they are beyond."""
    bound = sum(int(a) * int(b) for a, b in zip(np.abs(q).max(0, initial=0), np.abs(c).max(0, initial=0), strict=True))
    if bound < 1 << 62:
        return q.astype(np.int64) @ c.astype(np.int64).T
    whole = np.frompyfunc(int, 1, 1)
    exact = np.atleast_2d(whole(q) @ whole(c).T)
    return np.frompyfunc(lambda x: min(max(x, _LEAST), _MOST), 1, 1)(exact).astype(np.int64)


def inner_products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact scores of all rows of q with all of c, as longs."""
    s = np.zeros((len(q), len(c)), np.int64)
    large_q = np.abs(q).sum(1) > PLAIN_QUERY
    large_c = np.abs(c).max(1, initial=0) > PLAIN_CANDIDATE
    if not large_q.any() and not large_c.any():
        return (q @ c.T).astype(np.int64)
    s[np.ix_(~large_q, ~large_c)] = (q[~large_q] @ c[~large_c].T).astype(np.int64)
    if large_q.any():
        s[large_q] = _wide(q[large_q], c)
    if large_c.any():
        s[:, large_c] = _wide(q, c[large_c])
    return s


class _Block:
    """Queries with their open intervals of scores (as ordered integers) and how many scores lie above."""

    def __init__(self, row: dict) -> None:
        self.number, self.dim = row["block"], row["dim"]
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.matrix = np.frombuffer(row["matrix"], np.float64).reshape(len(self.ids), self.dim)
        self.low, self.high = np.frombuffer(row["low"], np.uint64), np.frombuffer(row["high"], np.uint64)
        self.above, self.open = np.frombuffer(row["above"], np.int64), row["open"]

    @property
    def step(self) -> np.ndarray:
        return (self.high - self.low) // np.uint64(BINS) + np.uint64(1)

    def scored(self, ids: np.ndarray, c: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Chunks of candidate ids, ordered scores by query and candidate, and which are the query itself."""
        for k in range(0, len(ids), CHUNK):
            part = ids[k : k + CHUNK]
            yield part, _ordered(inner_products(self.matrix, c[k : k + CHUNK])), self.ids[:, None] == part[None, :]


def _stored(path: str) -> Iterator[_Block]:
    """The blocks of a settled table, one in memory at a time."""
    fs, folder = open_store(path)
    for name in sorted(f.path for f in fs.get_file_info(pafs.FileSelector(folder)) if f.base_name.endswith(".parquet")):
        with fs.open_input_file(name) as file:
            for batch in pq.ParquetFile(file).iter_batches(batch_size=1):
                yield from (_Block(row) for row in batch.to_pylist())


def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[int, tuple[np.ndarray, np.ndarray]]]:
    """By dimension, ids and matrix of about HELD_BYTES of candidates."""
    held: list[pa.RecordBatch] = []

    def gathered() -> dict[int, tuple[np.ndarray, np.ndarray]]:
        rows = pa.Table.from_batches(held)
        ids, dims, out = rows["vec_id"].to_numpy(), rows["dim"].to_numpy(), {}
        data = rows["v"].to_pylist()
        for d in np.unique(dims):
            at = np.flatnonzero(dims == d)
            out[int(d)] = ids[at], np.frombuffer(b"".join(data[k] for k in at), np.float64).reshape(len(at), d)
        return out

    for batch in batches:
        for piece in (batch.slice(k, 4 * CHUNK) for k in range(0, batch.num_rows, 4 * CHUNK)):
            held.append(piece)
            if sum(x.nbytes for x in held) > HELD_BYTES:
                yield gathered()
                held.clear()
    if held:
        yield gathered()


def _first_state(rows: DataFrame, is_query, block: int) -> DataFrame:
    asked = rows.filter(is_query).dropDuplicates(["vec_id", "v"])
    blocks = max(1, -(-asked.count() // block))
    largest = rows.mapInArrow(_largest, "dim int, m double").groupBy("dim").agg(F.max("m").alias("m"))  # one row a dimension
    asked = asked.withColumn("_b", F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks))).join(largest, "dim")

    def gather(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["vec_id", "v"])
        matrix = np.array([np.frombuffer(v, np.float64) for v in group["v"]]).reshape(len(group), -1)
        most = int(group["m"].iloc[0])
        reach = [sum(int(x) for x in np.abs(q)) * most for q in matrix]
        low, high = (_ordered(np.array(x, np.int64)) for x in ([max(-h, _LEAST) for h in reach], [min(h, _MOST) for h in reach]))
        dim, ids = int(group["dim"].iloc[0]), group["vec_id"].to_numpy(np.int64)
        number = int(np.int64((dim << 40) + group["_b"].iloc[0]))
        return pd.DataFrame([(number, dim, True, ids.tobytes(), matrix.tobytes(), low.tobytes(), high.tobytes(), np.zeros(len(ids), np.int64).tobytes())], columns=[x.split()[0] for x in _STATE.split(", ")])

    return asked.groupBy("dim", "_b").applyInPandas(gather, _STATE)


def _largest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for held in _held(batches):
        yield pa.RecordBatch.from_pydict({"dim": pa.array(list(held), pa.int32()), "m": pa.array([float(np.abs(c).max(initial=0)) for _, c in held.values()], pa.float64())})


def _histograms(rows: DataFrame, path: str, k: int) -> DataFrame:
    """Of all blocks' queries the counts of scores by bin."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _held(batches):
            for b in _stored(path):
                if b.dim not in held or not b.open:
                    continue
                n, low, step = len(b.ids), b.low, b.step
                total = np.zeros(n * BINS, np.int64)
                for _, s, same in b.scored(*held[b.dim]):
                    q, c = np.nonzero((s >= low[:, None]) & (s <= b.high[:, None]) & ~same)
                    total += np.bincount(q * BINS + ((s[q, c] - low[q]) // step[q]).astype(np.int64), minlength=n * BINS)
                h = total.reshape(n, BINS)
                over = np.cumsum(h[:, ::-1], 1)[:, ::-1] - h  # what these candidates have above each bin
                q, at = np.nonzero((h > 0) & (over < (k - b.above)[:, None]))
                yield pa.RecordBatch.from_pydict({"block": pa.array(np.full(len(q), b.number)), "q": pa.array(q.astype(np.int32)), "bin": pa.array(at.astype(np.int32)), "n": pa.array(h[q, at])})

    return rows.mapInArrow(count, "block long, q int, bin int, n long").groupBy("block", "q", "bin").agg(F.sum("n").alias("n"))


def _narrowed(state: DataFrame, counts: DataFrame, k: int) -> DataFrame:
    """The intervals that hold the k-th best; of fewer than k candidates all are taken, from the lowest bound on."""

    def narrow(block: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        row = block.iloc[0].to_dict()
        b = _Block(row)
        if b.open:
            h = np.zeros((len(b.ids), BINS), np.int64)
            h[told["q"], told["bin"]] = told["n"]
            upto = np.cumsum(h[:, ::-1], 1)[:, ::-1]
            reach = upto >= (k - b.above)[:, None]
            enough = reach.any(1)
            at = np.where(enough, BINS - 1 - np.argmax(reach[:, ::-1], 1), 0)  # the highest bin that reaches k
            low = np.where(enough, b.low + at.astype(np.uint64) * b.step, b.low)
            high = np.where(enough, np.minimum(b.high, low + (b.step - np.uint64(1))), b.low)
            q = np.arange(len(b.ids))
            above = b.above + np.where(enough, upto[q, at] - h[q, at], 0)
            row |= {"low": low.tobytes(), "high": high.tobytes(), "above": above.tobytes(), "open": bool((high > low).any())}
        return pd.DataFrame([row])

    return state.groupBy("block").cogroup(counts.groupBy("block")).applyInPandas(narrow, _STATE)


def _kept(rows: DataFrame, path: str, k: int) -> DataFrame:
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _held(batches):
            for b in _stored(path):
                if b.dim not in held:
                    continue
                kth, want = b.low, np.maximum(k - b.above, 0)
                ties: dict[int, np.ndarray] = {}
                found: list[tuple] = []
                for ids, s, same in b.scored(*held[b.dim]):
                    q, c = np.nonzero((s > kth[:, None]) & ~same)
                    found.append((q, ids[c], s[q, c]))
                    equal = (s == kth[:, None]) & ~same
                    for q in np.flatnonzero(equal.any(1)).tolist():
                        ties[q] = np.sort(np.concatenate([ties.get(q, ids[:0]), ids[equal[q]]]))[: int(want[q])]
                found += [(np.full(len(t), q), t, np.full(len(t), kth[q])) for q, t in ties.items()]
                q, ids, s = (np.concatenate([f[j] for f in found]) for j in range(3))
                q = q.astype(np.int64)
                yield pa.RecordBatch.from_pydict({"query_id": pa.array(b.ids[q]), "block": pa.array(np.full(len(q), b.number)), "q": pa.array(q), "vec_id": pa.array(ids), "score": pa.array((s.astype(np.uint64) ^ _SIGN).view(np.int64))})

    return rows.mapInArrow(keep, "query_id long, block long, q long, vec_id long, score long")


def top_k(vectors: DataFrame, is_query, k: int = 10, block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score of the k best candidates of every row that is_query (a Column of vec_id) selects."""
    rows = settle(quantise(vectors), "topk-vectors")
    state = settle(_first_state(rows, is_query, block), "topk-state")
    while state.filter("open").limit(1).count():  # at most eight rounds: each leaves a 256th of 64 bits
        state = settle(_narrowed(state, _histograms(rows, state.settled_at, k), k), "topk-state")
    kept = _kept(rows, state.settled_at, k)
    order = Window.partitionBy("block", "q").orderBy(F.col("score").desc(), "vec_id")
    return kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
