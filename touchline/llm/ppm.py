"""LM scoring by prediction by partial matching (PPM), beside a unigram base score.

A text is coded as its lower-cased white-space tokens, a space between two and an end mark behind the last, byte by
byte. The model is a byte-context trie of ORDER context bytes, held as tables of counts: n(context, byte) for every
context length. A byte is predicted by the longest known context; if that has not seen it, the escape (method C: as
likely as the number of distinct bytes seen there) leads to the next shorter one, where the bytes that the longer
context has seen are excluded, and in the end to a uniform choice among bytes never seen. Bytes seen after a context
are also seen after its suffixes, so what exclusion takes from a context's total is one number of the longer context
(E below), and the code length of a byte is a closed expression of a few table entries.

Counting: tasks sort their (ORDER + 1)-byte grams and send each distinct one once; the sums are a table in the shared
folder. Scoring: a model of at most BLOCK_GRAMS grams, which is counted, is broadcast and every chunk of documents scored
where it is packed. A larger one stays in the shared folder, cut into blocks of at most so many grams by the two context
bytes next to the predicted byte, or more of them where two have too many (no back-off above the shared orders crosses
such a cut; the few counts of the shared orders go with each block). Of its most frequent grams, as many as a block holds,
the code lengths are broadcast, and chunks are scored with them where they are packed; for its other distinct grams, rare
or unseen, every chunk asks by a packed list a block; tasks that each load a block's model one after another answer; and
the answers return to their chunk. So the documents are read and packed once, whatever the model's size, no text is
written, and no task holds more than a block and a chunk.

The base score needs the corpus count of every token, a vocabulary without a bound, so nothing of it is broadcast:
documents are packed in chunks of about CHUNK_BYTES as ids of the chunk's own vocabulary; the chunks' counts are summed
by token, with partial sums before the shuffle, looked up from every chunk (frequent tokens dealt over salts), and summed
there by document. A token comes once a chunk, so frequent tokens have as many rows as there are chunks, not documents.

Null texts are empty: one end token. Texts are bytes, so what is no UTF-8 is scored like anything else; long texts are
scored whole. Rows with a null id count as training rows. Repeated rows are scored alike, and count as often as they
stand in the training part. Without training rows the base is log10(1) and PPM codes uniformly. An empty table gives an
empty result. Only doc_id and text are read, so other columns can't clash.
"""

from __future__ import annotations

import copy
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .common import fresh_path, lookup, remainder, settle, slices, space_tokens, tidy
from .stores import open_store
from .tables import Lookup

ORDER = 5
MOD, OUT = 7, 2
END = b"\n"
BLOCK_GRAMS = 1_000_000
CHUNK_BYTES = 6 << 20
FLUSH_GRAMS = 2_000_000


def coded(text: bytes | None) -> bytes:
    """What is predicted of a text: tokens, spaces between, and the end mark (a newline, which no token holds)."""
    return b" ".join(space_tokens(text)) + END


def gram_keys(texts: list[bytes | None], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """For every coded byte the integer of it and the `order` bytes before (end marks before the start); and where each text begins."""
    coded_texts = [coded(t) for t in texts]
    buffer = np.frombuffer(b"".join(END * order + t for t in coded_texts), np.uint8)
    lengths = np.array([len(t) for t in coded_texts], np.int64)
    keys = np.zeros(max(len(buffer) - order, 0), np.uint64)
    for j in range(order + 1):
        keys |= buffer[order - j : len(buffer) - j].astype(np.uint64) << np.uint64(8 * j)
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64) if len(lengths) else lengths
    keep = np.ones(len(keys), bool)
    for j in range(1, order + 1):  # positions that are another text's padding
        keep[starts[1:] + order * np.arange(len(lengths) - 1) + j - 1] = False
    return keys[keep], starts


def _distinct(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    if counts is None:
        keys = np.sort(keys)
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        return keys[first], np.diff(np.append(first, len(keys)))
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(keys) else counts


def count_grams(texts: DataFrame, order: int = ORDER) -> DataFrame:
    """(text binary) -> gram, n."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            return _distinct(np.concatenate([k for k, _ in held]), np.concatenate([n for _, n in held]))

        def told(keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"gram": pa.array(keys.astype(np.int64)), "n": pa.array(n.astype(np.int64))})

        for batch in batches:
            for piece in slices(batch, CHUNK_BYTES // 2):
                held.append(_distinct(gram_keys(piece.column("text").to_pylist(), order)[0]))
                if sum(len(k) for k, _ in held) > FLUSH_GRAMS:
                    held = [merged()]
                    if len(held[0][0]) > FLUSH_GRAMS // 2:
                        yield told(*held.pop())
        if held:
            yield told(*merged())
        held.clear()
        tidy()

    return texts.mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


class ByteModel:
    """PPM code lengths from gram counts of the whole corpus or of a block.

    Of each order k: n by gram, and T (total), D (distinct bytes) and E (what exclusion takes one order below) by context.
    """

    def __init__(self, grams: np.ndarray, n: np.ndarray, low: tuple[np.ndarray, np.ndarray], order: int = ORDER, shared: dict[int, tuple[np.ndarray, np.ndarray]] | None = None) -> None:
        """low: the counts of the two-byte grams of the whole corpus, which all blocks need for orders 1 and 0; shared: by
        order, the counts that this block has in common with others."""
        self.order = order
        table = [_distinct(low[0] & np.uint64(0xFF), low[1]), low]
        for k in range(2, order + 1):
            held = _distinct(grams & np.uint64((1 << 8 * (k + 1)) - 1), n)
            if shared and k in shared:  # what the block holds of these contexts is a part; contexts of its own stay
                full = _distinct(*shared[k])
                keep = ~np.isin(held[0] >> np.uint64(8), np.unique(full[0] >> np.uint64(8)))
                held = _distinct(np.concatenate([held[0][keep], full[0]]), np.concatenate([held[1][keep], full[1]]))
            table.append(held)
        self.n, self.context = [], []
        top = None
        for k in range(len(table)):
            (keys, counts), table[k] = table[k], None
            narrow = np.int32 if len(counts) == 0 or counts.max() < 1 << 31 else np.float64
            self.n.append(Lookup(keys, counts.astype(narrow), 0) if k < order else None)
            contexts, first = np.unique(keys >> np.uint64(8), return_index=True)
            sums = lambda x: np.add.reduceat(x, first) if len(first) else x[:0]  # noqa: B023, E731
            total, kinds = sums(counts.astype(np.float64)), np.diff(np.append(first, len(keys))).astype(np.float64)
            below = sums(self.n[k - 1](keys & np.uint64((1 << 8 * k) - 1))) if k else np.zeros(len(first))
            self.context.append(Lookup(contexts, np.arange(1, len(contexts) + 1, dtype=np.int32), 0))
            self.context[k].rows = np.column_stack([np.zeros(3), np.stack([total, kinds, below])]).T
            if k == order:
                of = np.repeat(np.arange(len(first)), kinds.astype(np.int64))
                top = np.log10(counts / (total[of] + kinds[of])) if len(keys) else np.zeros(0)
                self.top = Lookup(keys, top, 1.0)

    def log10(self, keys: np.ndarray) -> np.ndarray:
        """Of each gram, log10 of the probability of its last byte after the others."""
        out = self.top(keys)
        left = np.flatnonzero(out > 0)
        out[left] = 0
        gone_total, gone_kinds = np.zeros(len(left)), np.zeros(len(left))
        for k in range(self.order, -1, -1):
            g = keys[left] & np.uint64((1 << 8 * (k + 1)) - 1)
            total, kinds, below = self.context[k].rows[self.context[k](g >> np.uint64(8))].T
            known = kinds > 0
            rest, new = total - gone_total, kinds - gone_kinds
            n = self.n[k](g) if k < self.order else np.zeros(len(left))
            with np.errstate(divide="ignore", invalid="ignore"):
                here = np.log10(n / (rest + new))
                escape = np.where(known & (new > 0), np.log10(new / (rest + new)), 0.0)
            found = n > 0
            out[left] += np.where(found, here, escape)
            left, gone_total, gone_kinds = left[~found], below[~found], kinds[~found]
        if len(left):
            out[left] -= np.log10(256 - gone_kinds)  # uniform among bytes never seen
        return out


def _arrays(df: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    rows = df.toArrow()
    return rows["gram"].to_numpy().view(np.uint64), rows["n"].to_numpy()


class Blocks:
    """Which block of the model a gram belongs to, by its nearest context bytes: two, and more where two have too many grams."""

    def __init__(self, grams: DataFrame, order: int, most: int) -> None:
        self.levels: list[tuple[int, Lookup]] = []
        self.shared: list[tuple[int, int, int]] = []  # (block, order, context): counts that the block shares with others
        n_blocks, split = 0, {0: []}  # contexts to cut further, and the longer contexts they lie under
        rows = grams
        for depth in range(2, max(order, 2) + 1):
            mask = (1 << 8 * depth) - 1
            if depth > 2:
                over = rows.sparkSession.createDataFrame([(k,) for k in split], "over long")  # each has more than `most` grams
                rows = grams.withColumn("over", F.shiftright("gram", 8).bitwiseAND((1 << 8 * (depth - 1)) - 1)).join(F.broadcast(over), "over").drop("over")
            sizes = rows.groupBy(F.shiftright("gram", 8).bitwiseAND(mask).alias("context")).count().orderBy("context").toArrow()
            contexts, counts = sizes["context"].to_numpy(), sizes["count"].to_numpy()
            parents = contexts & ((1 << 8 * (depth - 1)) - 1) if depth > 2 else np.zeros(len(contexts), np.int64)
            at = np.full(len(contexts), -1, np.int64)
            deeper = {}
            for parent in np.unique(parents):
                held = most
                for k in np.flatnonzero(parents == parent):
                    if counts[k] > most and depth < order:
                        deeper[int(contexts[k])] = [*split[int(parent)], *([(depth - 1, int(parent))] if depth > 2 else [])]
                        continue
                    if held + counts[k] > most:
                        held, n_blocks = 0, n_blocks + 1
                        self.shared += [(n_blocks - 1, o, c) for o, c in (*split[int(parent)], *([(depth - 1, int(parent))] if depth > 2 else []))]
                    held += counts[k]
                    at[k] = n_blocks - 1
            self.levels.append((depth, Lookup(contexts.astype(np.uint64), at, -2)))
            split = deeper
            if not split:
                break
        self.n = max(n_blocks, 1)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """A gram under an unseen context belongs to the block of a sibling that it may fall back to, or to block 0."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for k, (depth, found) in enumerate(self.levels):
            at = found((keys[left] >> np.uint64(8)) & np.uint64((1 << 8 * depth) - 1))
            new = at == -2
            at[new] = 0 if k == 0 else self.first[k](keys[left[new]] >> np.uint64(8) & np.uint64((1 << 8 * (depth - 1)) - 1))
            out[left] = at
            left = left[at == -1]
        return out

    @property
    def first(self) -> list[Lookup | None]:
        """By level, a block under each cut context of the level before."""
        if not hasattr(self, "_first"):
            self._first = [None]
            for depth, found in self.levels[1:]:
                used = (found.keys != Lookup.FREE) & (found.values >= 0)
                parents, at = np.unique(found.keys[used] & np.uint64((1 << 8 * (depth - 1)) - 1), return_index=True)
                self._first.append(Lookup(parents, found.values[used][at], 0))
        return self._first


def _frequent(grams: DataFrame, most: int) -> Lookup:
    """log10 of the probabilities of the most frequent grams, `most` of them at most; 1 for others."""
    steps = sorted({int(2 ** (k / 2)) for k in range(2, 122)})
    held = grams.agg(*(F.count_if(F.col("n") >= t) for t in steps)).first()
    least = next(t for t, rows in zip(steps, held, strict=True) if rows <= most)
    by_context = grams.withColumn("context", F.shiftrightunsigned("gram", 8))
    sums = by_context.groupBy("context").agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))
    rows = by_context.filter(F.col("n") >= least).join(sums, "context").select("gram", "n", "total", "kinds").toArrow()
    n, total, kinds = (rows[c].to_numpy().astype(np.float64) for c in ("n", "total", "kinds"))
    return Lookup(rows["gram"].to_numpy().view(np.uint64), np.log10(n / (total + kinds)), 1.0)


class StoredModel:
    """A model in the shared folder, by block; the code lengths of its most frequent grams go with it."""

    def __init__(self, grams: DataFrame, low: tuple[np.ndarray, np.ndarray], order: int, most: int) -> None:
        self.low, self.order, self.blocks = low, order, Blocks(grams, order, most)
        spark, blocks = grams.sparkSession, grams.sparkSession.sparkContext.broadcast(self.blocks)

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at = blocks.value(batch.column("gram").to_numpy().view(np.uint64))
                yield pa.RecordBatch.from_pydict({"block": at, "k": pa.array(np.full(len(at), order, np.int32)), "gram": batch.column("gram"), "n": batch.column("n")})
            tidy()

        rows = grams.select("gram", "n").mapInArrow(place, "block long, k int, gram long, n long")
        for k in sorted({o for _, o, _ in self.blocks.shared}):
            asked = spark.createDataFrame([(b, c) for b, o, c in self.blocks.shared if o == k], "block long, context long")
            some = grams.withColumn("context", F.shiftright("gram", 8).bitwiseAND((1 << 8 * k) - 1)).join(F.broadcast(asked.select("context").distinct()), "context")
            some = some.groupBy("context", F.col("gram").bitwiseAND((1 << 8 * (k + 1)) - 1).alias("gram")).agg(F.sum("n").alias("n"))
            rows = rows.unionByName(some.join(F.broadcast(asked), "context").select("block", F.lit(k).alias("k"), "gram", "n"))
        self.path = fresh_path(spark, "ppm-model")
        rows.repartition(min(self.blocks.n, 2000), "block").write.partitionBy("block").option("compression", "zstd").parquet(self.path)
        self.frequent = _frequent(grams, most)

    def load(self, block: int) -> ByteModel:
        fs, path = open_store(f"{self.path}/block={block}")
        files = [f.path for f in fs.get_file_info(pafs.FileSelector(path, allow_not_found=True)) if f.base_name.endswith(".parquet")]
        tables = [pq.ParquetFile(fs.open_input_file(f)).read() for f in files]
        k, gram, n = (np.concatenate([t[c].to_numpy() for t in tables]) if tables else np.zeros(0, np.int64) for c in ("k", "gram", "n"))
        gram = gram.view(np.uint64)
        shared = {int(o): (gram[k == o], n[k == o]) for o in np.unique(k) if o < self.order}
        return ByteModel(gram[k == self.order], n[k == self.order], self.low, self.order, shared)


def model_of(grams: DataFrame, order: int = ORDER, most: int = BLOCK_GRAMS) -> ByteModel | StoredModel:
    low = _distinct(*_arrays(grams.groupBy(F.col("gram").bitwiseAND(0xFFFF).alias("gram")).agg(F.sum("n").alias("n"))))  # 65,536 rows at most
    if grams.limit(most + 1).count() <= most:
        return ByteModel(*_arrays(grams), low, order)
    return StoredModel(grams, low, order, most)


def scores_of(model: ByteModel, texts: list[bytes | None]) -> np.ndarray:
    scores = np.zeros(len(texts))
    for first, part in _parts(texts):
        keys, starts = gram_keys(part, model.order)
        scores[first : first + len(part)] = np.add.reduceat(model.log10(keys), starts)
    return scores


def _parts(texts: list[bytes | None], size: int = 1 << 18) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of texts of about `size` bytes, and where they begin."""
    part, held, first = [], 0, 0
    for k, t in enumerate(texts):
        part.append(t or b"")
        held += len(part[-1])
        if held > size:
            yield first, part
            part, held, first = [], 0, k + 1
    if part:
        yield first, part


CHUNK = "chunk long, doc_ids array<long>, held array<boolean>, scores array<double>, ends array<int>, ids binary, tokens array<binary>, counts array<long>, rare binary, places binary"


def packed(ids: np.ndarray) -> bytes:
    """Differences of ids that ascend within a document, compressed; the first four bytes tell the length."""
    raw = np.diff(ids, prepend=np.int32(0)).astype(np.int32).tobytes()
    return np.int32(len(ids)).tobytes() + pa.compress(raw, codec="zstd", asbytes=True)


def unpacked(data: bytes) -> np.ndarray:
    n = int(np.frombuffer(data[:4], np.int32)[0])
    return np.cumsum(np.frombuffer(pa.decompress(data[4:], 4 * n, codec="zstd", asbytes=True), np.int32), dtype=np.int64)


def _squeezed(numbers: np.ndarray) -> bytes:
    return numbers.nbytes.to_bytes(8, "little") + pa.compress(numbers.tobytes(), codec="zstd", asbytes=True)


def _loosened(data: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True), kind)


def frequent_scores(stored: StoredModel, texts: list[bytes | None]) -> tuple[list[float], bytes, bytes]:
    """Of each text the sum over frequent grams; the other distinct grams, ordered by block; and where each text's begin to
    differ from the one before, places among them and how often each occurs."""
    scores, keys, of = np.zeros(len(texts)), [], []
    for first, part in _parts(texts):
        grams, starts = gram_keys(part, stored.order)
        told = stored.frequent(grams)
        rare = np.flatnonzero(told > 0)
        told[rare] = 0
        scores[first : first + len(part)] = np.add.reduceat(told, starts)
        keys.append(grams[rare])
        of.append(first + np.searchsorted(starts, rare, side="right") - 1)
    distinct, at = np.unique(np.concatenate(keys or [np.zeros(0, np.uint64)]), return_inverse=True)
    order = np.argsort(stored.blocks(distinct), kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    pairs, times = np.unique(np.concatenate(of or [np.zeros(0, np.int64)]) * max(len(order), 1) + place[at], return_counts=True)
    ends = np.searchsorted(pairs, np.arange(1, len(texts) + 1) * max(len(order), 1))
    return scores.tolist(), _squeezed(distinct[order]), _squeezed(np.concatenate([ends, pairs % max(len(order), 1), times]).astype(np.int32))


def pack_chunks(docs: DataFrame, model: ByteModel | StoredModel, size: int = CHUNK_BYTES) -> DataFrame:
    """(doc_id, text, _held) -> chunks of documents as ids of their own vocabulary; counts: by token, of training rows;
    scores: in the same pass, by a model that is broadcast, or by what is frequent in a stored one; rare, places: the rest."""

    schema = to_arrow_schema(StructType.fromDDL(CHUNK))
    whole = docs.sparkSession.sparkContext.broadcast(model)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = 0
        for batch in batches:
            for piece in slices(batch, size):
                known: dict[bytes, int] = {}
                ids, ends, at = [], [], 0
                held = piece.column("_held").to_pylist()
                texts = piece.column("text").to_pylist()
                for text in texts:
                    tokens = [*space_tokens(text), END]
                    ids.append(np.sort(np.fromiter((known.setdefault(t, len(known)) for t in tokens), np.int32, len(tokens))))
                    at += len(tokens)
                    ends.append(at)
                counts = np.zeros(len(known), np.int64)
                trained = [x for x, out in zip(ids, held, strict=True) if not out]
                if trained:
                    counts += np.bincount(np.concatenate(trained), minlength=len(known))
                told = (scores_of(whole.value, texts).tolist(), None, None) if isinstance(whole.value, ByteModel) else frequent_scores(whole.value, texts)
                scores, *rest = told
                row = [(TaskContext.get().partitionId() << 32) + k, piece.column("doc_id").to_pylist(), held, scores, ends, packed(np.concatenate(ids)), list(known), counts.tolist(), *rest]
                yield pa.RecordBatch.from_arrays([pa.array([x], type=f.type) for x, f in zip(row, schema, strict=True)], schema=schema)
                k += 1
                del known, ids, texts, tokens, row, told, rest
                tidy()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"), "_held").mapInArrow(pack, CHUNK)


def answers_of(chunks: DataFrame, model: StoredModel) -> DataFrame:
    """Settled chunks -> chunk, told: of the chunk's rare grams log10 of their probabilities, packed, a block each."""
    slim = copy.copy(model)
    slim.frequent = None
    stored = chunks.sparkSession.sparkContext.broadcast(slim)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, rare in zip(batch.column("chunk").to_pylist(), batch.column("rare").to_pylist(), strict=True):
                keys = _loosened(rare, np.uint64)
                block = stored.value.blocks(keys)
                first = np.flatnonzero(np.append(True, block[1:] != block[:-1])) if len(block) else np.zeros(0, np.int64)
                parts = [keys[i:j].tobytes() for i, j in zip(first, np.append(first[1:], len(keys)), strict=True)]
                yield pa.RecordBatch.from_pydict({"chunk": pa.array([chunk] * len(parts), pa.int64()), "block": pa.array(block[first], pa.int64()), "x": pa.array(parts, pa.binary())})

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, at = None, None
        for batch in batches:
            told = []
            for block, x in zip(batch.column("block").to_pylist(), batch.column("x").to_pylist(), strict=True):
                if block != now:
                    now, at = block, None  # the last block's tables go before the next one's come
                    at = stored.value.load(block)
                told.append(at.log10(np.frombuffer(x, np.uint64)).tobytes())
            yield pa.RecordBatch.from_pydict({"chunk": batch.column("chunk"), "block": batch.column("block"), "x": pa.array(told, pa.binary())})
        at = None
        tidy()

    asked = chunks.select("chunk", "rare").mapInArrow(ask, "chunk long, block long, x binary")
    n = chunks.count()
    deals = 2 + n // 1000  # a block is asked by every chunk, so its questions are dealt over tasks as chunks grow in number
    asked = asked.repartition(int(min(model.blocks.n * deals, 20_000)), "block", F.pmod(F.xxhash64("chunk"), F.lit(deals))).sortWithinPartitions("block")
    told = settle(asked.mapInArrow(answer, "chunk long, block long, x binary"), "ppm-answers")
    return told.groupBy("chunk").agg(F.transform(F.array_sort(F.collect_list(F.struct("block", "x"))), lambda x: x["x"]).alias("told"))


def base_scores(chunks: DataFrame, model: ByteModel | StoredModel) -> DataFrame:
    """Settled chunks -> doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    asked = chunks.select("chunk", F.posexplode(F.arrays_zip("tokens", "counts")).alias("pos", "x")).select("chunk", "pos", "x.tokens", "x.counts")
    totals = settle(asked.groupBy("tokens").agg(F.sum("counts").alias("c"), F.count("*").alias("n")).filter("c > 0"), "ppm-tokens")
    sums = totals.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    n, v = int(sums.n), int(sums.v)
    answers = lookup(asked.select("chunk", "pos", "tokens"), totals, "tokens", "n").filter("c IS NOT NULL")
    answers = answers.groupBy("chunk").agg(F.collect_list(F.struct("pos", "c")).alias("x")).select("chunk", F.col("x.pos").alias("pos"), F.col("x.c").alias("c"))
    own = chunks.select("chunk", "doc_ids", "held", "scores", "ends", "ids", F.size("tokens").alias("kinds"), "places").join(answers, "chunk", "left")
    stored = isinstance(model, StoredModel)
    if stored:
        own = own.join(answers_of(chunks, model), "chunk", "left")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                x = {name: batch.column(name)[row] for name in batch.schema.names}
                c = np.zeros(x["kinds"].as_py(), np.int64)
                if x["pos"].is_valid:
                    c[x["pos"].values.to_numpy()] = x["c"].values.to_numpy()
                ids = unpacked(x["ids"].as_py())
                ends = x["ends"].values.to_numpy().astype(np.int64)
                starts = np.concatenate([[0], ends[:-1]])
                scores = x["scores"].values
                if stored and x["told"].is_valid:
                    told = np.concatenate([np.frombuffer(t, np.float64) for t in x["told"].as_py()])
                    places = _loosened(x["places"].as_py(), np.int32)
                    of = np.repeat(np.arange(len(ends)), np.diff(places[: len(ends)], prepend=0))
                    place, times = places[len(ends) :].reshape(2, -1)
                    scores = pa.array(scores.to_numpy() + np.bincount(of, told[place] * times, len(ends)))
                yield pa.RecordBatch.from_pydict({
                    "doc_id": x["doc_ids"].values, "held_out": x["held"].values, "n_tokens": pa.array(ends - starts), "n_known": pa.array(np.add.reduceat((c > 0).astype(np.int64)[ids], starts)),
                    "logs": pa.array(np.add.reduceat(np.log10(c + 1.0)[ids], starts)), "score": scores,
                })
            tidy()

    rows = own.mapInArrow(measure, "doc_id long, held_out boolean, n_tokens long, n_known long, logs double, score double")
    base = F.col("logs") - F.col("n_tokens") * F.lit(math.log10(n + v + 1))
    return rows.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), base.alias("base_score"), "score")


def report(docs: DataFrame, order: int = ORDER, most: int = BLOCK_GRAMS) -> DataFrame:
    """One row a document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    rows = docs.select("doc_id", "text", (remainder("doc_id", MOD) == OUT).alias("_held"))
    grams = settle(count_grams(rows.filter(~F.col("_held")).select(F.col("text").cast("binary").alias("text")), order), "ppm-grams")
    model = model_of(grams, order, most)
    return base_scores(settle(pack_chunks(rows, model), "ppm-chunks"), model)
