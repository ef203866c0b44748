"""Benchmark decontamination as a prefix-filtered set join.

Every benchmark window (10 consecutive item words, or a shorter item whole) is a set of positioned words whose
containment must be complete. At full containment the prefix of a set in a global order has one token, so a window is
joined by its rarest word alone: rarity is the word's number of occurrences over all documents, ties by the word. A
document position of that word is a candidate; the positional bound (as many words must precede it as in the window) and
the length bound (as many must follow) drop candidates before the words themselves are compared.

Words are kept as ids of the benchmark's own vocabulary, so a window is compared as a few integers. A benchmark of at most
INDEX_WORDS words, which are counted, is one index that is broadcast, and documents pass it in one go. A larger one is
joined by shuffles: word counts, windows and their rarest words are tables; a bitmap of fixed size tells tasks which
words are the rarest of some window (as good as certainly), and every document position of such a word goes with its
neighbours' hashes to the windows of that word, where the bounds and all words (as 64-bit hashes) are compared. Documents
are written once, with row numbers, to which the hits return; no item, however long, is held whole by anything but the
task that cuts it into windows.

Null texts, empty texts and texts without words have no windows and no hits; items without words never match. Bytes that
are no UTF-8 are parts of words. Texts are searched whole. Repeated documents get repeated rows, and an empty table gives
an empty one. Items with one id count as one item in n_items. Null item ids are left out of the item list. Columns of any
name pass through clean(); decontaminate() takes a prefix for its own.
"""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import own, settle, unused, with_computed, words

WINDOW = 10
#: Benchmark words a broadcast index may hold: about 100 MB in a Python worker.
INDEX_WORDS = 500_000


def item_windows(text: bytes | None, size: int = WINDOW) -> list[tuple[bytes, ...]]:
    w = words(text)
    return [tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))] if w else []


def vocabulary_counts(docs: DataFrame, vocabulary: frozenset[bytes]) -> dict[bytes, int]:
    """Occurrences of the benchmark's words over all documents: at most INDEX_WORDS counts come back."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        wanted, seen = shared.value, Counter()
        for batch in batches:
            for text in batch["text"]:
                seen.update(filter(wanted.__contains__, words(text)))
        yield pd.DataFrame({"word": list(seen), "n": list(seen.values())})

    parts = docs.select(F.col("text").cast("binary").alias("text")).mapInPandas(count, "word binary, n long")
    return {bytes(r.word): r.n for r in parts.groupBy("word").agg(F.sum("n").alias("n")).toLocalIterator()}


class WindowIndex:
    """Windows by their rarest word. Word ids start at 1; 0 is any word outside the benchmark."""

    def __init__(self, items: list[tuple[object, bytes | None]], counts: dict[bytes, int], size: int = WINDOW) -> None:
        self.ids: dict[bytes, int] = {}
        self.by_word: dict[int, list[tuple[int, int, bytes, frozenset]]] = defaultdict(list)
        owners: dict[tuple[bytes, ...], set] = defaultdict(set)
        for item, text in items:
            for window in item_windows(text, size):
                owners[window].add(item)
        for window, who in owners.items():
            codes = [self.ids.setdefault(w, len(self.ids) + 1) for w in window]
            at = min(range(len(window)), key=lambda k: (counts.get(window[k], 0), window[k], k))
            self.by_word[codes[at]].append((at, len(codes), np.array(codes, np.int32).tobytes(), frozenset(who)))
        self.by_word = dict(self.by_word)
        self.is_prefix = np.zeros(len(self.ids) + 1, bool)
        self.is_prefix[list(self.by_word)] = True

    def find(self, tokens: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """(start, end) of every window that occurs, and the items that own one."""
        get = self.ids.get
        codes = np.fromiter((get(w, 0) for w in tokens), np.int32, len(tokens))
        spans, found = [], set()
        raw = None
        for p in np.flatnonzero(self.is_prefix[codes]).tolist():
            for at, n, window, who in self.by_word[int(codes[p])]:
                start = p - at
                if start < 0 or start + n > len(tokens):
                    continue
                raw = codes.tobytes() if raw is None else raw
                if raw[4 * start : 4 * (start + n)] == window:
                    spans.append((start, start + n))
                    found |= who
        return spans, found


def word_count(benchmark: DataFrame) -> int:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [sum(len(words(t)) for t in batch.column("text").to_pylist())]})

    return benchmark.select(F.col("text").cast("binary").alias("text")).mapInArrow(count, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


NAMES = ("_n_words", "_hits", "_items")


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, most: int = INDEX_WORDS, drop: tuple[str, ...] = (), prefix: str = "") -> DataFrame:
    """docs (text, ...), without the columns to drop, plus _n_words, _hits (merged starts and ends, in words) and _items (item
    ids), with the prefix before their names; docs must not have columns of these names."""
    now = [prefix + n for n in NAMES]
    ddl = ", ".join(f"`{n}` {t}" for n, t in zip(now, ("long", "array<int>", "array<string>"), strict=True))
    if word_count(benchmark) > most:
        return _joined(docs, benchmark, size, ddl, now, drop)
    items = [(r.item_id, None if r.text is None else bytes(r.text)) for r in benchmark.select("item_id", F.col("text").cast("binary").alias("text")).collect()]  # at most `most` words
    vocabulary = frozenset(w for _, text in items for w in words(text))
    index = docs.sparkSession.sparkContext.broadcast(WindowIndex(items, vocabulary_counts(docs, vocabulary) if vocabulary else {}, size))
    return with_computed(docs, ["text"], ddl, _matcher(index), drop)


def _matcher(index):
    def make():
        at = index.value

        def match(texts: list[bytes | None]) -> list[list]:
            out: list[list] = [[], [], []]
            for text in texts:
                tokens = words(text)
                spans, found = at.find(tokens)
                out[0].append(len(tokens))
                out[1].append(merged(spans))
                out[2].append(sorted({str(x) for x in found if x is not None}))
            return out

        return match

    return make


# Beyond one index

#: Bits of the filter of rarest words, by its logarithm, and of the parts in which it is made.
FILTER_BITS, PART_BITS = 27, 16


def _hashes(tokens: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, len(tokens)).view(np.int64)


def _windows(benchmark: DataFrame, size: int) -> DataFrame:
    """item (text), w (hashes of a window's words): distinct."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist(), strict=True):
                h = _hashes(words(text))
                starts = range(max(1, len(h) - size + 1)) if len(h) else ()
                for k in range(0, len(starts), 50_000):
                    part = [h[j : j + size] for j in starts[k : k + 50_000]]
                    yield pa.RecordBatch.from_pydict({"item": pa.array([item] * len(part), pa.string()), "w": pa.array(part, pa.list_(pa.int64()))})

    rows = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(cut, "item string, w array<long>").distinct().withColumn("window", F.xxhash64("w"))


def _word_counts(docs: DataFrame) -> DataFrame:
    """word (hash), n: occurrences over all documents; a task sends each of its words now and then."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        told = lambda: pa.RecordBatch.from_pydict({"word": _hashes(list(seen)), "n": pa.array(list(seen.values()), pa.int64())})
        for batch in batches:
            for text in batch.column("text").to_pylist():
                seen.update(words(text))
                if len(seen) > 500_000:
                    yield told()
                    seen.clear()
        if seen:
            yield told()

    return docs.select(F.col("text").cast("binary").alias("text")).mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _filter(prefixes: DataFrame) -> np.ndarray:
    """A bitmap of the words (by the low bits of their hashes): 2**FILTER_BITS bits, whatever their number."""

    def part(rows: pd.DataFrame) -> pd.DataFrame:
        flags = np.zeros(1 << PART_BITS, np.uint8)
        flags[rows["slot"].to_numpy() & ((1 << PART_BITS) - 1)] = 1
        return pd.DataFrame({"k": [rows["k"].iloc[0]], "bits": [np.packbits(flags).tobytes()]})

    slot = F.col("word").bitwiseAND((1 << FILTER_BITS) - 1)
    rows = prefixes.select(slot.alias("slot")).distinct().withColumn("k", F.shiftright("slot", PART_BITS))
    parts = {r.k: r.bits for r in rows.groupBy("k").applyInPandas(part, "k long, bits binary").toLocalIterator()}
    empty = bytes((1 << PART_BITS) // 8)
    return np.frombuffer(b"".join(bytes(parts.get(k, empty)) for k in range(1 << (FILTER_BITS - PART_BITS))), np.uint8)


def _candidates(docs: DataFrame, row: str, bits, size: int) -> DataFrame:
    """row, n_words, word, p and near (the hashes from size - 1 before to size - 1 behind, 0 beyond the text) of every
    position of a word in the filter."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags, wide = bits.value, 2 * size - 1
        for batch in batches:
            for number, text in zip(batch.column("row").to_pylist(), batch.column("text").to_pylist(), strict=True):
                h = _hashes(words(text))
                slot = h & ((1 << FILTER_BITS) - 1)
                at = np.flatnonzero(flags[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8) & 1)
                padded = np.concatenate([np.zeros(size - 1, np.int64), h, np.zeros(size - 1, np.int64)])
                for k in range(0, len(at), 50_000):
                    p = at[k : k + 50_000]
                    near = pa.ListArray.from_arrays(np.arange(len(p) + 1, dtype=np.int32) * wide, padded[p[:, None] + np.arange(wide)].ravel())
                    yield pa.RecordBatch.from_pydict({"row": np.full(len(p), number), "n_words": np.full(len(p), len(h)), "word": h[p], "p": p.astype(np.int64), "near": near})

    rows = docs.select(F.col(row).alias("row"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(find, "row long, n_words long, word long, p long, near array<long>")


def _joined(docs: DataFrame, benchmark: DataFrame, size: int, ddl: str, now: list[str], drop: tuple[str, ...]) -> DataFrame:
    spark, p = docs.sparkSession, unused(docs, "_row", "_spans", "_found", *now)
    row, spans_, found_ = p + "_row", p + "_spans", p + "_found"
    rows = settle(docs.withColumn(row, F.monotonically_increasing_id()), "decontaminate-docs")
    owned = settle(_windows(benchmark, size), "decontaminate-windows")
    each = owned.dropDuplicates(["window"]).select("window", "w", F.posexplode("w").alias("at", "word"))
    each = each.join(_word_counts(rows), "word", "left")
    rarest = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word", "at"))
    windows = settle(each.groupBy("window").agg(rarest.alias("r"), F.first("w").alias("w")).select("window", "w", "r.word", "r.at"), "decontaminate-prefixes")
    bits = spark.sparkContext.broadcast(_filter(windows))
    met = _candidates(rows, row, bits, size).join(windows, "word")
    start, n = F.col("p") - F.col("at"), F.size("w")
    # The length and positional bounds, then all words.
    met = met.filter((start >= 0) & (start + n <= F.col("n_words"))).filter(F.slice("near", F.lit(size) - F.col("at"), n) == F.col("w"))
    met = settle(met.select("row", start.cast("int").alias("start"), (start + n).cast("int").alias("end"), "window"), "decontaminate-hits")
    spans = met.groupBy("row").agg(F.collect_set(F.struct("start", "end")).alias("s"))
    items = met.select("row", "window").distinct().join(owned.select("window", "item"), "window").groupBy("row").agg(F.collect_set("item").alias("i"))
    hits = spans.join(items, "row", "left").select(F.col("row").alias(row), F.flatten(F.transform("s", lambda x: F.array(x["start"], x["end"]))).alias(spans_), F.array_sort("i").alias(found_))
    hits = settle(hits, "decontaminate-found")
    rows = rows.join(F.broadcast(hits) if hits.limit(1000).count() < 1000 else hits, row, "left").drop(row)

    def make():
        def finish(texts: list[bytes | None], spans: list[list[int] | None], items: list[list[str] | None]) -> list[list]:
            return [[len(words(t)) for t in texts], [merged(list(zip(s[::2], s[1::2], strict=True))) if s else [] for s in spans], [i or [] for i in items]]

        return finish

    return with_computed(rows, ["text", spans_, found_], ddl, make, (spans_, found_, *drop))


def merged(spans: list[tuple[int, int]]) -> list[int]:
    """Overlapping or touching spans joined, as a flat list of starts and ends."""
    out: list[int] = []
    for start, end in sorted(spans):
        if out and start <= out[-1]:
            out[-1] = max(out[-1], end)
        else:
            out += [int(start), int(end)]
    return out


def digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


def report(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """One row a document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = decontaminate(docs.select("doc_id", "text"), benchmark, size, drop=("text",))
    n_hit = F.aggregate(F.sequence(F.lit(0), (F.size("_hits") / 2 - 1).cast("int")), F.lit(0).cast("long"), lambda s, k: s + (F.element_at("_hits", 2 * k + 2) - F.element_at("_hits", 2 * k + 1)).cast("long"))
    n_hit = F.when(F.size("_hits") > 0, n_hit).otherwise(F.lit(0).cast("long"))
    return found.select(
        "doc_id", F.col("_n_words").alias("n_words"), n_hit.alias("n_hit"), F.size("_items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("_items"), ",").cast("binary"), 256).alias("items_sha256"), (F.size("_hits") > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, most: int = INDEX_WORDS) -> DataFrame:
    """The documents without any benchmark window, with their own columns."""
    prefix = unused(docs, *NAMES)
    return decontaminate(docs, benchmark, size, most, prefix=prefix).filter(F.size(prefix + "_hits") == 0).select(*own(docs))
