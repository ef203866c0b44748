"""Toxicity by class-conditional Kneser-Ney models.

P(word | word before, class) is a Kneser-Ney bigram of words that backs off to a byte model of the word, so expressions of
several words count where the sample has them and spellings never seen still do. At the byte model's highest order (ORDER
bytes, anchored at the word's start) each class has its own counts; below it both share one back-off model of continuation
counts pooled over the classes, so that what is too rare in either class is given nearly the same probability by both
and decides nothing. Discounts of counts of one, two, and three or more are estimated from the counts of counts.

A word's evidence is the difference of its log-likelihoods. A document has four features: the length-normalised
difference itself (a word), and, since a toxic document is mostly ordinary words, sums over its distinct words of
log(1 - SHARE + SHARE * exp(a word's greatest evidence)): of spellings by their number and by its root (so that a few
insults count in a long text), and of words after words by its root. A logistic calibration on labelled rows that the counts have not seen turns them into a score from
0 to 1.

Labels are learnt from a sample bounded in rows and bytes (labelled_sample), both parameters; a task makes the models of
the sample's bigram counts and workers read them from the shared folder; the driver gets the features of the calibration
rows. All tables are packed arrays of 64-bit hashes. Every
text is scored whole; its language, source and id are no inputs. Null and empty texts have no evidence and get the
calibration's intercept. Bytes that are no UTF-8 are parts of words. Rows are scored on their own: repeated rows alike, an
empty table gives an empty result. Without labelled rows of both classes all scores are the share of toxic rows (0
without any).
"""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import own, settle, tidy, unused, with_computed, words
from .learning import SAMPLE_BYTES, held_out, labelled_sample, logistic, sigmoid
from .stores import open_store
from .tables import Lookup

ORDER, BACK = 12, 11
SHARE = 0.02
SAMPLE = 2_000
MOST_EVIDENCE = 30.0
MOD, OUT, THRESHOLD = 5, 0, 0.5
#: Marks around a word and the word before the first; no word holds them.
START, END = b" ", b"\n"

_BASE = np.uint64(0x9E3779B97F4A7C15)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return h ^ (h >> np.uint64(29))


class Framed:
    """Words between their marks as one buffer, with hashes of any run of bytes within a word."""

    def __init__(self, listed: list[bytes]) -> None:
        data = np.frombuffer(START + (END + START).join(listed) + END, np.uint8) if listed else np.zeros(0, np.uint8)
        sizes = np.fromiter((len(w) + 2 for w in listed), np.int64, len(listed))
        ends = np.cumsum(sizes)
        self.data, self.starts = data, ends - sizes
        self.place = (np.arange(len(data)) - np.repeat(self.starts, sizes)).astype(np.int32)
        self.word = np.repeat(np.arange(len(listed), dtype=np.int32), sizes)
        self.coded = np.flatnonzero(self.place > 0).astype(np.int32)  # every byte after a start mark is predicted
        self.powers = np.full(ORDER + 2, _BASE, np.uint64)
        self.powers[0] = 1
        self.powers = np.multiply.accumulate(self.powers)

    def runs(self, last: np.ndarray, n: np.ndarray | int) -> np.ndarray:
        """Hashes of the n (at most ORDER) bytes that end with position last, by position and length."""
        n = np.broadcast_to(np.asarray(n, np.int32), last.shape)
        out = np.empty(len(last), np.uint64)
        for i in range(0, len(last), 1 << 17):
            end, size = last[i : i + (1 << 17)], n[i : i + (1 << 17)]
            h = size.astype(np.uint64)
            for k in range(int(size.max(initial=0))):
                h += np.where(size > k, (self.data[np.maximum(end - k, 0)].astype(np.uint64) + np.uint64(1)) * self.powers[k + 1], np.uint64(0))
            out[i : i + len(end)] = _mixed(h)
        return out

    def hashes(self) -> np.ndarray:
        """One hash a word, of all its bytes."""
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        with np.errstate(over="ignore"):
            h = (self.data.astype(np.uint64) + np.uint64(1)) * _mixed(self.place.astype(np.uint64) + np.uint64(0x51ED27))
        return _mixed(np.add.reduceat(_mixed(h), self.starts))


def pair_keys(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return _mixed(before * np.uint64(0xD6E8FEB86659FD93) ^ word)


#: The hash of "no word before".
FIRST = np.uint64(0x1F0E3DAD99908345)


def discounts(counts: np.ndarray) -> np.ndarray:
    """What counts of 0, 1, 2 and 3 or more lose, from the counts of counts (Chen and Goodman's estimate, kept in (0, count))."""
    n1, n2, n3, n4 = (float((counts == k).sum()) for k in (1, 2, 3, 4))
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    told = [1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return np.array([0.0, *(min(max(d, 0.1), k - 0.05) for d, k in zip(told, (1, 2, 3), strict=True))])


class Level:
    """Discounted counts by gram, and total and what discounts free by context, as sorted arrays."""

    def __init__(self, grams: np.ndarray, contexts: np.ndarray, counts: np.ndarray) -> None:
        """Distinct grams with a context and a count each (counts of 0 hold nothing)."""
        some = counts > 0
        grams, contexts, counts = grams[some], contexts[some], counts[some]
        d = discounts(counts)[np.minimum(counts, 3)]
        order = np.argsort(grams)
        self.grams, self.left = grams[order], (counts - d)[order]
        self.contexts, at = np.unique(contexts, return_inverse=True)
        self.total = np.bincount(at, counts, len(self.contexts))
        self.free = np.bincount(at, d, len(self.contexts))

    @staticmethod
    def _find(keys: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(keys, asked), max(len(keys) - 1, 0))
        return at, keys[at] == asked if len(keys) else np.zeros(len(asked), bool)

    def share(self, contexts: np.ndarray) -> np.ndarray:
        """The share left to the back-off: 1 in unseen contexts."""
        at, known = self._find(self.contexts, contexts)
        return np.where(known, self.free[at] / self.total[at], 1.0) if len(self.contexts) else np.ones(len(contexts))

    def p(self, grams: np.ndarray, contexts: np.ndarray, back: np.ndarray) -> np.ndarray:
        """Probability of each gram's last element after its context, given that of the back-off."""
        if not len(self.grams):
            return back
        c, known = self._find(self.contexts, contexts)
        g, seen = self._find(self.grams, grams)
        return np.where(known, (np.where(seen, self.left[g], 0.0) + self.free[c] * back) / np.where(known, self.total[c], 1.0), back)


class Evidence:
    """What words tell of a document's class: the tables of log-likelihood differences."""

    def __init__(self, listed: list[bytes], before: np.ndarray, word: np.ndarray, counts: np.ndarray) -> None:
        """listed: the sample's distinct words; before and word: bigrams as places in it (-1: none before); counts: theirs by
        class (a row each)."""
        self.forget()
        hashes, spelt = self._learn_spelling(listed, word, counts)
        # Words after words: each class backs off to the pooled pairs, and these to the class's spelling.
        previous = np.where(before < 0, FIRST, hashes[np.maximum(before, 0)]) if len(listed) else np.zeros(0, np.uint64)
        pairs = pair_keys(previous, hashes[word]) if len(listed) else np.zeros(0, np.uint64)
        pooled = Level(pairs, previous, counts.sum(1))
        q = [np.log(Level(pairs, previous, counts[:, c]).p(pairs, previous, pooled.p(pairs, previous, spelt[c][word]))) for c in (0, 1)]
        self.of_pair = Lookup(pairs, (q[1] - q[0]).astype(np.float32), np.nan)
        del q, pooled
        contexts = np.unique(previous)
        share = [Level(pairs, previous, counts[:, c]).share(contexts) for c in (0, 1)]
        self.of_previous = Lookup(contexts, np.log(share[1] / share[0]).astype(np.float32), 0.0)

    def _learn_spelling(self, listed: list[bytes], word: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """The byte model; returns the words' hashes and their probabilities by class."""
        framed = Framed(listed)
        hashes = framed.hashes()
        by_word = np.stack([np.bincount(word, counts[:, c], len(listed)) for c in (0, 1)]) if len(listed) else np.zeros((2, 0))
        at = framed.coded
        n = np.minimum(framed.place[at] + 1, ORDER)
        top, context = framed.runs(at, n), framed.runs(at - 1, n - 1)
        # The shared back-off: of each run of up to BACK bytes, how many different bytes (or none) stand before it.
        lower = np.full(len(at), 1 / 256)
        for k in range(1, BACK + 1):
            there = np.flatnonzero(n - 1 >= k)
            last = at[there]
            run, its_context = framed.runs(last, k), framed.runs(last - 1, k - 1)
            ahead = np.where(framed.place[last] >= k, framed.data[np.maximum(last - k, 0)].astype(np.uint64) + np.uint64(1), np.uint64(0))
            _, first = np.unique(pair_keys(run, ahead), return_index=True)
            kinds, one, times = np.unique(run[first], return_index=True, return_counts=True)
            del ahead
            level = Level(kinds, its_context[first][one], times)
            for i in range(0, len(there), 1 << 17):  # a part at a time, for memory
                part = slice(i, i + (1 << 17))
                lower[there[part]] = level.p(run[part], its_context[part], lower[there[part]])
        grams, first, of = np.unique(top, return_index=True, return_inverse=True)
        levels = [Level(grams, context[first], np.bincount(of, by_word[c][framed.word[at]], len(grams)).astype(np.int64)) for c in (0, 1)]
        p = [x.p(grams, context[first], lower[first]) for x in levels]
        told = np.log(p[1] / p[0])
        self.of_gram = Lookup(grams, told.astype(np.float32), np.nan)
        contexts = np.unique(context)
        self.of_context = Lookup(contexts, np.log(levels[1].share(contexts) / levels[0].share(contexts)).astype(np.float32), 0.0)
        return hashes, [np.exp(np.bincount(framed.word[at], np.log(x[of]), len(listed))) if len(listed) else np.zeros(0) for x in p]

    def spelling(self, listed: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Of each word its hash and log P(word | toxic) - log P(word | ordinary), by its bytes alone."""
        framed = Framed(listed)
        at = framed.coded
        n = np.minimum(framed.place[at] + 1, ORDER)
        told = self.of_gram(framed.runs(at, n)).astype(np.float64)
        new = np.flatnonzero(np.isnan(told))
        told[new] = self.of_context(framed.runs(at[new] - 1, n[new] - 1))
        return framed.hashes(), np.bincount(framed.word[at], told, len(listed))

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("memo", "hashes", "spelt")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self.forget()

    def forget(self) -> None:
        """Drop what is remembered of words: places in the arrays of their hashes and spellings."""
        self.memo, self.hashes, self.spelt = {}, np.zeros(0, np.uint64), np.zeros(0)

    def _remember(self, listed: list[list[bytes]]) -> None:
        if len(self.memo) > 100_000:
            self.forget()
        new = sorted(set().union(*listed) - self.memo.keys())
        if new:
            hashes, told = self.spelling(new)
            self.memo.update(zip(new, range(len(self.hashes), len(self.hashes) + len(new)), strict=True))
            self.hashes, self.spelt = np.concatenate([self.hashes, hashes]), np.concatenate([self.spelt, told])

    def features(self, texts: list[bytes | None]) -> np.ndarray:
        """A row a text: the difference of the log-likelihoods a word, and three sums over distinct words."""
        out = np.zeros((len(texts), 4))
        for first, listed in _parts(texts):
            sizes = np.array([len(w) for w in listed])
            if not sizes.any():
                continue
            self._remember(listed)
            ids = np.fromiter(map(self.memo.__getitem__, chain.from_iterable(listed)), np.int64, sizes.sum())
            hashes, spelt = self.hashes[ids], self.spelt[ids]
            of = np.repeat(np.arange(len(listed)), sizes)
            previous = np.concatenate([[FIRST], hashes[:-1]])
            previous[(np.cumsum(sizes) - sizes)[sizes > 0]] = FIRST
            told = self.of_pair(pair_keys(previous, hashes)).astype(np.float64)
            new = np.flatnonzero(np.isnan(told))
            told[new] = spelt[new] + self.of_previous(previous[new])
            # Of each distinct word of a text its greatest evidence.
            key = of << 32 | ids
            order = np.argsort(key, kind="stable")
            start = np.flatnonzero(np.append(True, key[order][1:] != key[order][:-1]))
            text = of[order][start]
            some = sizes > 0
            kinds = np.bincount(text, minlength=len(listed))[some]
            here = out[first : first + len(listed)]
            here[some, 0] = np.bincount(of, told, len(listed))[some] / sizes[some]
            plain, paired = (np.log1p(SHARE * np.expm1(np.minimum(e, MOST_EVIDENCE))) for e in (spelt[order][start], np.maximum.reduceat(told[order], start)))
            plain, paired = (np.bincount(text, e, len(listed))[some] for e in (plain, paired))
            here[some, 1], here[some, 2], here[some, 3] = 20 * plain / kinds, plain / np.sqrt(kinds), paired / np.sqrt(kinds)
        return out


def _parts(texts: list[bytes | None], most: int = 1 << 20) -> Iterator[tuple[int, list[list[bytes]]]]:
    """The words of runs of texts of about `most` bytes, and where they begin."""
    first, held = 0, 0
    for k, text in enumerate(texts):
        held += len(text or b"")
        if held > most or k + 1 == len(texts):
            yield first, [words(t) for t in texts[first : k + 1]]
            first, held = k + 1, 0


def _count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each label and pair of words in how many documents it stands; a task sends its counts now and then."""
    seen: Counter = Counter()

    def told() -> pa.RecordBatch:
        columns = (*zip(*seen, strict=True), seen.values()) if seen else ([],) * 4
        types = (pa.int32(), pa.binary(), pa.binary(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=["label", "before", "word", "n"])

    for batch in batches:
        for label, text in zip(batch.column("label").to_pylist(), batch.column("text").to_pylist(), strict=True):
            w = words(text)
            seen.update({(label, a, b) for a, b in zip([b"", *w], w, strict=False)})
            if len(seen) > 100_000:
                yield told()
                seen.clear()
    yield told()


_OPEN: dict[str, Evidence] = {}


class Stored:
    """Models in the shared folder; a worker that opens them keeps the last it has opened."""

    def __init__(self, path: str) -> None:
        self.path = path

    def open(self) -> Evidence:
        if self.path not in _OPEN:
            fs, folder = open_store(self.path)
            files = [f.path for f in fs.get_file_info(pafs.FileSelector(folder)) if f.base_name.endswith(".parquet")]
            held = [x for f in files for x in pq.read_table(f, filesystem=fs)["model"].to_pylist()]
            _OPEN.clear()
            _OPEN[self.path] = pickle.loads(held.pop())
            tidy()
        return _OPEN[self.path]


def learnt(sample: DataFrame) -> Stored | None:
    """sample (label, text binary) -> the models, stored; None where a class has no words. The sample is bounded, so one task
    makes them of its pairs' counts."""
    counted = sample.select("label", "text").mapInArrow(_count_pairs, "label int, before binary, word binary, n long")
    counted = counted.groupBy("before", "word").agg(*(F.sum(F.when(F.col("label") == c, F.col("n")).otherwise(0)).alias(f"n{c}") for c in (0, 1)))

    def build(rows: pa.Table) -> pa.Table:
        counts = np.column_stack([rows[c].to_numpy() for c in ("n0", "n1")]).astype(np.int64)
        if not counts.sum(0).all():
            return pa.table({"model": pa.array([], pa.binary())})
        spelt = rows["word"].combine_chunks().dictionary_encode()
        before = pc.fill_null(pc.index_in(rows["before"].combine_chunks(), value_set=spelt.dictionary), -1)
        model = Evidence(spelt.dictionary.to_pylist(), before.to_numpy().astype(np.int64), spelt.indices.to_numpy().astype(np.int64), counts)
        made = pa.table({"model": pa.array([pickle.dumps(model)], pa.binary())})
        del model, spelt, before, rows
        tidy()
        return made

    made = settle(counted.withColumn("all", F.lit(0)).groupBy("all").applyInArrow(build, "model binary"), "toxicity-model")
    return Stored(made.settled_at) if made.count() else None


def fit(docs: DataFrame, labels: DataFrame, each: int = SAMPLE, most_bytes: int = SAMPLE_BYTES):
    """The models, stored, and the calibration's weights; or the share of toxic rows where one class is missing."""
    sample = labelled_sample(docs, labels, "toxic", MOD, OUT, each, most_bytes)
    model = learnt(sample.filter("part > 0"))
    if model is None:
        told = sample.agg(F.avg("label")).first()[0]
        return float(told or 0.0)

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at = model.open()
        for batch in batches:
            yield pd.DataFrame({"label": batch["label"], "x": at.features(batch["text"].to_list()).tolist()})

    rest = sample.filter("part = 0").select("label", "text").mapInPandas(measure, "label int, x array<double>").toPandas()
    if rest["label"].nunique() < 2:
        return model, np.array([0.0, 4.0, 4.0, 4.0, -6.0])
    return model, logistic(np.array(rest["x"].to_list()), rest["label"].to_numpy(float), l2=0.1)


def score(docs: DataFrame, labels: DataFrame, each: int = SAMPLE, drop: tuple[str, ...] = (), out: str = "_score") -> DataFrame:
    """docs (doc_id, text, ...) with a column out, which docs must not have, and without the columns to drop."""
    fitted = fit(docs, labels, each)
    if isinstance(fitted, float):
        return docs.drop(*drop).withColumn(out, F.lit(fitted))
    stored, weights = fitted

    def make():
        model = stored.open()
        return lambda texts: [sigmoid(model.features(texts) @ weights[:-1] + weights[-1])]

    return with_computed(docs, ["text"], f"`{out}` double", make, drop)


def report(docs: DataFrame, labels: DataFrame, each: int = SAMPLE) -> DataFrame:
    """One row a document: doc_id, held_out, score, predicted."""
    scored = score(docs.select("doc_id", "text"), labels, each, ("text",))
    return scored.select("doc_id", held_out("doc_id", MOD, OUT).alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= THRESHOLD).cast("int").alias("predicted"))


def ordinary(docs: DataFrame, labels: DataFrame, each: int = SAMPLE) -> DataFrame:
    """The documents that score below the threshold, with their own columns."""
    out = unused(docs, "_score") + "_score"
    return score(docs, labels, each, out=out).filter(F.col(out) < THRESHOLD).select(*own(docs))
