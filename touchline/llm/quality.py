"""Quality by regularised quadratic discriminant analysis.

A document is described by statistics of its whole text (lengths, shares of character classes, repetition), transformed
to be near normal. Each class has a mean and a covariance, shrunk towards the pooled covariance and that towards its
diagonal; a score is the logistic of the difference of the Gaussian log-densities, by Mahalanobis distances from the
classes' cached Cholesky factors, tempered by a calibration on labelled rows that the covariances have not seen.

Labels are learnt from a sample bounded in rows (SAMPLE a class) and bytes (labelled_sample), both parameters. The driver
gets the sample's statistics (a few MB), never texts. Language, source and id are no inputs. Statistics are of bytes, so
texts that are no UTF-8 are described like others. Null and empty texts are described as texts without words, and score
by the same rule. Texts are read whole. Rows are scored on their own: repeated rows alike, an empty table gives an empty
result. Without labelled rows of both classes all scores are the share of good rows
(0 without any).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import with_computed
from .learning import held_out, labelled_sample, logistic, sigmoid

SAMPLE = 5_000
SHRINK_CLASS, SHRINK_DIAGONAL = 0.1, 0.05
MOD, OUT, THRESHOLD = 4, 2, 0.7

_BYTES = np.arange(256)
_LOWER = (_BYTES >= 97) & (_BYTES <= 122)
_UPPER = (_BYTES >= 65) & (_BYTES <= 90)
_DIGIT = (_BYTES >= 48) & (_BYTES <= 57)
_SPACE = (_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13))
_HIGH = _BYTES >= 128
_STOP = np.isin(_BYTES, list(b".,;:"))
_MARK = ~(_LOWER | _UPPER | _DIGIT | _SPACE | _HIGH | _STOP)
NAMES = (
    "words", "word_length", "letters", "upper", "digits", "stops", "marks", "mark_kinds", "distinct", "repeats", "top", "pairs",
    "line_length", "line_copies", "marked_words", "upper_words",
)


def _logit(x: float, n: float) -> float:
    """Log odds of a share of n, kept finite."""
    p = (x + 0.5) / (n + 1.0)
    return float(np.log(p / (1 - p))) if p < 1 else float(np.log((x + 0.5) / 0.5))


def statistics(text: bytes | None) -> list[float]:
    text = text or b""
    h = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    n = max(len(text), 1)
    w = text.split()
    k = len(w)
    counts = Counter(w)
    lines = [x for x in text.split(b"\n") if x.strip()]
    same = sum(a == b for a, b in zip(w, w[1:], strict=False))
    marked = sum(not x[-1:].isalnum() and x[-1] < 128 and x[-1] not in b".,;:" for x in w)
    upper = sum(x[:2].isupper() and len(x) > 1 for x in w)
    return [
        np.log1p(k), np.log1p(sum(map(len, w)) / max(k, 1)), _logit(h[_LOWER | _UPPER | _HIGH].sum(), n), _logit(h[_UPPER].sum(), n), _logit(h[_DIGIT].sum(), n),
        _logit(h[_STOP].sum(), n), _logit(h[_MARK].sum(), n), np.log1p((h[_MARK] > 0).sum()), np.log1p(len(counts)) - 0.8 * np.log1p(k), _logit(same, max(k - 1, 0)),
        _logit(max(counts.values(), default=0), k), _logit(k - 1 - len(set(zip(w, w[1:], strict=False))) if k > 1 else 0, max(k - 1, 0)),
        np.log1p(n / max(len(lines), 1)), _logit(len(lines) - len(set(lines)), len(lines)), _logit(marked, k), _logit(upper, k),
    ]


class Discriminant:
    """Two shrunk Gaussians over standardised statistics, with their Cholesky factors' inverses."""

    def __init__(self, x: np.ndarray, y: np.ndarray) -> None:
        self.centre, self.scale = x.mean(0), x.std(0) + 1e-6
        z = (x - self.centre) / self.scale
        pooled = sum(np.cov(z[y == c], rowvar=False, bias=True) * (y == c).mean() for c in (0, 1))
        pooled = (1 - SHRINK_DIAGONAL) * pooled + SHRINK_DIAGONAL * np.diag(np.diag(pooled)) + 1e-3 * np.eye(z.shape[1])
        self.classes = []
        for c in (0, 1):
            own = np.cov(z[y == c], rowvar=False, bias=True)
            chol = np.linalg.cholesky((1 - SHRINK_CLASS) * own + SHRINK_CLASS * pooled)
            self.classes.append((z[y == c].mean(0), np.linalg.inv(chol), np.log(np.diag(chol)).sum()))

    def log_ratio(self, x: np.ndarray) -> np.ndarray:
        """log density as good - log density as bad."""
        z = (x - self.centre) / self.scale
        d = [-0.5 * (((z - mean) @ inverse.T) ** 2).sum(1) - half_log_det for mean, inverse, half_log_det in self.classes]
        return d[1] - d[0]


def tempered(ratio: np.ndarray) -> np.ndarray:
    """Signed root, since squared distances grow far out without meaning more."""
    return np.sign(ratio) * np.sqrt(np.abs(ratio))


def fit(docs: DataFrame, labels: DataFrame, each: int = SAMPLE) -> tuple[Discriminant, np.ndarray] | float:
    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.drop(columns="text").assign(x=[statistics(t) for t in batch["text"]])

    sample = labelled_sample(docs, labels, "quality", MOD, OUT, each)
    rows = sample.select("label", "part", "text").mapInPandas(measure, "label int, part int, x array<double>").toPandas()
    if rows["label"].nunique() < 2:
        return float(rows["label"].mean()) if len(rows) else 0.0
    x, y, part = np.array(rows["x"].tolist()), rows["label"].to_numpy(), rows["part"].to_numpy()
    learn = part > 0 if all((y[part > 0] == c).sum() > 1 for c in (0, 1)) else np.ones(len(y), bool)
    model = Discriminant(x[learn], y[learn])
    rest = ~learn if len(set(y[~learn])) == 2 else learn
    return model, logistic(tempered(model.log_ratio(x[rest]))[:, None], y[rest].astype(float), l2=0.1)


def score(docs: DataFrame, labels: DataFrame, each: int = SAMPLE, drop: tuple[str, ...] = (), out: str = "_score") -> DataFrame:
    """docs (doc_id, text, ...) with a column out, which docs must not have, and without the columns to drop."""
    fitted = fit(docs, labels, each)
    if isinstance(fitted, float):
        return docs.drop(*drop).withColumn(out, F.lit(fitted))
    shared = docs.sparkSession.sparkContext.broadcast(fitted)

    def make():
        model, weights = shared.value

        def run(texts: list[bytes | None]) -> list:
            x = np.array([statistics(t) for t in texts]).reshape(-1, len(NAMES))
            return [sigmoid(tempered(model.log_ratio(x)) * weights[0] + weights[1])]

        return run

    return with_computed(docs, ["text"], f"`{out}` double", make, drop)


def report(docs: DataFrame, labels: DataFrame, each: int = SAMPLE) -> DataFrame:
    """One row a document: doc_id, held_out, score, predicted."""
    scored = score(docs.select("doc_id", "text"), labels, each, ("text",))
    return scored.select("doc_id", held_out("doc_id", MOD, OUT).alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= THRESHOLD).cast("int").alias("predicted"))
