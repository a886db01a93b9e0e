"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

Every text becomes a few statistics, transformed (logs of sizes, log-odds of shares) so that
a normal density fits. Each class has a mean and a covariance, shrunk towards the pooled one
and towards its own diagonal; the difference of the two log densities, from Mahalanobis
distances by Cholesky factors computed once, gives the score.

Defined cases: null texts are empty; an empty text has statistics like any other and gets a
score; labels other than 0 and 1 teach nothing; several labels of a document all count; if a
class has fewer than ``MIN_ROWS`` labelled rows, the score is the share of label 1 (one half
without labels); repeated rows are scored alike; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetwane.llm.text import Words, chunks, fold, over_batches
from fleetwane.session import store

STATISTICS = (
    "log_words", "log_lines", "word_length", "log_longest", "distinct", "repeated_next", "top_word", "distinct_lines",
    "upper", "digit", "symbol", "shout", "stop", "comma", "other", "foreign",
)

#: Shrinkage of a class covariance towards the pooled one and towards its diagonal, and what is added to the diagonal.
TOWARDS_POOLED = 0.1
TOWARDS_DIAGONAL = 0.1
RIDGE = 0.05
MIN_ROWS = 2 * len(STATISTICS)

#: Scores stay this far from 0 and 1 in log-odds.
MOST_LOG_ODDS = 30.0

# classes of bytes
_SPACE, _LOWER, _UPPER, _DIGIT, _SYMBOL, _SHOUT, _STOP, _COMMA, _OTHER, _LEAD, _REST, _KINDS = range(12)
_KIND = np.full(256, _OTHER, np.int64)
for _chars, _kind in ((b" \t\n\x0b\f\r", _SPACE), (b"#*$%&|<>", _SYMBOL), (b"!", _SHOUT), (b".?;:", _STOP), (b",", _COMMA)):
    _KIND[list(_chars)] = _kind
_KIND[97:123], _KIND[65:91], _KIND[48:58] = _LOWER, _UPPER, _DIGIT
_KIND[128:192], _KIND[192:256] = _REST, _LEAD


def _odds(share: np.ndarray) -> np.ndarray:
    return np.log((share + 1e-3) / (1 - share + 1e-3))


def statistics(texts: list[str]) -> np.ndarray:
    """One row of STATISTICS for each text."""
    n = len(texts)
    words = Words(texts)
    owner = np.repeat(np.arange(n), np.diff(words.text_starts))
    kinds = np.bincount(owner * _KINDS + _KIND[words.raw[: len(owner)]], minlength=n * _KINDS).reshape(n, _KINDS).astype(float)
    chars = np.maximum(kinds.sum(1) - kinds[:, _SPACE] - kinds[:, _REST], 1)
    letters = np.maximum(kinds[:, _LOWER] + kinds[:, _UPPER], 1)

    count = words.counts()
    some = np.maximum(count, 1)
    of = np.repeat(np.arange(n), count)
    hashes, size = words.hashes(), words.ends - words.starts
    longest = np.zeros(n)
    np.maximum.at(longest, of, size)
    again = np.bincount(of[1:], (hashes[1:] == hashes[:-1]) & (of[1:] == of[:-1]), minlength=n) if len(of) > 1 else np.zeros(n)
    distinct, top = _distinct(of, hashes, n)

    line_owner, line_hash = _lines(texts)
    lines = np.bincount(line_owner, minlength=n)
    own_lines, _ = _distinct(line_owner, line_hash, n)
    shares = [distinct / some, again / some, top / some, own_lines / np.maximum(lines, 1), kinds[:, _UPPER] / letters]
    shares += [kinds[:, k] / chars for k in (_DIGIT, _SYMBOL, _SHOUT, _STOP, _COMMA, _OTHER, _LEAD)]
    sizes = [np.log1p(count), np.log1p(lines), np.log1p(np.bincount(of, size, minlength=n) / some), np.log1p(longest)]
    return np.column_stack(sizes + [_odds(np.clip(s, 0, 1)) for s in shares])


def _distinct(owner: np.ndarray, values: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per owner: how many different values, and how often the most frequent one occurs."""
    if not len(owner):
        return np.zeros(n), np.zeros(n)
    order = np.lexsort((values, owner))
    o, v = owner[order], values[order]
    first = np.concatenate(([True], (o[1:] != o[:-1]) | (v[1:] != v[:-1])))
    runs = np.diff(np.concatenate((np.flatnonzero(first), [len(o)])))
    top = np.zeros(n)
    np.maximum.at(top, o[first], runs)
    return np.bincount(o[first], minlength=n).astype(float), top


def _lines(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    owner, values = [], []
    for i, text in enumerate(texts):
        full = [hash(x) for x in text.split("\n") if x.strip()]
        owner += [i] * len(full)
        values += full
    return np.array(owner, np.int64), np.array(values, np.int64)


def document_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, stats (array) of every document."""
    kind = dict(docs.dtypes)["doc_id"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), [t or "" for t in batch.column("text").to_pylist()]
            for start, end in chunks(texts):
                yield {"doc_id": ids[start:end], "stats": statistics(texts[start:end]).tolist()}

    return over_batches(docs.select("doc_id", "text"), task, f"doc_id {kind}, stats array<double>")


@dataclass
class Discriminant:
    """Two normal densities, ready to score."""

    middle: np.ndarray
    scale: np.ndarray
    means: np.ndarray
    #: inverse of the Cholesky factor of each class covariance
    whiten: np.ndarray
    #: log prior minus half the log determinant, by class
    constant: np.ndarray

    def score(self, stats: np.ndarray) -> np.ndarray:
        x = (stats - self.middle) / self.scale
        density = [c - 0.5 * (((x - m) @ w.T) ** 2).sum(1) for m, w, c in zip(self.means, self.whiten, self.constant)]
        return 1 / (1 + np.exp(-np.clip(density[1] - density[0], -MOST_LOG_ODDS, MOST_LOG_ODDS)))


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        stats, label = np.array(batch.column("stats").to_pylist()), np.array(batch.column("label").to_pylist())
        for k in (0, 1):
            own = stats[label == k] if len(label) else stats
            if len(own):
                sums[k] = sums.get(k, 0) + np.concatenate(([len(own)], own.sum(0), (own.T @ own).ravel()))
    rows = [(k, i, v) for k, values in sums.items() for i, v in enumerate(values.tolist())]
    yield {"label": [r[0] for r in rows], "place": [r[1] for r in rows], "value": [r[2] for r in rows]}


def fit(labelled: DataFrame) -> Discriminant | float:
    """From (stats, label) rows: the densities, or the share of label 1 where a class has too few rows."""
    parts = over_batches(labelled.select("stats", "label"), _moments, "label int, place int, value double")
    d = len(STATISTICS)
    sums = np.zeros((2, 1 + d + d * d))
    for r in parts.groupBy("label", "place").agg(F.sum("value").alias("value")).collect():  # 2 * (1 + d + d * d) rows at most
        sums[r["label"], r["place"]] = r["value"]
    n = sums[:, 0]
    if n.min() < MIN_ROWS:
        return float(n[1] / n.sum()) if n.sum() else 0.5
    means = sums[:, 1 : 1 + d] / n[:, None]
    covariances = sums[:, 1 + d :].reshape(2, d, d) / n[:, None, None] - np.einsum("ki,kj->kij", means, means)
    pooled = np.einsum("k,kij->ij", n, covariances) / n.sum()
    scale = np.sqrt(np.maximum(np.diag(pooled), 1e-6))
    middle = (n @ means) / n.sum()
    pooled = pooled / np.outer(scale, scale)
    whiten, constant = [], []
    for k in (0, 1):
        own = covariances[k] / np.outer(scale, scale)
        own = (1 - TOWARDS_POOLED) * own + TOWARDS_POOLED * pooled
        own = (1 - TOWARDS_DIAGONAL) * own + TOWARDS_DIAGONAL * np.diag(np.diag(own)) + RIDGE * np.eye(d)
        factor = np.linalg.cholesky(own)
        whiten.append(np.linalg.inv(factor))
        constant.append(np.log(n[k] / n.sum()) - np.log(np.diag(factor)).sum())
    return Discriminant(middle, scale, (means - middle) / scale, np.array(whiten), np.array(constant))


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 3, held_out: int = 1) -> DataFrame:
    """doc_id, held_out, score, predicted for every document; learned from the other folds' labels."""
    stats = store(document_statistics(docs), "statistics")
    marks = labels.select("doc_id", F.col(label).cast("int").alias("label")).filter(F.col("label").isin(0, 1))
    taught = stats.join(marks, "doc_id").filter(fold("doc_id", folds) != held_out)
    model = fit(taught)
    kind = dict(docs.dtypes)["doc_id"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            values = np.array(batch.column("stats").to_pylist()).reshape(-1, len(STATISTICS))
            score = model.score(values) if isinstance(model, Discriminant) else np.full(len(values), model)
            yield {"doc_id": batch.column("doc_id"), "score": score}

    scored = over_batches(stats, task, f"doc_id {kind}, score double")
    return scored.select("doc_id", (fold("doc_id", folds) == held_out).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
