"""Language ID by hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A letter trigram (any run of other characters
counts as one blank) is the product of its letters' vectors, permuted by place; a document is
the bundle of its trigrams; a language is the bundle of its training documents, each with the
same weight. A document gets the language with the largest cosine, after the mean of the
languages is taken off both sides.

Defined cases: a text that is null, empty or without letters is ``und`` with score 0, as is
every text when nothing could be learned; ties go to the first language by name; rows with a
null lang teach nothing; repeated rows count each; other columns are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetwane.llm.text import chunks, over_batches, ship, text_udf, unused

UNKNOWN = "und"
SIZE = 1024
SEED = 7
BLANK = 32
#: Trigram vectors that a task keeps.
KEPT_VECTORS = 20_000
#: Texts counted together.
MOST_TEXTS = 512
#: Texts times different trigrams in one table.
MOST_CELLS = 1 << 22
#: Alphabets up to this size are counted in a dense table.
DENSE_ALPHABET = 128


@functools.cache
def _is_letter() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


@functools.cache
def _letter(code: int) -> np.ndarray:
    return np.random.default_rng([SEED, code]).integers(0, 2, SIZE, dtype=np.int8) * 2 - 1


class _Vectors:
    """Vectors of trigrams, kept by key."""

    def __init__(self):
        self.rows: dict[int, int] = {}
        self.table = np.zeros((KEPT_VECTORS, SIZE), np.int8)

    def of(self, keys: np.ndarray) -> np.ndarray:
        if len(keys) > KEPT_VECTORS:
            return _bound(keys)
        missing = [k for k in keys.tolist() if k not in self.rows]
        if len(self.rows) + len(missing) > KEPT_VECTORS:
            self.rows, missing = {}, keys.tolist()
        if missing:
            start = len(self.rows)
            self.table[start : start + len(missing)] = _bound(np.array(missing, np.int64))
            self.rows.update(zip(missing, range(start, start + len(missing))))
        return self.table[[self.rows[k] for k in keys.tolist()]]


def _bound(keys: np.ndarray) -> np.ndarray:
    first, second, third = keys >> 42, (keys >> 21) & 0x1FFFFF, keys & 0x1FFFFF
    letters, place = np.unique(np.concatenate((first, second, third)), return_inverse=True)
    vectors = np.stack([_letter(int(c)) for c in letters])
    a, b, c = place[: len(keys)], place[len(keys) : 2 * len(keys)], place[2 * len(keys) :]
    return np.roll(vectors, 2, 1)[a] * np.roll(vectors, 1, 1)[b] * vectors[c]


@functools.cache
def _vectors() -> _Vectors:
    return _Vectors()


def profiles(texts: list[str]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(start, end, counts, keys): trigram counts of the texts from start to end, and the trigrams' keys."""
    for start, end in chunks(texts, MOST_TEXTS):
        yield from _profiles([t.lower() for t in texts[start:end]], start)


def _profiles(part: list[str], start: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    codes = np.frombuffer(("\n".join(part) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _is_letter()[codes]
    keep = letter | np.concatenate(([True], letter[:-1]))
    owner = np.repeat(np.arange(len(part)), [len(t) + 1 for t in part])[keep]
    symbols = np.where(letter, codes, BLANK)[keep].astype(np.int64)
    inside = owner[2:] == owner[:-2] if len(owner) > 2 else np.zeros(0, bool)
    a, b, c, owner = symbols[:-2][inside], symbols[1:-1][inside], symbols[2:][inside], owner[2:][inside]
    keys, which = _keyed(a, b, c)
    n = len(part)
    if n > 1 and n * len(keys) > MOST_CELLS:  # many different letters: fewer texts at a time
        yield from _profiles(part[: n // 2], start)
        yield from _profiles(part[n // 2 :], start + n // 2)
        return
    counts = np.bincount(owner * max(len(keys), 1) + which, minlength=n * len(keys)).reshape(n, len(keys)) if len(keys) else np.zeros((n, 0))
    yield start, start + n, counts.astype(np.float32), keys


def _keyed(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The keys of the trigrams, each once and sorted, and the place of each trigram among them."""
    if not len(a):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    alphabet = np.flatnonzero(np.bincount(np.concatenate((a, b, c)).astype(np.int64)))
    if len(alphabet) > DENSE_ALPHABET:
        return np.unique((a << 42) | (b << 21) | c, return_inverse=True)
    size = len(alphabet)
    small = np.zeros(int(alphabet.max()) + 1, np.int64)
    small[alphabet] = np.arange(size)
    dense = (small[a] * size + small[b]) * size + small[c]
    present = np.flatnonzero(np.bincount(dense))
    index = np.zeros(size**3, np.int32)
    index[present] = np.arange(len(present))
    keys = (alphabet[present // (size * size)] << 42) | (alphabet[present // size % size] << 21) | alphabet[present % size]
    return keys, index[dense]


def bundles(texts: list[str]) -> Iterator[tuple[int, int, np.ndarray]]:
    """(start, end, vectors): the mean trigram vector of each text; zero without trigrams."""
    for start, end, counts, keys in profiles(texts):
        total = np.maximum(counts.sum(1, keepdims=True), 1)
        yield start, end, _projected(counts / total, keys)


#: Trigrams projected at a time.
BLOCK = 8192


def _projected(weights: np.ndarray, keys: np.ndarray) -> np.ndarray:
    out = np.zeros((len(weights), SIZE), np.float32)
    for i in range(0, len(keys), BLOCK):
        out += weights[:, i : i + BLOCK] @ _vectors().of(keys[i : i + BLOCK]).astype(np.float32)
    return out


def _taught(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    sums: dict[str, np.ndarray] = {}
    n: dict[str, int] = {}
    for batch in batches:
        texts, langs = [t or "" for t in batch.column("text").to_pylist()], batch.column("lang").to_pylist()
        for start, end, counts, keys in profiles(texts):
            shares = counts / np.maximum(counts.sum(1, keepdims=True), 1)
            own = np.array(langs[start:end], object)
            names = sorted(set(own))
            together = np.stack([shares[own == name].sum(0) for name in names])
            for name, vector in zip(names, _projected(together, keys)):
                sums[name] = sums.get(name, 0) + vector.astype(np.float64)
                n[name] = n.get(name, 0) + int((counts[own == name].sum(1) > 0).sum())
    yield {"lang": list(sums), "n": [n[k] for k in sums], "vector": [v.tolist() for v in sums.values()]}


def learn(docs: DataFrame, teaches: Column | None = None) -> dict[str, np.ndarray]:
    """Language -> mean vector, from the rows where ``teaches`` holds. One vector per language comes to the driver."""
    rows = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    rows = (rows if teaches is None else rows.filter(teaches)).select("text", "lang")
    parts = over_batches(rows, _taught, "lang string, n long, vector array<double>")
    flat = parts.select("lang", "n", F.posexplode("vector").alias("place", "value"))
    summed = flat.groupBy("lang", "place").agg(F.sum("value").alias("value"), F.sum("n").alias("n")).filter("n > 0")
    ordered = summed.groupBy("lang").agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("place", "value"))).alias("v"))
    return {r["lang"]: np.array([x["value"] for x in r["v"]]) / r["n"] for r in ordered.collect()}


class Predict:
    """Texts -> lang_pred and score, against learned vectors."""

    def __init__(self, learned: dict[str, np.ndarray]):
        self.names = sorted(learned)
        if self.names:
            table = np.stack([learned[k] for k in self.names])
            self.middle = table.mean(0) if len(table) > 1 else np.zeros(SIZE)
            centred = table - self.middle
            self.table = (centred / np.maximum(np.linalg.norm(centred, axis=1, keepdims=True), 1e-12)).astype(np.float32)

    @staticmethod
    def close() -> None:
        """Workers live on for other stages; the vectors do not."""
        _vectors.cache_clear()
        _letter.cache_clear()

    def __call__(self, texts: list[str]) -> dict[str, list]:
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        letters = [any(map(str.isalpha, t)) for t in texts]
        if self.names:
            for start, end, vectors in bundles(texts):
                own = vectors - self.middle.astype(np.float32)
                norm = np.maximum(np.linalg.norm(own, axis=1), 1e-12)
                cosine = own @ self.table.T / norm[:, None]
                best = cosine.argmax(1)
                for i, (k, value) in enumerate(zip(best.tolist(), cosine.max(1).tolist())):
                    if letters[start + i]:
                        names[start + i], scores[start + i] = self.names[k], min(max(value, 0.0), 1.0)
        return {"lang_pred": names, "score": scores}


def predict(docs: DataFrame, learned: dict[str, np.ndarray], result: str = "language") -> DataFrame:
    """docs with a struct ``result`` (lang_pred, score); a table that has such a column already is an error."""
    if unused(docs, result) != result:
        raise ValueError(f"the table has a column {result} already")
    ship(docs.sparkSession)
    return docs.withColumn(result, text_udf(Predict(learned), "lang_pred string, score double")("text"))
