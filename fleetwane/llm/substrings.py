"""Substring dedup: words covered by a window of 35 words that also starts elsewhere are removed.

Equal windows have the same smallest 8-gram (in an order that puts 8-grams with rare words
first, so that a window that reaches beyond a shared passage is known by its own words).
Windows whose smallest 8-gram occurs once are done. Runs of windows with a repeated one that
occur twice as a whole need no search. The others are dealt to shards by their 8-gram,
together with one copy of each other run that has it; each shard puts these runs into a
compressed FM-index (wavelet matrix of the Burrows-Wheeler transform), and the runs that
occur once are streamed against it by backward search: the matching statistics give the
windows that occur twice. An 8-gram with very many different runs is taken window by window.

Windows are judged on the input: all copies of a passage go. Words are compared by 64-bit hashes.

Defined cases: null texts have no words; a text shorter than a window keeps all of them;
repeated rows repeat each other's windows; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetwane.llm.fmindex import Index, repeated_windows
from fleetwane.llm.text import Words, chunks, mix, over_batches, whole, windows
from fleetwane.session import store

WINDOW = 35
GRAM = 8
#: 8-grams in a window.
SPAN = WINDOW - GRAM + 1
BINS = 1 << 16
ORDER_BITS = 12

#: Words that one index holds, about; runs of one 8-gram stay together.
SHARD_WORDS = 400_000
#: Different runs of an 8-gram beyond which its windows are taken one by one.
HOT_RUNS = 4_096

#: Levels (16 to a doubling of the count) that are told apart in the order of 8-grams.
STEP = 64

_U = np.uint64


def word_bins(docs: DataFrame) -> np.ndarray:
    """16 times the binary logarithm of the count of each bin of words, over all documents."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        total = np.zeros(BINS, np.int64)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for start, end in chunks(texts):
                total += np.bincount((Words(texts[start:end]).hashes() >> _U(48)).astype(np.int64), minlength=BINS)
        some = np.flatnonzero(total)
        yield {"bin": some, "n": total[some]}

    counts = over_batches(docs.select("text"), counted, "bin int, n long").groupBy("bin").agg(F.sum("n").alias("n"))
    levels = np.zeros(BINS, np.int64)
    for r in counts.collect():  # BINS rows at most
        levels[r["bin"]] = int(16 * np.log2(r["n"] + 1))
    return levels


class Runs:
    """The runs of windows of some texts: text, first window (word in the text), number of windows, smallest 8-gram."""

    def __init__(self, texts: list[str], levels: np.ndarray):
        self.words = Words(texts)
        self.hashes = self.words.hashes()
        none = np.zeros(0, np.int64)
        self.owner, self.start, self.count, self.key, self.grams = none, none, none, none.view(_U), none.view(_U)
        if len(self.hashes) < WINDOW:
            return
        level = levels[(self.hashes >> _U(48)).astype(np.int64)] // STEP
        rarest = level[: len(level) - GRAM + 1]
        for i in range(1, GRAM):
            rarest = np.minimum(rarest, level[i : i + len(rarest)])
        order = rarest.astype(_U)
        grams = order << _U(64 - ORDER_BITS) | windows(self.hashes, GRAM) >> _U(ORDER_BITS)
        least, width = grams, 1
        while 2 * width <= SPAN:
            least, width = np.minimum(least[:-width], least[width:]), 2 * width
        least = np.minimum(least[: len(grams) - SPAN + 1], least[SPAN - width :])
        owner = np.repeat(np.arange(len(texts)), self.words.counts())
        inside = np.flatnonzero(owner[: len(least)] == owner[WINDOW - 1 :])
        if not len(inside):
            return
        key, text = least[inside], owner[inside]
        head = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (text[1:] != text[:-1]))))
        self.owner, self.key = text[head], key[head]
        self.start = inside[head] - self.words.first[self.owner]
        self.count = np.diff(np.concatenate((head, [len(inside)])))
        self.grams = grams


def _keys(levels: np.ndarray):
    """(key, n) per chunk: n is 2 if the 8-gram occurs more than once in the chunk."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for start, end in chunks(texts):
                found = Runs(texts[start:end], levels)
                keys, grams = np.unique(found.key), np.sort(found.grams)
                n = np.searchsorted(grams, keys, "right") - np.searchsorted(grams, keys)
                yield {"key": keys.view(np.int64), "n": np.minimum(n, 2)}

    return task


def _runs(levels: np.ndarray):
    """(key, uid, start, count, content) of every run."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            texts, uid = [t or "" for t in batch.column("text").to_pylist()], batch.column("uid").to_numpy()
            for start, end in chunks(texts):
                found = Runs(texts[start:end], levels)
                first = found.words.first[found.owner] + found.start
                content = contents(found.hashes, first, first + found.count + WINDOW - 1)
                yield {"key": found.key.view(np.int64), "uid": uid[start:end][found.owner], "start": found.start, "count": found.count, "content": content}

    return task


_STEP = _U(0x9E3779B97F4A7C15)
_BACK = _U(pow(int(_STEP), -1, 1 << 64))


def contents(hashes: np.ndarray, a: np.ndarray, z: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the words from each a to z."""
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.concatenate((np.ones(1, _U), np.full(len(hashes), _STEP, _U))))
        back = np.cumprod(np.concatenate((np.ones(1, _U), np.full(len(hashes), _BACK, _U))))
        total = np.concatenate((np.zeros(1, _U), np.cumsum(mix(hashes) * powers[:-1])))
        return mix((total[z] - total[a]) * back[a] + (z - a).astype(_U)).view(np.int64)


def _wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Wanted runs of touched texts -> their words (words of hot runs: null, a row for each window)."""
    for batch in batches:
        texts, uid, runs = batch.column("text").to_pylist(), batch.column("uid").to_pylist(), batch.column("runs").to_pylist()
        for begin, end in chunks(texts):
            words = Words(texts[begin:end])
            hashes = words.hashes()
            out: dict[str, list] = {"shard": [], "uid": [], "start": [], "n": [], "content": [], "words": []}
            for i in range(end - begin):
                for run in runs[begin + i]:
                    if not run["wanted"]:
                        continue
                    starts = range(run["start"], run["start"] + run["count"]) if run["hot"] else (run["start"],)
                    first = np.array(starts) + int(words.first[i])
                    last = first + WINDOW - 1 + (1 if run["hot"] else run["count"])
                    out["shard"] += [run["key"]] * len(starts)
                    out["uid"] += [uid[begin + i]] * len(starts)
                    out["start"] += starts
                    out["n"] += [run["n"]] * len(starts)
                    if run["hot"]:
                        out["content"] += contents(hashes, first, last).tolist()
                        out["words"] += [None] * len(starts)
                    else:
                        out["content"].append(None)
                        out["words"].append(hashes[int(first[0]) : int(last[0])].view(np.int64))
            yield out


def _searched(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Runs sorted by shard -> (uid, start, spans): the words covered by repeated windows, as from, to, from, to, ..."""
    held: list[tuple[int, int, int, np.ndarray]] = []
    size, shard = 0, None
    for batch in batches:
        uid, start, n = (batch.column(c).to_pylist() for c in ("uid", "start", "n"))
        words = batch.column("words")
        offsets, flat = words.offsets.to_numpy(), words.values.to_numpy()
        for i, key in enumerate(batch.column("shard").to_pylist()):
            if key != shard and size >= SHARD_WORDS:
                yield _search(held)
                held, size = [], 0
            shard = key
            held.append((uid[i], start[i], n[i], flat[offsets[i] : offsets[i + 1]].copy()))
            size += len(held[-1][3])
    yield _search(held)


def _search(held: list[tuple[int, int, int, np.ndarray]]) -> dict:
    out: dict[str, list] = {"uid": [], "start": [], "spans": []}
    if not held:
        return out
    lengths = np.array([len(w) for *_, w in held])
    starts = np.concatenate(([0], np.cumsum(lengths + 1)[:-1]))
    text = np.zeros(int((lengths + 1).sum()), np.int64)
    _, symbols = np.unique(np.concatenate([w for *_, w in held]), return_inverse=True)
    inside = np.ones(len(text), bool)
    inside[starts + lengths] = False
    text[inside] = symbols + 1
    single = np.array([n < 2 for _, _, n, _ in held])
    hit = repeated_windows(Index(text), text, starts[single], (starts + lengths)[single], WINDOW)
    for (uid, place, n, _), start, length in zip(held, starts.tolist(), lengths.tolist()):
        if n < 2 and (spans := _joined(np.flatnonzero(hit[start : start + length]))):
            out["uid"].append(uid)
            out["start"].append(place)
            out["spans"].append(spans)
    return out


def _joined(at: np.ndarray) -> list[int]:
    """Windows that start at ``at`` -> the spans that they cover together."""
    if not len(at):
        return []
    gap = np.flatnonzero(np.diff(at) > WINDOW)
    first = at[np.concatenate(([0], gap + 1))]
    last = at[np.concatenate((gap, [len(at) - 1]))] + WINDOW
    return np.column_stack((first, last)).ravel().tolist()


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Every document: its words and the digest if all stay; the text only if it has candidate runs."""
    for batch in batches:
        texts = [t or "" for t in batch.column("text").to_pylist()]
        runs = batch.column("runs")
        touched = runs.is_valid().to_pylist()
        split = [_words(t) for t in texts]
        yield {
            "uid": batch.column("uid"),
            "doc_id": batch.column("doc_id"),
            "n_words": [len(w) for w in split],
            "kept_sha256": [hashlib.sha256(" ".join(w).encode()).hexdigest() for w in split],
            "text": [t if k else None for t, k in zip(texts, touched)],
            "runs": runs,
        }


def _words(text: str) -> list[str]:
    """The words between the six separators."""
    for separator in "\t\n\x0b\f\r":
        text = text.replace(separator, " ")
    return list(filter(None, text.split(" ")))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        removed, digests, kept_texts = [], [], []
        columns = (batch.column(c).to_pylist() for c in ("text", "runs", "covered"))
        for text, runs, covered in zip(*columns):
            words = _words(text)
            gone = np.zeros(len(words), bool)
            for run in runs:
                if run["n"] > 1:
                    gone[run["start"] : run["start"] + run["count"] + WINDOW - 1] = True
            for found in covered or ():
                for a, z in zip(found["spans"][::2], found["spans"][1::2]):
                    gone[found["start"] + a : found["start"] + z] = True
            kept = " ".join(w for w, g in zip(words, gone.tolist()) if not g)
            removed.append(int(gone.sum()))
            digests.append(hashlib.sha256(kept.encode()).hexdigest())
            kept_texts.append(kept)
        yield {"doc_id": batch.column("doc_id"), "n_words": batch.column("n_words"), "n_removed": removed, "kept_sha256": digests, "kept_text": kept_texts}


_RUN = "struct<start: int, count: int, key: bigint, n: bigint, hot: boolean, wanted: boolean>"


def candidate_runs(named: DataFrame, levels: np.ndarray) -> DataFrame:
    """The stored (uid, runs) of texts with runs whose 8-gram is repeated.

    A run has n (how often it occurs as a whole), hot (its 8-gram has very many different
    runs) and wanted (its words are needed: it occurs once, or it is the copy that stands
    for a run that shares its 8-gram with one that does).
    """
    keys = over_batches(named.select("text"), _keys(levels), "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    keys = store(keys.filter("n > 1").select("key"), "keys")
    runs = over_batches(named.select("uid", "text"), _runs(levels), "key long, uid long, start int, count int, content long")
    runs = store(runs.join(keys, "key"), "runs")

    first = F.min(F.struct("uid", "start")).alias("first")
    info = store(runs.groupBy("content").agg(F.count("*").alias("n"), F.min("key").alias("key"), first), "contents")
    by_key = info.groupBy("key").agg(F.count("*").alias("different"), F.min("n").alias("fewest"))
    by_key = store(by_key.filter("fewest = 1").select("key", (F.col("different") > HOT_RUNS).alias("hot")), "searched")
    info = store(info.join(by_key, "key", "left").select("content", "n", "first", "hot"), "contents")
    joined = runs.join(info, "content")
    wanted = F.col("hot").isNotNull() & (F.col("first") == F.struct("uid", "start"))
    run = F.struct("start", "count", "key", "n", F.coalesce("hot", F.lit(False)).alias("hot"), wanted.alias("wanted"))
    return store(joined.groupBy("uid").agg(F.collect_set(run).alias("runs")), "by-text")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document, and kept_text where a run of windows was looked at."""
    kind = dict(docs.dtypes)["doc_id"]
    levels = word_bins(docs)
    named = docs.select(F.xxhash64("doc_id", "text").alias("uid"), "doc_id", whole("text").alias("text"))
    by_text = candidate_runs(named, levels).withColumnRenamed("uid", "u")
    both = named.join(by_text, F.col("uid") == F.col("u"), "left").select("uid", "doc_id", "text", "runs")
    described = store(over_batches(both, _described, f"uid long, doc_id {kind}, n_words long, kept_sha256 string, text string, runs array<{_RUN}>"), "texts")
    touched = described.filter(F.col("runs").isNotNull())

    asked = touched.filter(F.exists("runs", lambda r: r["wanted"])).select("uid", "text", "runs")
    parts = store(over_batches(asked, _wanted, "shard long, uid long, start int, n long, content long, words array<long>"), "wanted")
    whole_runs = parts.filter("words is not null").repartition("shard").sortWithinPartitions("shard")
    spans = over_batches(whole_runs, _searched, "uid long, start int, spans array<int>")
    single = parts.filter("words is null")
    twice = store(single.groupBy("content").agg(F.sum("n").alias("m")).filter("m > 1"), "windows")
    windows_ = single.filter("n = 1").join(twice, "content").select("uid", "start", F.array(F.lit(0), F.lit(WINDOW)).alias("spans"))
    covered = store(spans.union(windows_).groupBy("uid").agg(F.collect_set(F.struct("start", "spans")).alias("covered")), "covered")

    once = F.exists("runs", lambda r: r["n"] == 1)
    columns = ["doc_id", "n_words", "text", "runs", "covered"]
    searched = touched.filter(once).join(covered.withColumnRenamed("uid", "u"), F.col("uid") == F.col("u"), "left").select(columns)
    known = touched.filter(~once).withColumn("covered", F.lit(None).cast("array<struct<start: int, spans: array<int>>>")).select(columns)
    cut = over_batches(searched.union(known), _cut, f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string, kept_text string")
    nothing = F.lit(0).cast("long").alias("n_removed"), "kept_sha256", F.lit(None).cast("string").alias("kept_text")
    return cut.union(described.filter(F.col("runs").isNull()).select("doc_id", "n_words", *nothing))
