"""Target-distribution importance resampling: documents whose n-grams look like those of a target corpus.

Words are runs of digits, a-z (A-Z lowered) and characters beyond ASCII. The features of a
text are its runs of 1 to ``most`` consecutive words, hashed into buckets by CRC-32. All
texts of a batch are joined with a sentinel byte between them; one pass of the expression
finds the words of all, a binary search in the texts' offsets tells whose they are, n-grams
that cross a text's end are masked, and ``bincount`` sums what is left: counts per bucket
for the models of corpus and target, gains per document for the weights.

Counts are summed in each batch before the one shuffle of at most ``BUCKETS`` rows a batch; the
driver holds one number per bucket. Drawing (Gumbel top-k) sorts documents, as rows of
numbers only, by range of score; ranks come from the places in the stored, sorted parts and the
parts' sizes, so no task sees more than a part.

Defined cases: null and wordless texts have no features and weight 0; texts of any length
are taken whole; an empty target or corpus counts as no features (the smoothing of one per
bucket stays); a null doc_id is hashed as the empty text and comes last among ties; repeated
rows are drawn as rows of their own; other columns are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fleetwane.llm.text import chunks, over_batches
from fleetwane.session import store

BUCKETS = 10_000
#: Words of the longest feature.
NGRAM = 1
#: Of the documents with at least LEAST_WORDS words, PERCENT % are drawn.
LEAST_WORDS, PERCENT = 20, 10
SEED = "2024"

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
#: No word has this byte.
SENTINEL = b"\x00"

#: Longer words are hashed one by one.
LONG = 64


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table.astype(np.uint32)


TABLE = _crc_table()


def crc32_of(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
    """CRC-32 of each stretch of bytes, going on from ``before`` (that of what precedes it); all stretches step together."""
    size = ends - starts
    order = np.argsort(-size, kind="stable")
    start, size = starts[order], size[order]
    crc = np.full(len(order), 0xFFFFFFFF, np.uint32) if before is None else ~before[order]
    long = int(np.searchsorted(-size, -LONG, "left"))  # those of more than LONG bytes come first
    for k in range(long):
        crc[k] = zlib.crc32(raw[start[k] : start[k] + size[k]].tobytes(), int(~crc[k])) ^ 0xFFFFFFFF
    start, rest = start[long:], crc[long:]
    active = np.searchsorted(-size[long:], -np.arange(LONG + 1), "left")  # how many have more than so many bytes
    for step in range(LONG + 1):
        m = int(active[step])
        if not m:
            break
        rest[:m] = TABLE[(rest[:m] ^ raw[start[:m] + step]) & np.uint32(0xFF)] ^ (rest[:m] >> np.uint32(8))
    out = np.empty(len(order), np.uint32)
    out[order] = ~crc
    return out


class Features:
    """The features of some texts: whose each is (``owner``), its ``bucket``, and the number of words of each text."""

    def __init__(self, texts: list[str], most: int = NGRAM, buckets: int = BUCKETS):
        parts = [t.encode("utf-8", "surrogatepass") for t in texts]
        joined = SENTINEL.join(parts).lower() + SENTINEL  # bytes: A-Z only
        raw = np.frombuffer(joined, np.uint8)
        spans = np.array([m.span() for m in WORD.finditer(joined)], np.int64).reshape(-1, 2)
        starts, ends = spans[:, 0], spans[:, 1]
        offsets = np.cumsum([0] + [len(p) + 1 for p in parts])
        of = np.searchsorted(offsets, starts, "right") - 1
        self.n_words = np.bincount(of, minlength=len(texts))[: len(texts)]
        blank = np.frombuffer(b" ", np.uint8)
        owners, hashes = [of], [crc32_of(raw, starts, ends)]
        for n in range(2, most + 1):
            crc = hashes[-1][:-1] if len(hashes[-1]) else hashes[-1]
            crc = crc32_of(blank, np.zeros(len(crc), np.int64), np.ones(len(crc), np.int64), crc)
            hashes.append(crc32_of(raw, starts[n - 1 :], ends[n - 1 :], crc))
            owners.append(of[: len(crc)])
        for n in range(2, most + 1):  # the last word must be of the same text
            whole = of[n - 1 :] == owners[n - 1]
            owners[n - 1], hashes[n - 1] = owners[n - 1][whole], hashes[n - 1][whole]
        self.owner = np.concatenate(owners)
        self.bucket = (np.concatenate(hashes) % np.uint32(buckets)).astype(np.int64)
        self.n_features = np.bincount(self.owner, minlength=len(texts))[: len(texts)]


def _texts(batch: pa.RecordBatch) -> list[str]:
    return [t or "" for t in batch.column("text").to_pylist()]


def bucket_counts(docs: DataFrame, most: int = NGRAM, buckets: int = BUCKETS) -> np.ndarray:
    """Features per bucket over all texts."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            texts = _texts(batch)
            for start, end in chunks(texts):
                total += np.bincount(Features(texts[start:end], most, buckets).bucket, minlength=buckets)
        some = np.flatnonzero(total)
        yield {"bucket": some, "n": total[some]}

    counts = over_batches(docs.select("text"), counted, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in counts.collect():  # at most one row per bucket
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of how much likelier each bucket is in the target, rounded down."""
    buckets = len(corpus)
    s, t = corpus.astype(float), target.astype(float)
    ratio = (t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weights(docs: DataFrame, target: DataFrame, most: int = NGRAM, buckets: int = BUCKETS) -> DataFrame:
    """doc_id, n_words, n_features, weight of every document; both tables have a column ``text``."""
    gain = gains(bucket_counts(docs, most, buckets), bucket_counts(target, most, buckets))
    kind = dict(docs.dtypes)["doc_id"]

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            texts, ids = _texts(batch), batch.column("doc_id")
            for start, end in chunks(texts):
                found = Features(texts[start:end], most, buckets)
                total = np.bincount(found.owner, gain[found.bucket], end - start)  # whole numbers: exact
                yield {"doc_id": ids[start:end], "n_words": found.n_words, "n_features": found.n_features, "weight": total.astype(np.int64)}

    return over_batches(docs.select("doc_id", "text"), weighed, f"doc_id {kind}, n_words long, n_features long, weight long")


def noisy_score(seed: str = SEED) -> Column:
    """The weight plus seeded Gumbel noise of the document's id, in thousandths."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    return F.col("weight") + F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def draw(weighed: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: str = SEED) -> DataFrame:
    """Every row with ``score`` and ``rank``: 1, 2, ... by falling score for the drawn ones, null for the others."""
    order = [F.desc("ready"), F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("weight"), F.asc("n_features")]
    # stored first: a sort by range reads its input twice
    scored = store(weighed.withColumn("score", noisy_score(seed)).withColumn("ready", F.col("n_words") >= least_words), "weighed")
    # the place in the sorted part, with the part's number above; stored, so that both stay what they are
    at = F.monotonically_increasing_id()
    placed = store(scored.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", at), "scored")
    part = F.shiftright("at", 33)
    parts = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n"), F.count_if("ready").alias("ready_n"))
    every = Window.partitionBy(F.lit(0))  # one row per partition of the sort
    earlier = F.sum("n").over(every.orderBy("part")) - F.col("n")
    take = F.floor(F.sum("ready_n").over(every) * percent / 100)
    parts = store(parts.select("part", earlier.alias("earlier"), take.alias("take")), "parts")
    joined = placed.withColumn("part", part).join(F.broadcast(parts), "part")
    rank = F.col("earlier") + F.col("at").bitwiseAND((1 << 33) - 1) + 1
    return joined.withColumn("rank", F.when(rank <= F.col("take"), rank)).drop("part", "earlier", "take", "at", "ready")


def resample(docs: DataFrame, target: DataFrame, *, most: int = NGRAM, percent: int = PERCENT) -> DataFrame:
    """The documents (all columns) that are drawn, a row for each drawn row of ``doc_id``; rows without an id are not drawn."""
    drawn = draw(weights(docs, target, most), percent).filter("rank is not null and doc_id is not null")
    chosen = drawn.select(F.col("doc_id").alias("drawn id")).distinct()
    return docs.join(chosen, docs["doc_id"] == F.col("drawn id"), "left_semi")
