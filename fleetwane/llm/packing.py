"""Harmonic packing: token sequences of documents in sequences of fixed capacity, with little padding.

A document's tokens (and an end token) are cut into pieces: as many as fill a sequence, then
at most one of each half, quarter, ... of the capacity down to ``LEAST`` tokens, then what is
left. A piece of n tokens is in class ``capacity // n``, whose bins take that many pieces: lengths
in (capacity / (k + 1), capacity / k] go k to a bin. The classes of 1, 2, 4, ... pieces fill their
bins to the last token but for shorter rests among them; only rests below ``LEAST`` tokens leave
gaps, of at most 1 / (k + 1) of their bin.

A worker keeps one open bin for each class and nothing else, so partitions are packed
independently, without a shuffle, in memory that does not depend on their size. What is in open
bins at a partition's end is put in a row and cut at every full sequence; the end of that row is
cut into sequences whose lengths are powers of two (sequences of such lengths need no padding).
Sequence ids hold the partition's number and a count, so a task that runs again packs the same.

Defined cases: null and empty texts are the end token alone; texts of any length are taken
whole; repeated rows are packed as rows of their own (pieces with a null doc_id keep it); other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles, TaskContext
from pyspark.sql import DataFrame
from tokenizers import Tokenizer as Library

from fleetwane.llm.bpe import Tokenizer
from fleetwane.llm.text import chunks, over_batches

CAPACITY = 2048
END_TOKEN = 1
#: Pieces that are cut off have at least so many tokens (a power of two).
LEAST = 128

#: Words whose ids a task keeps at hand, about.
KEPT_WORDS = 300_000

PIECES = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Ids:
    """Texts to token ids; words that were met before are looked up, new ones are encoded by the library, many at a time."""

    def __init__(self, path: str):
        self.tokenizer, self.library = Tokenizer(path), Library.from_file(path)
        self.library.no_padding()
        self.library.no_truncation()
        ends = [i for token, i in self.tokenizer.vocab.items() if token.endswith(self.tokenizer.end)]
        self.ends_word = np.zeros(max(self.tokenizer.tokens) + 1, bool)
        self.ends_word[ends] = bool(self.tokenizer.end)
        self.known: dict[str, bytes] = {}

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        split = [self.tokenizer.words(t) for t in texts]
        if len(self.known) > KEPT_WORDS:
            self.known.clear()
        known = self.known
        self._meet(list(set().union(*split).difference(known)))
        end = np.array([END_TOKEN], "<u4").tobytes()
        return [np.frombuffer(b"".join([*map(known.__getitem__, words), end]), "<u4") for words in split]

    def _meet(self, new: list[str]) -> None:
        """A word's last token, and no other, has the mark of a word's end; what the library takes otherwise is merged one by one."""
        special = self.tokenizer.special
        plain = [w for w in new if w not in special]
        ids = np.array(self.library.encode(" ".join(plain), add_special_tokens=False).ids, "<u4")
        cuts = (4 * (np.flatnonzero(self.ends_word[ids]) + 1)).tolist()
        if len(cuts) == len(plain) and (cuts[-1] if cuts else 0) == ids.nbytes:
            raw = ids.tobytes()
            self.known.update((w, raw[a:b]) for w, a, b in zip(plain, [0, *cuts], cuts))
            plain = []
        for word in [*plain, *special.keys() & set(new)]:
            self.known[word] = np.array(self.tokenizer.merge(word), "<u4").tobytes()


@functools.lru_cache(1)
def _ids(path: str) -> Ids:
    """One for all tasks of a worker."""
    return Ids(path)


def pieces(n: int, capacity: int = CAPACITY, least: int = LEAST) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens."""
    out, at = [], 0
    while n - at >= capacity:
        out.append((at, capacity))
        at += capacity
    size = capacity // 2
    while size >= least:
        if n - at >= size:
            out.append((at, size))
            at += size
        size //= 2
    if at < n:
        out.append((at, n - at))
    return out


class Bins:
    """The open bins of one worker, by class; a piece is (document, start, ids, tokens of the document)."""

    def __init__(self, first_id: int, capacity: int = CAPACITY):
        self.capacity, self.next_id = capacity, first_id
        self.open: dict[int, list[tuple]] = {}

    def put(self, piece: tuple) -> list[tuple]:
        """The pieces of the bin that this one completes, with sequence id and offset; often none."""
        k = self.capacity // len(piece[2])
        if k == 1:
            return self._closed([piece])
        held = self.open.setdefault(k, [])
        held.append((*piece[:2], piece[2].copy(), piece[3]))  # not a view of all tokens of a batch
        return self._closed(self.open.pop(k)) if len(held) == k else []

    def _closed(self, held: list[tuple]) -> list[tuple]:
        out, offset = [], 0
        for piece in held:
            out.append((*piece, self.next_id, offset))
            offset += len(piece[2])
        self.next_id += 1
        return out

    def rest(self) -> Iterator[tuple]:
        """What is in open bins, in full sequences and then in sequences of falling powers of two."""
        left = sum(len(p[2]) for held in self.open.values() for p in held)
        room, held = self._next_size(left), []
        for k in sorted(self.open):
            for doc, start, ids, total in self.open[k]:
                while len(ids):
                    part = ids[:room]
                    held.append((doc, start, part, total))
                    start, ids, room, left = start + len(part), ids[room:], room - len(part), left - len(part)
                    if not room:
                        yield from self._closed(held)
                        room, held = self._next_size(left), []
        self.open.clear()

    def _next_size(self, left: int) -> int:
        return self.capacity if left >= self.capacity else 1 << (left.bit_length() - 1) if left else 0


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    *,
    capacity: int = CAPACITY,
    least: int = LEAST,
    with_ids: bool = True,
) -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, if wanted, the ids.

    ``capacity`` and ``least`` are powers of two; a sequence is the pieces of one ``sequence_id`` by ``offset``.
    """
    if capacity & (capacity - 1) or least & (least - 1) or not 0 < least <= capacity:
        raise ValueError("capacity and least must be powers of two, least no larger than capacity")
    docs.sparkSession.sparkContext.addFile(tokenizer_path)
    name = os.path.basename(tokenizer_path)
    kind = dict(docs.dtypes)["doc_id"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        encode = _ids(SparkFiles.get(name))
        bins = Bins(TaskContext.get().partitionId() << 33, capacity)
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), [t or "" for t in batch.column("text").to_pylist()]
            for start, end in chunks(texts):
                done: list[tuple] = []
                for doc, tokens in zip(ids[start:end], encode(texts[start:end])):
                    for at, size in pieces(len(tokens), capacity, least):
                        done += bins.put((doc, at, tokens[at : at + size], len(tokens)))
                yield _columns(done, with_ids)
        yield _columns(list(bins.rest()), with_ids)

    return over_batches(docs.select("doc_id", "text"), task, f"doc_id {kind}, {PIECES}" + (", ids array<int>" if with_ids else ""))


def _columns(done: list[tuple], with_ids: bool) -> dict[str, list]:
    out = {
        "doc_id": [p[0] for p in done],
        "start": [p[1] for p in done],
        "length": [len(p[2]) for p in done],
        "ids_crc32": [zlib.crc32(p[2]) for p in done],
        "doc_tokens": [p[3] for p in done],
        "sequence_id": [p[4] for p in done],
        "offset": [p[5] for p in done],
    }
    return out | ({"ids": [p[2].astype(np.int32) for p in done]} if with_ids else {})
