"""BPE encoding and decoding with a lexicon in a minimal acyclic transducer.

The frequent words of the corpus are compiled into an automaton whose equal suffixes are
shared (built word by word in sorted order) and whose edges carry numbers that add up to the
word's index; at the index lie the word's ids, merged exactly. The file is given to the
executors, which map it into memory. Words outside the lexicon are merged exactly where they
occur. The tokenizer's file is a parameter; it is the kind that normalizes to NFC and lower
case, splits by pattern and marks word ends.

Defined cases: null texts are empty; an empty text has no ids and decodes to the empty text;
texts of the special tokens become their ids; a word of any length is merged exactly;
repeated rows give repeated results; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import os
import re
import tempfile
import unicodedata
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetwane.llm.text import chunks, over_batches, ship, text_udf, unused

#: Words in the lexicon at most; it only decides how many words are merged again.
LEXICON_WORDS = 200_000
#: Words whose ids a task keeps at hand, about.
KEPT_WORDS = 150_000

#: Longer words are merged with a heap.
SHORT = 48

#: The tokenizer's pattern of words (white space as in Unicode).
PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+")


#: The same for texts of Latin-1 characters in lower case, with their letters, numbers and blanks spelled out (several times as fast).
LATIN = re.compile("[a-zªµºß-öø-ÿ]+|'s|'t|'re|'ve|'m|'ll|'d|[0-9²³¹¼-¾]|[^\t-\r \x85\xa0a-zªµºß-öø-ÿ0-9²³¹¼-¾]+")


def _is_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def _byte_letters() -> list[str]:
    """The printable stand-in of every byte: itself if visible Latin-1, else the next free letter above."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    above = iter(range(0x100, 0x200))
    return [chr(b) if b in set(visible) else chr(next(above)) for b in range(256)]


class Tokenizer:
    """Words to ids by exact merges."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model = content["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.end = model.get("end_of_word_suffix") or ""
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.ranks = {pair: rank for rank, pair in enumerate(pairs)}
        self.tokens = {i: t for t, i in self.vocab.items()}
        special = {t["content"]: t["id"] for t in content.get("added_tokens", ())}
        self.special = special
        self.tokens.update({i: t for t, i in special.items()})
        self.special_pattern = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self.letters = _byte_letters()

    def words(self, text: str) -> list[str]:
        """The words of a text, special tokens as themselves (they contain no word of the pattern as a whole)."""
        if self.special_pattern and self.special_pattern.search(text):
            out = []
            for k, piece in enumerate(self.special_pattern.split(text)):
                out += [piece] if k % 2 else self._plain(piece)
            return out
        return self._plain(text)

    @staticmethod
    def _plain(text: str) -> list[str]:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # a sigma is lowered without regard to its place
        text = text.lower()
        return (LATIN if _is_latin(text) else PATTERN).findall(text)

    def merge(self, word: str) -> list[int]:
        if word in self.special:
            return [self.special[word]]
        parts = [self.letters[b] for b in word.encode("utf-8", "surrogatepass")]
        parts[-1] += self.end
        parts = self._short(parts) if len(parts) <= SHORT else self._long(parts)
        return [self.vocab[p] for p in parts if p in self.vocab]

    def _short(self, parts: list[str]) -> list[str]:
        get, none = self.ranks.get, len(self.ranks)
        ranks = [get(pair, none) for pair in zip(parts, parts[1:])]
        while ranks and (best := min(ranks)) < none:
            i = ranks.index(best)
            parts[i] += parts.pop(i + 1)
            del ranks[i]
            if i:
                ranks[i - 1] = get((parts[i - 1], parts[i]), none)
            if i < len(ranks):
                ranks[i] = get((parts[i], parts[i + 1]), none)
        return parts

    def _long(self, parts: list[str]) -> list[str]:
        ranks, n = self.ranks, len(parts)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [(ranks[p], i, p) for i, p in enumerate(zip(parts, parts[1:])) if p in ranks]
        heapq.heapify(heap)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = after[i]
            if j < 0 or (parts[i], parts[j]) != pair or not parts[i]:
                continue
            parts[i], parts[j], after[i] = parts[i] + parts[j], "", after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right >= 0 and (new := (parts[left], parts[right])) in ranks:
                    heapq.heappush(heap, (ranks[new], left, new))
        return [p for p in parts if p]


@functools.lru_cache(2)
def _tokenizer(path: str) -> Tokenizer:
    return Tokenizer(path)


# ---------------------------------------------------------------- the lexicon


def compile_lexicon(entries: dict[str, list[int]]) -> dict[str, np.ndarray]:
    """The minimal acyclic transducer of the words (as UTF-8 bytes) and the table of their ids.

    Edges are sorted by (state, byte). ``add`` of an edge is the number of words that come
    before it in the state, so the sum over a path is the word's index in sorted order.
    """
    ordered = sorted((w.encode("utf-8", "surrogatepass"), ids) for w, ids in entries.items())
    known: dict[tuple, int] = {}
    states: list[tuple] = []  # finished states: (final, ((byte, state), ...))

    def finish(node: list) -> int:
        key = (node[0], tuple(node[1]))
        if key not in known:
            known[key] = len(states)
            states.append(key)
        return known[key]

    path: list[list] = [[False, []]]  # open states along the last word
    last = b""
    for word, _ in ordered:
        same = 0
        while same < min(len(word), len(last)) and word[same] == last[same]:
            same += 1
        for depth in range(len(last), same, -1):
            path[depth - 1][1].append((last[depth - 1], finish(path[depth])))
        del path[same + 1 :]
        path += [[False, []] for _ in range(len(word) - same)]
        path[-1][0] = True
        last = word
    for depth in range(len(last), 0, -1):
        path[depth - 1][1].append((last[depth - 1], finish(path[depth])))
    root = finish(path[0])

    below = np.zeros(len(states), np.int64)  # words from a state on; targets come before their sources
    keys, targets, adds = [], [], []
    for state, (final, edges) in enumerate(states):
        total = int(final)
        for byte, target in edges:
            keys.append(state << 8 | byte)
            targets.append(target)
            adds.append(total)
            total += below[target]
        below[state] = total
    lengths = [len(ids) for _, ids in ordered]
    return {
        "key": np.array(keys, np.uint32),
        "target": np.array(targets, np.uint32),
        "add": np.array(adds, np.uint32),
        "final": np.array([s[0] for s in states], np.uint32),
        "offset": np.concatenate(([0], np.cumsum(lengths))).astype(np.uint32),
        "ids": np.array([i for _, ids in ordered for i in ids], np.uint32),
        "root": np.array([root], np.uint32),
    }


def write_lexicon(arrays: dict[str, np.ndarray], path: str) -> None:
    """One file: a line of JSON with the lengths, then the arrays as 32-bit numbers, aligned."""
    head = json.dumps({k: len(v) for k, v in arrays.items()}).encode()
    with open(path, "wb") as file:
        file.write(head.ljust(-(-(len(head) + 1) // 4) * 4 - 1) + b"\n")
        for array in arrays.values():
            file.write(array.astype("<u4").tobytes())


class Lexicon:
    """The automaton of a file, mapped into memory."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            lengths = json.loads(file.readline())
            at = file.tell()
        data = np.memmap(path, "<u4", "r", offset=0)
        at //= 4
        for name, n in lengths.items():
            setattr(self, name, data[at : at + n])
            at += n

    def find(self, words: list[str]) -> np.ndarray:
        """Index of each word, -1 if it is not in the lexicon: all words walk the automaton together."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        start = np.concatenate(([0], np.cumsum(size)[:-1])) if len(raw) else np.zeros(0, np.int64)
        buffer = np.frombuffer(b"".join(raw), np.uint8).astype(np.uint32)
        index = np.zeros(len(raw), np.int64)
        state = np.full(len(raw), self.root[0] if len(self.root) else 0, np.uint32)
        out = np.full(len(raw), -1, np.int64)
        active = np.arange(len(raw)) if len(self.key) else np.zeros(0, np.int64)
        step = 0
        while len(active):
            ended = size[active] == step
            done = active[ended]
            hit = done[self.final[state[done]] == 1]
            out[hit] = index[hit]
            active = active[~ended]
            key = state[active] << np.uint32(8) | buffer[start[active] + step]
            edge = np.searchsorted(self.key, key)
            edge[edge == len(self.key)] = 0
            known = self.key[edge] == key
            active, edge = active[known], edge[known]
            state[active] = self.target[edge]
            index[active] += self.add[edge]
            step += 1
        return out


# ---------------------------------------------------------------- Spark


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) over all texts; words are counted within each batch before they are shuffled."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            total: Counter = Counter()
            for text in texts:
                total.update(Tokenizer._plain(text))
            yield {"word": list(total), "n": list(total.values())}

    return over_batches(docs.select("text"), counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def make_lexicon(docs: DataFrame, tokenizer_path: str, most: int = LEXICON_WORDS) -> str:
    """Compile the ``most`` frequent words; returns the name of the file that executors get."""
    spark = docs.sparkSession
    top = word_counts(docs).filter("n > 1").orderBy(F.desc("n"), "word").limit(most).select("word")
    merge = _tokenizer(tokenizer_path).merge
    arrays = compile_lexicon({r["word"]: merge(r["word"]) for r in top.toLocalIterator()})
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    path = os.path.join(tempfile.mkdtemp(prefix="fleetwane-"), name)
    write_lexicon(arrays, path)
    spark.sparkContext.addFile(path)
    return name


class Known:
    """Words that a task has met, and their ids, one after another."""

    def __init__(self, tokenizer: Tokenizer, lexicon: Lexicon):
        self.tokenizer, self.lexicon = tokenizer, lexicon
        self.clear()

    def clear(self) -> None:
        self.slot: dict[str, int] = {}
        self.ids = np.zeros(0, np.uint32)
        self.size = np.zeros(0, np.int64)
        self.first = np.zeros(0, np.int64)

    def meet(self, words: list[str]) -> None:
        """Take in new words: from the lexicon if it has them, else by exact merges."""
        found = self.lexicon.find(words)
        special, merge = self.tokenizer.special, self.tokenizer.merge
        ids, known = np.asarray(self.lexicon.ids), found >= 0
        begin, end = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        begin[known], end[known] = self.lexicon.offset[found[known]], self.lexicon.offset[found[known] + 1]
        spans = zip(words, begin.tolist(), end.tolist())
        own = [ids[a:b] if b > a and w not in special else np.array(merge(w), np.uint32) for w, a, b in spans]
        start = len(self.slot)
        self.slot.update(zip(words, range(start, start + len(words))))
        size = np.fromiter(map(len, own), np.int64, len(own))
        flat = np.concatenate(own) if own else np.zeros(0, np.uint32)
        self.first = np.concatenate((self.first, len(self.ids) + np.cumsum(size) - size))
        self.size = np.concatenate((self.size, size))
        self.ids = np.concatenate((self.ids, flat))


class Encode:
    """Texts -> ids (and digests), with the lexicon and exact merges for the rest."""

    def __init__(self, lexicon: str, name: str, with_ids: bool):
        self.lexicon, self.name, self.with_ids = lexicon, name, with_ids

    @staticmethod
    def close() -> None:
        """Workers live on for other stages; what this one has met does not."""
        _known.cache_clear()
        _tokenizer.cache_clear()

    def __call__(self, texts: list[str]) -> dict[str, list]:
        known = _known(self.lexicon, self.name)
        token = known.tokenizer.tokens.__getitem__
        out: dict[str, list] = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": []} | ({"ids": []} if self.with_ids else {})
        for start, end in chunks(texts):
            split = [known.tokenizer.words(t) for t in texts[start:end]]
            if len(known.slot) > KEPT_WORDS:
                known.clear()
            new: dict[str, None] = {}
            for words in split:
                new.update(dict.fromkeys(w for w in words if w not in known.slot))
            if new:
                known.meet(list(new))
            for words in split:
                which = list(map(known.slot.__getitem__, words))
                index = np.array(which, np.int64)
                size = known.size[index]
                before = np.cumsum(size) - size
                total = int(size.sum())
                own = known.ids[np.repeat(known.first[index] - before, size) + np.arange(total)]
                out["n_tokens"].append(total)
                out["ids_sha256"].append(hashlib.sha256(own.astype("<u4").tobytes()).hexdigest())
                out["decoded_sha256"].append(hashlib.sha256(" ".join(map(token, own.tolist())).encode()).hexdigest())
                if self.with_ids:
                    out["ids"].append(own.astype(np.int32))
        return out


@functools.lru_cache(1)
def _known(lexicon: str, name: str) -> Known:
    return Known(_tokenizer(SparkFiles.get(name)), Lexicon(SparkFiles.get(lexicon)))


def encode(docs: DataFrame, tokenizer_path: str, most: int = LEXICON_WORDS, with_ids: bool = True, result: str = "encoded") -> DataFrame:
    """docs with a struct ``result``: n_tokens, ids_sha256, decoded_sha256 and, if wanted, ids; a table that has such a column already is an error."""
    if unused(docs, result) != result:
        raise ValueError(f"the table has a column {result} already")
    ship(docs.sparkSession)
    lexicon = make_lexicon(docs, tokenizer_path, most)
    docs.sparkSession.sparkContext.addFile(tokenizer_path)
    schema = "n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if with_ids else "")
    run = Encode(lexicon, os.path.basename(tokenizer_path), with_ids)
    return docs.withColumn(result, text_udf(run, schema)("text"))


def decode(ids: list[int], tokenizer_path: str) -> str:
    """The text of ids: the tokens with blanks between, special ones as well."""
    tokens = _tokenizer(tokenizer_path).tokens
    return " ".join(tokens[i] for i in ids if i in tokens)
