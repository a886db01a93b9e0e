"""Periodic run detection: stretches of words that repeat with a period, by an enhanced suffix array.

A run is a stretch of consecutive words with smallest period q (words q apart are identical)
that no neighbouring word extends; runs of at least ``max(least, 2 * q)`` words count. Within
a task the words of a few texts are numbered exactly (each text has numbers of its own), and
suffix array, inverse and LCP table are made of them. Every LCP interval of depth d is a set
of places that share d words and no more; for each suffix outside the interval's largest child
the places d words before and after it are looked up in the inverse: if one lies in another
child of the interval, there are two equal neighbours of d words which the next word does not
go on, a branching tandem. Each run ends with exactly one such square of its period. A square
is rotated to the left as long as words stay equal, which gives the run; squares of multiples
of the period end at the same place and merge into it. Intervals come as arrays (previous and
next smaller LCP), there are no tree nodes.

A text is one row, so nothing is shuffled; a task holds one text, or a few short ones, with
4 bytes a word and doubling step. Work is O(w log w) for w words.

Defined cases: null and wordless texts have no runs and collapse to the empty text; texts of
any length are taken whole; repeated rows give repeated results; ties are told apart by start,
then period; an empty table gives an empty result; other columns pass through untouched, and
one called like the result is an error.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetwane.llm.text import chunks, ship, text_udf, whole, words

#: Words that a run has at least.
LEAST = 12

#: Suffixes of small children that are looked up at a time.
AT_ONCE = 1 << 19

#: Words that squares are rotated together by; what goes on longer is compared in blocks.
STEPS = 64

SCHEMA = "runs array<struct<start: long, length: long, period: long>>, collapsed string"


# ---------------------------------------------------------------- the enhanced suffix array


def suffix_array(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(suffixes in order, the place of each suffix, LCP with the suffix before) by prefix doubling.

    Only suffixes that are not yet alone in their group are sorted again; ``levels[j]`` tells
    equal stretches of 2**j symbols.
    """
    n = len(symbols)
    order = np.argsort(symbols, kind="stable").astype(np.int32)
    rank = np.empty(n, np.int32)
    open_ = np.arange(n, dtype=np.int32)
    key = symbols[order].astype(np.int64)
    levels, width = [], 1
    while True:
        head = np.concatenate(([True], key[1:] != key[:-1])) if len(key) else np.zeros(0, bool)
        rank[order[open_]] = np.maximum.accumulate(np.where(head, open_, 0))
        levels.append(rank.copy())
        alone = head & np.concatenate((head[1:], [True])) if len(head) else head
        open_ = open_[~alone]
        if not len(open_):
            break
        suffix = order[open_]
        behind = suffix.astype(np.int64) + width
        second = np.where(behind < n, rank[np.minimum(behind, n - 1)], -1)
        key = rank[suffix].astype(np.int64) * (n + 1) + second + 1
        place = np.argsort(key, kind="stable")
        key, order[open_] = key[place], suffix[place]
        width *= 2
    lcp = np.zeros(n + 1, np.int32)
    tied = np.flatnonzero(levels[0][order[1:]] == levels[0][order[:-1]]) + 1 if n else np.zeros(0, np.int64)
    a, b = order[tied - 1].astype(np.int64), order[tied].astype(np.int64)
    for j in range(len(levels) - 1, -1, -1):
        inside = np.maximum(a, b) < n
        same = inside & (levels[j][np.minimum(a, n - 1)] == levels[j][np.minimum(b, n - 1)])
        step = np.where(same, 1 << j, 0)
        a, b = a + step, b + step
    lcp[tied] = a - order[tied - 1]
    return order, rank, lcp


def _smaller_before(values: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """The last place before each asked one whose value is smaller (the first value is smaller than all asked)."""
    before = np.arange(len(values)) - 1
    active = asked[values[before[asked]] >= values[asked]]
    while len(active):
        before[active] = before[before[active]]
        active = active[values[before[active]] >= values[active]]
    return before[asked]


def _intervals(lcp: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """(place, depth, low, high, child low, child high): the suffixes of all but the largest child of each LCP interval, in slices."""
    n = len(lcp) - 1
    at = np.flatnonzero(lcp > 0)
    if not len(at):
        return
    low = _smaller_before(lcp, at)
    high = n - _smaller_before(lcp[::-1], (n - at)[::-1])[::-1]
    depth = lcp[at]
    order = np.lexsort((at, depth, low))
    at, low, high, depth = at[order], low[order], high[order], depth[order]
    first = np.concatenate(([True], (low[1:] != low[:-1]) | (depth[1:] != depth[:-1])))
    number = np.cumsum(first) - 1
    # a child begins at every boundary of an interval, and one at the interval's low end
    follows = np.concatenate((np.where(first[1:], high[:-1], at[1:]), high[-1:]))
    begins = np.flatnonzero(first)
    child_low, child_high = np.concatenate((low[begins], at)), np.concatenate((at[begins], follows))
    owner = np.concatenate((number[begins], number))
    order = np.lexsort((child_low - child_high, owner))  # the largest child of each interval first
    child_low, child_high, owner = child_low[order], child_high[order], owner[order]
    small = np.concatenate(([False], owner[1:] == owner[:-1]))
    child_low, child_high, owner = child_low[small], child_high[small], owner[small]
    low, high, depth = low[begins][owner], high[begins][owner], depth[begins][owner]
    reach = np.cumsum(child_high - child_low)
    start = 0
    while start < len(reach):
        done = reach[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(reach, done + AT_ONCE, "right")))
        size = child_high[start:end] - child_low[start:end]
        of = np.repeat(np.arange(start, end), size)
        place = np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size) + child_low[of]
        yield place, depth[of].astype(np.int64), low[of], high[of], child_low[of], child_high[of]
        start = end


def branching_squares(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, depth) of all places where two equal stretches of ``depth`` symbols meet and the next symbol does not go on."""
    order, inverse, lcp = suffix_array(symbols)
    n, starts, depths = len(symbols), [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for place, depth, low, high, child_low, child_high in _intervals(lcp):
        suffix = order[place].astype(np.int64)
        for other, first in ((suffix + depth, suffix), (suffix - depth, suffix - depth)):
            inside = (other >= 0) & (other < n)
            there = inverse[np.clip(other, 0, n - 1)]
            hit = inside & (there >= low) & (there < high) & ((there < child_low) | (there >= child_high))
            starts.append(first[hit])
            depths.append(depth[hit])
    both = np.unique(np.stack((np.concatenate(starts), np.concatenate(depths))), axis=1)
    return both[0], both[1]


def _rotated(symbols: np.ndarray, start: np.ndarray, period: np.ndarray) -> np.ndarray:
    """How far each square can be rotated to the left."""
    out = np.zeros(len(start), np.int64)
    active = np.arange(len(start))
    for step in range(1, STEPS + 1):
        active = active[start[active] >= step]
        at = start[active] - step
        active = active[symbols[at] == symbols[at + period[active]]]
        out[active] = step
        if not len(active):
            return out
    for k in active.tolist():
        p, end, size = int(period[k]), int(start[k] - out[k]), 4 * STEPS
        while end:
            begin = max(0, end - size)
            differ = np.flatnonzero(symbols[begin:end] != symbols[begin + p : end + p])
            if len(differ):
                end = begin + int(differ[-1]) + 1
                break
            end, size = begin, 2 * size
        out[k] = start[k] - end
    return out


def periodic_runs(symbols: np.ndarray, least: int = LEAST) -> np.ndarray:
    """Rows (start, length, period) of all runs, sorted by start, then period."""
    start, period = branching_squares(symbols)
    end = start + 2 * period
    order = np.lexsort((period, end))
    start, period, end = start[order], period[order], end[order]
    found = [np.zeros((0, 3), np.int64)]
    while len(start):  # of the squares with one end the one with the smallest period; those it explains go
        head = np.concatenate(([True], end[1:] != end[:-1]))
        reach = start[head] - _rotated(symbols, start[head], period[head])
        found.append(np.stack((reach, end[head] - reach, period[head]), axis=1))
        group = np.cumsum(head) - 1
        left = ~head & ((period % period[head][group] != 0) | (start < reach[group]))
        start, period, end = start[left], period[left], end[left]
    runs = np.concatenate(found)
    runs = runs[runs[:, 1] >= np.maximum(least, 2 * runs[:, 2])]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


# ---------------------------------------------------------------- texts


class Find:
    """Texts -> their runs, and the words that no run repeats."""

    def __init__(self, least: int):
        self.least = least

    def __call__(self, texts: list[str]) -> dict[str, list]:
        out: dict[str, list] = {"runs": [], "collapsed": []}
        for begin, end in chunks(texts):
            parts = [t.encode("utf-8", "surrogatepass").split() for t in texts[begin:end]]  # splits at the six blanks
            symbols, used = [], 0
            for part in parts:
                numbers: defaultdict = defaultdict()
                numbers.default_factory = numbers.__len__
                symbols.append(np.fromiter(map(numbers.__getitem__, part), np.int64, len(part)) + used)
                used += len(numbers)
            first = np.cumsum([0, *map(len, parts)])
            runs = periodic_runs(np.concatenate(symbols), self.least)
            cut = np.searchsorted(runs[:, 0], first)
            for i, part in enumerate(parts):
                own = runs[cut[i] : cut[i + 1]] - [int(first[i]), 0, 0]
                out["runs"].append([{"start": s, "length": n, "period": p} for s, n, p in own.tolist()])
                if len(own):
                    change = np.zeros(len(part) + 1, np.int64)
                    np.add.at(change, own[:, 0] + own[:, 2], 1)
                    np.add.at(change, own[:, 0] + own[:, 1], -1)
                    part = [w for w, covered in zip(part, np.cumsum(change).tolist()) if not covered]
                out["collapsed"].append(b" ".join(part).decode("utf-8", "surrogatepass"))
        return out


def find(docs: DataFrame, text: str | Column = "text", *, least: int = LEAST, result: str = "periodic") -> DataFrame:
    """docs with a struct ``result``: ``runs`` (start, length, period) and ``collapsed``.

    ``collapsed`` has the words, joined by blanks, without those that a run contains after
    its first period.
    """
    if result in docs.columns:
        raise ValueError(f"the table has a column {result} already")
    ship(docs.sparkSession)
    return docs.withColumn(result, text_udf(Find(least), SCHEMA)(whole(text)))


def with_periods(text: str | Column, doc_id: str) -> Column:
    """The text; in a tenth of the documents (by checksum of the id) a last part of its words repeats with a period.

    A wordless text, and one without an id, stay as they are.
    """
    h = F.crc32(F.col(doc_id).cast("string"))
    g = F.floor(h / 10)
    w = words(whole(text))
    n = F.size(w)
    a = (g % F.greatest(n, F.lit(1))).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    again = F.flatten(F.array_repeat(F.slice(w, a + 1, p), F.ceil((n - a) / p).cast("int")))
    changed = F.array_join(F.slice(F.concat(F.slice(w, F.lit(1), a), again), F.lit(1), n), " ")
    return F.when((h % 10 == 0) & (n > 0), changed).otherwise(whole(text))


def digests(found: Column) -> list[Column]:
    """Of a result struct: number of runs, the greatest (ties: smallest start, then period), checksums of runs and collapsed text."""
    runs = found["runs"]
    best = F.array_max(F.transform(runs, lambda x: F.struct(x["length"].alias("n"), (-x["start"]).alias("s"), (-x["period"]).alias("p"))))
    texts = F.transform(runs, lambda x: F.concat_ws(",", x["start"], x["length"], x["period"]))
    joined = F.when(F.size(runs) > 0, F.concat(F.array_join(texts, "\n"), F.lit("\n"))).otherwise("")
    return [
        F.size(runs).cast("long").alias("n_runs"),
        (-best["s"]).alias("start"),
        best["n"].alias("length"),
        (-best["p"]).alias("period"),
        F.floor(1000 * best["n"] / -best["p"]).cast("long").alias("exponent_milli"),
        F.sha2(joined, 256).alias("runs_sha256"),
        F.sha2(found["collapsed"], 256).alias("collapsed_sha256"),
    ]
