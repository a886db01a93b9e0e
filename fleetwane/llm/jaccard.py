"""N-gram Jaccard join by prefix trees: documents that share most of their word 5-grams.

A document's set holds its distinct 5-word shingles as 64-bit tokens whose order is global:
shingles with the rarest words first (word counts over all documents, in a fixed number of
bins), then by hash. Similar sets share a certain number of tokens of their prefixes in that
order, so a class of equal sets that shares too few with all others is done. The rest are
ordered again, by how many of them hold a token: tokens that one set holds alone come first and are only
counted, and a set that shares less than PERCENT % of its tokens is done. Prefixes in that order have the
rarest shared tokens, and what they tie together are the families; nothing outside a family can
link to it, and passages that many documents share do not tie them while other words set them
apart. Within a family the ordered sets are stored in a trie; each set walks it, paths shared by
several sets are counted once, and a subtree is left as soon as the tokens that remain cannot
make up the overlap. Large families are cut into blocks that meet through pivots first; then
each set that is not yet connected to a block, but shares enough prefix tokens with it, meets it.

Defined cases: null or wordless texts have empty sets and link with nothing; shorter texts
are one shingle; equal texts (repeated rows) link; rows with a null doc_id take part, and
their component is the smallest id they reach (null if none); an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fleetwane.llm.graph import components
from fleetwane.llm.text import Words, chunks, mix, over_batches, unused, whole, windows
from fleetwane.session import store

SHINGLE = 5
#: A pair links if 100 * overlap >= PERCENT * union.
PERCENT = 75

#: Bins of the word counts, and bits of the order that come from them.
BINS = 1 << 22
ORDER_BITS = 12

#: Of so many tokens of a set one more is taken into the prefix, and one more must be shared there.
EXTRA = 8

#: Bits that mark the ids or classes of candidates, and those in a row of Spark's bitmaps.
ID_BITS = 1 << 26
_BITMAP = 1 << 15

#: Sets that one block of a family holds, and sets that all its blocks share.
BLOCK = 256
PIVOTS = 8

_U = np.uint64


# ---------------------------------------------------------------- sets


def _bins(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> _U(42)).astype(np.int64)


def word_bins(docs: DataFrame) -> np.ndarray:
    """How frequent words are: 8 times the binary logarithm of the count of each bin of words, over all documents."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        total = np.zeros(BINS, np.int64)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for start, end in chunks(texts):
                bins, n = np.unique(_bins(Words(texts[start:end], lower=True).hashes()), return_counts=True)
                total[bins] += n
        some = np.flatnonzero(total)
        yield {"bin": some, "n": total[some]}

    counts = over_batches(docs.select("text"), counted, "bin int, n long").groupBy("bin").agg(F.sum("n").alias("n"))
    seen = counts.filter("n > 1").select("bin", F.log2("n").cast("float").alias("level")).toArrow()  # BINS rows at most
    levels = np.zeros(BINS, np.uint16)
    levels[seen.column("bin").to_numpy()] = 8 * seen.column("level").to_numpy()
    return levels


def sets(texts: list[str], levels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, first): the sorted distinct tokens of text i are tokens[first[i]:first[i + 1]]."""
    words = Words(texts, lower=True)
    hashes = words.hashes()
    level = levels[_bins(hashes)]
    owner_all, tokens_all = [], []
    count = words.counts()
    for size in range(1, SHINGLE + 1):
        runs = windows(hashes, size)
        if not len(runs):
            continue
        if size < SHINGLE:
            owner = np.flatnonzero(count == size)
            at = words.first[:-1][owner]
        else:
            lengths = np.maximum(count - SHINGLE + 1, 0)
            owner = np.repeat(np.arange(len(texts)), lengths)
            at = np.arange(len(owner)) - np.repeat(np.concatenate(([0], np.cumsum(lengths)))[:-1], lengths) + words.first[:-1][owner]
        rarest = level[at]
        for i in range(1, size):
            rarest = np.minimum(rarest, level[at + i])
        order = np.minimum(rarest, (1 << ORDER_BITS) - 1).astype(_U)
        value = runs[at] if size == SHINGLE else mix(runs[at] + _U(size))
        owner_all.append(owner)
        tokens_all.append(order << _U(64 - ORDER_BITS) | value >> _U(ORDER_BITS))
    if not owner_all:
        return np.zeros(0, _U), np.zeros(len(texts) + 1, np.int64)
    owner, tokens = np.concatenate(owner_all), np.concatenate(tokens_all)
    place = np.lexsort((tokens, owner))
    owner, tokens = owner[place], tokens[place]
    new = np.concatenate(([True], (owner[1:] != owner[:-1]) | (tokens[1:] != tokens[:-1]))) if len(owner) else np.zeros(0, bool)
    owner, tokens = owner[new], tokens[new]
    return tokens, np.searchsorted(owner, np.arange(len(texts) + 1))


def classes(tokens: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A 64-bit id of each set; equal sets have the same."""
    with np.errstate(over="ignore"):
        sums = np.concatenate((np.zeros(1, _U), np.cumsum(mix(tokens ^ _U(0x5851F42D4C957F2D)))))
        return mix(sums[first[1:]] - sums[first[:-1]] + np.diff(first).astype(_U)).view(np.int64)


def prefix_sizes(sizes: np.ndarray) -> np.ndarray:
    """The first tokens of each set that are looked at: size - ceil(PERCENT % of size) + 1, and size / EXTRA more.

    Two similar sets of x and y tokens share at least min(x, y) / EXTRA + 1 of them.
    """
    return np.where(sizes > 0, sizes - (sizes * PERCENT + 99) // 100 + 1 + sizes // EXTRA, 0)


def _prefix_size(size: Column) -> Column:
    return (size - F.floor((size * PERCENT + 99) / 100) + 1 + F.floor(size / EXTRA)).cast("int")


def _least_shared(size: Column) -> Column:
    """A set of ``size`` shares so many prefix tokens with any similar set (which has PERCENT % of its tokens at least)."""
    return 1 + F.floor(F.floor(size * PERCENT / 100) / EXTRA)


def document_classes(docs: DataFrame, levels: np.ndarray) -> DataFrame:
    """doc_id, n_shingles, cls (null for an empty set)."""
    kind = dict(docs.dtypes)["doc_id"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), [t or "" for t in batch.column("text").to_pylist()]
            for start, end in chunks(texts):
                tokens, first = sets(texts[start:end], levels)
                own, size = classes(tokens, first).tolist(), np.diff(first).tolist()
                yield {"doc_id": ids[start:end], "n_shingles": size, "cls": [c if n else None for c, n in zip(own, size)]}

    return over_batches(docs.select("doc_id", "text"), task, f"doc_id {kind}, n_shingles long, cls long")


# ---------------------------------------------------------------- families


def _prefixes(levels: np.ndarray):
    """Rows (token, cls, n) of classes by prefix token, combined (``_combined``) in each chunk of texts."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for start, end in chunks(texts):
                tokens, first = sets(texts[start:end], levels)
                own, chosen = np.unique(classes(tokens, first), return_index=True)  # equal sets of the chunk count once
                size = np.diff(first)[chosen]
                take = prefix_sizes(size)
                at = np.arange(int(take.sum())) - np.repeat(np.cumsum(take) - take, take) + np.repeat(first[chosen], take)
                yield _combined(tokens[at].view(np.int64), np.repeat(own, take))

    return task


def _combined(token: np.ndarray, cls: np.ndarray) -> dict:
    """Rows (token, cls, n) of the tokens of some classes.

    Where several classes have a token, the first stands for them (n = -1); for the
    others only the number of such tokens is kept (n > 0, with the class for a token). Else n = 0.
    """
    order = np.argsort(token, kind="stable")
    token, cls = token[order], cls[order]
    head = np.concatenate(([True], token[1:] != token[:-1])) if len(token) else np.zeros(0, bool)
    places = np.flatnonzero(head)
    several = np.diff(np.concatenate((places, [len(token)]))) > 1
    tied, n = np.unique(cls[~head], return_counts=True)
    return {
        "token": np.concatenate((token[head], tied)),
        "cls": np.concatenate((cls[head], tied)),
        "n": np.concatenate((np.where(several, -1, 0), n)),
    }


def _whole_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows (cls, tokens) -> rows (token, cls, n), combined in each batch."""
    for batch in batches:
        offsets, flat = batch.column("tokens").offsets.to_numpy(), batch.column("tokens").values.to_numpy()
        rows = _combined(flat[offsets[0] : offsets[-1]], np.repeat(batch.column("cls").to_numpy(), np.diff(offsets)))
        order = np.argsort(rows["cls"], kind="stable")  # rows of a class side by side take fewer bytes
        yield {name: values[order] for name, values in rows.items()}


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows sorted by token -> (cls, n): how many of its prefix tokens each class shares with other classes."""
    held_token = held_cls = held_n = np.zeros(0, np.int64)
    for batch in batches:
        token, cls, n = (batch.column(c).to_numpy() for c in ("token", "cls", "n"))
        counted = n > 0
        ready = (cls[counted], n[counted])
        token, cls, n = (np.concatenate(x) for x in ((held_token, token[~counted]), (held_cls, cls[~counted]), (held_n, n[~counted])))
        last = np.searchsorted(token, token[-1]) if len(token) else 0  # the last token may go on
        more = _in_common(token[:last], cls[:last], n[:last])
        held_token, held_cls, held_n = token[last:], cls[last:], n[last:]
        yield _summed(*(np.concatenate(x) for x in zip(ready, more)))
    yield _summed(*_in_common(held_token, held_cls, held_n))


def _in_common(token: np.ndarray, cls: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 1 for each row whose token has rows of several classes."""
    if not len(token):
        return cls, n
    group = np.cumsum(np.concatenate(([True], token[1:] != token[:-1]))) - 1
    starts = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1])))
    several = (np.minimum.reduceat(cls, starts) != np.maximum.reduceat(cls, starts)) | (np.minimum.reduceat(n, starts) < 0)
    kept = cls[several[group]]
    return kept, np.ones(len(kept), np.int64)


def _summed(cls: np.ndarray, n: np.ndarray) -> dict:
    names, place = np.unique(cls, return_inverse=True)
    return {"cls": names, "n": np.bincount(place, n, len(names)).astype(np.int64) if len(names) else names}


def _sharing(rows: DataFrame) -> DataFrame:
    """(cls, n): how many of its tokens (rows of ``_combined``) each class shares with others."""
    counts = over_batches(rows.repartition("token").sortWithinPartitions("token"), _shared, "cls long, n long")
    return counts.groupBy("cls").agg(F.sum("n").alias("n"))


def candidates(docs: DataFrame, known: DataFrame, levels: np.ndarray) -> DataFrame:
    """The stored (cls, size, id) of classes that share enough prefix tokens with others to be similar to one."""
    shared = _sharing(over_batches(docs.select("text"), _prefixes(levels), "token long, cls long, n int"))
    size = known.filter("cls is not null").groupBy("cls").agg(F.max("n_shingles").alias("size"), F.min("doc_id").alias("id"))
    return store(size.join(shared, "cls").filter(F.col("n") >= _least_shared(F.col("size"))).select("cls", "size", "id"), "candidates")


def shared_sets(own: DataFrame) -> DataFrame:
    """The stored (cls, size, tokens) of candidates (cls, tokens) that share PERCENT % of their tokens with others, and those, rarest first.

    A set similar to another shares as many, so what shares fewer goes, and after that its
    tokens count no more. The first time shared tokens are only counted, with no token brought back
    to its sets; then a token is counted over all sets and joined as a table of one row per token,
    so one that very many sets hold is only a skewed key of a join.
    """
    enough = 100 * F.col("n") >= PERCENT * F.col("size")
    sizes = own.select("cls", F.size("tokens").alias("size")).distinct()
    passed = sizes.join(_sharing(over_batches(own, _whole_sets, "token long, cls long, n int")), "cls").filter(enough)
    held = _marked(own, "cls", store(passed.select("cls"), "passed"))
    each = held.select("cls", F.size("tokens").alias("size"), F.explode("tokens").alias("token"))
    counts = each.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.min("cls").alias("least"), F.max("cls").alias("most"))
    common = store(counts.filter("least < most").select("token", "n"), "common")
    # rows of one class that come twice are one
    rarest_first = F.sort_array(F.collect_set(F.struct("n", "token")))["token"]
    shared = each.join(common, "token").groupBy("cls", "size").agg(rarest_first.alias("tokens"))
    return store(shared.filter(100 * F.size("tokens") >= PERCENT * F.col("size")), "shared")


def _shared_prefix(length: Column) -> Column:
    """The tokens of a row of ``shared_sets`` among the first ``length`` of its whole set; those held by it alone come before them."""
    alone = F.col("size") - F.size("tokens")
    return F.slice("tokens", F.lit(1), F.greatest(F.lit(0), length - alone).cast("int"))


def families(own: DataFrame) -> DataFrame:
    """The stored (cls, family, n) of sets (``shared_sets``) tied by tokens of their prefixes; n is the family's size.

    Similar sets have a token in common among the first size - ceil(PERCENT % of size) + 1 of each.
    """
    first = F.col("size") - F.floor((F.col("size") * PERCENT + 99) / 100) + 1
    prefix = own.select("cls", F.explode(_shared_prefix(first)).alias("token"))
    ends = prefix.groupBy("token").agg(F.min("cls").alias("b"), F.max("cls").alias("most"))
    least = store(ends.filter("b < most").select("token", "b"), "least")
    ties = prefix.join(least, "token").select(F.col("cls").alias("a"), "b").distinct()
    found = store(components(ties).select(F.col("node").alias("cls"), F.col("component").alias("family")), "families")
    return store(found.join(found.groupBy("family").agg(F.count("*").alias("n")), "family"), "families")


# ---------------------------------------------------------------- the trie


class Trie:
    """Ordered sets (arrays of token ranks), with paths without branches in one node.

    ``sizes`` counts the tokens of each set with those that no other set holds and that are left out.
    A node is (start, end, set, children, shortest, longest, ended): its tokens are those
    of the set ``set`` from start to end; ``shortest`` is the smallest size below it, ``longest``
    the length of the longest path; ``ended`` are the sets that end there.
    """

    def __init__(self, ordered: list[np.ndarray], sizes: list[int] | None = None):
        self.sets = ordered
        self.sizes = sizes or [len(s) for s in ordered]
        order = sorted(range(len(ordered)), key=lambda i: ordered[i].astype(">u4").tobytes())
        self.root = self._node(order, 0)

    def _node(self, order: list[int], depth: int):
        a, z = self.sets[order[0]], self.sets[order[-1]]
        n = min(len(a), len(z))
        differ = np.flatnonzero(a[depth:n] != z[depth:n])
        end = depth + int(differ[0]) if len(differ) else n
        ended = [i for i in order if len(self.sets[i]) == end]
        children, rest = [], order[len(ended) :]
        while rest:
            token, k = self.sets[rest[0]][end], 1
            while k < len(rest) and self.sets[rest[k]][end] == token:
                k += 1
            children.append(self._node(rest[:k], end))
            rest = rest[k:]
        return depth, end, order[0], children, min(self.sizes[i] for i in order), max(len(self.sets[i]) for i in order), ended

    def similar(self, has: np.ndarray, size: int) -> Iterator[int]:
        """Stored sets similar to the set of ``size`` tokens marked in ``has``."""
        open_nodes = [(self.root, 0)]
        while open_nodes:
            (start, end, held, children, shortest, longest, ended), overlap = open_nodes.pop()
            if self._most(overlap, size, longest - start) < self._needed(size, shortest):
                continue
            overlap += int(np.count_nonzero(has[self.sets[held][start:end]]))
            for i in ended:
                if 100 * overlap >= PERCENT * (size + self.sizes[i] - overlap):
                    yield i
            if children and self._most(overlap, size, longest - end) >= self._needed(size, shortest):
                open_nodes += [(child, overlap) for child in children]

    @staticmethod
    def _most(overlap: int, size: int, left: int) -> int:
        return (100 + PERCENT) * (overlap + min(size - overlap, left))

    @staticmethod
    def _needed(size: int, other: int) -> int:
        return PERCENT * (size + other)


def linked(stored: list[tuple[int, int, np.ndarray]], probes: list[tuple[int, int, np.ndarray]]) -> list[tuple[int, int]]:
    """Links between probes and stored sets, each (name, size, tokens), that connect them (no more than connect)."""
    above: dict[int, int] = {}

    def top(x: int) -> int:
        while above.get(x, x) != x:
            above[x] = above.get(above[x], above[x])
            x = above[x]
        return x

    if not stored or not probes:
        return []
    values, ranks = np.unique(np.concatenate([tokens for _, _, tokens in stored]), return_inverse=True)
    cuts = np.cumsum([len(tokens) for _, _, tokens in stored])[:-1]
    trie = Trie(np.split(ranks.astype(np.uint32), cuts), [size for _, size, _ in stored])
    has, out = np.zeros(len(values), bool), []
    for name, size, probe in probes:
        at = np.minimum(np.searchsorted(values, probe), len(values) - 1)
        own = at[values[at] == probe]
        has[own] = True
        for i in trie.similar(has, size):
            other = stored[i][0]
            a, b = top(name), top(other)
            if a != b:
                above[max(a, b)] = min(a, b)
                out.append((name, other))
        has[own] = False
    return out


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows sorted by (family, part), roles 0 (stored), 1 (probe) or 2 (both) -> links (a, b)."""
    key, group = None, []
    for batch in batches:
        names, sizes, tokens = batch.column("cls").to_pylist(), batch.column("size").to_pylist(), batch.column("tokens")
        offsets, flat = tokens.offsets.to_numpy(), tokens.values.to_numpy().view(_U)
        roles = batch.column("role").to_pylist()
        links = []
        for i, k in enumerate(zip(batch.column("family").to_pylist(), batch.column("part").to_pylist())):
            if k != key:
                links += _group_links(group)
                key, group = k, []
            group.append((roles[i], (names[i], sizes[i], flat[offsets[i] : offsets[i + 1]].copy())))
        yield {"a": [x for x, _ in links], "b": [y for _, y in links]}
    links = _group_links(group)
    yield {"a": [x for x, _ in links], "b": [y for _, y in links]}


def _group_links(group: list[tuple[int, tuple[int, int, np.ndarray]]]) -> list[tuple[int, int]]:
    return linked([row for role, row in group if role != 1], [row for role, row in group if role != 0])


def _by_part(rows: DataFrame) -> DataFrame:
    dealt = rows.select("family", "part", "cls", "role", "size", "tokens").repartition("family", "part").sortWithinPartitions("family", "part")
    return over_batches(dealt, _joined, "a long, b long")


def _marked(rows: DataFrame, key: str, chosen: DataFrame) -> DataFrame:
    """The rows whose key has its bit among those of the one column of ``chosen``.

    All rows with a chosen key, and few others as long as chosen keys are much fewer than bits;
    nothing is shuffled but bits.
    """

    def place(column: str) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(ID_BITS))

    at = chosen.select(place(chosen.columns[0]).alias("place"))
    at = at.select(F.floor(F.col("place") / _BITMAP).alias("nth"), (F.col("place") % _BITMAP).alias("bit"))
    marks = np.zeros((ID_BITS // _BITMAP, _BITMAP // 8), np.uint8)
    for r in at.groupBy("nth").agg(F.bitmap_construct_agg("bit").alias("bits")).collect():  # ID_BITS bits at most
        marks[r.nth] = np.frombuffer(r.bits, np.uint8)
    marks, names = marks.ravel(), rows.columns

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            place = batch.column("place").to_numpy()
            found = batch.filter(pa.array((marks[place >> 3] >> (place & 7) & 1).astype(bool)))
            yield {name: found.column(name) for name in names}

    schema = ", ".join(f"{name} {kind}" for name, kind in rows.dtypes)
    return over_batches(rows.select("*", place(key).alias("place")), task, schema)


def _candidate_sets(docs: DataFrame, chosen: DataFrame, levels: np.ndarray) -> DataFrame:
    """The stored (cls, tokens) of the classes with these ids; other classes may be among them, and a class may come several times."""
    texts = _marked(docs.select("doc_id", "text"), "doc_id", chosen.select("id")).select("text")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        seen: set[int] = set()  # of this task's part of the candidates
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for start, end in chunks(texts):
                tokens, first = sets(texts[start:end], levels)
                own, size, right = classes(tokens, first).tolist(), np.diff(first), []
                for i, cls in enumerate(own):
                    if size[i] and cls not in seen:
                        seen.add(cls)
                        right.append(i)
                yield {"cls": [own[i] for i in right], "tokens": [tokens[first[i] : first[i + 1]].view(np.int64) for i in right]}

    return store(over_batches(texts, task, "cls long, tokens array<long>"), "sets")


def links(docs: DataFrame, known: DataFrame, levels: np.ndarray) -> DataFrame:
    """(a, b) links between classes; together they connect what is similar."""
    sets_ = _candidate_sets(docs, candidates(docs, known, levels), levels)
    shared = shared_sets(sets_)
    own = store(shared.join(families(shared), "cls"), "family-sets")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    part = F.pmod(F.xxhash64("cls"), blocks).cast("int")
    first = own.withColumn("part", part).withColumn("role", F.lit(2))
    large = own.filter(F.col("n") > BLOCK)
    chosen = large.withColumn("nth", F.row_number().over(Window.partitionBy("family").orderBy(F.xxhash64("cls"), "cls"))).filter(F.col("nth") <= PIVOTS)
    pivots = chosen.withColumn("part", F.explode(F.sequence(F.lit(0), blocks - 1))).filter(F.col("part") != part).withColumn("role", F.lit(2))
    done = store(_by_part(first.unionByName(pivots.drop("nth"))), "pairs")
    if large.limit(1).count() == 0:
        return done

    # large families: components of the first round, in blocks, and what may link them
    label = F.coalesce(F.col("component"), F.col("cls"))
    labelled = large.join(components(done), F.col("cls") == F.col("node"), "left").select("cls", "size", label.alias("label"))
    labelled = store(labelled, "labels")
    sizes = labelled.groupBy("label").agg(F.count("*").alias("m"))
    block = F.xxhash64("label", F.pmod(F.xxhash64("cls"), F.ceil(F.col("m") / BLOCK)))
    placed = store(labelled.join(sizes, "label").select("cls", "size", "label", "m", block.alias("block")), "placed")
    # joined as one row per class, then a row per token
    prefix = large.select("cls", _shared_prefix(_prefix_size(F.col("size"))).alias("first")).join(placed, "cls")
    prefix = prefix.select("cls", "size", "label", "m", "block", F.explode("first").alias("token"))
    several = prefix.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high").select("token")
    prefix = store(prefix.join(several, "token"), "prefixes")
    others = prefix.select("token", F.col("block").alias("b"), F.col("label").alias("l"), F.col("m").alias("k")).distinct()
    smaller = F.struct("m", "label") < F.struct("k", "l")  # the smaller component asks
    met = prefix.join(others, "token").filter(smaller).groupBy("cls", "size", "b").count()
    met = store(met.filter(F.col("count") >= _least_shared(F.col("size"))).select("cls", "b"), "met")
    asked = met.groupBy("b").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("chunks"))
    own = own.select("cls", "size", "tokens")
    columns = [F.col("b").alias("family"), F.col("chunk").alias("part"), "cls", "role", "size", "tokens"]
    stored = met.join(asked, "b").withColumn("chunk", F.pmod(F.xxhash64("cls"), F.col("chunks")).cast("int")).join(own, "cls").withColumn("role", F.lit(0))
    probes = placed.select("cls", "block").join(asked, F.col("block") == F.col("b")).join(own, "cls")
    probes = probes.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).withColumn("role", F.lit(1))
    return store(done.union(_by_part(stored.select(columns).union(probes.select(columns)))), "pairs")


# ---------------------------------------------------------------- documents


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    levels = word_bins(docs)
    known = store(document_classes(docs, levels), "classes")
    found = components(links(docs, known, levels))
    keyed = known.join(found, F.col("cls") == F.col("node"), "left").withColumn("key", F.coalesce("component", "cls"))
    keyed = store(keyed.select("doc_id", "n_shingles", "key"), "keyed")
    least = store(keyed.filter("key is not null").groupBy("key").agg(F.min("doc_id").alias("least")), "smallest")
    both = keyed.join(least.withColumnRenamed("key", "k"), F.col("key") == F.col("k"), "left")
    component = F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("least"))
    return both.select("doc_id", "n_shingles", component.alias("component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents without those similar to an earlier one: that with the smaller id (null last), then the smaller text digest.

    Rows with the same id and text, null or not, are one document; of them the row stays whose
    columns come first in order. Null and empty texts are alike, and similar to none with another id.
    """
    key = unused(docs, "row_key")
    keyed = docs.withColumn(key, _row_key(docs))
    found = near_duplicates(keyed.select(F.col(key).alias("doc_id"), "text"))
    stay = found.filter(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias(unused(keyed, "stays"))).distinct()
    kept = keyed.join(stay, F.col(key) == F.col(stay.columns[0]), "left_semi")
    rows = kept.groupBy(key).agg(F.min(F.struct(*(F.col(f"`{c}`") for c in docs.columns))).alias("row"))
    return rows.select("row.*")


def _row_key(docs: DataFrame) -> Column:
    """Texts in the order of ids (null last), then of a digest of the text."""
    whole_number = dict(docs.dtypes)["doc_id"] in ("tinyint", "smallint", "int", "bigint")
    doc_id = F.col("doc_id")
    ordered = F.lpad(F.hex(doc_id.cast("bigint").bitwiseXOR(F.lit(-(1 << 63)))), 16, "0") if whole_number else doc_id.cast("string")
    return F.concat(F.coalesce(F.concat(F.lit("0"), ordered), F.lit("1")), F.lit(":"), F.md5(whole("text")))
