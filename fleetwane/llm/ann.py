"""Approximate nearest neighbours by collision counting.

Vectors are dealt by the power of two that their norm is next to. Within such a level they
are mapped so that the largest inner product is the smallest distance (one more component
fills them up to the level's largest norm), and projected on single random directions. A
block of vectors keeps, per direction, its projections in sorted order. A query opens in each
of these arrays a window centred on its own projection. A vector that lies in the windows of
enough directions is a candidate, and candidates are verified by the exact inner product in
double precision.

The first round's windows serve the score of the 20th best vector of a bounded sample, which
no true neighbour is below: each level has its own distance for it, and levels whose norms
cannot reach the score are left out. Queries for which fewer verified candidates than asked
reach the score ask again with windows for twice the distance in the same sorted arrays, and
so on until enough do, or the windows hold all vectors; then all are taken. Blocks of queries
meet all blocks of vectors. Of equal vectors only the ids that can be among the nearest are
indexed.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components take
no part; vectors are compared with those of their length only; ties go to the smaller id;
repeated rows of one id are one candidate; fewer candidates than asked give fewer rows; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fleetwane.llm.text import over_batches, ship
from fleetwane.session import local_table, store

NEAREST = 20

#: Directions; a window reaches WIDTH times the distance to each side; that many directions must agree.
#: A vector at that very distance lies in a window with probability erf(WIDTH / sqrt(2)) = 0.866 and so
#: in AGREE of them with probability 0.972, a nearer one more often; one at 1.3 times the distance with 0.15.
DIRECTIONS = 96
WIDTH = 1.5
AGREE = 77
SEED = 97
#: What rounding may move a projection by.
SLACK = 1e-6

#: The sample for the first distance, of each length: one in SAMPLE_SHARE vectors, by hash, but about
#: SAMPLE at most, and about SAMPLE_LEAST (or all) at least.
SAMPLE_SHARE = 16
SAMPLE = 4096
SAMPLE_LEAST = 320
#: The smallest distance that a further round serves.
LEAST_DISTANCE = 1e-3

#: Vectors (on average; below 2 ** 16) and queries that meet in one task.
VECTOR_BLOCK = 8192
QUERY_BLOCK = 512


def _directions(size: int) -> np.ndarray:
    return np.random.default_rng([SEED, size]).standard_normal((size + 1, DIRECTIONS))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy().astype(np.float64).reshape(len(flat), -1)


def _lifted(vectors: np.ndarray, largest: float) -> np.ndarray:
    """Within the unit ball, and filled up to its surface."""
    inside = vectors / largest
    return np.column_stack((inside, np.sqrt(np.maximum(0, 1 - (inside**2).sum(1)))))


def _scores(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products, the same for equal vectors wherever they stand."""
    return (vectors * query).sum(1)


class Block:
    """The sorted projections of some vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, largest: float):
        self.ids, self.vectors = ids, vectors
        projected = (_lifted(vectors, largest) @ _directions(vectors.shape[1])).T
        order = np.argsort(projected, axis=1, kind="stable")
        self.sorted = np.take_along_axis(projected, order, 1)
        #: the place of each vector in each sorted array
        self.places = np.empty(order.shape, np.uint16)
        np.put_along_axis(self.places, order, np.arange(len(ids), dtype=np.uint16)[None, :], 1)

    def windows(self, centres: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each query (row) and direction: where its window begins in the sorted array, and its length."""
        low = [np.searchsorted(values, c - reach) for values, c in zip(self.sorted, centres.T)]
        high = [np.searchsorted(values, c + reach, "right") for values, c in zip(self.sorted, centres.T)]
        begin = np.array(low).T
        return begin.astype(np.uint16), (np.array(high).T - begin).astype(np.uint16)

    def collisions(self, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
        """In how many directions each vector lies in a query's window."""
        inside = self.places - begin[:, None] < length[:, None]  # places below the window wrap around
        return inside.view(np.uint8).sum(0, dtype=np.uint8)

    def nearest(
        self, own: int, query: np.ndarray, begin: np.ndarray, length: np.ndarray, bound: float, agree: int, k: int
    ) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the best k candidates that reach the bound; without one all are candidates."""
        enough = self.collisions(begin, length) >= agree if np.isfinite(bound) else np.True_
        near = np.flatnonzero(enough & (self.ids != own))
        scores = _scores(self.vectors[near], query)
        near, scores = near[scores >= bound], scores[scores >= bound]
        best = np.lexsort((self.ids[near], -scores))[:k]
        return self.ids[near[best]], scores[best]


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _norm(vector: Column) -> Column:
    """Of a usable vector, without squares that overflow or vanish."""
    top = F.array_max(F.transform(vector, F.abs))
    return F.least(top * F.sqrt(F.aggregate(vector, F.lit(0.0), lambda total, x: total + x / top * (x / top))), F.lit(sys.float_info.max))


def _distance(bound: Column, norm: Column, largest: Column) -> Column:
    """How far (lifted by ``largest``) a vector can be whose inner product with a query of this norm reaches the bound."""
    return F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * (bound / norm / largest)))


def _bounds(queries: DataFrame, sample: dict[int, tuple[np.ndarray, np.ndarray]], k: int) -> DataFrame:
    """queries with the score of their k-th best of the sample; null if there are fewer."""

    def task(batches):
        for batch in batches:
            ids, vectors = batch.column("query_id").to_numpy(), batch.column("vector")
            bound = []
            for own, vector in zip(ids.tolist(), vectors.to_pylist()):
                query = np.array(vector, np.float64)
                known, held = sample.get(len(query), (np.zeros(0, np.int64), np.zeros((0, len(query)))))
                scores = np.sort(_scores(held[known != own], query))[::-1]
                bound.append(float(scores[k - 1]) if len(scores) >= k else None)
            yield {name: batch.column(name) for name in ("query_id", "vector", "dim", "norm")} | {"bound": bound}

    return over_batches(queries, task, "query_id long, vector array<double>, dim int, norm double, bound double")


def search(
    table: DataFrame, queries: Column, k: int = NEAREST, vec_id: str = "vec_id", embedding: str = "embedding", agree: int = AGREE
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every row for which ``queries`` holds."""
    spark = table.sparkSession
    ship(spark)
    vectors = table.filter(_usable(F.col(embedding)) & F.col(vec_id).isNotNull())
    vectors = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("vector"), queries.alias("asks"))
    vectors = vectors.withColumn("dim", F.size("vector")).withColumn("norm", _norm(F.col("vector")))
    asked = vectors.filter("asks").select(F.col("vec_id").alias("query_id"), "vector", "dim", "norm").dropDuplicates(["query_id"])
    # of equal vectors the k + 1 smallest ids suffice: k of them are better than any other
    nth = F.dense_rank().over(Window.partitionBy("vector").orderBy("vec_id"))
    # norms about a power of two, such as 1, are in one level
    level = F.floor(F.log2("norm") + 0.5).cast("int").alias("level")
    indexed = vectors.withColumn("nth", nth).filter(F.col("nth") <= k + 1)
    indexed = store(indexed.select("vec_id", "vector", "dim", "norm", level).distinct(), "vectors")

    # a row for each length of vectors and power of two of their norms
    facts = indexed.groupBy("dim", "level").agg(F.count("*").alias("n"), F.max("norm").alias("largest")).collect()
    held = {dim: sum(r["n"] for r in facts if r["dim"] == dim) for dim in {r["dim"] for r in facts}}
    top = {dim: max(r["largest"] for r in facts if r["dim"] == dim) for dim in held}
    shares = [(dim, min(1.0, max(SAMPLE_LEAST, min(n / SAMPLE_SHARE, SAMPLE)) / n)) for dim, n in held.items()]
    shares = local_table(spark, [(dim, int(share * 2**31)) for dim, share in shares], "dim int, below long")
    picked = indexed.join(F.broadcast(shares), "dim").filter(F.pmod(F.xxhash64("vec_id"), F.lit(2**31)) < F.col("below"))
    picked = picked.select("dim", "vec_id", "vector").collect()
    sample = {}
    for dim in held:
        rows = [r for r in picked if r["dim"] == dim]
        sample[dim] = (np.array([r["vec_id"] for r in rows], np.int64), np.array([r["vector"] for r in rows], np.float64).reshape(len(rows), dim))

    levels = [(r["dim"], r["level"], r["largest"], -(-r["n"] // VECTOR_BLOCK)) for r in facts]
    dealt_to = local_table(spark, levels, "dim int, level int, scale double, dealt int")
    levels = F.broadcast(local_table(spark, levels, "dim int, level int, largest double, blocks int"))
    blocked = indexed.join(F.broadcast(dealt_to), ["dim", "level"])
    blocked = blocked.select("vec_id", "vector", "dim", "level", "scale", F.pmod(F.xxhash64("vec_id"), F.col("dealt")).cast("int").alias("block"))
    parts = ["dim", "level", "block", "query_block"]

    def meet(held: pa.Table, asked: pa.Table) -> pa.Table:
        out: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
        if len(held) and len(asked):
            own, query = held.column("vec_id").to_numpy(), _matrix(asked.column("vector"))
            block = Block(own, _matrix(held.column("vector")), held.column("scale")[0].as_py())
            unit = query / np.abs(query).max(1, keepdims=True)
            unit /= np.sqrt((unit**2).sum(1, keepdims=True))
            centres = np.column_stack((unit, np.zeros(len(unit)))) @ _directions(query.shape[1])
            begin, length = block.windows(centres, WIDTH * asked.column("radius").to_numpy() + SLACK)
            bound = asked.column("bound").to_pylist()
            for i, query_id in enumerate(asked.column("query_id").to_pylist()):
                least = -np.inf if bound[i] is None else bound[i]
                ids, scores = block.nearest(query_id, query[i], begin[i], length[i], least, agree, k)
                out["query_id"] += [query_id] * len(ids)
                out["vec_id"] += ids.tolist()
                out["score"] += scores.tolist()
        return pa.table(out, pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())]))

    def ask(asking: DataFrame, n: int) -> DataFrame:
        """The best k of what the windows hold and reaches the bound."""
        query_blocks = max(1, -(-n // QUERY_BLOCK))
        dealt = blocked.withColumn("query_block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
        asking = asking.withColumn("query_block", F.pmod(F.xxhash64("query_id"), query_blocks).cast("int")).join(levels, "dim")
        # no vector of a level that is too short reaches the bound; 1e-9 for rounding
        asking = asking.filter(F.col("bound").isNull() | (F.col("bound") / F.col("norm") / F.col("largest") <= 1 + 1e-9))
        radius = _distance(F.col("bound"), F.col("norm"), F.col("largest"))
        asking = asking.withColumn("radius", F.coalesce(F.when(radius < 2, radius), F.lit(float("inf"))))
        asking = asking.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("query_id", "vector", "bound", "radius", *parts)
        met = dealt.groupBy(parts).cogroup(asking.groupBy(parts)).applyInArrow(meet, "query_id long, vec_id long, score double")
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
        return store(met.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"), "nearest")

    tops = local_table(spark, list(top.items()), "dim int, top double")
    asking = store(_bounds(asked, sample, k), "queries")
    found = ask(asking, asking.count())
    while True:
        done = found.filter(F.col("rank") == k).select("query_id")
        # those without a bound have met all vectors
        short = asking.join(done, "query_id", "left_anti").filter(F.col("bound").isNotNull()).join(F.broadcast(tops), "dim")
        wider = F.greatest(2 * _distance(F.col("bound"), F.col("norm"), F.col("top")), F.lit(LEAST_DISTANCE))
        bound = F.when(wider < 2, F.col("norm") * F.col("top") * (1 - wider * wider / 2))
        short = store(short.select("query_id", "vector", "dim", "norm", bound.alias("bound")), "queries")
        n = short.count()
        if not n:
            return found
        found = found.join(short, "query_id", "left_anti").unionByName(ask(short, n))
        asking = short
