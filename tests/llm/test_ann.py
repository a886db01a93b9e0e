import math

import numpy as np
from pyspark.sql import functions as F

from fleetwane.llm import ann
from fleetwane.llm.queries import QUERIES


def brute(rows, asks, k=20):
    ids = np.array([i for i, _ in rows])
    vectors = np.array([v for _, v in rows], np.float64)
    out = {}
    for i, v in rows:
        if asks(i):
            scores = (vectors * np.array(v, np.float64)).sum(1)
            order = [j for j in np.lexsort((ids, -scores)) if ids[j] != i][:k]
            out[i] = [(int(ids[j]), float(scores[j])) for j in order]
    return out


def test_recall_against_brute_force(spark, tables):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{tables}/embeddings.parquet").collect()]
    want = brute(rows, lambda i: i % 20 == 0)
    got = {}
    for r in sorted(QUERIES["op5_nearest_neighbours"](spark, tables).collect(), key=lambda r: r["rank"]):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    for q, found in got.items():
        assert found == sorted(found, key=lambda x: (-x[1], x[0]))


def test_ties_copies_and_lengths(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [1.0, 0.0, 0.0]) for i in range(60)] + [(100 + i, (rng.normal(size=3) * 0.3).tolist()) for i in range(40)]
    odd = [(200, None), (201, []), (202, [0.0, 0.0, 0.0]), (203, [None, 1.0, 1.0]), (204, [math.nan, 1.0, 0.0]), (205, [math.inf, 0.0, 0.0]), (206, [1.0, 2.0]), (None, [1.0, 1.0, 1.0]), (0, [1.0, 0.0, 0.0])]
    table = spark.createDataFrame([(i, v, 1, "x") for i, v in rows + odd], "vec_id long, embedding array<float>, label int, score string")
    found = {}
    for r in sorted(ann.search(table, F.col("vec_id") % 20 == 0).collect(), key=lambda r: r["rank"]):
        found.setdefault(r.query_id, []).append(r.vec_id)
    assert found[0] == list(range(1, 21)) and found[40] == list(range(20))
    assert set(found) == {0, 20, 40, 100, 120}
    assert ann.search(table.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_few_candidates(spark):
    table = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [-1.0, 0.0])], "vec_id long, embedding array<float>")
    rows = ann.search(table, F.col("vec_id") == 0).collect()
    assert [(r["rank"], r.vec_id, r.score) for r in sorted(rows, key=lambda r: r["rank"])] == [(1, 1, 0.5), (2, 2, -1.0)]


def test_agreement_guarantees_recall():
    inside = math.erf(ann.WIDTH / math.sqrt(2))
    passes = sum(math.comb(ann.DIRECTIONS, i) * inside**i * (1 - inside) ** (ann.DIRECTIONS - i) for i in range(ann.AGREE, ann.DIRECTIONS + 1))
    assert passes >= 0.95


def test_recall_with_uneven_norms(spark):
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(3000, 32))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    vectors[:500] *= 0.01
    vectors[7] *= 10_000
    rows = list(enumerate(vectors.tolist()))
    want = brute(rows, lambda i: i % 20 == 0)
    found = {}
    for r in ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    assert all(len(found[q]) == 20 for q in want)
    hits = sum(len(found[q] & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.95 * 20 * len(want)


def test_all_candidates_if_fewer(spark):
    rng = np.random.default_rng(8)
    rows = [(100 + i, rng.normal(size=2).tolist()) for i in range(2000)]
    for size in range(3, 40):  # a few vectors of each length, one opposite to the others
        query = rng.normal(size=size)
        rows += [(3_000 + 3 * size + i, (query * x).tolist()) for i, x in enumerate((1.0, 0.999, -1.0))]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = {}
    for r in ann.search(table, (F.col("vec_id") >= 3_000) & (F.col("vec_id") % 3 == 0)).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    assert found == {3_000 + 3 * size: {3_001 + 3 * size, 3_002 + 3 * size} for size in range(3, 40)}


def test_windows_widen_until_enough_are_found(spark):
    rng = np.random.default_rng(9)
    rows = list(enumerate(rng.normal(size=(400, 16)).tolist()))
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    # more directions must agree than there are: only windows that hold all vectors give candidates
    found = {}
    for r in sorted(ann.search(table, F.col("vec_id") < 30, agree=ann.DIRECTIONS + 1).collect(), key=lambda r: r["rank"]):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert found == brute(rows, lambda i: i < 30)
