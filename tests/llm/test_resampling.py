import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from fleetwane.llm import resampling
from fleetwane.llm.queries import QUERIES

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text, most=1):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(UPPER))
    return [" ".join(words[i : i + n]) for n in range(1, most + 1) for i in range(len(words) - n + 1)], len(words)


def expected(docs, target, most=1, percent=10, least=20):
    s, t = Counter(), Counter()
    own = [[zlib.crc32(f.encode()) % 10_000 for f in features(text, most)[0]] for _, text in docs]
    for buckets in own:
        s.update(buckets)
    for text in target:
        t.update(zlib.crc32(f.encode()) % 10_000 for f in features(text, most)[0])
    big_s, big_t = sum(s.values()), sum(t.values())
    rows = []
    for (doc_id, text), buckets in zip(docs, own):
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (big_s + 10_000) / ((s[b] + 1) * (big_t + 10_000)))) for b in buckets)
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(buckets), weight, score, features(text)[1] >= least])
    ready = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[2], r[1]))
    out = [(*r[:4], i + 1 if i < percent * len(ready) // 100 else None) for i, r in enumerate(ready)]
    return sorted(out + [(*r[:4], None) for r in rows if not r[4]], key=repr)


def test_crc32_equals_zlib():
    rng = random.Random(2)
    for _ in range(50):
        raw = bytes(rng.randrange(256) for _ in range(700))
        cut = sorted((rng.randrange(700), rng.randrange(700)) for _ in range(40))
        starts, ends = np.array([min(c) for c in cut]), np.array([max(c) for c in cut])
        got = resampling.crc32_of(np.frombuffer(raw, np.uint8), starts, ends)
        assert got.tolist() == [zlib.crc32(raw[a:b]) for a, b in zip(starts, ends)]
        again = resampling.crc32_of(np.frombuffer(raw, np.uint8), starts, ends, got)
        assert again.tolist() == [zlib.crc32(raw[a:b] * 2) for a, b in zip(starts, ends)]


def test_no_feature_crosses_a_text():
    texts = ["one Two three", "", "four", "ÄÖ five\x00six", "x" * 300 + " y"]
    for most in (1, 2, 3):
        found = resampling.Features(texts, most)
        for i, text in enumerate(texts):
            want = Counter(zlib.crc32(f.encode()) % 10_000 for f in features(text, most)[0])
            assert Counter(found.bucket[found.owner == i].tolist()) == want
        assert found.n_words.tolist() == [features(t)[1] for t in texts]
        assert found.n_features.tolist() == [len(features(t, most)[0]) for t in texts]


def test_query_equals_brute_force(spark, tables):
    docs = [tuple(r) for r in spark.read.parquet(f"{tables}/documents.parquet").select("doc_id", "text").collect()]
    target = [r.text for r in spark.read.parquet(f"{tables}/benchmark.parquet").collect()]
    rows = sorted((tuple(r) for r in QUERIES["op12_importance_resampling"](spark, tables).collect()), key=repr)
    assert rows == expected(docs, target)
    assert sum(r[4] is not None for r in rows) > 10


@pytest.mark.parametrize("most", [1, 3])
def test_odd_rows(spark, odd_docs, no_docs, most):
    docs = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    target = spark.createDataFrame([("same text here",), (None,), ("",)], "text string")
    clashing = odd_docs.withColumnsRenamed({"n_chars": "rank", "lang": "weight"})
    columns = ["doc_id", "n_features", "weight", "score", "rank"]
    got = resampling.draw(resampling.weights(clashing, target, most), percent=60, least_words=2).select(columns).collect()
    assert sorted(map(tuple, got), key=repr) == expected(docs, ["same text here", None, ""], most, 60, 2)
    assert resampling.draw(resampling.weights(no_docs, target)).count() == 0
    assert resampling.draw(resampling.weights(odd_docs, target.limit(0))).count() == len(docs)


def test_resample_keeps_columns(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    target = spark.read.parquet(f"{tables}/benchmark.parquet")
    drawn = resampling.resample(docs.withColumnRenamed("lang", "score"), target)
    ranks = QUERIES["op12_importance_resampling"](spark, tables).filter("rank is not null")
    assert "score" in drawn.columns
    assert {r.doc_id for r in drawn.collect()} == {r.doc_id for r in ranks.collect()}


def test_ranks_over_many_parts(spark):
    rows = [(i, 30, 30, i % 3) for i in range(5_000)]
    weighed = spark.createDataFrame(rows, "doc_id long, n_words long, n_features long, weight long").repartition(16)
    drawn = resampling.draw(weighed, percent=50).filter("rank is not null").orderBy("rank").collect()
    assert [r["rank"] for r in drawn] == list(range(1, 2_501))
    assert [(-r.score, r.doc_id) for r in drawn] == sorted((-r.score, r.doc_id) for r in drawn)
