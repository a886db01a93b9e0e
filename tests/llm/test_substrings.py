import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from fleetwane.llm import fmindex, substrings
from fleetwane.llm.queries import QUERIES


def split(text):
    return [w for w in re.split(r"[ \t-\r]+", text or "") if w]


def brute(texts, size=35):
    words = [split(t) for t in texts]
    seen = Counter(tuple(w[i : i + size]) for w in words for i in range(len(w) - size + 1))
    out = []
    for w in words:
        gone = {i + d for i in range(len(w) - size + 1) if seen[tuple(w[i : i + size])] > 1 for d in range(size)}
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def corpus(rng, n):
    passages = [[f"p{k}_{i}" for i in range(rng.randint(30, 90))] for k in range(6)]
    texts = []
    for i in range(n):
        w = []
        for _ in range(rng.randint(0, 4)):
            kind = rng.random()
            if kind < 0.4:
                p = rng.choice(passages)
                a = rng.randint(0, len(p) // 2)
                w += p[a : a + rng.randint(20, 90)]
            elif kind < 0.5:
                w += ["and"] * rng.randint(1, 90)
            elif kind < 0.6 and texts:
                w += split(rng.choice(texts))
            else:
                w += [f"w{rng.randrange(8)}" if rng.random() < 0.5 else f"u{rng.randrange(10_000)}" for _ in range(rng.randint(1, 60))]
        texts.append(" ".join(w) if rng.random() < 0.9 else "\n".join(w))
    return texts


@pytest.mark.parametrize(("hot", "shard"), [(4096, 400_000), (3, 50)])
def test_removed_words_equal_brute_force(spark, hot, shard, monkeypatch):
    monkeypatch.setattr(substrings, "HOT_RUNS", hot)
    monkeypatch.setattr(substrings, "SHARD_WORDS", shard)
    texts = corpus(random.Random(hot), 250)
    rows = substrings.remove_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert [(r.n_words, r.n_removed, r.kept_sha256) for r in sorted(rows, key=lambda r: r.doc_id)] == brute(texts)


def test_query_equals_brute_force(spark, tables):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{tables}/documents.parquet").collect())
    rows = sorted(QUERIES["op8_substring_dedup"](spark, tables).collect(), key=lambda r: r.doc_id)
    assert [(r.n_words, r.n_removed, r.kept_sha256) for r in rows] == brute([t for _, t in docs])


def test_index_counts_patterns():
    rng = np.random.default_rng(2)
    text = np.concatenate((rng.integers(1, 5, 400), [0], rng.integers(1, 5, 300), [0]))
    index = fmindex.Index(text)
    for _ in range(200):
        size, at = rng.integers(1, 7), rng.integers(0, 390)
        pattern = text[at : at + size]
        low, high = np.zeros(1, np.int64), np.full(1, len(text))
        for symbol in pattern[::-1]:
            low, high = index.extend(np.array([symbol]), low, high)
        found = sum(np.array_equal(text[i : i + size], pattern) for i in range(len(text) - size + 1))
        assert int(high[0] - low[0]) == found


def test_odd_rows(odd_docs, no_docs):
    docs = odd_docs.collect()
    got = sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in substrings.remove_repeats(odd_docs).collect())
    assert got == sorted((str(d.doc_id), *x) for d, x in zip(docs, brute([d.text for d in docs])))
    assert substrings.remove_repeats(no_docs).count() == 0
