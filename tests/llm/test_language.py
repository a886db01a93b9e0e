import random
import zlib

import numpy as np
import pytest

from fleetwane.llm import language
from fleetwane.llm.queries import QUERIES


def test_held_out_accuracy(spark, tables):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{tables}/documents.parquet").collect()}
    rows = QUERIES["op9_language_id"](spark, tables).collect()
    assert len(rows) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in held) >= 0.95 * len(held)


def test_odd_rows(odd_docs, no_docs):
    learned = language.learn(odd_docs)
    assert set(learned) == {"en"}
    rows = language.predict(odd_docs, learned).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        letters = any(c.isalpha() for c in r.text or "")
        assert r.language.lang_pred == ("en" if letters else "und")
        assert 0 <= r.language.score <= 1
    assert language.predict(no_docs, learned).count() == 0
    assert language.learn(no_docs) == {}
    assert {r.language.lang_pred for r in language.predict(odd_docs, {}).collect()} == {"und"}


def test_profile_counts_trigrams():
    (_, _, counts, keys), = language.profiles(["abab ab!", "Q"])
    named = {tuple(chr(k >> s & 0x1FFFFF) for s in (42, 21, 0)): int(n) for k, n in zip(keys.tolist(), counts[0])}
    assert named == {("a", "b", "a"): 1, ("b", "a", "b"): 1, ("a", "b", " "): 2, ("b", " ", "a"): 1, (" ", "a", "b"): 1}
    assert counts[1].sum() == 0


def plain_bundle(text):
    """The mean trigram vector by plain loops."""
    symbols = []
    for ch in text.lower():
        if ch.isalpha():
            symbols.append(ord(ch))
        elif not symbols or symbols[-1] != language.BLANK:
            symbols.append(language.BLANK)
    if not symbols or symbols[-1] != language.BLANK:
        symbols.append(language.BLANK)
    total, n = [0] * language.SIZE, 0
    for a, b, c in zip(symbols, symbols[1:], symbols[2:]):
        x, y, z = (language._letter(s).tolist() for s in (a, b, c))
        total = [t + x[i - 2] * y[i - 1] * z[i] for i, t in enumerate(total)]
        n += 1
    return [t / max(n, 1) for t in total]


def test_equals_plain_loops(spark, tables):
    rows = spark.read.parquet(f"{tables}/documents.parquet").filter("lang is not null").orderBy("doc_id").limit(50).collect()
    texts = [(r.text or "")[:400] for r in rows]
    vectors = [plain_bundle(t) for t in texts]
    own = np.concatenate([v for _, _, v in language.bundles(texts)])
    assert np.allclose(own, vectors, atol=1e-5)
    names = sorted({r.lang for r in rows})
    docs = spark.createDataFrame([(r.doc_id, t, r.lang) for r, t in zip(rows, texts)], "doc_id long, text string, lang string")
    learned = language.learn(docs)
    means = {k: [sum(c) / len(c) for c in zip(*(v for v, r in zip(vectors, rows) if r.lang == k))] for k in names}
    assert sorted(learned) == names and all(np.allclose(learned[k], means[k], atol=1e-5) for k in names)
    middle = [sum(c) / len(names) for c in zip(*means.values())]
    got = {r.doc_id: r.language for r in language.predict(docs, learned).collect()}
    for r, v in zip(rows, vectors):
        x = np.array(v) - middle
        cosines = {k: float(x @ (np.array(means[k]) - middle) / np.linalg.norm(x) / np.linalg.norm(np.array(means[k]) - middle)) for k in names}
        best = max(names, key=lambda k: cosines[k])
        assert got[r.doc_id].lang_pred == best
        assert got[r.doc_id].score == pytest.approx(min(max(cosines[best], 0), 1), abs=1e-4)


def test_many_letters_are_counted_in_small_tables(monkeypatch):
    rng = random.Random(1)
    texts = ["".join(chr(rng.randrange(0x4E00, 0x9FFF)) for _ in range(200)) for _ in range(60)]
    whole = np.concatenate([v for _, _, v in language.bundles(texts)])
    monkeypatch.setattr(language, "MOST_CELLS", 5_000)
    tables = list(language.profiles(texts))
    assert all(c.size <= 5_000 or e - s == 1 for s, e, c, _ in tables)
    assert [s for s, *_ in tables] == [0, *[e for _, e, *_ in tables][:-1]] and tables[-1][1] == 60
    assert np.allclose(np.concatenate([v for _, _, v in language.bundles(texts)]), whole, atol=1e-6)
