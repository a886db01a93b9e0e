import hashlib
import random
import zlib

import numpy as np
import pytest

from fleetwane.llm import periodic
from fleetwane.llm.queries import QUERIES


def brute_runs(s, least):
    """Every period, every maximal stretch; of equal stretches the smallest period."""
    out = {}
    for q in range(1, len(s) // 2 + 1):
        i = 0
        while i + q < len(s):
            j = i
            while j + q < len(s) and s[j] == s[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, 2 * q):
                out.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted(((a, n, q) for (a, n), q in out.items()), key=lambda r: (r[0], r[2]))


def test_runs_equal_brute_force():
    rng = random.Random(5)
    for _ in range(1500):
        n, letters, least = rng.randrange(0, 80), rng.choice([1, 2, 2, 3, 5]), rng.choice([2, 4, 12])
        s = [rng.randrange(letters) for _ in range(n)]
        if n and rng.random() < 0.5:
            a = rng.randrange(n)
            p = 1 + (n - a) // rng.randrange(3, 11)
            s = [s[i] if i < a else s[a + (i - a) % p] for i in range(n)]
        got = [tuple(r) for r in periodic.periodic_runs(np.array(s, np.int64), least).tolist()]
        assert got == brute_runs(s, least), s


def test_lcp_and_suffixes_equal_brute_force():
    rng = random.Random(6)
    for _ in range(200):
        s = [rng.randrange(3) for _ in range(rng.randrange(1, 60))]
        order, inverse, lcp = periodic.suffix_array(np.array(s))
        assert order.tolist() == sorted(range(len(s)), key=lambda i: s[i:])
        assert [order[k] for k in inverse] == list(range(len(s)))
        for k in range(1, len(s)):
            a, b = s[order[k - 1] :], s[order[k] :]
            assert lcp[k] == next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


@pytest.mark.parametrize("n,p", [(200_000, 1), (120_000, 7), (60_000, 20_000)])
def test_long_runs(n, p):
    assert periodic.periodic_runs(np.arange(n) % p).tolist() == [[0, n, p]]


def test_small_slices_and_blocks(monkeypatch):
    monkeypatch.setattr(periodic, "AT_ONCE", 7)
    monkeypatch.setattr(periodic, "STEPS", 2)
    test_runs_equal_brute_force()


def expected(doc_id, text):
    """The query's row by plain Python."""
    w = (text or "").encode().split()
    n = len(w)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w, 12)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    return (
        doc_id,
        len(runs),
        *(best or (None, None, None)),
        1000 * best[1] // best[2] if best else None,
        hashlib.sha256(lines.encode()).hexdigest(),
        hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in gone)).hexdigest(),
    )


def test_query_equals_brute_force(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r) for r in QUERIES["op11_periodic_runs"](spark, tables).collect()}
    assert len(got) == len(docs)
    short = [d for d in docs if len(d.text or "") < 12_000]
    assert len(short) > 150 and any(got[d.doc_id][1] for d in short)
    for d in short:
        assert got[d.doc_id] == expected(d.doc_id, d.text)


def test_odd_rows(odd_docs, no_docs):
    changed = odd_docs.select("doc_id", periodic.with_periods("text", "doc_id").alias("text"))
    from pyspark.sql import functions as F

    rows = periodic.find(changed).select("doc_id", *periodic.digests(F.col("periodic"))).collect()
    texts = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    assert len(rows) == len(texts)
    small = [t for t in texts if len(t[1] or "") < 100_000]
    got = {repr(tuple(r)) for r in rows}
    assert all(repr(expected(*t)) in got for t in small)
    (long,) = periodic.find(odd_docs.filter("doc_id = 5")).select("periodic.*").collect()
    assert [tuple(r) for r in long.runs] == [(0, 30_000, 10)]
    assert long.collapsed == "one two three four five six seven eight nine ten"
    assert periodic.find(no_docs).count() == 0
    assert periodic.find(odd_docs).columns == [*odd_docs.columns, "periodic"]
    with pytest.raises(ValueError):
        periodic.find(odd_docs.withColumnRenamed("lang", "periodic"))
