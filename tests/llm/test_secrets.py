import hashlib
import random
import re

from fleetwane.llm import secrets
from fleetwane.llm.queries import QUERIES

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def brute(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found)


def noisy(rng):
    parts = ["password", "Passwd", "SECRET", "token", "api_key", "apikey", "=", ": ", '"', "'", " ", "\n", "AKIA", "akia", "deadbeef", "é", "İ",
             "0123456789abcdef", "ABCDEF0123456789", "xyzw1234", "a", "=="]
    return "".join(rng.choice(parts) for _ in range(rng.randint(0, 60)))


def test_spans_equal_plain_search():
    rng = random.Random(5)
    for _ in range(3000):
        text = noisy(rng)
        assert secrets.spans_of(text)[0] == brute(text), text


def test_checksum_decides():
    body = "abcDEF0123456789abcDEF01234567"
    import zlib

    value, digits = zlib.crc32(body.encode()), ""
    while value:
        value, d = divmod(value, 62)
        digits = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"[d] + digits
    good = "ghp_" + body + digits.rjust(6, "0")
    text = f"see {good} and ghp_{body}000000"
    assert secrets.spans_of(text)[1] == [(4, 1, 4 + len(good))]


def test_query_equals_plain_search(spark, tables):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{tables}/documents.parquet").collect()}
    rows = QUERIES["op4_secret_scans"](spark, tables).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = brute(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(secrets.written(want).encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple([k for _, k, _ in want].count(i) for i in range(3))


def test_odd_rows(odd_docs, no_docs):
    rows = secrets.scan(odd_docs).collect()
    assert len(rows) == odd_docs.count() and all(r.spans == "" for r in rows)
    assert secrets.scan(no_docs).count() == 0
    kept = secrets.redact(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(map(str, kept.collect())) == sorted(map(str, odd_docs.collect()))


def test_redacted(spark):
    docs = spark.createDataFrame([(1, 'x token = "abcdefgh12" y')], "doc_id long, text string")
    assert secrets.redact(docs).first().text == 'x [SECRET]" y'
