import hashlib
import random
import struct

import pytest

from fleetwane.llm import bpe
from fleetwane.llm.queries import QUERIES, tokenizer_path

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def truth():
    return tokenizers.Tokenizer.from_file(tokenizer_path())


@pytest.fixture(scope="module")
def own():
    return bpe.Tokenizer(tokenizer_path())


def merged(own, text):
    return [i for w in own.words(text) for i in own.merge(w)]


def test_merges_equal_library(truth, own):
    rng = random.Random(3)
    letters = "abcdefghij ABZ'sttredm  \n.,!?12ñéüßÇΣσς漢字İ😀́  _-|<>"
    for size in (5, 30, 300):
        for _ in range(400):
            text = "".join(rng.choice(letters) for _ in range(size))
            assert merged(own, text) == truth.encode(text, add_special_tokens=False).ids, repr(text)
    for text in ("x" * 5000, "abcdefgh" * 2000, "a<|endoftext|>b <|startoftext|>", "<|endoftext|>", "it's we'll I'd 's 'x ''s"):
        assert merged(own, text) == truth.encode(text, add_special_tokens=False).ids


def test_both_patterns_split_alike():
    for code in range(256):
        text = f"a{chr(code)}{chr(code)}b'{chr(code)}ll 's".lower()
        if bpe._is_latin(text):
            assert bpe.LATIN.findall(text) == bpe.PATTERN.findall(text), code


def test_lexicon_is_exact_and_minimal(own, tmp_path):
    words = ["tap", "taps", "top", "tops", "stop", "stops", "é", "éa"]
    arrays = bpe.compile_lexicon({w: own.merge(w) for w in words})
    bpe.write_lexicon(arrays, tmp_path / "x.bin")
    lexicon = bpe.Lexicon(str(tmp_path / "x.bin"))
    asked = [*words, "ta", "tapss", "", "zzz", "ê"]
    found = lexicon.find(asked).tolist()
    order = sorted(words, key=lambda w: w.encode())
    assert found == [order.index(w) if w in words else -1 for w in asked]
    for w, k in zip(words, found):
        assert lexicon.ids[lexicon.offset[k] : lexicon.offset[k + 1]].tolist() == own.merge(w)
    # minimal: no two states have the same right language
    final, edges = arrays["final"], {}
    for key, target in zip(arrays["key"].tolist(), arrays["target"].tolist()):
        edges.setdefault(key >> 8, []).append((key & 255, target))
    states = [(int(f), tuple(edges.get(i, ()))) for i, f in enumerate(final)]
    assert len(set(states)) == len(states)
    assert bpe.compile_lexicon({})["key"].size == 0


def test_query_equals_library(spark, tables, truth):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{tables}/documents.parquet").collect()}
    rows = QUERIES["op7_bpe"](spark, tables).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = truth.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(truth.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_odd_rows(odd_docs, no_docs, truth):
    rows = bpe.encode(odd_docs, tokenizer_path(), most=20).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        want = truth.encode(r.text or "", add_special_tokens=False).ids
        assert list(r.encoded.ids) == want
        assert bpe.decode(want, tokenizer_path()) == truth.decode(want, skip_special_tokens=False)
    assert bpe.encode(no_docs, tokenizer_path()).count() == 0
