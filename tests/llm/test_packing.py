import os
import struct
import zlib
from collections import defaultdict

import numpy as np
import pytest

from fleetwane.llm import packing
from fleetwane.llm.queries import QUERIES, tokenizer_path

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def truth():
    library = tokenizers.Tokenizer.from_file(tokenizer_path())
    return lambda text: [*library.encode(text or "", add_special_tokens=False).ids, 1]


def padding(rows, capacity=2048):
    """Tokens of padding; checks that the pieces of each sequence lie one after another."""
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    lost = 0
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
        lost += 0 if at & (at - 1) == 0 else capacity - at
    return lost


def test_pieces_cover_every_length():
    for n in [*range(1, 2100), 4095, 4096, 4097, 70_001]:
        at = 0
        for start, length in packing.pieces(n):
            assert start == at and 0 < length <= 2048
            at += length
        assert at == n


def test_bins_hold_a_fixed_count():
    bins, rng, closed, put = packing.Bins(0), np.random.default_rng(1), [], 0
    for doc in range(20_000):
        for start, size in packing.pieces(int(rng.integers(1, 3000))):
            put += size
            done = bins.put((doc, start, np.zeros(size, "<u4"), 0))
            if done:
                assert len({2048 // len(p[2]) for p in done}) == 1 and len(done) == 2048 // len(done[0][2])
            closed += done
    held = sum(len(p[2]) for b in bins.open.values() for p in b)
    assert held <= 2048 * 2 * packing.LEAST
    rest = list(bins.rest())
    assert sum(len(p[2]) for p in closed + rest) == put and not bins.open
    sizes = defaultdict(int)
    for p in rest:
        sizes[p[4]] += len(p[2])
    assert all(n & (n - 1) == 0 for n in sizes.values())


def test_new_words_equal_the_library(truth):
    own = packing.Ids(tokenizer_path())
    texts = ["It's a dog's 's 'll", "ñandú 漢字 😀 İ ΑΣ ́x e\u0301", "<|endoftext|> a<|startoftext|>b", "", "12 3.4.5 ... -- \x00 \u00a0x", "x" * 3000]
    for _ in range(2):
        assert [x.tolist() for x in own(texts)] == [truth(t) for t in texts]
    assert own(["a b"])[0].tolist() == truth("a b")


def test_query_packs_every_id_once(spark, tables, truth):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{tables}/documents.parquet").collect()}
    rows = QUERIES["op13_packing"](spark, tables).collect()
    pieces = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
    assert set(pieces) == set(texts)
    total = 0
    for doc_id, text in texts.items():
        ids, at = truth(text), 0
        total += len(ids)
        for r in sorted(pieces[doc_id], key=lambda r: r.start):
            own = ids[at : at + r.length]
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(own)}I", *own))
            at += r.length
        assert at == len(ids)
    assert padding(rows) <= 0.005 * total


def test_workers_pack_independently(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet").repartition(5)
    rows = packing.pack(docs, tokenizer_path(), with_ids=False).collect()
    assert len({r.sequence_id >> 33 for r in rows}) == 5
    assert padding(rows) <= 0.005 * sum(r.length for r in rows)


def test_odd_rows(odd_docs, no_docs, truth):
    clashing = odd_docs.withColumnsRenamed({"n_chars": "start", "lang": "ids"})
    rows = packing.pack(clashing, tokenizer_path()).collect()
    got = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.doc_id is None, r.doc_id or 0, r.start)):
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and r.length == len(r.ids)
        got[r.doc_id].append(r.ids)
    want = [(r.doc_id, truth(r.text)) for r in odd_docs.collect()]
    for doc_id, ids in want:
        times = sum(d == doc_id for d, _ in want)
        assert sorted(i for piece in got[doc_id] for i in piece) == sorted(ids * times)
        if times == 1:
            assert [i for piece in got[doc_id] for i in piece] == ids
    assert packing.pack(no_docs, tokenizer_path()).count() == 0
    padding(rows)


def test_other_capacities(odd_docs):
    rows = packing.pack(odd_docs, tokenizer_path(), capacity=64, least=8, with_ids=False).collect()
    assert padding(rows, 64) <= 0.01 * sum(r.length for r in rows) + 64
    with pytest.raises(ValueError):
        packing.pack(odd_docs, tokenizer_path(), capacity=100)
    assert os.path.exists(tokenizer_path())
