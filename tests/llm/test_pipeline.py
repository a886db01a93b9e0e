import hashlib
import re
import struct

import pytest

import corpus_pipeline
from fleetwane.llm import secrets
from fleetwane.llm.queries import tokenizer_path
from llm.test_jaccard import brute as similar
from llm.test_mixing import brute as mixed
from llm.test_secrets import brute as found

tokenizers = pytest.importorskip("tokenizers")


def plain(docs):
    """The stages in plain Python over [(doc_id, text, lang, source)]: rows (doc_id, digest of ids)."""
    docs = [d for d in docs if any(c.isalpha() for c in d[1] or "")]
    stays = similar({i: t for i, t, _, _ in docs})
    docs = [d for d in docs if stays[d[0]][1] == d[0]]
    clean = []
    for i, text, lang, source in docs:
        at, pieces = 0, []
        for start, _, end in found(text):
            if start >= at:
                pieces += [text[at:start], secrets.REDACTED]
            at = max(at, end)
        clean.append((i, "".join([*pieces, text[at:]]), lang, source))
    _, _, copies = mixed([(i, s, len(re.findall(r"[^ \t-\r]+", t))) for i, t, _, s in clean])
    encode = tokenizers.Tokenizer.from_file(tokenizer_path()).encode
    rows = []
    for (i, text, lang, source), n in zip(clean, copies):
        ids = encode(text, add_special_tokens=False).ids
        rows += [(i, lang, source, hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest())] * n
    return sorted(rows)


def test_run_equals_plain_python(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet").collect()
    rows = corpus_pipeline.run(spark, tables).collect()
    assert sorted((r.doc_id, r.lang, r.source, r.ids_sha256) for r in rows) == plain([(d.doc_id, d.text, d.lang, d.source) for d in docs])
    assert all(len(r.ids) == r.n_tokens for r in rows)


def test_stages_take_odd_and_empty_tables(spark, odd_docs, no_docs):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    for docs, some in ((odd_docs.select(columns), True), (no_docs.select(columns), False)):
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, "")
            if name != corpus_pipeline.STAGES[-1][0]:
                assert docs.columns == columns
            assert (docs.count() > 0) == some, name


def test_extra_columns_and_odd_ids_survive(spark):
    text = "the quick brown fox jumps over the lazy dog again and again until night falls"
    rows = [
        (1, text, "en", "a", "x1"),
        (None, text, "en", "a", "x2"),
        (None, text, "en", "b", "x3"),
        (2, text + " at last", "en", "a", "x4"),
        (3, "something else entirely is written in this short text here", None, "b", "x5"),
        (3, "and the same number has another text which is not alike at all", "en", None, "x6"),
        (3, "and the same number has another text which is not alike at all", "en", None, "x6"),
        (None, "a text without any number that nothing else comes near to", "en", "a", "x7"),
    ]
    clashing = ["language", "encoded", "_source", "mix_source", "mix_copies", "cls", "uid", "text_", "row_key", "stays", "row"]
    docs = spark.createDataFrame(
        [(*r[:4], *[r[4]] * len(clashing)) for r in rows],
        "doc_id long, text string, lang string, source string, " + ", ".join(f"{c} string" for c in clashing),
    )
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, "").collect(), docs.schema)
        assert docs.columns[4:] == clashing
        if name == "jaccard join":  # one of the four like 1; both texts of 3; the one without an id
            assert sorted(r.language for r in docs.collect()) == ["x1", "x5", "x6", "x7"]
        assert all(len({r[c] for c in clashing}) == 1 for r in docs.collect())
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").columns[:3] == ["doc_id", "lang", "source"]
