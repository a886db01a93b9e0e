import hashlib
import random
import re
from fractions import Fraction

import pytest

import corpus_pipeline
from fleetwane.llm import mixing


def size(text):
    return len(re.findall(r"[^ \t-\r]+", text or ""))


def brute(docs, weights=(5, 2, 1), cap=3):
    """[(doc_id, source, size)] -> {source: target} and the copies of each row."""
    total = {}
    for _, s, n in docs:
        total[s] = total.get(s, 0) + n
    order = sorted(total, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    capped = set()
    while True:
        free = sum(total.values()) - cap * sum(total[s] for s in capped)
        others = sum(weight[s] for s in order if s not in capped)
        new = {s for s in order if s not in capped and Fraction(weight[s] * free, others) > cap * total[s]}
        if not new:
            break
        capped |= new
    target = {s: float(cap * total[s]) if s in capped else weight[s] * free / others for s in order}
    copies = []
    for i, s, _ in docs:
        times = int(target[s] // total[s]) if total[s] else 0
        rest = target[s] - times * total[s]
        key = key_of(i)
        before = sum(n for j, t, n in docs if t == s and key_of(j) < key)
        held = sum(n for j, t, n in docs if t == s and key_of(j) == key)
        copies.append(times + (rest > 0 and 2 * (before + held) - held <= 2 * rest))
    return total, target, copies


def key_of(i):
    return hashlib.md5(f"0:{'' if i is None else i}".encode()).hexdigest()


def test_mix_equals_brute_force(spark):
    rng = random.Random(8)
    docs = [(i, rng.choice(["a", "b", "c", "ß", None, "tiny"]) if i % 9 else "tiny2", " ".join("x" * rng.randint(0, 30))) for i in range(300)]
    docs = [(i, s, t if s != "tiny" else t[:3]) for i, s, t in docs] + [(5, "a", "one two"), (5, "a", "one two"), (None, None, None), (999, "empty", "")]
    sized = [(i, s, size(t)) for i, s, t in docs]
    total, target, copies = brute(sized)
    rows = mixing.mix(spark.createDataFrame(docs, "doc_id long, source string, text string")).collect()
    key = lambda r: tuple((x is not None, x) for x in r)
    got = sorted(((r.doc_id, r["size"], r.source_size, r.target, r.taken) for r in rows), key=key)
    assert got == sorted(((i, n, total[s], target[s], n * c) for (i, s, n), c in zip(sized, copies)), key=key)
    assert all(r.taken <= 3 * r["size"] for r in rows)


def test_repeated_rows_are_the_mix(spark, odd_docs, no_docs):
    taken = {(r.doc_id, r["size"]): r.taken for r in mixing.mix(odd_docs).collect()}
    out = mixing.repeated(odd_docs)
    assert out.columns == odd_docs.columns
    words = {}
    for r in out.collect():
        words[r.doc_id, size(r.text)] = words.get((r.doc_id, size(r.text)), 0) + size(r.text)
    doubled = {(8, size("same text here, same text here"))}  # a repeated row
    assert {k: v for k, v in words.items() if v} == {k: v * (2 if k in doubled else 1) for k, v in taken.items() if v}
    assert mixing.mix(no_docs).count() == 0 and mixing.repeated(no_docs).count() == 0


@pytest.fixture()
def long_texts(monkeypatch):
    """Texts count ten million times their words, so that few rows have the words of many gigabytes."""
    monkeypatch.setattr(mixing, "n_words", lambda text, count=mixing.n_words: count(text) * 10_000_000)


def many_words(total):
    """Documents of five sources, one null and one capped, that have ``total`` words."""
    rng = random.Random(total)
    docs = [(i, ["a", "b", "c", None][i % 4] if i else "tiny", rng.randint(1, 3) if i else 1) for i in range(total // 4)]
    docs.append((len(docs), "a", total - sum(n for *_, n in docs)))
    return [(i, s, " ".join("x" * n)) for i, s, n in docs]


@pytest.mark.parametrize("total", [100, 700])  # the words fit an int, then only a long
def test_stage_repeats_by_more_words_than_an_int(spark, long_texts, total):
    docs = many_words(total)
    _, _, copies = brute([(i, s, 10_000_000 * size(t)) for i, s, t in docs])
    out = corpus_pipeline.mix_sources(spark, spark.createDataFrame(docs, "doc_id long, source string, text string"), "")
    assert sorted(r.doc_id for r in out.collect()) == sorted(i for (i, *_), n in zip(docs, copies) for _ in range(n))


@pytest.mark.parametrize("total", [100, 700])
def test_mix_of_more_words_than_an_int_equals_brute_force(spark, long_texts, total):
    docs = many_words(total)
    sized = [(i, s, 10_000_000 * size(t)) for i, s, t in docs]
    words, target, copies = brute(sized)
    rows = mixing.mix(spark.createDataFrame(docs, "doc_id long, source string, text string")).collect()
    got = sorted((r.doc_id, r["size"], r.source_size, r.target, r.taken) for r in rows)
    assert got == [(i, n, words[s], target[s], n * c) for (i, s, n), c in zip(sized, copies)]
