import random

import numpy as np
import pytest

from fleetwane.llm import jaccard
from fleetwane.llm.graph import components


def shingles(text):
    w = "".join(c.lower() if c.isascii() else c for c in text or "").split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(docs):
    sets = {i: shingles(t) for i, t in docs.items()}
    least = {i: i for i in docs}
    ids = list(docs)
    changed = True
    linked = [(a, b) for n, a in enumerate(ids) for b in ids[n + 1 :] if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in linked:
            m = min(least[a], least[b])
            changed |= (least[a], least[b]) != (m, m)
            least[a] = least[b] = m
    return {i: (len(sets[i]), least[i]) for i in docs}


def corpus(rng, n):
    docs = {}
    for i in range(n):
        if docs and rng.random() < 0.6:
            w = docs[rng.choice(list(docs))].split(" ")
            for _ in range(rng.choice([0, 1, 1, 2, 5])):
                if w:
                    w[rng.randrange(len(w))] = rng.choice(["new", "The", "x"])
        else:
            w = [f"w{rng.randrange(40)}" for _ in range(rng.choice([0, 1, 3, 5, 20, 60, 120]))]
        docs[i] = " ".join(w)
    return docs


@pytest.mark.parametrize("block", [256, 4])
def test_components_equal_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", block)  # small blocks: large families meet in the second round
    monkeypatch.setattr(jaccard, "PIVOTS", 2)
    docs = corpus(random.Random(block), 220)
    rows = jaccard.near_duplicates(spark.createDataFrame(list(docs.items()), "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute(docs)


def test_trie_finds_all_similar_sets():
    rng = np.random.default_rng(4)
    base = [np.unique(rng.integers(0, 300, 60)) for _ in range(6)]
    sets = [np.unique(np.where(rng.random(len(b)) < 0.08, rng.integers(0, 300, len(b)), b)).astype(np.uint64) for b in base for _ in range(8)]
    sets += [sets[0], sets[0][:-1]]
    values, ranks = np.unique(np.concatenate(sets), return_inverse=True)
    trie = jaccard.Trie(np.split(ranks.astype(np.uint32), np.cumsum([len(s) for s in sets])[:-1]))
    for x in sets:
        has = np.isin(values, x)
        want = {i for i, y in enumerate(sets) if 4 * len(np.intersect1d(x, y)) >= 3 * len(np.union1d(x, y))}
        assert set(trie.similar(has, len(x))) == want


def shuffled_rows(node):
    """Rows written by the exchanges of a plan without adaptive execution."""
    own = node.metrics().apply("shuffleRecordsWritten").value() if node.nodeName() == "Exchange" else 0
    return own + sum(shuffled_rows(node.children().apply(i)) for i in range(node.children().size()))


def test_texts_are_not_shuffled_for_candidates(spark, monkeypatch):
    docs = spark.range(3000).selectExpr("id as doc_id", "concat_ws(' ', 'a', id, id + 1, 'b', 'c', id, 'd') as text")
    docs = docs.unionByName(docs.filter("doc_id % 1000 = 7").selectExpr("cast(null as long) as doc_id", "concat(text, ' e') as text"))
    levels = np.zeros(jaccard.BINS, np.uint16)
    known = jaccard.document_classes(docs, levels).filter("doc_id is null or doc_id % 500 = 7").selectExpr("cls", "1L as size", "doc_id as id")
    known = known.persist()
    stored, keep = [], jaccard.store
    monkeypatch.setattr(jaccard, "store", lambda df, label: stored.append(df) or keep(df, label))
    options = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for name, value in options.items():
        spark.conf.set(name, value)
    try:
        found = {(r.cls, len(r.tokens)) for r in jaccard._candidate_sets(docs, known, levels).collect()}
        (plan,) = stored
        plan.collect()
        assert shuffled_rows(plan._jdf.queryExecution().executedPlan()) <= 100  # not all 3003 texts
    finally:
        for name in options:
            spark.conf.unset(name)
    assert {r.cls for r in known.collect()} <= {cls for cls, _ in found} and len(found) <= 20 and {n for _, n in found} <= {3, 4}


def test_marked_rows_hold_all_chosen_keys(spark):
    rows = spark.range(5000).selectExpr("if(id % 97 = 0, null, cast(id as string)) as k", "id as v")
    chosen = rows.filter("v < 200").select("k")
    kept = {r.v for r in jaccard._marked(rows, "k", chosen).collect()}
    assert {v for v in range(5000) if v < 200 or v % 97 == 0} <= kept and len(kept) < 300
    assert jaccard._marked(rows, "k", chosen.filter("false")).count() == 0


def test_components(spark):
    pairs = [(5, 4), (4, 3), (9, 8), (1, 5), (7, 7), (12, 11), (11, 10), (10, 12)] + [(100 + i, 101 + i) for i in range(40)]
    rows = components(spark.createDataFrame(pairs, "a long, b long")).collect()
    got = {r.node: r.component for r in rows}
    assert len(rows) == len(got)
    assert {got[x] for x in (1, 3, 4, 5)} == {1} and {got[x] for x in (8, 9)} == {8} and {got[x] for x in (10, 11, 12)} == {10}
    assert {got[100 + i] for i in range(41)} == {100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_odd_rows(odd_docs, no_docs):
    rows = {r.doc_id: r for r in jaccard.near_duplicates(odd_docs).collect()}
    assert jaccard.near_duplicates(odd_docs).count() == odd_docs.count()
    texts = {r.doc_id: r.text for r in odd_docs.collect() if r.doc_id is not None}
    want = brute(texts)
    assert {i: (rows[i].n_shingles, rows[i].component_id) for i in texts} == want
    assert rows[None].component_id is None
    assert jaccard.near_duplicates(no_docs).count() == 0
    kept = jaccard.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted({c for _, c in want.values()})
