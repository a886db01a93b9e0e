import zlib

import numpy as np

from fleetwane.llm import quality
from fleetwane.llm.queries import QUERIES


def test_held_out_accuracy(spark, tables):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{tables}/labels.parquet").collect()}
    rows = QUERIES["op1_quality_classifier"](spark, tables).collect()
    assert len(rows) == spark.read.parquet(f"{tables}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in held) >= 0.85 * len(held)


def test_score_is_the_difference_of_log_densities():
    rng = np.random.default_rng(1)
    d = len(quality.STATISTICS)
    factor = np.tril(rng.normal(size=(2, d, d))) + 3 * np.eye(d)
    means = rng.normal(size=(2, d))
    model = quality.Discriminant(np.zeros(d), np.ones(d), means, np.linalg.inv(factor), -np.log(np.abs(np.linalg.det(factor))))
    x = rng.normal(size=(5, d))

    def density(k):
        gap = x - means[k]
        return -0.5 * np.einsum("ni,ij,nj->n", gap, np.linalg.inv(factor[k] @ factor[k].T), gap) - np.log(np.abs(np.linalg.det(factor[k])))

    np.testing.assert_allclose(model.score(x), 1 / (1 + np.exp(-np.clip(density(1) - density(0), -30, 30))))


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(0, 1, 0), (1, None, 0), (6, 0, 1), (6, 1, 1), (None, 1, 0)], "doc_id long, quality int, toxic int")
    rows = quality.classify(odd_docs, labels).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert quality.classify(no_docs, labels).count() == 0
    assert {r.score for r in quality.classify(odd_docs, labels.limit(0)).collect()} == {0.5}
