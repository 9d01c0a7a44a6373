"""Segments against all pairs of ends, the fitted model against held-out rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewlake.llm import toxicity


def plain_segments(scores):
    """All maximal scoring segments: the best one, then those left and right of it."""
    best = None
    for start in range(len(scores)):
        total = 0.0
        for end in range(start, len(scores)):
            total += scores[end]
            if total > 1e-9 and (best is None or total > best[2] + 1e-9):
                best = (start, end + 1, total)
    if best is None:
        return []
    start, end, total = best
    return (plain_segments(scores[:start]) + [best] + [(a + end, b + end, s) for a, b, s in plain_segments(scores[end:])])


def test_segments():
    random.seed(1)
    for _ in range(300):
        size = random.randint(0, 25)
        hits = [(at, random.choice([random.uniform(0.1, 3), random.uniform(-3, -0.5)])) for at in range(size) if random.random() < 0.5]
        scores = [-0.3] * size
        for at, weight in hits:
            scores[at] = weight
        found = toxicity.segments(hits, -0.3, size)
        want = plain_segments(scores)
        assert [(a, b) for a, b, _ in found] == [(a, b) for a, b, _ in want]
        assert [s for _, _, s in found] == pytest.approx([s for _, _, s in want])


def test_decay():
    share, score = np.array([0.1, 0.9]), np.array([2.0, -1.0])
    decay = toxicity.root_of_growth(share, score)
    assert share @ np.exp(decay * score) == pytest.approx(1.0)


@pytest.fixture(scope="module")
def fitted(spark):
    base = "/root/testdata/sf0.1"
    documents, labels = (spark.read.parquet(f"{base}/{name}.parquet") for name in ("documents", "labels"))
    return documents, labels, toxicity.train(documents, labels, ~toxicity.held_out(F.col("doc_id")))


def test_held_out(spark, fitted):
    documents, labels, model = fitted
    rows = toxicity.score_texts(documents, model, keep=["doc_id"]).join(labels, "doc_id").where(
        toxicity.held_out(F.col("doc_id"))).collect()
    order = np.argsort([row.score for row in rows]).argsort() + 1
    toxic = np.array([row.toxic for row in rows])
    area = (order[toxic == 1].sum() - toxic.sum() * (toxic.sum() + 1) / 2) / (toxic.sum() * (toxic == 0).sum())
    predicted = np.array([row.score >= 0.7 for row in rows])
    assert area > 0.93 and (toxic[predicted] == 1).mean() > 0.9 and predicted[toxic == 1].mean() > 0.7


def test_passages_and_odd_texts(spark, fitted):
    _, _, model = fitted
    clean = "plain words stand here " * 20
    rows = [(1, clean + "idiot moron stupid trash " + clean, "x"), (2, None, "x"), (3, "", "x"), (3, "", "x"), (None, clean * 500, "x")]
    got = toxicity.score_texts(spark.createDataFrame(rows, "doc_id long, text string, SCORE string"), model).collect()
    assert len(got) == 5 and got[0].score >= 0.7
    assert [(span.start, span.end) for span in got[0].toxic_passages] == [(80, 84)]
    assert all(row.score < 0.3 and not row.toxic_passages for row in got[1:])


def test_no_labels(spark):
    documents = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, None), (None, 1), (7, 0)], "doc_id long, toxic int")
    model = toxicity.train(documents, labels, F.lit(True))
    assert toxicity.score_texts(documents, model).first().score < 0.5
    assert toxicity.score_texts(documents.limit(0), model).count() == 0


def test_held_out_of_few_labels(spark):
    base = "/root/testdata/sf0.01"
    documents, labels = (spark.read.parquet(f"{base}/{name}.parquet") for name in ("documents", "labels"))
    held = toxicity.held_out(F.col("doc_id"))
    model = toxicity.train(documents, labels, ~held)
    rows = toxicity.score_texts(documents, model, keep=["doc_id"]).join(labels, "doc_id").where(held).collect()
    toxic = [row for row in rows if row.toxic]
    predicted = [row for row in rows if row.score >= 0.7]
    assert sum(row.score >= 0.7 for row in toxic) >= 0.6 * len(toxic)
    assert sum(row.toxic for row in predicted) >= 0.9 * len(predicted)


def test_weights_shrink_with_few_texts():
    few, many = (toxicity.log_odds(np.array([n]), np.array([0.0]), 1000.0, 9000.0, 3.0, np.log, np.sqrt) for n in (2.0, 40.0))
    assert 0 < few[0][0] < many[0][0] and few[1][0] < many[1][0]
