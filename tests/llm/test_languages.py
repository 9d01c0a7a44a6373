"""Viterbi against a plain loop; identification against held-out rows."""

import random
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewlake.llm import languages

BASE = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    documents = spark.read.parquet(f"{BASE}/documents.parquet")
    return languages.train(documents.where(languages.remainder(F.col("doc_id"), 5) != 0))


def worth(scores, path, first, penalty):
    changes = sum(a != b and not start for a, b, start in zip(path, path[1:], first[1:]))
    return sum(row[label] for row, label in zip(scores, path)) - penalty * changes


def test_best_path_of_short_sequences():
    rng = np.random.default_rng(1)
    for size in range(1, 8):
        for _ in range(20):
            scores, first = rng.normal(size=(size, 3)) * 3, rng.random(size) < 0.2
            first[0] = True
            found = languages.best_path(scores, first, 2.0)
            best = max(worth(scores, path, first, 2.0) for path in product(range(3), repeat=size))
            assert worth(scores, found, first, 2.0) == pytest.approx(best)


def test_best_path_of_long_sequences():
    rng = np.random.default_rng(2)
    for size in (50, 1000, 7001):
        scores, first = rng.normal(size=(size, 4)) * 2, rng.random(size) < 0.01
        value, back = scores[0].copy(), []
        for at in range(1, size):
            cost = 0.0 if first[at] else 3.0
            moved = value.max() - cost
            back.append(np.where(value >= moved, np.arange(4), value.argmax()))
            value = np.maximum(value, moved) + scores[at]
        found = languages.best_path(scores, first, 3.0)
        assert worth(scores, found, first, 3.0) == pytest.approx(value.max())
    assert len(languages.best_path(np.zeros((0, 3)), np.zeros(0, bool), 1.0)) == 0


def test_ngrams_against_slices():
    random.seed(3)
    words = ["a", "été", "straße", "日本", "aaaa"]
    slots, owners = languages.ngram_slots(words)
    for at, word in enumerate(words):
        alone, _ = languages.ngram_slots([word])
        size = len(word) + 2
        assert sorted(slots[owners == at]) == sorted(alone)
        assert len(alone) == len(word) + sum(max(0, size - order + 1) for order in (2, 3, 4))


def test_held_out_accuracy(spark, model):
    documents = spark.read.parquet(f"{BASE}/documents.parquet").where(languages.remainder(F.col("doc_id"), 5) == 0)
    rows = languages.identify(documents, model).collect()
    assert np.mean([row.lang == row.lang_pred for row in rows]) > 0.98
    assert all(0 <= row.score <= 1 for row in rows)


def test_mixed_and_odd_texts(spark, model):
    by = {row.lang: row.text for row in spark.read.parquet(f"{BASE}/documents.parquet").where("length(text) > 2000").collect()}
    mixed = " ".join(by["en"].split()[:60]) + " " + " ".join(by["de"].split()[:90])
    rows = [(1, mixed, "x"), (2, None, "x"), (3, " 12 .! \n", "x"), (4, "", "x"), (5, "日本語のテキスト", "x"), (5, "日本語のテキスト", "x"),
            (None, by["fr"] * 40, "x"), (7, "²½Ⅷ", "x"), (8, "w" * 200_000, "x")]
    got = languages.identify(spark.createDataFrame(rows, "doc_id long, text string, Score string"), model).collect()
    assert len(got) == len(rows) and got[0].lang_pred == "de" and 0.5 < got[0].score < 0.8
    assert {span.lang for span in got[0].lang_spans} == {"en", "de"} and got[0].lang_spans[0].start == 0
    assert [(row.lang_pred, row.score) for row in got[1:4]] == [("und", 0.0)] * 3
    assert got[4].lang_pred in model.langs and got[4].lang_pred == got[5].lang_pred and got[6].lang_pred == "fr"
    assert got[7].lang_pred == "und"


def test_scripts_narrow(spark):
    rows = [("ru", "это просто текст на языке " * 5)] * 3 + [("en", "this is plain text of a language " * 5)] * 3 + [(None, "x"), ("el", None)]
    model = languages.train(spark.createDataFrame(rows, "lang string, text string"))
    assert model.langs == ["en", "ru"]
    found = languages.identify(spark.createDataFrame([("щука",), ("xyz",)], "text string"), model).collect()
    assert [row.lang_pred for row in found] == ["ru", "en"]


def test_nothing_learned(spark):
    empty = spark.createDataFrame([], "lang string, text string")
    model = languages.train(empty)
    assert [row.lang_pred for row in languages.identify(spark.createDataFrame([("abc",)], "text string"), model).collect()] == ["und"]
    assert languages.identify(empty, model).count() == 0


def test_rejection(spark, model):
    df = spark.createDataFrame([(1, "the and of that is", "en"), (2, None, None), (3, "123", "en")], "doc_id long, text string, lang string")
    kept = languages.keep_identified(df, model)
    assert kept.columns == df.columns and [row.doc_id for row in kept.collect()] == [1]
