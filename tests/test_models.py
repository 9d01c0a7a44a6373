"""Clustering, its measures, segments and text models."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from reviewlake.operators import clustering, features, segments, text_models


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(1)
    centers = np.array([[0, 0, 0], [9, 0, 0], [0, 9, 9.0]])
    points = np.concatenate([center + rng.normal(scale=0.5, size=(60, 3)) for center in centers])
    pdf = pd.DataFrame(points, columns=["x", "y", "z"]).assign(user_id=range(180), truth=np.repeat([0, 1, 2], 60), flat=1.0)
    return pdf, spark.createDataFrame(pdf).repartition(4).cache()


@pytest.mark.parametrize("method", ["kmeans", "gmm", "agglomerative", "spectral"])
def test_planted_clusters_are_found(blobs, method):
    _, df = blobs
    found = clustering.perform_clustering(df, method, 3, columns=["x", "y", "z"], n_init=3)
    pairs = found.rows.groupBy("truth", "cluster").count().collect()
    assert sorted(row["count"] for row in pairs) == [60, 60, 60]
    assert found.measures["silhouette_score"] > 0.8


def test_constant_columns_are_left_out(blobs):
    assert clustering.feature_columns(blobs[1], exclude=["user_id", "truth"]) == ["x", "y", "z"]


def test_measures(spark, blobs):
    pdf, df = blobs
    rows = df.select(array_to_vector(F.array("x", "y", "z")).alias("features"), F.col("truth").alias("cluster"))
    found = clustering.cluster_metrics(rows)
    x, labels = pdf[["x", "y", "z"]].to_numpy(), pdf["truth"].to_numpy()
    centers = np.array([x[labels == k].mean(0) for k in range(3)])
    within = sum(((x[labels == k] - centers[k]) ** 2).sum() for k in range(3))
    between = sum(60 * ((centers[k] - x.mean(0)) ** 2).sum() for k in range(3))
    assert found["calinski_harabasz_score"] == pytest.approx(between / 2 / (within / 177))
    scatter = [np.linalg.norm(x[labels == k] - centers[k], axis=1).mean() for k in range(3)]
    worst = [max((scatter[i] + scatter[j]) / np.linalg.norm(centers[i] - centers[j]) for j in range(3) if j != i) for i in range(3)]
    assert found["davies_bouldin_score"] == pytest.approx(np.mean(worst))
    one = clustering.cluster_metrics(rows.withColumn("cluster", F.lit(0)))
    assert all(math.isnan(value) for value in one.values())


def test_best_number(blobs):
    assert clustering.find_optimal_clusters(blobs[1], 4, columns=["x", "y", "z"])["optimal_clusters"] == 3
    nan = math.nan
    assert clustering.best_k([{"k": 2, "silhouette_score": nan, "calinski_harabasz_score": 1},
                              {"k": 4, "silhouette_score": nan, "calinski_harabasz_score": 2}]) == 4
    assert clustering.best_k([{"k": 2, "silhouette_score": nan, "calinski_harabasz_score": nan}]) == 3


def test_profile_ranks_features(spark):
    df = spark.createDataFrame([(0, 1.0, 10.0), (0, 1.0, 10.0), (1, 5.0, 11.0), (1, 5.0, 11.0)], "cluster int, big_gap double, small double")
    rows = clustering.analyze_clusters(df, ["small", "big_gap"], 1).orderBy("cluster").collect()
    assert [(row["feature"], row["characteristic"], row["percentage"]) for row in rows] == [
        ("big_gap", "Low big gap", 50.0), ("big_gap", "High big gap", 50.0)]


def test_frequency_consistency(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"user_id": rng.choice([1, 2, 3, 4], 300, p=[0.7, 0.2, 0.09, 0.01]),
                        "created_at": pd.Timestamp("2024-01-01") + pd.to_timedelta(rng.integers(0, 60 * 86400, 300), unit="s")})
    found = segments.frequency_consistency(spark.createDataFrame(pdf)).toPandas().set_index("user_id")["review_frequency_consistency"]
    for user, part in pdf.groupby("user_id"):
        gaps = part["created_at"].sort_values().diff().dt.days.dropna()
        want = 1.0 if len(part) < 3 else 1 / (1 + (gaps.std() / gaps.mean() if gaps.mean() > 0 else 0))
        assert found[user] == pytest.approx(want)


def test_customer_defaults(spark):
    reviews = spark.createDataFrame([(1, 5, 7), (1, None, 8)], "user_id int, rating int, product_id int")
    row = segments.customer_features(reviews, F.current_timestamp()).first()
    assert (row["total_reviews"], row["weekend_review_ratio"], row["avg_text_length"], row["rating_std"]) == (1, 0.5, 0, 0.0)


def test_null_users_stay_unmatched(spark):
    df = spark.createDataFrame([(None, 5), (1, 4), (1, 2)], "user_id int, rating int")
    rows = features.extract_user_features(df, date=None).collect()
    assert {row["user_id"]: row["user_review_count"] for row in rows} == {None: None, 1: 2}


def test_constant_column_has_no_zscore(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0)], "flat double, v double")
    rows = features.extract_statistical_features(df, ["flat", "v"]).collect()
    assert [row["flat_zscore"] for row in rows] == [None, None]
    assert sorted(row["v_percentile"] for row in rows) == [0.5, 1.0]


def test_importance_of_constant_is_last(spark):
    df = spark.createDataFrame([(1.0, 1.0, 2.0), (1.0, 2.0, 4.1), (1.0, 3.0, 5.9)], "flat double, v double, y double")
    rows = features.feature_importance(df, "y").collect()
    assert [row["feature"] for row in rows] == ["v", "flat"] and rows[1]["importance_score"] is None


TRAINING = [("wonderful great thing works", "positive"), ("awful broken terrible waste", "negative"), ("plain box arrived", "neutral")]


def test_classifier(spark, tmp_path):
    df = spark.createDataFrame([(i, f"{text} item{i % 7}", label) for i in range(90) for text, label in [TRAINING[i % 3]]],
                               "id int, t string, label string")
    model, metrics = text_models.train_sentiment_model(df, "t", "label", "id", 100)
    assert metrics["accuracy"] == 1.0
    text_models.save_model(model, str(tmp_path / "m"))
    asked = spark.createDataFrame([("great works",), ("terrible waste",)], "t string")
    rows = text_models.score_with_model(text_models.load_model(str(tmp_path / "m")), asked, "t").collect()
    assert rows[0]["ml_label"] == "positive" and rows[0]["ml_score"] > 0.5
    assert rows[1]["ml_label"] == "negative" and rows[1]["ml_score"] < -0.5


def test_tfidf_weights(spark):
    df = spark.createDataFrame([("boat boat car",), ("boat tree",)], "t string")
    rows, vocabulary = text_models.extract_tfidf_features(df, "t", 10)
    vector = rows.first()["tfidf"].toArray()
    weights = {"boat": 2 * (math.log(3 / 3) + 1), "car": math.log(3 / 2) + 1, "boat boat": math.log(3 / 2) + 1, "boat car": math.log(3 / 2) + 1}
    length = math.sqrt(sum(value * value for value in weights.values()))
    for term, value in weights.items():
        assert vector[vocabulary.index(term)] == pytest.approx(value / length)


def test_frequent_terms_are_those_of_all_words_and_pairs(spark):
    import random
    from collections import Counter
    random.seed(3)
    rows = [[random.choice("abcdefghij") * 2 for _ in range(random.randint(0, 12))] for _ in range(60)]
    counted = Counter(word for row in rows for word in row)
    counted.update(" ".join(pair) for row in rows for pair in zip(row, row[1:]))
    expected = sorted(counted, key=lambda term: (-counted[term], term))
    words = spark.createDataFrame([(row,) for row in rows], "_kept array<string>")
    for limit in (1, 5, 10, 14, 60, 1000):
        assert text_models.frequent_terms(words, limit) == expected[:limit]


def test_features_read_each_text_once(spark):
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def told(text):
        read.add(1)
        return text
    rows = spark.range(60).select(
        F.col("id").alias("review_id"), (F.col("id") % 7).alias("user_id"), (F.col("id") % 5).alias("product_id"),
        (1 + F.col("id") % 5).alias("rating"), F.timestamp_seconds(F.col("id") * 1000).alias("created_at"),
        told(F.concat(F.lit("The red boat, a 2nd boat and CAFÉ "), F.col("id").cast("string"))).alias("review_text"))
    found = features.engineer_features(rows, order=["created_at", "review_id"]).toPandas().sort_values("review_id")
    assert len(found) == 60 and read.value == 60
    assert list(found.columns[:6]) == ["product_id", "user_id", "review_id", "rating", "created_at", "review_text"]
    assert found["word_count"].tolist() == [9] * 60 and found["rating_rolling_mean_7"].notna().all()
    np.testing.assert_allclose(found["user_review_count_percentile"], found["user_review_count"].rank(pct=True))
    assert found["tfidf"].map(lambda vector: len(vector.indices) > 3).all()


def test_counts_of_plain_words_are_those_of_the_stages(spark):
    """The words of `plain_words` are those of the tokenizer and the stop words; counts of terms are those of the counter."""
    from pyspark.ml import PipelineModel
    texts = ["The Boat and the boat tree", "", None, "É t\u00e9 3 d'or \u4e2d\u6587 boat_tree x\u0301y \U0001d400\U0001d401 a\u200db",
             "I don't tree   boat\nboat\tCAR car car", "the of and", "\u0130stanbul \u03a3\u03a3 boat car"]
    rows = spark.createDataFrame(list(enumerate(texts)), "_at long, t string").repartition(3)
    words = rows.select("_at", text_models.plain_words(F.col("t")).alias("_plain"))
    cut = PipelineModel(text_models._words("_text")).transform(rows.withColumn("_text", text_models.plain_letters(F.col("t"))))
    kept = cut.select("_kept")
    vocabulary = text_models.frequent_terms(kept, 30)
    assert text_models.frequent_terms(words.select("_plain"), 30) == vocabulary and any(" " in term for term in vocabulary)
    expected = PipelineModel([*text_models._terms(), text_models._counter(vocabulary)]).transform(cut)
    counted = text_models.count_terms(words, {"a": vocabulary, "b": vocabulary[:3]})
    found = {row["_at"]: row for row in counted.collect()}
    assert len(found) == len(texts)
    for row in expected.collect():
        np.testing.assert_array_equal(found[row["_at"]]["a"].toArray(), row["_counts"].toArray())
        np.testing.assert_array_equal(found[row["_at"]]["b"].toArray(), row["_counts"].toArray()[:3])
