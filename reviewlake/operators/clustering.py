"""Clustering of numeric feature tables with Spark ML, its metrics and profiles."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml.clustering import BisectingKMeans, GaussianMixture, KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, MinMaxScaler, RobustScaler, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from reviewlake.operators.cleaning import numeric_columns
from reviewlake.operators.relational import sample_rows
from reviewlake.session import materialize

MIN_VARIANCE = 1e-8


def feature_columns(df: DataFrame, exclude: Sequence[str] = ("user_id",)) -> list[str]:
    """Numeric columns whose variance is not negligible; all of them when fewer than two remain."""
    columns = [name for name in numeric_columns(df) if name not in exclude]
    row = df.agg(*[F.coalesce(F.var_samp(name), F.lit(0.0)).alias(name) for name in columns]).first()
    kept = [name for name in columns if row[name] > MIN_VARIANCE]
    return kept if len(kept) >= 2 else columns


def scaled_matrix(df: DataFrame, columns: Sequence[str], method: str = "standard") -> DataFrame:
    """Add `features`: the columns as a scaled vector (standard, minmax, robust)."""
    scalers = {
        "standard": lambda: StandardScaler(withMean=True, withStd=True),
        "minmax": lambda: MinMaxScaler(),
        "robust": lambda: RobustScaler(withCentering=True),
    }
    if method not in scalers:
        raise ValueError(f"unknown scaling {method!r}; use one of {sorted(scalers)}")
    raw = VectorAssembler(inputCols=list(columns), outputCol="_raw", handleInvalid="error").transform(
        df.fillna(0, list(columns)))
    scaler = scalers[method]().setInputCol("_raw").setOutputCol("features")
    return scaler.fit(raw).transform(raw).drop("_raw")


@dataclass
class Clustering:
    """Rows with their `cluster`, and what was measured on the way."""

    method: str
    n_clusters: int
    rows: DataFrame
    columns: list[str]
    measures: dict[str, float] = field(default_factory=dict)


def _kmeans(matrix: DataFrame, k: int, seed: int, n_init: int) -> tuple[DataFrame, float]:
    """Best of `n_init` starts by cost."""
    best = None
    for start in range(n_init):
        model = KMeans(k=k, seed=seed + start).fit(matrix)
        cost = model.summary.trainingCost
        if best is None or cost < best[1]:
            best = (model, cost)
    return best[0].transform(matrix).withColumnRenamed("prediction", "cluster"), best[1]


def _mixture(matrix: DataFrame, k: int, seed: int, n_init: int) -> tuple[DataFrame, float]:
    """Best of `n_init` starts by likelihood, given per row."""
    best = None
    for start in range(n_init):
        model = GaussianMixture(k=k, seed=seed + start).fit(matrix)
        likelihood = model.summary.logLikelihood
        if best is None or likelihood > best[1]:
            best = (model, likelihood)
    rows = best[0].transform(matrix).withColumnRenamed("prediction", "cluster").drop("probability")
    return rows, best[1] / matrix.count()


def _bisecting(matrix: DataFrame, k: int, seed: int) -> DataFrame:
    """Hierarchical splits. Centered data is moved off the origin first: a split starts from a
    disturbance proportional to the length of the center, which would be nothing there.
    """
    moved = matrix.withColumn("_moved", array_to_vector(F.transform(vector_to_array("features"), lambda x: x + 1)))
    model = BisectingKMeans(k=k, seed=seed, maxIter=50, featuresCol="_moved").fit(moved)
    return model.transform(moved).withColumnRenamed("prediction", "cluster").drop("_moved")


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] - 2 * a @ b.T + (b * b).sum(1)[None, :], 0.0)


def _spectral(matrix: DataFrame, k: int, seed: int, landmarks: int = 48, nearest: int = 5) -> DataFrame:
    """Landmark-based spectral clustering (Chen & Cai 2011).

    Rows are tied to their nearest landmarks instead of to each other, so nothing
    grows with pairs of rows. Only landmark x landmark sums reach the driver.
    """
    anchors = KMeans(k=landmarks, seed=seed).fit(matrix)
    centers = np.array(anchors.clusterCenters())
    m, width = len(centers), max(anchors.summary.trainingCost / max(matrix.count(), 1), 1e-12)
    near = min(nearest, m)

    def affinity(rows: np.ndarray) -> np.ndarray:
        distance = _squared(rows, centers)
        cut = np.partition(distance, near - 1, axis=1)[:, near - 1:near]
        z = np.where(distance <= cut, np.exp(-(distance - distance.min(1, keepdims=True)) / (2 * width)), 0.0)
        return z / z.sum(1, keepdims=True)

    columns = [name for name in matrix.columns if name != "features"]
    plain = matrix.withColumn("features", vector_to_array("features"))

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        gram, degree = np.zeros((m, m)), np.zeros(m)
        for batch in batches:
            if len(batch):
                z = affinity(np.stack(batch["features"].to_numpy()))
                gram += z.T @ z
                degree += z.sum(0)
        yield pd.DataFrame({"i": np.repeat(np.arange(m + 1), m), "j": np.tile(np.arange(m), m + 1),
                            "v": np.concatenate([gram.ravel(), degree])})

    total = plain.select("features").mapInPandas(sums, "i int, j int, v double").groupBy("i", "j").agg(
        F.sum("v").alias("v")).toPandas()  # (landmarks + 1) x landmarks numbers
    filled = np.zeros((m + 1, m))
    filled[total["i"], total["j"]] = total["v"]
    gram, degree = filled[:m], np.maximum(filled[m], 1e-12)
    scale = 1 / np.sqrt(degree)
    values, vectors = np.linalg.eigh(scale[:, None] * gram * scale[None, :])
    top = np.argsort(values)[::-1][:k]
    projection = (scale[:, None] * vectors[:, top]) / np.sqrt(np.maximum(values[top], 1e-12))

    def embed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                rows = affinity(np.stack(batch["features"].to_numpy())) @ projection
                rows /= np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)
                yield batch.assign(_embedding=list(rows))

    schema = StructType([*plain.schema.fields, StructField("_embedding", ArrayType(DoubleType()))])
    embedded = materialize(plain.mapInPandas(embed, schema), "spectral").withColumns(
        {"features": array_to_vector("features"), "_embedding": array_to_vector("_embedding")})
    model = KMeans(k=k, seed=seed, featuresCol="_embedding").fit(embedded)
    labelled = model.transform(embedded).withColumnRenamed("prediction", "cluster")
    return labelled.select(*columns, "features", "cluster")


def perform_clustering(df: DataFrame, method: str = "kmeans", n_clusters: int = 5, scaling_method: str = "standard",
                       columns: Sequence[str] | None = None, seed: int = 42, n_init: int = 10,
                       with_metrics: bool = True) -> Clustering:
    """Cluster the rows of a feature table.

    Methods: kmeans, gmm, agglomerative (bisecting k-means, the scalable
    hierarchy) and spectral (landmark based).
    """
    columns = list(columns or feature_columns(df))
    # The scaled table is read by every iteration of every model.
    matrix = materialize(scaled_matrix(df, columns, scaling_method), "matrix")
    measures: dict[str, float] = {}
    if method == "kmeans":
        rows, measures["inertia"] = _kmeans(matrix, n_clusters, seed, n_init)
    elif method == "gmm":
        rows, measures["log_likelihood"] = _mixture(matrix, n_clusters, seed, n_init)
    elif method == "agglomerative":
        rows = _bisecting(matrix, n_clusters, seed)
    elif method == "spectral":
        rows = _spectral(matrix, n_clusters, seed)
    else:
        raise ValueError(f"unknown clustering method {method!r}")
    if with_metrics:
        measures |= cluster_metrics(rows)
    return Clustering(method, n_clusters, rows, columns, measures)


def cluster_metrics(rows: DataFrame) -> dict[str, float]:
    """Silhouette (squared Euclidean), Calinski-Harabasz and Davies-Bouldin; NaN for one cluster.

    Two passes: sums per cluster, then distances to the own center.
    """
    # One row per cluster.
    found = rows.groupBy("cluster").agg(
        F.count("*").alias("n"), Summarizer.mean(F.col("features")).alias("center")).orderBy("cluster").collect()
    names = ("silhouette_score", "calinski_harabasz_score", "davies_bouldin_score")
    if len(found) < 2:
        return dict.fromkeys(names, math.nan)
    ids = {row["cluster"]: at for at, row in enumerate(found)}
    sizes = np.array([row["n"] for row in found], dtype=float)
    centers = np.array([row["center"].toArray() for row in found])

    own = F.coalesce(*[F.when(F.col("cluster") == cluster, F.lit(centers[at].tolist())) for cluster, at in ids.items()])
    squares = F.zip_with(vector_to_array("features"), own, lambda x, y: (x - y) * (x - y))
    distance = F.sqrt(F.aggregate(squares, F.lit(0.0), lambda total, x: total + x))
    spread = {row["cluster"]: row for row in rows.select("cluster", distance.alias("d")).groupBy("cluster").agg(
        F.avg("d").alias("mean"), F.sum(F.col("d") * F.col("d")).alias("squares")).collect()}
    within = sum(row["squares"] for row in spread.values())
    mean = (sizes[:, None] * centers).sum(0) / sizes.sum()
    between = float((sizes * ((centers - mean) ** 2).sum(1)).sum())
    k, n = len(found), sizes.sum()
    scatter = np.array([spread[row["cluster"]]["mean"] for row in found])
    gaps = np.sqrt(_squared(centers, centers))
    np.fill_diagonal(gaps, np.inf)
    ratios = (scatter[:, None] + scatter[None, :]) / np.maximum(gaps, 1e-300)
    return dict(zip(names, (
        ClusteringEvaluator(featuresCol="features", predictionCol="cluster").evaluate(rows),
        between * (n - k) / (within * (k - 1)) if within and n > k else math.nan,
        float(ratios.max(1).mean()))))


def find_optimal_clusters(df: DataFrame, max_clusters: int = 12, method: str = "kmeans",
                          columns: Sequence[str] | None = None, seed: int = 42, n_init: int = 1) -> dict:
    """Try 2..max_clusters clusters; best silhouette, else best Calinski-Harabasz, else 3."""
    columns = list(columns or feature_columns(df))
    matrix = materialize(scaled_matrix(df, columns), "matrix")
    tried: list[dict] = []
    for k in range(2, max_clusters + 1):
        if method == "kmeans":
            rows, inertia = _kmeans(matrix, k, seed, n_init)
        elif method == "gmm":
            rows, likelihood = _mixture(matrix, k, seed, n_init)
            inertia = -likelihood
        else:
            raise ValueError(f"cannot search with {method!r}")
        tried.append({"k": k, "inertia": float(inertia), **cluster_metrics(rows)})
    return {"optimal_clusters": best_k(tried), "metrics": tried, "method": method}


def best_k(tried: Sequence[dict]) -> int:
    for name in ("silhouette_score", "calinski_harabasz_score"):
        valid = [row for row in tried if not math.isnan(row[name])]
        if valid:
            return max(valid, key=lambda row: row[name])["k"]
    return 3


def analyze_clusters(rows: DataFrame, columns: Sequence[str], top: int = 5) -> DataFrame:
    """(cluster, size, percentage, feature, cluster_mean, global_mean, difference, rank, characteristic).

    The `top` features of every cluster by relative difference of the mean; the
    first three carry a High / Low characteristic.
    """
    def means(grouped, prefix: str = "") -> DataFrame:
        return grouped.agg(F.count("*").alias(f"{prefix}size"), F.array(*[F.struct(
            F.lit(at).alias("place"), F.lit(name).alias("feature"),
            F.avg(name).alias(f"{prefix}mean")) for at, name in enumerate(columns)]).alias("_f"))

    per_cluster = means(rows.groupBy("cluster")).select("cluster", "size", F.inline("_f"))
    overall = means(rows.groupBy(), "global_").select("global_size", F.inline("_f")).drop("place")
    # One row per feature.
    joined = per_cluster.join(F.broadcast(overall), "feature")
    difference = F.when(F.col("global_mean") != 0,
                        F.abs(F.col("mean") - F.col("global_mean")) / F.abs("global_mean")).otherwise(0.0)
    ranked = joined.withColumn("difference", difference).withColumn("rank", F.row_number().over(
        Window.partitionBy("cluster").orderBy(F.desc("difference"), "place")))
    word = F.when(F.col("mean") > F.col("global_mean"), "High ").otherwise("Low ")
    return ranked.where(F.col("rank") <= top).select(
        "cluster", "size", (F.col("size") * 100 / F.col("global_size")).alias("percentage"), "feature",
        F.col("mean").alias("cluster_mean"), "global_mean", "difference", "rank",
        F.when(F.col("rank") <= 3, F.concat(word, F.replace("feature", F.lit("_"), F.lit(" "))))
        .alias("characteristic"))


def project_clusters(rows: DataFrame, key: str, sample: int = 5000) -> tuple[DataFrame, list[float]]:
    """2-D principal components, fitted on all rows, and their explained variance; `sample` points to draw."""
    model = PCA(k=2, inputCol="features", outputCol="_pca").fit(rows)
    chosen = sample_rows(rows.select(key, "features", "cluster"), F.col(key), sample)
    points = vector_to_array(F.col("_pca"))
    placed = model.transform(chosen).select(key, points[0].alias("x"), points[1].alias("y"), "cluster")
    return placed, [float(value) for value in model.explainedVariance]
