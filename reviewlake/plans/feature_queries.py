"""Feature groups, customer features, clustering and segments."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from reviewlake import lens
from reviewlake.lens import with_sql
from reviewlake.operators import clustering, features, segments
from reviewlake.plans.registry import query, r8, rounded
from reviewlake.plans.table_queries import _PRODUCT_STATS
from reviewlake.plans.text_queries import CALENDAR_SQL, CYCLES_SQL, SEASONS_SQL, SENTENCES, SYLLABLES, words_sql
from reviewlake.session import materialize, spread

AS_OF = "2024-03-01"


def _as_of():
    return F.lit(AS_OF).cast("timestamp")


def _texts(spark, base):
    return spread(lens.texts(spark, base), "review_id")


# Feature groups -----------------------------------------------------------------------------------

DAYS = "CAST(floor(date_diff('microsecond', ts, (SELECT max(created_at) FROM texts)) / 86400000000.0) AS BIGINT)"


@query("e04_temporal_features", with_sql("texts") + f"""
SELECT review_id, {CALENDAR_SQL}, {CYCLES_SQL}, {SEASONS_SQL}, {DAYS} AS days_since_latest,
       round({DAYS} / 7.0, 8) AS weeks_since_latest, round({DAYS} / CAST(30.44 AS DOUBLE), 8) AS months_since_latest
FROM (SELECT review_id, created_at AS ts FROM texts)""")
def e04(spark, base):
    found = features.extract_temporal_features(lens.texts(spark, base).select("review_id", "created_at"))
    return rounded(found.drop("created_at"), "month_sin", "month_cos", "day_of_week_sin", "day_of_week_cos",
                   "weeks_since_latest", "months_since_latest")


READING = (f"CASE WHEN {SENTENCES} > 0 AND len({words_sql('text')}) > 0 THEN greatest(0.0, least(100.0, 206.835 - 1.015 * "
           f"len({words_sql('text')}) / CAST({SENTENCES} AS DOUBLE) - 84.6 * {SYLLABLES} / "
           f"CAST(len({words_sql('text')}) AS DOUBLE))) ELSE 0.0 END")
INTERACTION = with_sql("texts") + f"""
, base AS (SELECT review_id, user_id, product_id, rating, created_at, len({words_sql('text')}) AS words, {READING} AS ease
           FROM (SELECT *, review_text AS text FROM texts)),
u AS (SELECT user_id, round_even(avg(rating), 3) AS m, count(*) AS n FROM texts GROUP BY 1),
p AS (SELECT product_id, round_even(avg(rating), 3) AS m FROM texts GROUP BY 1),
j AS (SELECT b.*, u.m AS um, u.n AS un, p.m AS pm, (SELECT median(words) FROM base) AS med,
      floor(date_diff('microsecond', created_at, (SELECT max(created_at) FROM texts)) / 86400000000.0) AS days
      FROM base b JOIN u ON b.user_id = u.user_id JOIN p ON b.product_id = p.product_id)
SELECT review_id, round(words / (rating + 1.0), 8) AS word_count_rating_ratio,
       CAST(words > med AND rating >= 4 AS INTEGER) AS is_detailed_positive,
       CAST(words > med AND rating <= 2 AS INTEGER) AS is_detailed_negative,
       round(um - pm, 8) AS user_product_rating_diff, CAST(um - pm < -0.5 AS INTEGER) AS user_harsher_than_average,
       CAST(um - pm > 0.5 AS INTEGER) AS user_more_generous_than_average,
       round(rating * exp(-days / 30.0), 8) AS recent_review_rating_interaction, round(words / (ease + 1), 8) AS complexity_score
FROM j"""
INTERACTIONS = ["word_count_rating_ratio", "is_detailed_positive", "is_detailed_negative", "user_product_rating_diff",
                "user_harsher_than_average", "user_more_generous_than_average", "recent_review_rating_interaction",
                "complexity_score"]
FRACTIONS = ["word_count_rating_ratio", "user_product_rating_diff", "recent_review_rating_interaction", "complexity_score"]


@query("e05_interaction_features", INTERACTION)
def e05(spark, base):
    config = features.FeatureConfig(enable_statistical_features=False, enable_tfidf_features=False, enable_topic_modeling=False)
    rows = _texts(spark, base).select("review_id", "review_text", "user_id", "product_id", "rating", "created_at")
    found = features.engineer_features(rows, config=config)
    return rounded(found.select("review_id", *INTERACTIONS), *FRACTIONS)


@query("e06_user_features", with_sql("ratings") + """
, s AS (SELECT user_id, count(*) AS n, round_even(avg(rating), 3) AS m FROM ratings GROUP BY 1)
SELECT r.user_id, r.rating, n AS user_review_count, m AS user_avg_rating, CASE WHEN n <= 2 THEN 'novice' WHEN n <= 5 THEN 'casual'
       WHEN n <= 10 THEN 'regular' ELSE 'expert' END AS user_experience_level, count(*) AS reviews
FROM ratings r JOIN s ON r.user_id = s.user_id GROUP BY ALL""")
def e06(spark, base):
    rows = features.extract_user_features(lens.ratings(spark, base).select("user_id", "rating", "created_at"))
    return rows.groupBy("user_id", "rating", "user_review_count", "user_avg_rating", "user_experience_level").agg(
        F.count("*").alias("reviews"))


@query("e07_product_features", _PRODUCT_STATS + "SELECT * FROM product_features")
def e07(spark, base):
    return features.product_features(lens.product_ratings(spark, base))


@query("e07_product_features_on_rows", _PRODUCT_STATS + """
SELECT f.product_id, r.rating, f.product_popularity_rank, f.product_category, count(*) AS reviews
FROM product_ratings r JOIN product_features f ON r.product_id = f.product_id GROUP BY ALL""")
def e07_rows(spark, base):
    reviews = lens.product_ratings(spark, base).select("product_id", "rating", "created_at")
    return features.extract_product_features(reviews).groupBy(
        "product_id", "rating", "product_popularity_rank", "product_category").agg(F.count("*").alias("reviews"))


def _statistics_sql(name: str) -> str:
    return f"""round(({name} - avg({name}) OVER ()) / stddev_samp({name}) OVER (), 6) AS {name}_zscore,
    round((rank() OVER (ORDER BY {name}) + (count(*) OVER (PARTITION BY {name}) - 1) / 2.0) / count(*) OVER (), 8) AS {name}_percentile,
    CAST({name} < q_{name}[1] - 1.5 * (q_{name}[2] - q_{name}[1]) OR {name} > q_{name}[2] + 1.5 * (q_{name}[2] - q_{name}[1]) AS INTEGER)
    AS {name}_is_outlier"""


STATISTICS = ["l_extendedprice", "l_quantity", "l_discount"]


@query("e08_statistical_features", "WITH " + """q AS (SELECT """ + ", ".join(
    f"quantile_cont({name}, [0.25, 0.75]) AS q_{name}" for name in STATISTICS) + """ FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, """ + ", ".join(_statistics_sql(name) for name in STATISTICS) + " FROM lineitem CROSS JOIN q")
def e08(spark, base):
    rows = lens.table(spark, base, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", *STATISTICS)
    found = features.extract_statistical_features(rows, STATISTICS).drop(*STATISTICS)
    found = rounded(found, *[f"{name}_zscore" for name in STATISTICS], digits=6)
    return rounded(found, *[f"{name}_percentile" for name in STATISTICS])


@query("e09_rolling_rating", with_sql("texts") + """
SELECT review_id, rating, round(avg(rating) OVER w, 8) AS rating_rolling_mean_7,
       round(coalesce(stddev_samp(rating) OVER w, 0), 8) AS rating_rolling_std_7 FROM texts
WINDOW w AS (ORDER BY created_at, review_id ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""")
def e09(spark, base):
    rows = lens.texts(spark, base).select("review_id", "rating", "created_at")
    found = features.extract_statistical_features(rows, [], ["created_at", "review_id"]).drop("created_at")
    return rounded(found, "rating_rolling_mean_7", "rating_rolling_std_7")


IMPORTANCE = ["l_linenumber", "l_extendedprice", "l_discount", "l_tax"]
IMPORTANCE_SQL = "WITH i AS (" + " UNION ALL ".join(
    f"""SELECT '{name}' AS feature, abs(corr({name}, l_quantity)) AS c, var_samp({name}) AS v,
    count(*) FILTER ({name} IS NULL) / CAST(count(*) AS DOUBLE) AS m FROM lineitem""" for name in IMPORTANCE) + ")"


@query("e10_feature_importance", IMPORTANCE_SQL + """
SELECT feature, round(c, 8) AS correlation, round(v, 2) AS variance, round(m, 8) AS missing_ratio,
       round(c * (1 - m) * least(1.0, v), 8) AS importance_score FROM i""")
def e10(spark, base):
    found = features.feature_importance(lens.table(spark, base, "lineitem"), "l_quantity", IMPORTANCE, chunk=3)
    return rounded(found, "correlation", "missing_ratio", "importance_score").withColumn("variance", F.round("variance", 2))


@query("e11_select_top_features", IMPORTANCE_SQL + "SELECT feature FROM i ORDER BY c * (1 - m) * least(1.0, v) DESC, feature LIMIT 2")
def e11(spark, base):
    return features.select_top_features(lens.table(spark, base, "lineitem"), "l_quantity", 2, IMPORTANCE).select("feature")


@query("e13_engineer_features", with_sql("texts") + f"""
, u AS (SELECT user_id, count(*) AS n FROM texts GROUP BY 1), p AS (SELECT product_id, count(*) AS n FROM texts GROUP BY 1),
w AS (SELECT review_id, len({words_sql('review_text')}) AS words FROM texts)
SELECT t.review_id, CAST(w.words AS INTEGER) AS word_count, CAST(year(created_at) AS INTEGER) AS year, u.n AS user_review_count,
       p.n AS product_review_count, round((w.words - avg(w.words) OVER ()) / stddev_samp(w.words) OVER (), 8) AS word_count_zscore,
       round((rank() OVER (ORDER BY w.words) + (count(*) OVER (PARTITION BY w.words) - 1) / 2.0) / count(*) OVER (), 8)
       AS word_count_percentile,
       round((rank() OVER (ORDER BY u.n) + (count(*) OVER (PARTITION BY u.n) - 1) / 2.0) / count(*) OVER (), 8) AS user_review_count_percentile,
       round((p.n - avg(p.n) OVER ()) / stddev_samp(p.n) OVER (), 8) AS product_review_count_zscore,
       round(avg(rating) OVER (ORDER BY created_at, t.review_id ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 8) AS rating_rolling_mean_7,
       true AS topics_add_up, true AS topic_is_heaviest, true AS terms_are_words, 0::BIGINT AS unranked
FROM texts t JOIN w ON t.review_id = w.review_id JOIN u ON t.user_id = u.user_id JOIN p ON t.product_id = p.product_id""")
def e13(spark, base):
    rows = _texts(spark, base).select("review_id", "review_text", "user_id", "product_id", "rating", "created_at")
    # every group with all of its columns; those without a plain form are held against what must be true of them
    found = features.engineer_features(rows, order=["created_at", "review_id"])
    topics = [name for name in found.columns if name.startswith("topic_") and name.endswith("_weight")]
    ranked = [name for name in found.columns if name.endswith("_percentile")]
    total = sum((F.col(name) for name in topics), F.lit(0.0))
    # vectors are read as they are stored, without the terms that a text lacks
    terms = F.size(F.filter(F.unwrap_udt("tfidf")["values"], lambda x: x > 0))
    facts = found.select(
        "review_id", "word_count", "year", "user_review_count", "product_review_count", "word_count_zscore", "word_count_percentile",
        "user_review_count_percentile", "product_review_count_zscore", "rating_rolling_mean_7",
        # a text without a term has no topic
        ((F.abs(total - 1) < 1e-6) | ((total == 0) & (terms == 0))).alias("topics_add_up"),
        (F.abs(F.greatest(*topics) - F.col("dominant_topic_weight")) < 1e-9).alias("topic_is_heaviest"),
        # a word, or a pair of neighbouring ones, is a term
        (terms <= 2 * F.col("word_count")).alias("terms_are_words"),
        F.size(F.filter(F.array(*[F.struct(F.col(name.removesuffix("_percentile")).alias("v"), F.col(name).alias("r")) for name in ranked]),
                        lambda x: x["v"].isNotNull() & x["r"].isNull())).cast("bigint").alias("unranked"))
    return rounded(facts, "word_count_zscore", "word_count_percentile", "user_review_count_percentile",
                   "product_review_count_zscore", "rating_rolling_mean_7")


@query("e14_insight_features", with_sql("texts") + f"""
SELECT review_id, round(helpful_votes / (total_votes + 1e-5), 6) AS helpfulness_ratio,
       CAST(len({words_sql('review_text')}) AS INTEGER) AS review_length, CAST(length(review_text) AS INTEGER) AS review_char_count,
       CAST(year(created_at) AS INTEGER) AS review_year, CAST(month(created_at) AS INTEGER) AS review_month,
       CAST(isodow(created_at) - 1 AS INTEGER) AS review_day_of_week, CAST(rating >= 4 AS INTEGER) AS is_positive,
       CAST(rating <= 2 AS INTEGER) AS is_negative, abs(sentiment_score) AS sentiment_magnitude,
       CASE WHEN sentiment_score > -1 AND sentiment_score <= -0.1 THEN 'Negative' WHEN sentiment_score > -0.1 AND sentiment_score <= 0.1
            THEN 'Neutral' WHEN sentiment_score > 0.1 THEN 'Positive' END AS sentiment_category FROM texts""")
def e14(spark, base):
    found = features.review_insight_features(_texts(spark, base))
    return found.select("review_id", F.round("helpfulness_ratio", 6).alias("helpfulness_ratio"), "review_length",
                        "review_char_count", "review_year", "review_month", "review_day_of_week", "is_positive",
                        "is_negative", "sentiment_magnitude", "sentiment_category")


# Customers ----------------------------------------------------------------------------------------

CUSTOMERS = with_sql("texts") + f"""
, b AS (SELECT user_id, count(rating) AS n, round_even(avg(rating), 4) AS m, coalesce(round_even(stddev_samp(rating), 4), 0) AS sd,
  min(rating) AS lo, max(rating) AS hi, count(DISTINCT product_id) AS products,
  {", ".join(f"count(*) FILTER (rating = {k}) AS r{k}" for k in range(1, 6))},
  CAST(floor(date_diff('microsecond', min(created_at), max(created_at)) / 86400000000.0) AS BIGINT) + 1 AS active,
  CAST(floor(date_diff('microsecond', max(created_at), TIMESTAMP '{AS_OF}') / 86400000000.0) AS BIGINT) AS ago,
  avg(CAST(isodow(created_at) IN (6, 7) AS INTEGER)) AS weekend, avg(length(review_text)) AS tl,
  coalesce(stddev_samp(length(review_text)), 0) AS tsd, min(length(review_text)) AS tmin, max(length(review_text)) AS tmax,
  CAST(sum(length(review_text)) AS BIGINT) AS tsum, count(*) FILTER (length(review_text) < 50) AS short,
  count(*) FILTER (length(review_text) >= 50 AND length(review_text) < 200) AS medium,
  count(*) FILTER (length(review_text) >= 200) AS long, avg(sentiment_score) AS s, coalesce(stddev_samp(sentiment_score), 0) AS ssd,
  avg(CAST(sentiment_score > 0 AS INTEGER)) AS pos, avg(CAST(sentiment_score < 0 AS INTEGER)) AS neg FROM texts GROUP BY 1),
customers AS (SELECT user_id, n AS total_reviews, m AS avg_rating, sd AS rating_std, lo AS min_rating, hi AS max_rating,
  products AS unique_products, {", ".join(f"r{k} AS rating_{k}_count, round(r{k} / CAST(n AS DOUBLE), 8) AS rating_{k}_ratio" for k in range(1, 6))},
  active AS days_active, ago AS last_review_days_ago, round(weekend, 8) AS weekend_review_ratio, round(tl, 8) AS avg_text_length,
  round(tsd, 8) AS text_length_std, CAST(tmin AS INTEGER) AS min_text_length, CAST(tmax AS INTEGER) AS max_text_length,
  tsum AS total_text_length, short AS short_reviews, medium AS medium_reviews, long AS long_reviews,
  round(s, 8) AS avg_sentiment, round(ssd, 8) AS sentiment_std, round(pos, 8) AS positive_sentiment_ratio,
  round(neg, 8) AS negative_sentiment_ratio, hi - lo AS rating_range, round(products / CAST(n AS DOUBLE), 8) AS product_diversity,
  round(1 - products / CAST(n AS DOUBLE), 8) AS repeat_purchase_ratio, round(1 / (1 + sd), 8) AS rating_consistency,
  1.0::DOUBLE AS review_frequency_consistency, round(n / CAST(active AS DOUBLE), 8) AS reviews_per_day,
  round(short / CAST(n AS DOUBLE), 8) AS short_review_ratio, round(long / CAST(n AS DOUBLE), 8) AS long_review_ratio,
  round(n * 0.3 + tl * 0.001 + products / CAST(n AS DOUBLE) * 10 + n / CAST(active AS DOUBLE) * 5, 6) AS engagement_score,
  round(tl * 0.01 + 1 / (1 + sd) * 2 + (5 - abs(m - 3)) * 0.5, 6) AS review_quality_score FROM b)
"""


def _customers(spark, base):
    return segments.customer_features(lens.texts(spark, base), _as_of())


@query("a07_customer_features", CUSTOMERS + "SELECT * FROM customers")
def a07(spark, base):
    found = _customers(spark, base)
    plain = [name for name, dtype in found.dtypes if dtype == "double" and not name.endswith("_score")
             and name not in ("avg_rating", "rating_std")]
    return rounded(rounded(found, *plain), "engagement_score", "review_quality_score", digits=6)


@query("a08_rating_pivot", CUSTOMERS + "SELECT user_id, " + ", ".join(
    f"rating_{k}_count, rating_{k}_ratio" for k in range(1, 6)) + " FROM customers")
def a08(spark, base):
    columns = [f"rating_{k}_{part}" for k in range(1, 6) for part in ("count", "ratio")]
    return rounded(_customers(spark, base).select("user_id", *columns), *[name for name in columns if "ratio" in name])


# Clustering ---------------------------------------------------------------------------------------

NUMBERS = ["total_reviews", "avg_rating", "rating_std", "unique_products", "days_active", "reviews_per_day",
           "avg_text_length", "avg_sentiment", "engagement_score"]


@query("m01_feature_columns", with_sql("ratings") + """
, c AS (SELECT user_id, avg(rating) AS avg_rating, count(*) AS total_reviews, 1.0 AS constant FROM ratings GROUP BY 1)
SELECT name AS feature FROM (SELECT 'avg_rating' AS name, var_samp(avg_rating) AS v FROM c
UNION ALL SELECT 'total_reviews', var_samp(total_reviews) FROM c UNION ALL SELECT 'constant', var_samp(constant) FROM c) WHERE v > 1e-8""")
def m01(spark, base):
    users = lens.ratings(spark, base).groupBy("user_id").agg(
        F.avg("rating").alias("avg_rating"), F.count("*").alias("total_reviews")).withColumn("constant", F.lit(1.0))
    kept = clustering.feature_columns(users)
    return spark.createDataFrame([(name,) for name in kept], "feature string")


@query("m02_scaling")
def m02(spark, base):
    users = materialize(_customers(spark, base).select("user_id", *NUMBERS), "customers")
    result = None
    for method in ("standard", "minmax", "robust"):
        values = clustering.scaled_matrix(users, NUMBERS, method).select(
            F.posexplode(vector_to_array("features")).alias("at", "value"))
        part = values.groupBy("at").agg(F.round(F.avg("value"), 4).alias("mean"), F.round(F.min("value"), 4).alias("low"),
                                        F.round(F.max("value"), 4).alias("high")).withColumn("method", F.lit(method))
        result = part if result is None else result.unionByName(part)
    return result


_SCALED = ("l_quantity", "l_extendedprice", "l_discount")


@query("m02_scaled_columns", "SELECT * FROM (" + " UNION ALL ".join(f"""
SELECT {at} AS at, method, round(avg((x - shift) / scale), 6) AS mean, round(min((x - shift) / scale), 6) AS low, round(max((x - shift) / scale), 6) AS high
FROM (SELECT CAST({name} AS DOUBLE) AS x FROM lineitem), (SELECT 'standard' AS method, avg({name}) AS shift, stddev_samp({name}) AS scale FROM lineitem
      UNION ALL SELECT 'minmax', CAST(min({name}) AS DOUBLE), CAST(max({name}) - min({name}) AS DOUBLE) FROM lineitem) GROUP BY method"""
                                                                    for at, name in enumerate(_SCALED)) + ")")
def m02_columns(spark, base):
    rows = lens.table(spark, base, "lineitem").select(*_SCALED)
    result = None
    for method in ("standard", "minmax"):
        values = clustering.scaled_matrix(rows, _SCALED, method).select(F.posexplode(vector_to_array("features")).alias("at", "value"))
        part = values.groupBy("at").agg(F.round(F.avg("value"), 6).alias("mean"), F.round(F.min("value"), 6).alias("low"),
                                        F.round(F.max("value"), 6).alias("high")).withColumn("method", F.lit(method))
        result = part if result is None else result.unionByName(part)
    return rounded(result.withColumn("mean", F.col("mean") + 0.0), "mean", digits=6)


def _clustered(spark, base, method, k=5, n_init=3):
    users = materialize(_customers(spark, base).select("user_id", *NUMBERS), "customers")
    return clustering.perform_clustering(users, method, k, "standard", NUMBERS, n_init=n_init)


def _sizes(found):
    measures = [F.lit(float(value)).alias(name) for name, value in found.measures.items()]
    return found.rows.groupBy("cluster").agg(F.count("*").alias("size")).select("*", *measures)


@query("m03_kmeans")
def m03(spark, base):
    return _sizes(_clustered(spark, base, "kmeans"))


@query("m04_gaussian_mixture")
def m04(spark, base):
    return _sizes(_clustered(spark, base, "gmm"))


@query("m05_hierarchical")
def m05(spark, base):
    return _sizes(_clustered(spark, base, "agglomerative"))


@query("m06_spectral")
def m06(spark, base):
    return _sizes(_clustered(spark, base, "spectral"))


def _vectors(spark, base):
    vectors = lens.table(spark, base, "embeddings")
    return materialize(vectors.select("vec_id", "label", array_to_vector(F.col("embedding").cast("array<double>"))
                                      .alias("features")), "vectors")


@query("m07_cluster_metrics")
def m07(spark, base):
    rows = _vectors(spark, base).withColumnRenamed("label", "cluster")
    measures = clustering.cluster_metrics(rows)
    return rows.groupBy("cluster").agg(F.count("*").alias("size")).select(
        "*", *[F.lit(float(value)).alias(name) for name, value in measures.items()])


@query("m07_given_labels", """
WITH v AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS d FROM embeddings),
g AS (SELECT d, avg(x) AS m FROM v GROUP BY d), c AS (SELECT label, d, avg(x) AS m, count(*) AS n FROM v GROUP BY 1, 2),
dist AS (SELECT v.label, vec_id, sum((x - m) * (x - m)) AS q FROM v JOIN c ON v.label = c.label AND v.d = c.d GROUP BY 1, 2),
spread AS (SELECT label, avg(sqrt(q)) AS s, sum(q) AS w, count(*) AS n FROM dist GROUP BY 1),
gaps AS (SELECT a.label AS i, b.label AS j, sqrt(sum((a.m - b.m) * (a.m - b.m))) AS gap FROM c a JOIN c b ON a.d = b.d AND a.label <> b.label GROUP BY 1, 2),
worst AS (SELECT i, max((p.s + q.s) / gap) AS r FROM gaps JOIN spread p ON p.label = i JOIN spread q ON q.label = j GROUP BY i)
SELECT round((SELECT sum(n * (c.m - g.m) * (c.m - g.m)) FROM c JOIN g ON c.d = g.d) * (sum(n) - count(*)) / (sum(w) * (count(*) - 1)), 6) AS calinski_harabasz_score,
       round((SELECT avg(r) FROM worst), 6) AS davies_bouldin_score, CAST(sum(n) AS BIGINT) AS vectors FROM spread""")
def m07_given(spark, base):
    rows = _vectors(spark, base).withColumnRenamed("label", "cluster")
    measures = clustering.cluster_metrics(rows)
    return rows.agg(F.count("*").alias("vectors"), *[F.round(F.lit(float(measures[name])), 6).alias(name)
                                                     for name in ("calinski_harabasz_score", "davies_bouldin_score")])


@query("m08_optimal_clusters")
def m08(spark, base):
    users = materialize(_customers(spark, base).select("user_id", *NUMBERS), "customers")
    found = clustering.find_optimal_clusters(users, 5, "kmeans", NUMBERS)
    tried = F.array(*[F.struct(F.lit(row["k"]).alias("k"), F.lit(float(row["silhouette_score"])).alias("silhouette_score"),
                               F.lit(float(row["inertia"])).alias("inertia")) for row in found["metrics"]])
    return users.agg(F.count("*").alias("customers"), F.lit(found["optimal_clusters"]).alias("optimal_clusters"),
                     tried.alias("t")).select("customers", "optimal_clusters", F.inline("t"))


@query("m09_projection")
def m09(spark, base):
    rows = _vectors(spark, base).withColumnRenamed("label", "cluster")
    placed, variance = clustering.project_clusters(rows, "vec_id")
    return placed.select("vec_id", F.round("x", 4).alias("x"), F.round("y", 4).alias("y"), "cluster",
                         F.lit(variance[0]).alias("explained_x"), F.lit(variance[1]).alias("explained_y"))


PROFILE = ["o_totalprice", "o_custkey", "late"]


@query("m10_cluster_profile", """
WITH r AS (SELECT CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS cluster, o_totalprice, o_custkey,
           month(o_orderdate) % 3 AS late FROM orders),
g AS (SELECT count(*) AS n, avg(o_totalprice) AS o_totalprice, avg(o_custkey) AS o_custkey, avg(late) AS late FROM r),
c AS (SELECT cluster, count(*) AS size, avg(o_totalprice) AS o_totalprice, avg(o_custkey) AS o_custkey, avg(late) AS late
      FROM r GROUP BY 1),
l AS (""" + " UNION ALL ".join(f"""SELECT c.cluster, c.size, c.size * 100.0 / g.n AS percentage, '{name}' AS feature,
  c.{name} AS m, g.{name} AS gm FROM c CROSS JOIN g""" for name in PROFILE) + """)
SELECT cluster, size, round(percentage, 8) AS percentage, feature, round(m, 4) AS cluster_mean, round(gm, 4) AS global_mean,
       round(abs(m - gm) / abs(gm), 8) AS difference, CASE WHEN m > gm THEN 'High ' ELSE 'Low ' END || replace(feature, '_', ' ')
       AS characteristic FROM l""")
def m10(spark, base):
    status = F.col("o_orderstatus")
    rows = lens.table(spark, base, "orders").select(
        F.when(status == "F", 0).when(status == "O", 1).otherwise(2).alias("cluster"), "o_totalprice", "o_custkey",
        (F.month("o_orderdate") % 3).alias("late"))
    found = clustering.analyze_clusters(rows, PROFILE).drop("rank")
    return rounded(rounded(found, "percentage", "difference"), "cluster_mean", "global_mean", digits=4)


@query("o04_distinguishing_features")
def o04(spark, base):
    found = _clustered(spark, base, "kmeans", 3, 1)
    return clustering.analyze_clusters(found.rows, found.columns, 5).select(
        "cluster", "feature", "rank", r8("difference").alias("difference"), "characteristic")


# Segments -----------------------------------------------------------------------------------------

WORDS = f"len({words_sql('review_text')})"
HELPFUL = "helpful_votes / (total_votes + 1e-5)"


@query("g01_segment_base", with_sql("texts") + f"""
SELECT review_id, CAST({WORDS} AS INTEGER) AS review_length, round({HELPFUL}, 6) AS helpfulness_ratio,
       CAST(rating >= 4 AS INTEGER) AS is_positive FROM texts""")
def g01(spark, base):
    found = segments.segmentation_features(_texts(spark, base))
    return found.select("review_id", "review_length", F.round("helpfulness_ratio", 6).alias("helpfulness_ratio"), "is_positive")


def _segment_sql(key: str, minimum: int, extra: str = "") -> str:
    return f"""SELECT {key}, round(avg(rating), 8) AS avg_score, round(stddev_samp(rating), 8) AS score_std,
      count(rating) AS review_count, round(avg({WORDS}), 8) AS avg_review_length, round(avg({HELPFUL}), 8) AS avg_helpfulness,
      round(avg(sentiment_score), 8) AS avg_sentiment{extra} FROM texts GROUP BY 1 HAVING count(rating) >= {minimum}"""


def _segment_rows(spark, base):
    return segments.segmentation_features(_texts(spark, base))


@query("g02_user_segment_features", with_sql("texts") + _segment_sql("user_id", 2))
def g02(spark, base):
    return segments.user_segment_features(_segment_rows(spark, base), digits=8)


@query("g03_product_segment_features", with_sql("texts") + _segment_sql(
    "product_id", 3, ", round(avg(CAST(rating >= 4 AS INTEGER)), 8) AS positive_ratio"))
def g03(spark, base):
    return segments.product_segment_features(_segment_rows(spark, base), digits=8)


def _segmented(rows, columns, per_segment):
    stored = materialize(rows, "segment-rows")
    k = segments.segment_count(stored.count(), per_segment)
    return clustering.perform_clustering(stored, "kmeans", k, "standard", columns, n_init=1, with_metrics=False).rows


@query("g02_user_segments")
def g02_segments(spark, base):
    rows = segments.user_segment_features(_segment_rows(spark, base))
    clustered = _segmented(rows, ["avg_score", "score_std", "review_count", "avg_review_length", "avg_helpfulness",
                                  "avg_sentiment"], 20)
    return rounded(segments.name_user_segments(clustered), "avg_score", "avg_reviews", digits=4)


@query("g03_product_segments")
def g03_segments(spark, base):
    rows = segments.product_segment_features(_segment_rows(spark, base))
    clustered = _segmented(rows, ["avg_score", "score_std", "review_count", "avg_review_length", "positive_ratio",
                                  "avg_helpfulness", "avg_sentiment"], 30)
    return rounded(segments.name_product_segments(clustered), "avg_score", "avg_reviews", "score_std", digits=4)


@query("g04_review_segments")
def g04_segments(spark, base):
    rows = materialize(segments.review_segment_features(_segment_rows(spark, base)), "segment-rows")
    columns = ["score", "review_length", "helpfulness_ratio", "sentiment_score", "sentiment_magnitude"]
    found = clustering.perform_clustering(rows, "kmeans", 4, "standard", columns, n_init=1, with_metrics=False)
    return rounded(segments.name_review_segments(found.rows), "avg_score", "avg_length", "avg_sentiment", digits=4)


@query("g05_name_user_segments", with_sql("ratings") + """
, u AS (SELECT user_id, avg(rating) AS s, count(*) AS n FROM ratings GROUP BY 1),
c AS (SELECT user_id % 4 AS cluster, count(*) AS users, avg(s + user_id % 4 - 1) AS s, avg(n - 10 * (user_id % 4)) AS n FROM u GROUP BY 1)
SELECT cluster, users, round(s, 8) AS avg_score, round(n, 8) AS avg_reviews, CASE WHEN s >= 4.5 AND n >= 10 THEN 'Super Fans'
  WHEN s >= 4.5 THEN 'Happy Customers' WHEN s <= 2.5 THEN 'Harsh Critics' WHEN n >= 15 THEN 'Prolific Reviewers'
  ELSE 'Moderate Users' END AS segment FROM c""")
def g05(spark, base):
    users = lens.ratings(spark, base).groupBy("user_id").agg(F.avg("rating").alias("s"), F.count("*").alias("n"))
    cluster = F.col("user_id") % 4
    return rounded(segments.name_user_segments(users.select(
        cluster.alias("cluster"), (F.col("s") + cluster - 1).alias("avg_score"),
        (F.col("n") - 10 * cluster).alias("review_count"))), "avg_score", "avg_reviews")


@query("g06_name_product_segments", with_sql("product_ratings") + """
, u AS (SELECT product_id, avg(rating) AS s, count(*) AS n, stddev_samp(rating) AS sd FROM product_ratings GROUP BY 1),
c AS (SELECT product_id % 4 AS cluster, count(*) AS products, avg(s + product_id % 4 - 1) AS s, avg(n) AS n,
      avg(sd * (product_id % 4) / 2) AS sd FROM u GROUP BY 1)
SELECT cluster, products, round(s, 8) AS avg_score, round(n, 8) AS avg_reviews, round(sd, 8) AS score_std,
  CASE WHEN s >= 4.5 AND sd <= 0.5 THEN 'Universally Loved' WHEN s <= 2.5 THEN 'Poorly Received' WHEN sd >= 1.5 THEN 'Controversial'
  WHEN n >= 50 THEN 'Popular Products' ELSE 'Average Products' END AS segment FROM c""")
def g06(spark, base):
    products = lens.product_ratings(spark, base).groupBy("product_id").agg(
        F.avg("rating").alias("s"), F.count("*").alias("n"), F.stddev_samp("rating").alias("sd"))
    cluster = F.col("product_id") % 4
    return rounded(segments.name_product_segments(products.select(
        cluster.alias("cluster"), (F.col("s") + cluster - 1).alias("avg_score"), F.col("n").alias("review_count"),
        (F.col("sd") * cluster / 2).alias("score_std"))), "avg_score", "avg_reviews", "score_std")


@query("g07_name_review_segments", with_sql("texts") + f"""
, c AS (SELECT review_id % 5 AS cluster, count(*) AS reviews, avg(least(5, rating + review_id % 5)) AS s, avg({WORDS} * (review_id % 3) / 10.0) AS n,
        avg(sentiment_score * (review_id % 5)) AS t FROM texts GROUP BY 1)
SELECT cluster, reviews, round(s, 8) AS avg_score, round(n, 8) AS avg_length, round(t, 8) AS avg_sentiment,
  CASE WHEN n >= 100 AND abs(t) >= 0.3 THEN 'Detailed & Emotional' WHEN n <= 20 THEN 'Brief Reviews' WHEN abs(t) >= 0.5 THEN 'Emotional Reviews'
  WHEN s >= 4.5 THEN 'Enthusiastic Reviews' ELSE 'Balanced Reviews' END AS segment FROM c""")
def g07(spark, base):
    key = F.col("review_id")
    rows = _segment_rows(spark, base).select(
        (key % 5).alias("cluster"), F.least(F.lit(5), F.col("rating") + key % 5).alias("score"),
        (F.col("review_length") * (key % 3) / 10).alias("review_length"),
        (F.col("sentiment_score") * (key % 5)).alias("sentiment_score"))
    return rounded(segments.name_review_segments(rows), "avg_score", "avg_length", "avg_sentiment")
