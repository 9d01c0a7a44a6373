"""Predicates, joins, aggregates, windows, sorting and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewlake import lens
from reviewlake.lens import with_sql
from reviewlake.operators import documents, features, ranks, relational, standardize, summaries
from reviewlake.operators.cleaning import remove_duplicates
from reviewlake.functions.text import truncate
from reviewlake.operators.segments import frequency_consistency, segmentation_features
from reviewlake.plans.registry import day, query, r8, rounded, second

# Projection, predicates, limits -------------------------------------------------------------------


@query("p01_projection", "SELECT o_orderkey, o_custkey FROM orders")
def p01(spark, base):
    return relational.project(lens.table(spark, base, "orders"), ["o_orderkey", "o_custkey", "no_such_column"])


@query("p02_predicates", """
SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem
WHERE l_returnflag IN ('A', 'N') AND l_quantity >= 45 AND l_discount <= 0.02 AND l_linestatus <> 'O'""")
def p02(spark, base):
    filters = [("l_returnflag", "in", ["A", "N"]), ("l_quantity", ">=", 45.0), ("l_discount", "<=", 0.02),
               ("l_linestatus", "!=", "O")]
    return relational.read_with(lens.table(spark, base, "lineitem"),
                                ["l_orderkey", "l_linenumber", "l_quantity", "l_returnflag"], filters)


@query("p03_conjunction", """
SELECT o_orderstatus, count(*) AS orders FROM orders
WHERE o_totalprice > 100000 AND o_totalprice < 300000 AND o_orderpriority = '1-URGENT' GROUP BY 1""")
def p03(spark, base):
    filters = [("o_totalprice", ">", 100000.0), ("o_totalprice", "<", 300000.0), ("o_orderpriority", "==", "1-URGENT")]
    return (lens.table(spark, base, "orders").where(relational.predicate(filters))
            .groupBy("o_orderstatus").agg(F.count("*").alias("orders")))


@query("p04_head_limit", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def p04(spark, base):
    return (lens.table(spark, base, "orders").select("o_orderkey", "o_totalprice")
            .orderBy(F.desc("o_totalprice"), "o_orderkey").limit(100))


@query("p05_standard_names", """
SELECT doc_id AS user_id, text AS review_text, CAST(n_chars AS DOUBLE) AS rating FROM documents WHERE lang = 'en'""")
def p05(spark, base):
    upload = lens.table(spark, base, "documents").where("lang = 'en'").select(
        F.col("doc_id").alias(" Customer_ID "), F.col("text").alias("Text"), F.col("lang").alias("content"),
        F.col("n_chars").cast("double").alias("Stars"))
    return standardize.standardize_names(upload)


@query("p06_required_columns", """
SELECT count(*) AS "rows", 'review_text' AS missing, 'document_text' AS candidates FROM documents
UNION ALL SELECT count(*), 'rating', '' FROM documents""")
def p06(spark, base):
    upload = lens.table(spark, base, "documents").withColumnRenamed("text", "document_text")
    missing = standardize.missing_columns(upload)
    rows = [F.struct(F.lit(name).alias("missing"), F.lit(",".join(found)).alias("candidates"))
            for name, found in missing.items()]
    return upload.agg(F.count("*").alias("rows"), F.array(*rows).alias("m")).select("rows", F.inline("m"))


@query("p07_valid_ratings", with_sql("dirty") + """
SELECT row_key, CAST(rating AS DOUBLE) AS rating FROM dirty WHERE rating BETWEEN 1 AND 5""")
def p07(spark, base):
    df = lens.dirty(spark, base).select("row_key", F.col("rating").cast("string").alias("rating"))
    return standardize.valid_ratings(df)


@query("p08_nonblank_text", with_sql("dirty") + "SELECT row_key FROM dirty WHERE trim(review_text) <> ''")
def p08(spark, base):
    return standardize.with_text(lens.dirty(spark, base)).select("row_key")


@query("p09_date_parsing", """
SELECT event_id, CASE WHEN event_id % 7 = 0 THEN NULL ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS created_at
FROM events""")
def p09(spark, base):
    text = F.when(F.col("event_id") % 7 == 0, "not a date").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    df = lens.table(spark, base, "events").select("event_id", text.alias("created_at"))
    return standardize.parse_dates(df).select("event_id", second("created_at").alias("created_at"))


@query("p10_period_and_rating", with_sql("product_ratings") + """
SELECT rating, count(*) AS reviews FROM product_ratings
WHERE created_at >= TIMESTAMP '1997-01-01' AND created_at < TIMESTAMP '1999-01-01' AND rating IN (4, 5) GROUP BY 1""")
def p10(spark, base):
    reviews = lens.product_ratings(spark, base)
    chosen = standardize.in_period(F.col("created_at"), "1997-01-01", "1998-12-31") & F.col("rating").isin(4, 5)
    return reviews.where(chosen).groupBy("rating").agg(F.count("*").alias("reviews"))


@query("p11_filtered_page", """
SELECT p_partkey, p_name, p_type, (SELECT count(*) FROM part WHERE lower(p_type) = 'economy') AS total
FROM part WHERE lower(p_type) = 'economy' ORDER BY p_partkey LIMIT 25 OFFSET 10""")
def p11(spark, base):
    part = lens.table(spark, base, "part")
    page, total = relational.page(part, ["p_partkey"], 10, 25, equals_ignoring_case={"p_type": "Economy"})
    return page.select("p_partkey", "p_name", "p_type", total.scalar().alias("total"))


@query("p12_privacy_projection", "SELECT c_custkey AS user_id, c_name AS username FROM customer")
def p12(spark, base):
    users = lens.table(spark, base, "customer").withColumnsRenamed({"c_custkey": "user_id", "c_name": "username"})
    return relational.project(users, ["user_id", "username", "registration_date", "is_verified", "total_orders"])


@query("p13_point_lookup", "SELECT * FROM part WHERE p_partkey = 42")
def p13(spark, base):
    return relational.get_one(lens.table(spark, base, "part"), "p_partkey", 42)


@query("p14_document_find", """
SELECT p_partkey AS product_id, p_retailprice AS price, p_size AS size FROM part
WHERE p_size >= 10 AND list_contains(string_split(p_name, ' '), 'red')
ORDER BY p_retailprice DESC, p_partkey LIMIT 20 OFFSET 3""")
def p14(spark, base):
    products = lens.table(spark, base, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_retailprice").alias("price"),
        F.split("p_name", " ").alias("tags"),
        F.struct(F.col("p_size").alias("size"), F.col("p_brand").alias("brand")).alias("specifications"))
    condition = (F.col("specifications.size") >= 10) & F.array_contains("tags", "red")
    return relational.find(products, condition, ["product_id", "price", "specifications.size"],
                           [F.desc("price"), F.asc("product_id")], 3, 20)


@query("p15_config_validation", with_sql("dirty") + """
, counts AS (SELECT count(*) FILTER (user_id IS NULL) AS users, count(*) FILTER (rating IS NULL) AS ratings,
                    count(*) FILTER (rating < 1) AS low, count(*) FILTER (rating > 5) AS high FROM dirty)
SELECT * FROM (
  SELECT 'required' AS "check", 'title' AS "column", 1 AS found FROM counts
  UNION ALL SELECT 'non_null', 'user_id', users FROM counts UNION ALL SELECT 'non_null', 'rating', ratings FROM counts
  UNION ALL SELECT 'type', 'review_text', 1 FROM counts
  UNION ALL SELECT 'minimum', 'rating', low FROM counts UNION ALL SELECT 'maximum', 'rating', high FROM counts)
WHERE found > 0""")
def p15(spark, base):
    rules = {"required_columns": ["title", "rating"], "non_null_columns": ["user_id", "rating"],
             "column_types": {"review_text": "numeric", "created_at": "datetime"},
             "value_ranges": {"rating": {"min": 1, "max": 5}}, "check_duplicates": True}
    return standardize.validate_dataframe(lens.dirty(spark, base), rules).drop("message")


@query("p16_config_cleaning", """
SELECT DISTINCT o_custkey % 50 AS customer, CASE WHEN o_orderkey % 3 = 0 THEN 'none' ELSE o_orderstatus END AS status,
       TRY_CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS priority FROM orders""")
def p16(spark, base):
    orders = lens.table(spark, base, "orders").select(
        (F.col("o_custkey") % 50).alias("customer"),
        F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderstatus")).alias("status"),
        F.substring("o_orderpriority", 1, 1).alias("priority"))
    return standardize.clean_dataframe(orders, {
        "remove_duplicates": True, "fill_null_values": {"status": "none"},
        "type_conversions": {"priority": "numeric"}}).distinct()


@query("p17_minimum_data", with_sql("dirty") + """
SELECT count(*) AS total_rows, count(*) FILTER (NOT coalesce(rating BETWEEN 1 AND 5, false)) AS bad_ratings,
       CASE WHEN count(*) < 10 THEN false
            ELSE count(*) FILTER (NOT coalesce(rating BETWEEN 1 AND 5, false)) <= count(*) * 0.1 END AS is_valid
FROM dirty""")
def p17(spark, base):
    return standardize.validate_data(lens.dirty(spark, base), "reviews").drop("message")


# Joins --------------------------------------------------------------------------------------------

_PRODUCTS = """products AS (SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
                                  p_brand AS brand FROM part)"""


def _products(spark, base):
    return lens.table(spark, base, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"), F.col("p_brand").alias("brand"))


def _users(spark, base):
    return lens.table(spark, base, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_name").alias("username"),
        F.col("c_mktsegment").alias("location"), F.col("c_acctbal").alias("balance"))


@query("j01_products_left_reviews", with_sql("product_ratings") + ", " + _PRODUCTS + """
SELECT p.product_id, p.brand, count(r.review_id) AS total_reviews, round(avg(r.rating), 8) AS average_rating
FROM products p LEFT JOIN product_ratings r ON p.product_id = r.product_id GROUP BY 1, 2""")
def j01(spark, base):
    summary = summaries.product_review_summary(_products(spark, base), lens.product_ratings(spark, base), ["brand"])
    return rounded(summary.select("product_id", "brand", "total_reviews", "average_rating"), "average_rating")


@query("j02_users_reviews_activity", with_sql("ratings") + """
SELECT c_custkey AS user_id, c_mktsegment AS location, count(DISTINCT r.review_id) AS total_reviews,
       round(avg(r.rating), 8) AS average_rating_given, count(DISTINCT e.event_id) AS total_activities
FROM customer LEFT JOIN ratings r ON c_custkey = r.user_id LEFT JOIN events e ON c_custkey = e.user_id
GROUP BY 1, 2""")
def j02(spark, base):
    activity = lens.table(spark, base, "events").select(
        "user_id", F.col("event_id").alias("activity_id"), F.col("ts").alias("activity_timestamp"))
    summary = summaries.user_engagement_summary(_users(spark, base), lens.ratings(spark, base), activity, ["location"])
    return rounded(summary.select("user_id", "location", "total_reviews", "average_rating_given", "total_activities"),
                   "average_rating_given")


@query("j03_user_stats_to_rows", with_sql("ratings") + """
, stats AS (SELECT user_id, count(*) AS n, round_even(avg(rating), 3) AS m FROM ratings GROUP BY 1)
SELECT user_avg_rating, count(*) AS reviews, CAST(sum(user_review_count) AS BIGINT) AS weight FROM (
  SELECT r.review_id, s.m AS user_avg_rating, s.n AS user_review_count
  FROM ratings r LEFT JOIN stats s ON r.user_id = s.user_id) GROUP BY 1""")
def j03(spark, base):
    reviews = lens.ratings(spark, base)
    rows = features.extract_user_features(reviews.select("review_id", "user_id", "rating"), date=None)
    return rows.groupBy("user_avg_rating").agg(F.count("*").alias("reviews"),
                                               F.sum("user_review_count").alias("weight"))


@query("j04_product_stats_to_rows", with_sql("product_ratings") + """
, stats AS (SELECT product_id, count(*) AS n FROM product_ratings GROUP BY 1)
SELECT product_category, rating, count(*) AS reviews FROM (
  SELECT rating, CASE WHEN n <= 5 THEN 'niche' WHEN n <= 20 THEN 'moderate' WHEN n <= 50 THEN 'popular'
                      ELSE 'bestseller' END AS product_category
  FROM product_ratings r LEFT JOIN stats s ON r.product_id = s.product_id) GROUP BY 1, 2""")
def j04(spark, base):
    reviews = lens.product_ratings(spark, base).select("product_id", "rating", "created_at")
    rows = features.extract_product_features(reviews)
    return rows.groupBy("product_category", "rating").agg(F.count("*").alias("reviews"))


@query("j05_joined_aggregates", with_sql("ratings") + """
SELECT a.user_id, a.n AS reviews, b.days FROM (SELECT user_id, count(*) AS n FROM ratings GROUP BY 1) a
JOIN (SELECT user_id, date_diff('day', min(created_at), max(created_at)) AS days FROM ratings GROUP BY 1) b
ON a.user_id = b.user_id""")
def j05(spark, base):
    stats = features.user_features(lens.ratings(spark, base))
    return stats.select("user_id", F.col("user_review_count").alias("reviews"),
                        F.col("user_activity_span_days").alias("days"))


@query("j06_demographics", with_sql("ratings") + """
SELECT r.user_id, r.n AS reviews, c_name AS username, c_mktsegment AS location, c_acctbal AS balance
FROM (SELECT user_id, count(*) AS n FROM ratings GROUP BY 1) r LEFT JOIN customer ON c_custkey = r.user_id""")
def j06(spark, base):
    stats = lens.ratings(spark, base).groupBy("user_id").agg(F.count("*").alias("reviews"))
    return stats.join(_users(spark, base), "user_id", "left")


@query("j07_orphan_keys", """
SELECT user_id, count(*) AS "rows" FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 3 <> 0)
GROUP BY 1""")
def j07(spark, base):
    parents = lens.table(spark, base, "customer").where("c_custkey % 3 <> 0")
    return relational.orphans(lens.table(spark, base, "events"), "user_id", parents, "c_custkey")


@query("j08_global_scalar", with_sql("product_ratings") + """
SELECT date_diff('day', created_at, (SELECT max(created_at) FROM product_ratings)) AS days_since_latest,
       count(*) AS reviews FROM product_ratings GROUP BY 1""")
def j08(spark, base):
    reviews = lens.product_ratings(spark, base)
    aged = features.extract_temporal_features(reviews.select("created_at"))
    return aged.groupBy("days_since_latest").agg(F.count("*").alias("reviews"))


# Aggregates ---------------------------------------------------------------------------------------


@query("a01_product_review_summary", with_sql("product_ratings") + ", " + _PRODUCTS + """
SELECT p.product_id, p.product_name, p.category, p.brand, count(r.review_id) AS total_reviews,
       round(avg(r.rating), 8) AS average_rating,
       CAST(sum(CASE WHEN r.sentiment_label = 'positive' THEN 1 ELSE 0 END) AS BIGINT) AS positive_reviews,
       CAST(sum(CASE WHEN r.sentiment_label = 'negative' THEN 1 ELSE 0 END) AS BIGINT) AS negative_reviews,
       CAST(sum(CASE WHEN r.sentiment_label = 'neutral' THEN 1 ELSE 0 END) AS BIGINT) AS neutral_reviews,
       strftime(max(r.created_at), '%Y-%m-%d') AS latest_review_date
FROM products p LEFT JOIN product_ratings r ON p.product_id = r.product_id GROUP BY 1, 2, 3, 4""")
def a01(spark, base):
    summary = summaries.product_review_summary(_products(spark, base), lens.product_ratings(spark, base))
    return rounded(summary, "average_rating").withColumn("latest_review_date", day("latest_review_date"))


@query("a02_user_engagement", with_sql("ratings") + """
, r AS (SELECT user_id, count(DISTINCT review_id) AS n, avg(rating) AS m, count(DISTINCT product_id) AS p
        FROM ratings GROUP BY 1),
a AS (SELECT user_id, count(DISTINCT event_id) AS n, max(ts) AS last FROM events GROUP BY 1)
SELECT c_custkey AS user_id, c_name AS username, c_mktsegment AS location, coalesce(r.n, 0) AS total_reviews,
       round(r.m, 8) AS average_rating_given, coalesce(a.n, 0) AS total_activities,
       strftime(a.last, '%Y-%m-%d %H:%M:%S') AS last_activity_date, coalesce(r.p, 0) AS products_reviewed
FROM customer LEFT JOIN r ON c_custkey = r.user_id LEFT JOIN a ON c_custkey = a.user_id""")
def a02(spark, base):
    activity = lens.table(spark, base, "events").select(
        "user_id", F.col("event_id").alias("activity_id"), F.col("ts").alias("activity_timestamp"))
    summary = summaries.user_engagement_summary(_users(spark, base), lens.ratings(spark, base), activity)
    return rounded(summary, "average_rating_given").withColumn("last_activity_date", second("last_activity_date"))


@query("a03_daily_trends", with_sql("product_ratings") + """
SELECT strftime(created_at, '%Y-%m-%d') AS review_date, count(*) AS total_reviews,
       round(avg(rating), 8) AS average_rating, count(*) FILTER (sentiment_label = 'positive') AS positive_count,
       count(*) FILTER (sentiment_label = 'negative') AS negative_count,
       count(*) FILTER (sentiment_label = 'neutral') AS neutral_count
FROM product_ratings GROUP BY 1 ORDER BY 1 DESC""")
def a03(spark, base):
    trends = summaries.daily_review_trends(lens.product_ratings(spark, base))
    return rounded(trends, "average_rating").withColumn("review_date", day("review_date"))


def _stats_sql(table: str, columns: list[str]) -> str:
    return " UNION ALL ".join(f"""SELECT '{name}' AS "column", count(*) AS "rows", CAST(min({name}) AS DOUBLE) AS minimum,
        CAST(max({name}) AS DOUBLE) AS maximum, round(avg({name}), 4) AS average,
        count(DISTINCT {name}) AS distinct_values FROM {table}""" for name in columns)


@query("a04_table_stats", _stats_sql("lineitem", [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]))
def a04(spark, base):
    return rounded(summaries.table_stats(lens.table(spark, base, "lineitem")), "average", digits=4)


@query("a04_row_counts", " UNION ALL ".join(
    f"""SELECT '{name}' AS "table", count(*) AS "rows" FROM {name}""" for name in ("orders", "customer", "part")))
def a04_counts(spark, base):
    return summaries.row_counts({name: lens.table(spark, base, name) for name in ("orders", "customer", "part")})


@query("a05_user_stats", with_sql("ratings") + """
SELECT user_id, n AS user_review_count, m AS user_avg_rating, s AS user_rating_std, lo AS user_min_rating,
       hi AS user_max_rating, hi - lo AS user_rating_range, CAST(m < 3 AS INTEGER) AS user_is_harsh_reviewer,
       CAST(m > 4 AS INTEGER) AS user_is_generous_reviewer, d AS user_activity_span_days,
       round(n / (d + 1.0), 8) AS user_review_frequency
FROM (SELECT user_id, count(*) AS n, round_even(avg(rating), 3) AS m,
             coalesce(round_even(stddev_samp(rating), 3), 0) AS s, min(rating) AS lo, max(rating) AS hi,
             date_diff('day', min(created_at), max(created_at)) AS d FROM ratings GROUP BY 1)""")
def a05(spark, base):
    return rounded(features.user_features(lens.ratings(spark, base)).drop("user_experience_level"),
                   "user_review_frequency")


_PRODUCT_STATS = with_sql("product_ratings") + """
, s AS (SELECT product_id, count(*) AS n, round_even(avg(rating), 3) AS m,
               coalesce(round_even(stddev_samp(rating), 3), 0) AS sd, min(rating) AS lo, max(rating) AS hi,
               min(created_at) AS oldest, max(created_at) AS youngest FROM product_ratings GROUP BY 1),
latest AS (SELECT max(created_at) AS newest FROM product_ratings),
product_features AS (
SELECT product_id, n AS product_review_count, m AS product_avg_rating, sd AS product_rating_std,
       lo AS product_min_rating, hi AS product_max_rating, hi - lo AS product_rating_range,
       CAST(sd > 1.5 AS INTEGER) AS product_is_controversial, CAST(m > 4 AS INTEGER) AS product_is_highly_rated,
       CAST(m < 2.5 AS INTEGER) AS product_is_poorly_rated,
       CAST(dense_rank() OVER (ORDER BY n DESC) AS DOUBLE) AS product_popularity_rank,
       date_diff('day', oldest, newest) AS product_age_days, date_diff('day', youngest, newest) AS product_days_since_last_review,
       CASE WHEN n <= 5 THEN 'niche' WHEN n <= 20 THEN 'moderate' WHEN n <= 50 THEN 'popular'
            ELSE 'bestseller' END AS product_category FROM s CROSS JOIN latest)
"""


@query("a06_product_stats", _PRODUCT_STATS + """
SELECT product_id, product_review_count, product_avg_rating, product_rating_std, product_is_controversial,
       product_is_highly_rated, product_is_poorly_rated FROM product_features""")
def a06(spark, base):
    stats = features.product_features(lens.product_ratings(spark, base))
    return stats.select("product_id", "product_review_count", "product_avg_rating", "product_rating_std",
                        "product_is_controversial", "product_is_highly_rated", "product_is_poorly_rated")


@query("a09_document_product_group", with_sql("product_ratings") + """
SELECT product_id, count(*) AS total_reviews, round(avg(rating), 8) AS average_rating,
       strftime(max(created_at), '%Y-%m-%d') AS latest_review, count(*) FILTER (verified_purchase) AS verified_reviews,
       count(*) FILTER (sentiment_label = 'positive') AS positive,
       count(*) FILTER (sentiment_label = 'negative') AS negative,
       count(*) FILTER (sentiment_label = 'neutral') AS neutral FROM product_ratings GROUP BY 1""")
def a09(spark, base):
    groups = summaries.run_analytics("product_analytics", lens.product_ratings(spark, base))
    return rounded(groups, "average_rating").withColumn("latest_review", day("latest_review"))


@query("a10_document_user_group", with_sql("ratings") + """
SELECT user_id, count(*) AS total_reviews, round(avg(rating), 8) AS average_rating_given,
       count(DISTINCT product_id) AS products_reviewed_count,
       count(*) FILTER (sentiment_label = 'positive') AS positive_given,
       count(*) FILTER (sentiment_label = 'negative') AS negative_given,
       count(*) FILTER (sentiment_label = 'neutral') AS neutral_given,
       round(date_diff('microsecond', min(created_at), max(created_at)) / 86400000000.0, 8) AS review_frequency_days
FROM ratings GROUP BY 1""")
def a10(spark, base):
    return rounded(summaries.run_analytics("user_analytics", lens.ratings(spark, base)),
                   "average_rating_given", "review_frequency_days")


@query("a11_stage_list", with_sql("product_ratings") + """
SELECT product_id, total, positive, round(positive / CAST(total AS DOUBLE), 8) AS share FROM (
  SELECT product_id, count(*) AS total, count(*) FILTER (sentiment_label = 'positive') AS positive
  FROM product_ratings GROUP BY 1)""")
def a11(spark, base):
    positive = F.count_if(F.col("sentiment_label") == "positive")
    return summaries.aggregate(lens.product_ratings(spark, base), [
        lambda df: df.groupBy("product_id").agg(F.count("*").alias("total"), positive.alias("positive")),
        lambda df: df.withColumn("share", r8(F.col("positive") / F.col("total"))),
        lambda df: df.select("product_id", "total", "positive", "share")])


@query("a12_monthly_products", with_sql("product_ratings") + """
SELECT product_id, CAST(year(created_at) AS INTEGER) AS year, CAST(month(created_at) AS INTEGER) AS month,
       round(avg(rating), 8) AS rating, round(avg(sentiment_score), 8) AS sentiment_score,
       count(review_id) AS review_count FROM product_ratings GROUP BY 1, 2, 3""")
def a12(spark, base):
    return rounded(summaries.monthly_product_summary(lens.product_ratings(spark, base)), "rating", "sentiment_score")


@query("a13_product_summary", with_sql("product_ratings") + """
SELECT product_id, round(avg(rating), 8) AS rating, round(avg(sentiment_score), 8) AS sentiment_score,
       count(review_id) AS review_count FROM product_ratings GROUP BY 1""")
def a13(spark, base):
    return rounded(summaries.product_summary(lens.product_ratings(spark, base)), "rating", "sentiment_score")


@query("a14_overview", with_sql("ratings") + """
SELECT count(*) AS total_reviews, round(avg(rating), 8) AS average_rating, round(avg(rating) - 3, 8) AS rating_delta,
       count(DISTINCT product_id) AS unique_products, count(DISTINCT user_id) AS unique_users FROM ratings""")
def a14(spark, base):
    return rounded(summaries.overview(lens.ratings(spark, base)), "average_rating", "rating_delta")


@query("a15_sentiment_distribution", with_sql("product_ratings") + """
SELECT sentiment_label, count(*) AS count, round(count(*) * 100.0 / (SELECT count(*) FROM product_ratings), 8) AS percentage
FROM product_ratings GROUP BY 1""")
def a15(spark, base):
    return rounded(summaries.distribution(lens.product_ratings(spark, base), "sentiment_label"), "percentage")


@query("a16_sentiment_over_time", with_sql("product_ratings") + """
SELECT strftime(created_at, '%Y-%m-%d') AS date, round(avg(sentiment_score), 8) AS avg_sentiment,
       round(stddev_samp(sentiment_score), 8) AS sentiment_std, count(*) AS review_count
FROM product_ratings GROUP BY 1""")
def a16(spark, base):
    days = summaries.daily(lens.product_ratings(spark, base), "sentiment_score", "avg_sentiment", "sentiment_std")
    return rounded(days, "avg_sentiment", "sentiment_std").withColumn("date", day("date"))


@query("a16_sentiment_band", with_sql("texts") + """
SELECT date, a AS avg_sentiment, s AS sentiment_std, n AS review_count, round(a + s, 8) AS upper, round(a - s, 8) AS lower
FROM (SELECT strftime(created_at, '%Y-%m-%d') AS date, round_even(avg(sentiment_score), 3) AS a,
             round_even(stddev_samp(sentiment_score), 3) AS s, count(*) AS n FROM texts GROUP BY 1)""")
def a16_band(spark, base):
    band = summaries.sentiment_over_time(lens.texts(spark, base))
    return rounded(band, "upper", "lower").withColumn("date", day("date"))


@query("a17_rating_distribution", with_sql("product_ratings") + """
SELECT rating, count(*) AS count, round(count(*) * 100.0 / (SELECT count(*) FROM product_ratings), 8) AS percentage
FROM product_ratings GROUP BY 1""")
def a17(spark, base):
    return rounded(summaries.distribution(lens.product_ratings(spark, base), "rating"), "percentage")


@query("a18_rating_trends", with_sql("product_ratings") + """
SELECT strftime(created_at, '%Y-%m-%d') AS date, round(avg(rating), 8) AS avg_rating,
       round(stddev_samp(rating), 8) AS rating_std, count(*) AS review_count FROM product_ratings GROUP BY 1""")
def a18(spark, base):
    return rounded(summaries.rating_trends(lens.product_ratings(spark, base)), "avg_rating", "rating_std").withColumn(
        "date", day("date"))


@query("a19_rating_by_category", with_sql("product_ratings") + """
SELECT p_type AS category, round(avg(rating), 8) AS avg_rating, count(rating) AS review_count,
       round(stddev_samp(rating), 8) AS rating_std FROM product_ratings JOIN part ON p_partkey = product_id
GROUP BY 1 ORDER BY 2, 1""")
def a19(spark, base):
    # Reviews are reduced per product and rating before the category is looked up.
    per_product = lens.product_ratings(spark, base).groupBy("product_id", "rating").agg(F.count("*").alias("n"))
    joined = per_product.join(_products(spark, base).select("product_id", "category"), "product_id")
    n, rating = F.col("n"), F.col("rating")
    total, first, second_ = F.sum("n"), F.sum(rating * n), F.sum(rating * rating * n)
    variance = (second_ - first * first / total) / (total - 1)
    return joined.groupBy("category").agg(
        r8(first / total).alias("avg_rating"), total.alias("review_count"),
        r8(F.sqrt(variance)).alias("rating_std")).orderBy("avg_rating", "category")


@query("a20_sentiment_by_rating", with_sql("product_ratings") + """
SELECT rating, round(avg(sentiment_score), 8) AS sentiment_score FROM product_ratings GROUP BY 1""")
def a20(spark, base):
    return rounded(summaries.mean_by(lens.product_ratings(spark, base), "rating", "sentiment_score"),
                   "sentiment_score")


@query("a20_price_boxes", with_sql("product_ratings") + """
SELECT rating, round(quantile_cont(price, 0.25), 4) AS q1, round(median(price), 4) AS median,
       round(quantile_cont(price, 0.75), 4) AS q3, min(price) AS minimum, max(price) AS maximum,
       round(quantile_cont(price, 0.25) - 1.5 * (quantile_cont(price, 0.75) - quantile_cont(price, 0.25)), 4) AS lower_fence,
       round(quantile_cont(price, 0.75) + 1.5 * (quantile_cont(price, 0.75) - quantile_cont(price, 0.25)), 4) AS upper_fence
FROM product_ratings GROUP BY 1""")
def a20_boxes(spark, base):
    boxes = summaries.box_statistics(lens.product_ratings(spark, base), "rating", "price")
    return rounded(boxes, "q1", "median", "q3", "lower_fence", "upper_fence", digits=4)


@query("a22_sentiment_metrics", with_sql("product_ratings") + """
SELECT round(avg(sentiment_score), 8) AS avg_sentiment, round(stddev_samp(sentiment_score), 8) AS sentiment_std,
       round(avg(CAST(sentiment_score > 0.1 AS INTEGER)), 8) AS positive_ratio,
       round(avg(CAST(sentiment_score < -0.1 AS INTEGER)), 8) AS negative_ratio,
       round(avg(CAST(abs(sentiment_score) <= 0.1 AS INTEGER)), 8) AS neutral_ratio FROM product_ratings""")
def a22(spark, base):
    metrics = summaries.sentiment_metrics(lens.product_ratings(spark, base))
    return rounded(metrics, *metrics.columns)


_RATING_COUNTS = ", ".join(f"count(*) FILTER (rating = {k}) AS rating_{k}" for k in range(1, 6))


@query("a23_rating_metrics", with_sql("product_ratings") + f"""
SELECT round(avg(rating), 8) AS avg_rating, round(stddev_samp(rating), 8) AS rating_std, {_RATING_COUNTS},
       round(avg(CAST(rating >= 4 AS INTEGER)), 8) AS high_rating_ratio,
       round(avg(CAST(rating <= 2 AS INTEGER)), 8) AS low_rating_ratio FROM product_ratings""")
def a23(spark, base):
    return rounded(summaries.rating_metrics(lens.product_ratings(spark, base)),
                   "avg_rating", "rating_std", "high_rating_ratio", "low_rating_ratio")


@query("a25_analytics_summary", with_sql("product_ratings") + f"""
SELECT count(*) AS total_reviews, round(avg(rating), 8) AS average_rating, {_RATING_COUNTS},
       (SELECT count(*) FROM part) AS total_products, (SELECT count(*) FROM customer) AS total_users
FROM product_ratings""")
def a25(spark, base):
    return summaries.analytics_summary(lens.product_ratings(spark, base), _products(spark, base), _users(spark, base), 8)


@query("a26_review_batch", with_sql("product_ratings") + f"""
SELECT device_type, count(*) AS total_reviews, round(avg(rating), 8) AS average_rating, {_RATING_COUNTS}
FROM product_ratings GROUP BY 1""")
def a26(spark, base):
    return summaries.review_batch(lens.product_ratings(spark, base), "device_type", 8)


@query("a26_review_batch_location", with_sql("product_ratings") + f"""
SELECT location, count(*) AS total_reviews, round(avg(rating), 8) AS average_rating, {_RATING_COUNTS}
FROM product_ratings GROUP BY 1""")
def a26_location(spark, base):
    return summaries.review_batch(lens.product_ratings(spark, base), "location", 8)


@query("a27_purchase_batch", with_sql("stream_events") + """
SELECT payment_method, count(*) AS total_orders, round(sum(amount), 8) AS total_revenue,
       round(avg(amount), 8) AS average_order_value FROM stream_events WHERE event_type = 'purchase' GROUP BY 1""")
def a27(spark, base):
    purchases = lens.stream_events(spark, base).where("event_type = 'purchase'")
    return summaries.purchase_batch(purchases, "payment_method", 8)


@query("a28_histogram", """
WITH b AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders)
SELECT bin, round(lo + (bin - 1) * (hi - lo) / 50, 4) AS low, round(lo + bin * (hi - lo) / 50, 4) AS high, count(*) AS count
FROM (SELECT CAST(least(50, 1 + floor((o_totalprice - lo) / (hi - lo) * 50)) AS BIGINT) AS bin, lo, hi
      FROM orders CROSS JOIN b) GROUP BY bin, lo, hi""")
def a28(spark, base):
    return rounded(summaries.histogram(lens.table(spark, base, "orders"), "o_totalprice", 50), "low", "high", digits=4)


@query("a28_histogram_small", with_sql("texts") + """
, v AS (SELECT len(list_filter(regexp_split_to_array(review_text, '[\\t-\\r\\x1c-\\x20\\x{85}\\p{Z}]+'), lambda w: w <> ''))
        AS n FROM texts), b AS (SELECT min(n) AS lo, max(n) AS hi FROM v)
SELECT CAST(least(30, 1 + floor((n - lo) / CAST(hi - lo AS DOUBLE) * 30)) AS BIGINT) AS bin, count(*) AS count
FROM v CROSS JOIN b GROUP BY 1""")
def a28_small(spark, base):
    lengths = segmentation_features(lens.texts(spark, base).select("review_text"))
    return summaries.histogram(lengths, "review_length", 30).select("bin", "count")


def _describe_sql(table: str, columns: list[str]) -> str:
    return " UNION ALL ".join(f"""SELECT '{c}' AS name, count({c}) AS count, round(avg({c}), 4) AS mean,
      round(stddev_samp({c}), 4) AS std, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max,
      round(quantile_cont({c}, 0.25), 4) AS q25, round(quantile_cont({c}, 0.5), 4) AS q50,
      round(quantile_cont({c}, 0.75), 4) AS q75 FROM {table}""" for c in columns)


@query("a29_describe", _describe_sql("lineitem", ["l_extendedprice", "l_quantity", "l_discount"]))
def a29(spark, base):
    found = summaries.describe(lens.table(spark, base, "lineitem"), ["l_extendedprice", "l_quantity", "l_discount"])
    return rounded(found, "mean", "std", "q25", "q50", "q75", digits=4)


def _pairs_sql(table: str, columns: list[str]) -> str:
    return " UNION ALL ".join(f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round(corr({a}, {b}), 8) AS correlation "
                              f"FROM {table}" for at, a in enumerate(columns) for b in columns[at + 1:])


@query("a30_correlations", _pairs_sql("lineitem", [
    "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]))
def a30(spark, base):
    columns = ["l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return rounded(summaries.correlation_matrix(lens.table(spark, base, "lineitem"), columns), "correlation")


@query("a31_rating_sentiment", with_sql("product_ratings") + """
SELECT round(corr(rating, sentiment_score), 8) AS correlation,
       round(avg(CAST(sentiment_score > 0.1 AS INTEGER)) * 100, 8) AS positive_percentage,
       round(avg(CAST(sentiment_score < -0.1 AS INTEGER)) * 100, 8) AS negative_percentage FROM product_ratings""")
def a31(spark, base):
    found = summaries.rating_sentiment_correlation(lens.product_ratings(spark, base))
    return rounded(found, *found.columns)


@query("a32_review_insights", with_sql("texts") + """
, v AS (SELECT rating, helpful_votes / (total_votes + 1e-5) AS h, len(list_filter(regexp_split_to_array(review_text,
        '[\\t-\\r\\x1c-\\x20\\x{85}\\p{Z}]+'), lambda w: w <> '')) AS n FROM texts)
SELECT round(avg(rating), 8) AS average_score,
       (SELECT rating FROM v GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS most_common_score,
       round(avg(CAST(rating >= 4 AS INTEGER)) * 100, 8) AS positive_percentage,
       round(avg(h), 8) AS average_helpfulness, count(*) FILTER (h > 0.5) AS highly_helpful,
       round(max(h), 8) AS max_helpfulness, round(avg(n), 8) AS average_length,
       count(*) FILTER (n > 100) AS long_reviews, CAST(median(n) AS DOUBLE) AS median_length FROM v""")
def a32(spark, base):
    found = summaries.review_insights(segmentation_features(lens.texts(spark, base)))
    return rounded(found, "average_score", "positive_percentage", "average_helpfulness", "max_helpfulness",
                   "average_length")


@query("a33_job_summary", """
SELECT count(*) AS total_jobs, count(*) FILTER (o_orderstatus = 'F') AS completed_jobs,
       count(*) FILTER (o_orderstatus = 'P') AS failed_jobs,
       round(count(*) FILTER (o_orderstatus = 'F') / CAST(count(*) AS DOUBLE), 8) AS success_rate,
       CAST(sum(CAST(floor(o_totalprice) AS BIGINT)) AS BIGINT) AS total_records_processed FROM orders""")
def a33(spark, base):
    jobs = lens.table(spark, base, "orders").select(
        F.col("o_orderkey").alias("job_id"),
        F.when(F.col("o_orderstatus") == "F", "completed").when(F.col("o_orderstatus") == "P", "failed")
        .otherwise("running").alias("status"), F.floor("o_totalprice").alias("records_processed"))
    return rounded(summaries.job_summary(jobs), "success_rate")


# Windows ------------------------------------------------------------------------------------------


@query("w01_rolling_rows", """
SELECT event_id, rating, round(avg(rating) OVER w, 8) AS rating_rolling_mean_7,
       round(coalesce(stddev_samp(rating) OVER w, 0), 8) AS rating_rolling_std_7
FROM (SELECT event_id, ts, 1 + CAST(floor(value) AS INTEGER) % 5 AS rating FROM events)
WINDOW w AS (ORDER BY ts, event_id ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""")
def w01(spark, base):
    events = lens.table(spark, base, "events").select(
        "event_id", "ts", (1 + F.pmod(F.floor("value").cast("int"), F.lit(5))).alias("rating"))
    rolled = ranks.rolling_rows(events, "rating", ["ts", "event_id"], 7)
    return rounded(rolled.drop("ts"), "rating_rolling_mean_7", "rating_rolling_std_7")


def _rank_sql(column: str) -> str:
    return (f"(rank() OVER (ORDER BY {column}) + (count(*) OVER (PARTITION BY {column}) - 1) / 2.0) "
            f"/ count(*) OVER ()")


@query("w02_percentile_rank", f"""
SELECT o_orderkey, round({_rank_sql('o_totalprice')}, 9) AS o_totalprice_percentile,
       round({_rank_sql('o_custkey')}, 9) AS o_custkey_percentile FROM orders""")
def w02(spark, base):
    orders = lens.table(spark, base, "orders").select("o_orderkey", "o_totalprice", "o_custkey")
    ranked = ranks.percentile_rank(orders, ["o_totalprice", "o_custkey"])
    return ranked.select("o_orderkey", *[F.round(f"{name}_percentile", 9).alias(f"{name}_percentile")
                                         for name in ("o_totalprice", "o_custkey")])


@query("w03_popularity_rank", _PRODUCT_STATS + "SELECT product_id, product_popularity_rank FROM product_features")
def w03(spark, base):
    stats = lens.product_ratings(spark, base).groupBy("product_id").agg(F.count("*").alias("n"))
    return ranks.dense_rank_of_counts(stats, "n", "product_popularity_rank").drop("n")


@query("w04_duplicate_flags", """
SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) > 1 AS o_custkey_duplicate,
       row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) > 1 AS o_orderpriority_duplicate FROM orders""")
def w04(spark, base):
    orders = lens.table(spark, base, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    return ranks.duplicate_flags(orders, ["o_custkey", "o_orderpriority"], ["o_orderkey"]).drop(
        "o_custkey", "o_orderpriority")


@query("w05_frequency_consistency", """
WITH g AS (SELECT user_id, date_diff('microsecond', lag(ts) OVER (PARTITION BY user_id ORDER BY ts), ts) // 86400000000 AS gap
           FROM events),
a AS (SELECT user_id, count(*) AS reviews, avg(gap) AS m, stddev_samp(gap) AS s FROM g GROUP BY 1)
SELECT user_id, reviews, round(CASE WHEN reviews < 3 THEN 1.0 WHEN m > 0 THEN 1 / (1 + s / m) ELSE 1.0 END, 8)
       AS review_frequency_consistency FROM a""")
def w05(spark, base):
    events = lens.table(spark, base, "events").select("user_id", F.col("ts").alias("created_at"))
    return rounded(frequency_consistency(events), "review_frequency_consistency")


@query("w06_relative_position", _PRODUCT_STATS + """
SELECT product_id, product_age_days, product_days_since_last_review FROM product_features""")
def w06(spark, base):
    stats = features.product_features(lens.product_ratings(spark, base))
    return stats.select("product_id", "product_age_days", "product_days_since_last_review")


# Sort, top-k, sampling ----------------------------------------------------------------------------


@query("o01_sort_by_time", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS created_at FROM events ORDER BY ts, event_id")
def o01(spark, base):
    return (lens.table(spark, base, "events").orderBy("ts", "event_id")
            .select("event_id", second("ts").alias("created_at")))


@query("o02_top_features", """
WITH i AS (""" + " UNION ALL ".join(f"""SELECT '{c}' AS feature, abs(corr({c}, l_quantity)) AS c, var_samp({c}) AS v
FROM lineitem""" for c in ("l_linenumber", "l_extendedprice", "l_discount", "l_tax", "l_suppkey")) + """)
SELECT feature, round(c * least(1.0, v), 8) AS importance_score FROM i ORDER BY 2 DESC, 1 LIMIT 3""")
def o02(spark, base):
    columns = ["l_linenumber", "l_extendedprice", "l_discount", "l_tax", "l_suppkey"]
    top = features.select_top_features(lens.table(spark, base, "lineitem"), "l_quantity", 3, columns)
    return rounded(top.select("feature", "importance_score"), "importance_score")


@query("o05_top_scored", """
SELECT doc_id, CAST(len(list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'),
       lambda w: w IN ('the', 'that'))) AS INTEGER) AS score FROM documents
WHERE len(list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda w: w IN ('the', 'that'))) > 0
ORDER BY 2 DESC, 1 LIMIT 10""")
def o05(spark, base):
    found = documents.text_search(lens.table(spark, base, "documents"), "text", "doc_id", "The that", 10)
    return found.select("doc_id", "score")


@query("o06_seeded_sample", """
SELECT o_orderkey, o_custkey FROM orders ORDER BY md5(CAST(o_orderkey AS VARCHAR) || '-42'), o_orderkey LIMIT 1000""")
def o06(spark, base):
    orders = lens.table(spark, base, "orders").select("o_orderkey", "o_custkey")
    return relational.sample_rows(orders, F.col("o_orderkey"), 1000)


@query("o07_stratified_split", """
SELECT o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus ORDER BY md5(CAST(o_orderkey AS VARCHAR)))
       <= ceil(round(0.8 * count(*) OVER (PARTITION BY o_orderstatus), 6)) AS is_train FROM orders""")
def o07(spark, base):
    orders = lens.table(spark, base, "orders").select("o_orderkey", "o_orderstatus")
    return ranks.hash_rank_split(orders, "o_orderstatus", F.col("o_orderkey").cast("string"))


@query("o08_preview", """
SELECT doc_id, CASE WHEN length(text) > 100 THEN substr(text, 1, 97) || '...' ELSE text END AS text
FROM documents ORDER BY doc_id LIMIT 10""")
def o08(spark, base):
    return (lens.table(spark, base, "documents").orderBy("doc_id").limit(10)
            .select("doc_id", truncate(F.col("text")).alias("text")))


# Set operations -----------------------------------------------------------------------------------


@query("u01_union_all", """
SELECT o_orderkey AS id, o_custkey AS user_id, NULL::DOUBLE AS value FROM orders
UNION ALL SELECT event_id, user_id, value FROM events""")
def u01(spark, base):
    orders = lens.table(spark, base, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("user_id"))
    events = lens.table(spark, base, "events").select(F.col("event_id").alias("id"), "user_id", "value")
    return relational.union_all([orders, events])


@query("u02_distinct_rows", "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def u02(spark, base):
    return remove_duplicates(lens.table(spark, base, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber"))


@query("u02_keep_first", """
SELECT o_custkey, o_orderkey, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n FROM orders) WHERE n = 1""")
def u02_first(spark, base):
    orders = lens.table(spark, base, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return remove_duplicates(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")
