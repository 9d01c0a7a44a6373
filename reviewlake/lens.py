"""Review-shaped views over the stored tables, each with its SQL twin.

There is no review table in the test data; reviews are read out of order lines
(`ratings`, `product_ratings`), documents (`docs`, `texts`) and events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.schemas import TABLES


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """One stored table, read with its fixed schema (timestamps in UTC)."""
    return spark.read.schema(TABLES[name]).parquet(f"{base}/{name}.parquet")


def _int(column: Column) -> Column:
    return column.cast("int")


def _line_columns() -> list[Column]:
    return [
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("review_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        _int(F.ceil(F.col("l_quantity") / 10)).alias("rating"),
        F.col("l_shipdate").alias("created_at"),
        _int(F.round(F.col("l_tax") * 100)).alias("helpful_votes"),
        _int(F.round(F.col("l_discount") * 100)).alias("total_votes"),
        F.round(F.col("l_discount") * 20 - 1, 2).alias("sentiment_score"),
        (F.col("l_returnflag") != "R").alias("verified_purchase"),
        F.col("l_returnflag").alias("device_type"),
        F.col("l_linestatus").alias("location"),
        F.col("l_extendedprice").alias("price"),
    ]


def label_of(score: Column, threshold: float = 0.1) -> Column:
    """positive / negative / neutral around zero."""
    return (F.when(score > threshold, "positive")
            .when(score < -threshold, "negative").otherwise("neutral"))


def product_ratings(spark: SparkSession, base: str) -> DataFrame:
    """Order lines as reviews of products (no reviewer)."""
    lines = table(spark, base, "lineitem").select(*_line_columns())
    return lines.withColumn("sentiment_label", label_of(F.col("sentiment_score")))


def ratings(spark: SparkSession, base: str) -> DataFrame:
    """Order lines as reviews, with the ordering customer as reviewer."""
    users = table(spark, base, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"))
    return product_ratings(spark, base).join(users, "order_id")


def docs(spark: SparkSession, base: str) -> DataFrame:
    """Documents as review texts."""
    return table(spark, base, "documents").select(
        F.col("doc_id").alias("review_id"), F.col("text").alias("review_text"),
        F.col("source").alias("category"), F.col("lang").alias("language"))


def texts(spark: SparkSession, base: str) -> DataFrame:
    """Documents as full reviews: author, product, rating and time from the event of the same id."""
    value, key = F.col("value"), F.col("review_id")
    events = table(spark, base, "events").select(
        F.col("event_id").alias("review_id"),
        F.col("ts").alias("created_at"), "user_id",
        _int(F.get_json_object("props", "$.k")).alias("product_id"),
        (1 + F.pmod(_int(F.floor(value)), F.lit(5))).alias("rating"),
        F.round(value - 2 * F.floor(value / 2) - 1, 2).alias("sentiment_score"))
    return docs(spark, base).join(events, "review_id").select(
        "*", _int(key % 11).alias("helpful_votes"), _int(key % 13).alias("total_votes"),
        (key % 3 != 0).alias("verified_purchase"))


def dirty(spark: SparkSession, base: str) -> DataFrame:
    """`texts` with nulls, blanks, bad mails, bad ratings and future dates put in by rule."""
    key = F.col("review_id")

    def null_every(step: int, rest: int, column: Column) -> Column:
        return F.when(key % step != rest, column)

    user_text = F.col("user_id").cast("string")
    day = F.expr("interval 10 days")
    return texts(spark, base).select(
        key.alias("row_key"),
        null_every(101, 7, key).alias("review_id"),
        null_every(50, 0, F.col("user_id")).alias("user_id"),
        F.col("product_id"),
        null_every(20, 4, F.col("rating") + _int(key % 3) - 1).alias("rating"),
        F.when(key % 33 == 0, "").otherwise(F.col("review_text")).alias("review_text"),
        F.when(key % 20 == 3, "invalid-email")
         .otherwise(F.concat(F.lit(" User"), user_text, F.lit("@Example.com"))).alias("user_email"),
        F.when(key % 50 != 1, F.when(key % 40 == 0, F.col("created_at") + day)
               .otherwise(F.col("created_at"))).alias("created_at"),
        null_every(100, 9, F.col("helpful_votes")).alias("helpful_votes"),
        F.col("total_votes"))


#: Event type of the stored events -> event type of the event processors.
EVENT_TYPES = {"view": "product_view", "purchase": "purchase", "signup": "user_activity",
               "click": "user_activity", "error": "review"}


def stream_events(spark: SparkSession, base: str) -> DataFrame:
    """Stored events as stream events with the payload fields of their type."""
    raw = table(spark, base, "events")
    kind = F.coalesce(*[F.when(F.col("event_type") == old, new) for old, new in EVENT_TYPES.items()])
    value = F.col("value")
    return raw.select(
        F.col("event_id").cast("string").alias("event_id"),
        kind.alias("event_type"),
        F.col("ts").alias("timestamp"),
        F.col("event_type").alias("source"),
        "user_id",
        _int(F.get_json_object("props", "$.k")).cast("bigint").alias("product_id"),
        F.when(kind == "review", 1 + F.pmod(_int(F.floor(value)), F.lit(5))).alias("rating"),
        F.when(kind == "user_activity", F.floor(value / 10).cast("double")).alias("page_views"),
        F.when(kind == "user_activity", value).alias("time_spent"),
        F.when(kind == "product_view", value / 10).alias("view_duration"),
        F.when(kind == "purchase", value).alias("amount"),
        F.when(kind == "purchase", F.lit(1)).alias("quantity"),
        F.when(kind == "purchase", F.col("props")).alias("payment_method"))


# SQL twins -------------------------------------------------------------------------------------

_SQL = {
    "product_ratings": """product_ratings AS (
  SELECT *, CASE WHEN sentiment_score > 0.1 THEN 'positive'
                 WHEN sentiment_score < -0.1 THEN 'negative' ELSE 'neutral' END AS sentiment_label
  FROM (SELECT l_orderkey * 8 + l_linenumber AS review_id, l_orderkey AS order_id, l_partkey AS product_id,
               CAST(ceil(l_quantity / 10) AS INTEGER) AS rating, l_shipdate AS created_at,
               CAST(round(l_tax * 100) AS INTEGER) AS helpful_votes,
               CAST(round(l_discount * 100) AS INTEGER) AS total_votes,
               round(l_discount * 20 - 1, 2) AS sentiment_score,
               l_returnflag <> 'R' AS verified_purchase, l_returnflag AS device_type,
               l_linestatus AS location, l_extendedprice AS price FROM lineitem))""",
    "ratings": """ratings AS (
  SELECT p.*, o_custkey AS user_id FROM product_ratings p JOIN orders ON order_id = o_orderkey)""",
    "docs": """docs AS (
  SELECT doc_id AS review_id, text AS review_text, source AS category, lang AS language FROM documents)""",
    "texts": """texts AS (
  SELECT d.*, e.ts AS created_at, e.user_id, CAST(e.props->>'$.k' AS INTEGER) AS product_id,
         1 + CAST(floor(e.value) AS INTEGER) % 5 AS rating,
         round(e.value - 2 * floor(e.value / 2) - 1, 2) AS sentiment_score,
         CAST(d.review_id % 11 AS INTEGER) AS helpful_votes, CAST(d.review_id % 13 AS INTEGER) AS total_votes,
         d.review_id % 3 <> 0 AS verified_purchase
  FROM docs d JOIN events e ON d.review_id = e.event_id)""",
    "dirty": """dirty AS (
  SELECT review_id AS row_key, CASE WHEN review_id % 101 <> 7 THEN review_id END AS review_id,
         CASE WHEN review_id % 50 <> 0 THEN user_id END AS user_id, product_id,
         CASE WHEN review_id % 20 <> 4 THEN rating + CAST(review_id % 3 AS INTEGER) - 1 END AS rating,
         CASE WHEN review_id % 33 = 0 THEN '' ELSE review_text END AS review_text,
         CASE WHEN review_id % 20 = 3 THEN 'invalid-email'
              ELSE ' User' || CAST(user_id AS VARCHAR) || '@Example.com' END AS user_email,
         CASE WHEN review_id % 50 <> 1 THEN
              CASE WHEN review_id % 40 = 0 THEN created_at + INTERVAL 10 DAY ELSE created_at END END AS created_at,
         CASE WHEN review_id % 100 <> 9 THEN helpful_votes END AS helpful_votes, total_votes
  FROM texts)""",
    "stream_events": """stream_events AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, kind AS event_type, ts AS "timestamp", event_type AS source, user_id,
         CAST(props->>'$.k' AS BIGINT) AS product_id,
         CASE WHEN kind = 'review' THEN 1 + CAST(floor(value) AS INTEGER) % 5 END AS rating,
         CASE WHEN kind = 'user_activity' THEN floor(value / 10) END AS page_views,
         CASE WHEN kind = 'user_activity' THEN value END AS time_spent,
         CASE WHEN kind = 'product_view' THEN value / 10 END AS view_duration,
         CASE WHEN kind = 'purchase' THEN value END AS amount,
         CASE WHEN kind = 'purchase' THEN 1 END AS quantity,
         CASE WHEN kind = 'purchase' THEN props END AS payment_method
  FROM (SELECT *, CASE event_type WHEN 'view' THEN 'product_view' WHEN 'purchase' THEN 'purchase'
                       WHEN 'signup' THEN 'user_activity' WHEN 'click' THEN 'user_activity'
                       WHEN 'error' THEN 'review' END AS kind FROM events))""",
}

_NEEDS = {"ratings": ["product_ratings"], "texts": ["docs"], "dirty": ["texts"]}


def with_sql(*names: str) -> str:
    """`WITH ...` prefix that defines the named views and what they need."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in _NEEDS.get(name, []):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    return "WITH " + ",\n".join(_SQL[name] for name in ordered)
