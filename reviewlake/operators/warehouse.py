"""Star schema, extra rules, freshness, privacy, spam and report tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlake.functions.expr import cut
from reviewlake.operators.quality import Context, Rule

# Fixed values of the configuration.
LENGTH_EDGES = [0, 50, 150, 500, 1000, float("inf")]
LENGTH_LABELS = ["0-50", "50-150", "150-500", "500-1000", "1000+"]
USER_ID = r"^[A-Za-z0-9_-]+$"
PRODUCT_ID = r"^PROD_[0-9]+$"
TEXT_LENGTH = (10, 5000)
REQUIRED_FIELDS = ("user_id", "product_id", "rating", "review_text", "timestamp")


def key_of(*parts: str) -> Column:
    """Surrogate key: the same natural key gives the same value in every run."""
    return F.md5(F.concat_ws("|", *[F.col(part).cast("string") for part in parts]))


def dimension(df: DataFrame, key: str, attributes: Sequence[str], name: str) -> DataFrame:
    """One row per natural key with its surrogate key (of several rows, the smallest attribute values)."""
    values = F.struct(*attributes)
    return (df.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(values).alias("_v"))
            .select(key_of(key).alias(f"{name}_key"), key, *[F.col(f"_v.{a}").alias(a) for a in attributes]))


def date_dimension(df: DataFrame, ts: str = "created_at") -> DataFrame:
    """Every date between the first and the last, with its calendar parts."""
    span = df.agg(F.min(F.to_date(ts)).alias("first"), F.max(F.to_date(ts)).alias("last"))
    days = span.select(F.explode(F.sequence("first", "last")).alias("date"))
    date = F.col("date")
    return days.select(
        F.date_format(date, "yyyyMMdd").cast("int").alias("date_key"), date, F.year(date).alias("year"),
        F.quarter(date).alias("quarter"), F.month(date).alias("month"), F.dayofmonth(date).alias("day"),
        F.weekday(date).alias("day_of_week"), F.weekday(date).isin(5, 6).alias("is_weekend"))


def review_facts(reviews: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Reviews with surrogate keys. The keys are computed, so no dimension is joined."""
    return reviews.select(
        "review_id", key_of("user_id").alias("user_key"), key_of("product_id").alias("product_key"),
        F.date_format("created_at", "yyyyMMdd").cast("int").alias("date_key"), *measures)


def length_bucket(text: Column) -> Column:
    """Text length class, upper edges included; an empty text is in none."""
    return cut(F.length(text), LENGTH_EDGES, LENGTH_LABELS)


def _matches(pattern: str):
    def check(df: DataFrame, rule: Rule, context: Context) -> dict[str, Column]:
        return {name: F.coalesce(F.col(name).cast("string").rlike(pattern), F.lit(False))
                for name in rule.columns if name in df.columns}
    return check


def _length_between(low: int, high: int):
    def check(df: DataFrame, rule: Rule, context: Context) -> dict[str, Column]:
        return {name: F.coalesce(F.length(name).between(low, high), F.lit(False))
                for name in rule.columns if name in df.columns}
    return check


FORMAT_RULES = (
    Rule("user_id_format", "validity", "high", _matches(USER_ID), 0.99, ("user_id",)),
    Rule("product_id_format", "validity", "high", _matches(PRODUCT_ID), 0.99, ("product_id",)),
    Rule("review_text_length", "validity", "medium", _length_between(*TEXT_LENGTH), 0.95, ("review_text",)),
)


def alerts(df: DataFrame, as_of: Column, ts: str, is_error: Column, delay_minutes: Column | None = None,
           freshness_hours: float = 6, error_percent: float = 5, max_delay_minutes: float = 30) -> DataFrame:
    """(alert, value, threshold, raised) for freshness, error rate and processing delay."""
    age = (F.unix_micros(as_of) - F.unix_micros(F.max(ts))) / 3_600_000_000
    errors = F.avg(F.when(is_error, 1.0).otherwise(0.0)) * 100
    entries = [("data_freshness_hours", age, freshness_hours), ("error_rate_percent", errors, error_percent)]
    if delay_minutes is not None:
        entries.append(("processing_delay_minutes", F.max(delay_minutes), max_delay_minutes))
    found = df.agg(F.array(*[F.struct(F.lit(name).alias("alert"), value.cast("double").alias("value"),
                                      F.lit(float(limit)).alias("threshold")) for name, value, limit in entries])
                   .alias("_a")).select(F.inline("_a"))
    return found.withColumn("raised", F.col("value") > F.col("threshold"))


def anonymize(column: Column) -> Column:
    """One-way pseudonym."""
    return F.sha2(column.cast("string"), 256)


def mask_email(column: Column) -> Column:
    """First letter and domain stay."""
    return F.regexp_replace(column, r"^(.)[^@]*@", "$1***@")


def mask_text_emails(text: Column) -> Column:
    """Mail addresses inside a text."""
    return F.regexp_replace(text, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "[email]")


def mask_letters_digits(column: Column) -> Column:
    """Same shape, no content."""
    return F.mask(column)


def without_spam(df: DataFrame, spam: str = "is_spam") -> DataFrame:
    return df.where(~F.coalesce(F.col(spam), F.lit(False)))


def period_trends(reviews: DataFrame, period: str) -> DataFrame:
    """Reviews, mean rating and sentiment, users and products per week or month."""
    return reviews.groupBy(F.to_date(F.date_trunc(period, "created_at")).alias(period)).agg(
        F.count("*").alias("total_reviews"), F.avg("rating").alias("average_rating"),
        F.avg("sentiment_score").alias("average_sentiment"),
        F.countDistinct("product_id").alias("products"))


def top_rated_products(reviews: DataFrame, n: int = 10, min_reviews: int = 5) -> DataFrame:
    """Best mean rating among products with enough reviews, ties by volume and id."""
    stats = reviews.groupBy("product_id").agg(F.avg("rating").alias("average_rating"),
                                              F.count("*").alias("total_reviews"))
    return (stats.where(F.col("total_reviews") >= min_reviews)
            .orderBy(F.desc("average_rating"), F.desc("total_reviews"), "product_id").limit(n))


def seasonality(reviews: DataFrame) -> DataFrame:
    """Reviews and mean rating per calendar month over all years, with the share of the volume."""
    months = reviews.groupBy(F.month("created_at").alias("month")).agg(
        F.count("*").alias("total_reviews"), F.avg("rating").alias("average_rating"))
    total = months.agg(F.sum("total_reviews")).scalar()
    return months.withColumn("share", F.col("total_reviews") / total)
