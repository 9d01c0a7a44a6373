"""Stream messages: parsing and enrichment. The same functions run on batch and streaming frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlake.functions import sentiment
from reviewlake.functions.expr import short_id
from reviewlake.functions.text import clean_text
from reviewlake.lens import label_of
from reviewlake.schemas import EVENT_DATA

# Names under which producers send the event types.
TYPE_ALIASES = {"review_submitted": "review", "product_viewed": "product_view", "purchase_completed": "purchase"}


def is_message(value: Column, parsed: Column | None = None) -> Column:
    """The text is one JSON object."""
    parsed = F.try_parse_json(value) if parsed is None else parsed
    return parsed.isNotNull() & F.startswith(F.ltrim(value, F.lit(" \t\r\n")), F.lit("{"))


def parse_messages(df: DataFrame, received: Column | None = None, source: str = "stream") -> DataFrame:
    """Messages in `value` as events: event_id, event_type, timestamp, source, data (JSON text).

    Missing parts get defaults: first md5 digits of the message, `unknown`, the
    time of receipt, the message itself. Anything that is not a JSON object is left out. Each message is parsed once
    for the test and once for all of its parts.
    """
    value = F.col("value")
    received = F.current_timestamp() if received is None else received

    def part(name: str) -> Column:
        return F.try_variant_get("_message", f"$.{name}", "string")

    parsed = df.select("value", F.try_parse_json("value").alias("_message"))
    return parsed.where(is_message(value, F.col("_message"))).select(
        F.coalesce(part("event_id"), short_id(value)).alias("event_id"),
        F.coalesce(part("event_type"), F.lit("unknown")).alias("event_type"),
        F.coalesce(F.try_to_timestamp(part("timestamp")), received).alias("timestamp"),
        F.coalesce(part("source"), F.lit(source)).alias("source"),
        F.coalesce(part("data"), value).alias("data"))


def malformed_messages(df: DataFrame) -> DataFrame:
    """What `parse_messages` leaves out, for quarantine."""
    return df.where(~F.coalesce(is_message(F.col("value")), F.lit(False)))


def decode(events: DataFrame) -> DataFrame:
    """Payload fields of `data` as typed columns."""
    return events.withColumn("_data", F.from_json("data", EVENT_DATA)).select(
        *[column for column in events.columns], "_data.*")


def canonical_type(event_type: Column) -> Column:
    return F.coalesce(*[F.when(event_type == alias, name) for alias, name in TYPE_ALIASES.items()], event_type)


def _payload(df: DataFrame, name: str, dtype: str = "double") -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(dtype)


def activity_score(page_views: Column, time_spent: Column) -> Column:
    """1 + 0.1 per page + 0.2 per minute (at most 5), at most 10."""
    pages = F.coalesce(page_views * 0.1, F.lit(0.0))
    minutes = F.coalesce(F.least(time_spent / 60, F.lit(5.0)) * 0.2, F.lit(0.0))
    return F.least(1.0 + pages + minutes, F.lit(10.0))


def purchase_category(amount: Column) -> Column:
    return F.when(amount < 25, "low_value").when(amount < 100, "medium_value").otherwise("high_value")


def order_amount(df: DataFrame) -> Column:
    """`amount`, or `total_amount` as some producers call it."""
    return F.coalesce(_payload(df, "amount"), _payload(df, "total_amount"))


def enrich(df: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Add the figures of each event type; columns of other types stay null.

    review: polarity, subjectivity, label, latency; user_activity: session
    duration, activity score; product_view: duration, bounce; purchase: revenue, class.
    """
    now = F.current_timestamp() if processed_at is None else processed_at
    kind = canonical_type(F.col("event_type"))
    amount = order_amount(df)
    view_duration = F.coalesce(_payload(df, "view_duration"), F.lit(0.0))
    text = _payload(df, "review_text", "string")
    staged = df.withColumn("event_type", kind).withColumn(
        "_clean", F.when((kind == "review") & text.isNotNull(), clean_text(text)))
    is_review, is_activity = F.col("event_type") == "review", F.col("event_type") == "user_activity"
    is_view, is_purchase = F.col("event_type") == "product_view", F.col("event_type") == "purchase"
    staged = staged.withColumn("sentiment_polarity", sentiment.compound(F.col("_clean")))
    polarity = F.col("sentiment_polarity")
    return staged.withColumns({
        "sentiment_subjectivity": F.when(polarity.isNotNull(), sentiment.subjectivity(F.col("_clean"))),
        "sentiment_label": F.when(polarity.isNotNull(), label_of(polarity, 0.1)),
        "processing_latency_ms": F.when(
            is_review, (F.unix_micros(now) - F.unix_micros("timestamp")) / 1000),
        "session_duration": F.when(is_activity, F.coalesce(_payload(df, "session_duration"), F.lit(0.0))),
        "activity_score": F.when(is_activity, activity_score(_payload(df, "page_views"), _payload(df, "time_spent"))),
        "view_duration": F.when(is_view, view_duration),
        "bounce_rate": F.when(is_view, F.when(view_duration < 5, 1).otherwise(0)),
        "revenue_impact": F.when(is_purchase, F.coalesce(amount, F.lit(0.0)) * F.coalesce(
            _payload(df, "quantity", "int"), F.lit(1))),
        "purchase_category": F.when(is_purchase, purchase_category(F.coalesce(amount, F.lit(0.0)))),
        "processed_timestamp": now,
    }).drop("_clean")
