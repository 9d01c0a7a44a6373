"""Sliding windows over event time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlake.streaming.events import canonical_type, order_amount

TYPES = ("review", "user_activity", "product_view", "purchase")


def window_parts(events: DataFrame, size: str = "60 seconds", slide: str = "30 seconds") -> DataFrame:
    """Sums, counts and extremes per window, which add up over batches: see `merge_windows`.

    They are built before the shuffle, so a busy window costs one row per task. An event belongs to every window with
    start <= time < end.
    """
    kind = canonical_type(F.col("event_type"))
    rating = F.when(kind == "review", F.col("rating"))
    amount = F.when(kind == "purchase", order_amount(events))
    grouped = events.groupBy(F.window("timestamp", size, slide)).agg(
        F.count("*").alias("event_count"),
        *[F.count_if(kind == name).alias(f"{name}_events") for name in TYPES],
        F.count_if(~kind.isin(*TYPES)).alias("other_events"),
        F.sum(rating).alias("rating_sum"), F.count(rating).alias("ratings"), F.min(rating).alias("min_rating"),
        F.max(rating).alias("max_rating"), F.sum(amount).alias("total_revenue"), F.count(amount).alias("orders"),
        F.min(amount).alias("min_order"), F.max(amount).alias("max_order"))
    return grouped.select(F.col("window.start").alias("start_time"), F.col("window.end").alias("end_time"), *grouped.columns[1:])


def add_parts(parts: DataFrame) -> DataFrame:
    """Parts of the same window added up: parts again, with each column an aggregate of itself."""
    def added(name: str) -> Column:
        return F.min(name) if name.startswith("min_") else F.max(name) if name.startswith("max_") else F.sum(name)
    figures = [name for name in parts.columns if name not in ("start_time", "end_time")]
    return parts.groupBy("start_time", "end_time").agg(*[added(name).alias(name) for name in figures])


def merge_windows(parts: DataFrame) -> DataFrame:
    """One row per window: events in total and by type, rating and order figures."""
    counts = ["event_count", *[f"{name}_events" for name in TYPES], "other_events"]
    merged = parts.groupBy("start_time", "end_time").agg(
        *[F.sum(name).alias(name) for name in counts], F.try_divide(F.sum("rating_sum"), F.sum("ratings")).alias("avg_rating"),
        F.min("min_rating").alias("min_rating"), F.max("max_rating").alias("max_rating"),
        F.sum("total_revenue").alias("total_revenue"),
        F.try_divide(F.sum("total_revenue"), F.sum("orders")).alias("avg_order_value"),
        F.min("min_order").alias("min_order"), F.max("max_order").alias("max_order"))
    return merged.select(F.concat(F.lit("window_"), F.date_format("start_time", "yyyyMMdd_HHmmss")).alias("window_id"), "*")


def window_aggregates(events: DataFrame, size: str = "60 seconds", slide: str = "30 seconds") -> DataFrame:
    """The windows of a table of events."""
    return merge_windows(window_parts(events, size, slide))


def event_throughput(processed: DataFrame, every: str = "1 minute") -> DataFrame:
    """Events, events per second and mean latency per interval of event time, from the processed sink."""
    grouped = processed.groupBy(F.window("timestamp", every)).agg(
        F.count("*").alias("events"), F.avg("processing_latency_ms").alias("avg_latency_ms"))
    seconds = F.unix_seconds("window.end") - F.unix_seconds("window.start")
    return grouped.select(F.col("window.start").alias("interval_start"), "events",
                          (F.col("events") / seconds).alias("events_per_second"), "avg_latency_ms")


def window_stats(windows: DataFrame, as_of: Column) -> DataFrame:
    """Windows in total, finished, still open, and events in them."""
    done = F.col("end_time") < as_of
    return windows.agg(F.count("*").alias("total_windows"), F.count_if(done).alias("processed_windows"),
                       F.count_if(~done).alias("active_windows"),
                       F.coalesce(F.sum("event_count"), F.lit(0)).alias("total_events_in_windows"))
