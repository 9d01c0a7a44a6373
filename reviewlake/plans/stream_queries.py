"""Stream operators: in batch form against SQL, and as streaming runs over landed messages."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewlake import lens
from reviewlake.lens import with_sql
from reviewlake.plans.registry import query, rounded, second
from reviewlake.session import scratch_path
from reviewlake.streaming import events as E
from reviewlake.streaming import windows as W
from reviewlake.streaming.pipeline import EventStream, message_source

NOW = "2024-02-01"


def _now():
    return F.lit(NOW).cast("timestamp")


def _events(spark, base):
    return lens.stream_events(spark, base)


def _messages(spark, base, broken: bool = False, added: float = 0.0):
    """The stored events as JSON messages (value, timestamp); every 100th message is cut short when `broken`, and
    amounts are larger by `added`."""
    rows = _events(spark, base).withColumn("amount", F.col("amount") + added)
    payload = F.struct("user_id", "product_id", "rating", "page_views", "time_spent", "view_duration", "amount", "quantity",
                       "payment_method")
    message = F.to_json(F.struct("event_id", "event_type", F.date_format(
        "timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"), "source", payload.alias("data")))
    if broken:
        message = F.when(F.col("event_id").cast("bigint") % 100 == 17, F.substring(message, 1, 20)).otherwise(message)
    return rows.select(message.alias("value"), "timestamp")


def _land(spark, base, broken: bool = False) -> str:
    """The messages as files, one for each core of the session."""
    path = scratch_path(spark, "messages")
    _messages(spark, base, broken).select("value").repartition(spark.sparkContext.defaultParallelism).write.text(path)
    return path


KEPT = "CAST(event_id AS BIGINT) % 100 <> 17"


# Batch forms --------------------------------------------------------------------------------------


@query("x01_parse_messages", with_sql("stream_events") + f"""
SELECT event_type, count(*) AS events, strftime(max("timestamp"), '%Y-%m-%d %H:%M:%S') AS latest, round(sum(amount), 2) AS amount
FROM stream_events WHERE {KEPT} GROUP BY 1""")
def x01(spark, base):
    raw = spark.read.schema("value string").text(_land(spark, base, True))
    events = E.decode(E.parse_messages(raw))
    return events.groupBy("event_type").agg(F.count("*").alias("events"), second(F.max("timestamp")).alias("latest"),
                                            F.round(F.sum("amount"), 2).alias("amount"))


@query("x01_defaults", """
SELECT substr(md5('{"rating":' || CAST(1 + event_id % 5 AS VARCHAR) || ',"n":' || CAST(event_id AS VARCHAR) || '}'), 1, 8) AS event_id,
       'unknown' AS event_type, 1 + event_id % 5 AS rating FROM events""")
def x01_defaults(spark, base):
    key = F.col("event_id")
    raw = lens.table(spark, base, "events").select(F.concat(
        F.lit('{"rating":'), (key % 5 + 1).cast("string"), F.lit(',"n":'), key.cast("string"), F.lit("}")).alias("value"))
    parsed = E.parse_messages(raw, _now())
    return parsed.select("event_id", "event_type", F.get_json_object("data", "$.rating").cast("bigint").alias("rating"))


@query("x03_enrich_reviews", with_sql("stream_events") + f"""
SELECT event_id, rating, round(date_diff('microsecond', "timestamp", TIMESTAMP '{NOW}') / 1000.0, 3) AS processing_latency_ms
FROM stream_events WHERE event_type = 'review'""")
def x03(spark, base):
    found = E.enrich(_events(spark, base), _now()).where("event_type = 'review'")
    return rounded(found.select("event_id", "rating", "processing_latency_ms"), "processing_latency_ms", digits=3)


@query("x03_review_sentiment", """
WITH r AS (SELECT CAST(event_id AS VARCHAR) AS event_id, event_id % 4 AS way FROM events)
SELECT event_id, CAST(CASE way WHEN 0 THEN 0.6124 WHEN 1 THEN -0.4588 WHEN 2 THEN 0.0 END AS DOUBLE) AS sentiment_polarity,
       CASE way WHEN 0 THEN 'positive' WHEN 1 THEN 'negative' WHEN 2 THEN 'neutral' END AS sentiment_label,
       CAST(CASE way WHEN 0 THEN 1 WHEN 1 THEN 1 WHEN 2 THEN 0 END AS DOUBLE) AS sentiment_subjectivity FROM r""")
def x03_sentiment(spark, base):
    """Reviews of four kinds by turns: good, bad, plain, without text."""
    way = F.col("event_id") % 4
    text = F.when(way == 0, "an amazing thing").when(way == 1, "a bad thing it is").when(way == 2, "a thing")
    raw = lens.table(spark, base, "events").select(
        F.col("event_id").cast("string").alias("event_id"), F.lit("review_submitted").alias("event_type"),
        F.col("ts").alias("timestamp"), F.lit("stream").alias("source"), text.alias("review_text"))
    return E.enrich(raw, _now()).select("event_id", "sentiment_polarity", "sentiment_label", "sentiment_subjectivity")


@query("x04_enrich_activity", with_sql("stream_events") + """
SELECT event_id, round(least(1 + 0.1 * page_views + 0.2 * least(time_spent / 60, 5), 10), 8) AS activity_score, 0.0::DOUBLE AS session_duration
FROM stream_events WHERE event_type = 'user_activity'""")
def x04(spark, base):
    found = E.enrich(_events(spark, base), _now()).where("event_type = 'user_activity'")
    return rounded(found.select("event_id", "activity_score", "session_duration"), "activity_score")


@query("x05_enrich_views", with_sql("stream_events") + """
SELECT event_id, view_duration, CAST(view_duration < 5 AS INTEGER) AS bounce_rate FROM stream_events WHERE event_type = 'product_view'""")
def x05(spark, base):
    return E.enrich(_events(spark, base), _now()).where("event_type = 'product_view'").select(
        "event_id", "view_duration", "bounce_rate")


@query("x06_enrich_purchases", with_sql("stream_events") + """
SELECT event_id, amount * quantity AS revenue_impact, CASE WHEN amount < 25 THEN 'low_value' WHEN amount < 100 THEN 'medium_value'
       ELSE 'high_value' END AS purchase_category FROM stream_events WHERE event_type = 'purchase'""")
def x06(spark, base):
    return E.enrich(_events(spark, base), _now()).where("event_type = 'purchase'").select(
        "event_id", "revenue_impact", "purchase_category")


@query("x07_dispatch", """
SELECT CASE event_type WHEN 'view' THEN 'product_view' WHEN 'purchase' THEN 'purchase' WHEN 'error' THEN 'review'
       ELSE event_type END AS event_type, count(*) AS events, count(*) FILTER (event_type = 'view') AS views,
       count(*) FILTER (event_type = 'purchase') AS purchases FROM events GROUP BY 1""")
def x07(spark, base):
    names = {"view": "product_viewed", "purchase": "purchase_completed", "error": "review_submitted"}
    kind = F.coalesce(*[F.when(F.col("event_type") == old, new) for old, new in names.items()], F.col("event_type"))
    raw = lens.table(spark, base, "events").select(
        F.col("event_id").cast("string").alias("event_id"), kind.alias("event_type"), F.col("ts").alias("timestamp"),
        F.lit("stream").alias("source"), F.col("value").alias("total_amount"))
    return E.enrich(raw, _now()).groupBy("event_type").agg(
        F.count("*").alias("events"), F.count("bounce_rate").alias("views"), F.count("revenue_impact").alias("purchases"))


WINDOWS_SQL = with_sql("stream_events") + """
, placed AS (SELECT *, unnest([floor(epoch_us("timestamp") / 30000000.0) * 30, floor(epoch_us("timestamp") / 30000000.0) * 30 - 30])
             AS start FROM stream_events)
SELECT strftime(to_timestamp(start) AT TIME ZONE 'UTC', 'window_%Y%m%d_%H%M%S') AS window_id,
       count(*) AS event_count, count(*) FILTER (event_type = 'review') AS review_events,
       count(*) FILTER (event_type = 'user_activity') AS user_activity_events,
       count(*) FILTER (event_type = 'product_view') AS product_view_events,
       count(*) FILTER (event_type = 'purchase') AS purchase_events, 0::BIGINT AS other_events,
       round(avg(rating), 8) AS avg_rating, min(rating) AS min_rating, max(rating) AS max_rating,
       round(sum(amount), 6) AS total_revenue, round(avg(amount), 6) AS avg_order_value, min(amount) AS min_order,
       max(amount) AS max_order FROM placed GROUP BY start"""


def _plain_windows(df):
    return rounded(rounded(df.drop("start_time", "end_time"), "avg_rating"), "total_revenue", "avg_order_value", digits=6)


@query("x10_sliding_windows", with_sql("stream_events") + """
SELECT strftime(to_timestamp(start) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS start_time, count(*) AS event_count FROM (
  SELECT unnest([floor(epoch_us("timestamp") / 30000000.0) * 30, floor(epoch_us("timestamp") / 30000000.0) * 30 - 30]) AS start
  FROM stream_events) GROUP BY start""")
def x10(spark, base):
    return W.window_aggregates(_events(spark, base)).select(second("start_time").alias("start_time"), "event_count")


@query("x11_window_aggregates", WINDOWS_SQL)
def x11(spark, base):
    return _plain_windows(W.window_aggregates(_events(spark, base)))


@query("x13_throughput", with_sql("stream_events") + f"""
SELECT strftime(date_trunc('minute', "timestamp"), '%Y-%m-%d %H:%M:%S') AS interval_start, count(*) AS events,
       round(count(*) / 60.0, 8) AS events_per_second, round(avg(CASE WHEN event_type = 'review' THEN
       date_diff('microsecond', "timestamp", TIMESTAMP '{NOW}') / 1000.0 END), 3) AS avg_latency_ms FROM stream_events GROUP BY 1""")
def x13(spark, base):
    found = W.event_throughput(E.enrich(_events(spark, base), _now()))
    found = found.withColumn("interval_start", second("interval_start"))
    return rounded(rounded(found, "events_per_second"), "avg_latency_ms", digits=3)


@query("x13_window_stats", f"""
SELECT count(*) AS total_windows, count(*) FILTER (w < '20240115') AS processed_windows, count(*) FILTER (w >= '20240115')
       AS active_windows, CAST(sum(event_count) AS BIGINT) AS total_events_in_windows
FROM (SELECT substr(strftime(strptime(window_id, 'window_%Y%m%d_%H%M%S') + INTERVAL 60 SECOND, '%Y%m%d%H%M%S'), 1, 14) AS w,
      event_count FROM ({WINDOWS_SQL}))""")
def x13_windows(spark, base):
    return W.window_stats(W.window_aggregates(_events(spark, base)), F.lit("2024-01-15").cast("timestamp"))


# Streaming runs -----------------------------------------------------------------------------------


def _stream(spark) -> EventStream:
    return EventStream(spark, scratch_path(spark, "stream"))


COUNTS = with_sql("stream_events") + f"SELECT event_type, count(*) AS events FROM stream_events WHERE {KEPT} GROUP BY 1"


@query("x08_raw_sink", COUNTS)
def x08(spark, base):
    stream = _stream(spark)
    stream.land_raw(message_source(spark, _land(spark, base, True))).awaitTermination()
    raw = spark.read.schema("event_id string, event_type string").json(stream.path("raw"))
    return raw.groupBy("event_type").agg(F.count("*").alias("events"))


@query("x01_quarantine", f"SELECT count(*) AS malformed FROM events WHERE NOT ({KEPT})")
def x01_quarantine(spark, base):
    stream = _stream(spark)
    stream.quarantine(message_source(spark, _land(spark, base, True))).awaitTermination()
    return spark.read.text(stream.path("malformed")).agg(F.count("*").alias("malformed"))


@query("x09_processed_upsert", with_sql("stream_events") + """
SELECT event_type, count(*) AS events, round(sum(amount), 2) AS revenue FROM stream_events GROUP BY 1""")
def x09(spark, base):
    stream, source = _stream(spark), _land(spark, base)
    # The same folder read twice: the second run replaces nothing new and doubles nothing.
    for _ in range(2):
        stream.store_processed(message_source(spark, source, 1)).awaitTermination()
    return stream.processed().groupBy("event_type").agg(F.count("*").alias("events"),
                                                        F.round(F.sum("revenue_impact"), 2).alias("revenue"))


@query("x09_repeated_ids", with_sql("stream_events") + """
SELECT event_type, count(*) AS events, round(sum(amount + 1), 2) AS revenue FROM stream_events GROUP BY 1""")
def x09_repeated(spark, base):
    """Every event comes again in a later batch, with another amount: the later one stays, also after compaction."""
    stream, source = _stream(spark), scratch_path(spark, "messages")
    for added in (0.0, 1.0):
        _messages(spark, base, added=added).select("value").write.mode("append").text(source)
        stream.store_processed(message_source(spark, source)).awaitTermination()
    stream.compact(1)
    return stream.processed().groupBy("event_type").agg(F.count("*").alias("events"),
                                                        F.round(F.sum("revenue_impact"), 2).alias("revenue"))


@query("x02_growing_source", COUNTS.replace(f"WHERE {KEPT} ", ""))
def x02(spark, base):
    stream, source = _stream(spark), scratch_path(spark, "messages")
    first = spark.read.schema("value string").text(_land(spark, base))
    for part in range(2):
        first.where(F.pmod(F.xxhash64("value"), F.lit(2)) == part).write.mode("append").text(source)
        stream.land_raw(message_source(spark, source)).awaitTermination()
    raw = spark.read.schema("event_id string, event_type string").json(stream.path("raw"))
    return raw.groupBy("event_type").agg(F.count("*").alias("events"))


@query("x12_finished_windows", WINDOWS_SQL)
def x12(spark, base):
    stream = _stream(spark)
    messages = message_source(spark, _land(spark, base), 100)
    for query_ in (stream.land_raw(messages), stream.store_windows(messages)):
        query_.awaitTermination()
    stream.close_windows().awaitTermination()
    return _plain_windows(stream.windows().unionByName(stream.flush_open_windows()))


PLACED_SQL = f"SELECT CAST(sum(event_count) AS BIGINT) AS placements FROM ({WINDOWS_SQL})"


@query("x12_several_batches", PLACED_SQL)
def x12_several(spark, base):
    """Finished and open windows and late rows together hold every placement, whatever the batches."""
    stream = _stream(spark)
    stream.store_windows(message_source(spark, _land(spark, base), 1)).awaitTermination()
    stream.close_windows().awaitTermination()
    windows = stream.windows().unionByName(stream.flush_open_windows())
    placed = windows.agg(F.sum("event_count").alias("n")).unionByName(stream.late_rows().agg(F.count("*").alias("n")))
    return placed.agg(F.sum("n").alias("placements"))


@query("x12_late_rows", with_sql("stream_events") + """
, limits AS (SELECT epoch_us(max("timestamp")) / 1000000.0 - 86400 AS closed FROM stream_events),
placed AS (SELECT *, epoch_us("timestamp") / 1000000.0 AS moment, unnest([floor(epoch_us("timestamp") / 30000000.0) * 30,
           floor(epoch_us("timestamp") / 30000000.0) * 30 - 30]) AS start FROM stream_events)
SELECT count(*) AS late, count(*) FILTER (event_type = 'purchase') AS late_purchases FROM placed, limits
WHERE moment < closed AND start + 60 <= closed""")
def x12_late(spark, base):
    """The newest day comes first; older events are then late for the windows that were finished before it."""
    events = _messages(spark, base)
    newest = events.agg(F.max("timestamp")).scalar()
    stream, source = EventStream(spark, scratch_path(spark, "stream"), watermark="1 day"), scratch_path(spark, "messages")
    old = F.col("timestamp") < newest - F.expr("INTERVAL 1 DAY")
    for part in (~old, old):
        events.where(part).select("value").write.mode("append").text(source)
        stream.store_windows(message_source(spark, source)).awaitTermination()
    late = stream.late_rows()
    return late.agg(F.count("*").alias("late"), F.count_if(F.col("event_type") == "purchase").alias("late_purchases"))


@query("x14_drain_and_flush", f"SELECT CAST(sum(event_count) AS BIGINT) AS events_in_windows FROM ({WINDOWS_SQL})")
def x14(spark, base):
    stream = _stream(spark)
    stream.run(_land(spark, base))
    every = stream.windows().unionByName(stream.flush_open_windows())
    return every.agg(F.sum("event_count").alias("events_in_windows"))


@query("x15_batch_figures", with_sql("stream_events") + """
SELECT 'reviews' AS kind, count(*) AS events, CAST(count(*) AS DOUBLE) AS figure FROM stream_events WHERE event_type = 'review'
UNION ALL SELECT 'purchases', count(*), round(sum(amount), 0) FROM stream_events WHERE event_type = 'purchase'""")
def x15(spark, base):
    stream = _stream(spark)
    stream.store_batch_figures(message_source(spark, _land(spark, base), 2)).awaitTermination()
    reviews = spark.read.parquet(f"{stream.path('figures')}/reviews").agg(
        F.sum("total_reviews").alias("events"), F.sum("total_reviews").cast("double").alias("figure"))
    purchases = spark.read.parquet(f"{stream.path('figures')}/purchases").agg(
        F.sum("total_orders").alias("events"), F.round(F.sum("total_revenue"), 0).alias("figure"))
    return (reviews.select(F.lit("reviews").alias("kind"), "events", "figure")
            .unionByName(purchases.select(F.lit("purchases").alias("kind"), "events", "figure")))


@query("x16_hourly_landing", with_sql("stream_events") + """
SELECT event_type AS type, strftime("timestamp", '%Y-%m-%d') AS date, CAST(hour("timestamp") AS INTEGER) AS hour, count(*) AS events
FROM stream_events GROUP BY 1, 2, 3""")
def x16(spark, base):
    stream = _stream(spark)
    stream.land_raw(message_source(spark, _land(spark, base)), hourly=True).awaitTermination()
    raw = spark.read.schema("event_id string, type string, date date, hour int").json(stream.path("raw"))
    return raw.groupBy("type", F.date_format("date", "yyyy-MM-dd").alias("date"), "hour").agg(F.count("*").alias("events"))


@query("z06_stream_run", with_sql("stream_events") + f"""
SELECT count(*) AS processed, (SELECT count(*) FROM events WHERE NOT ({KEPT})) AS malformed FROM stream_events WHERE {KEPT}""")
def z06(spark, base):
    stream = _stream(spark)
    stream.run(_land(spark, base, True))
    malformed = spark.read.text(stream.path("malformed")).agg(F.count("*")).scalar()
    return stream.processed().agg(F.count("*").alias("processed")).select("processed", malformed.alias("malformed"))
