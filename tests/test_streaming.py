"""Streaming runs equal the batch functions; retries change nothing."""

import json

import pytest
from pyspark.sql import functions as F

from reviewlake.streaming import events as E
from reviewlake.streaming import windows as W
from reviewlake.streaming.pipeline import EventStream, message_source


def message(at: int, kind: str, second: int, **data) -> str:
    return json.dumps({"event_id": f"e{at}", "event_type": kind, "source": "t",
                       "timestamp": f"2024-01-01T{second // 3600:02d}:{second // 60 % 60:02d}:{second % 60:02d}", "data": data})


MESSAGES = [
    message(1, "review_submitted", 0, rating=5, review_text="great, I love it"),
    message(2, "review_submitted", 30, rating=1, review_text="terrible"),
    message(3, "purchase_completed", 59, total_amount=120.0, quantity=2),
    message(4, "product_viewed", 60, view_duration=3),
    message(5, "user_activity", 90, page_views=200, time_spent=600),
    message(6, "purchase", 95, amount=10.0),
    message(7, "something", 4000),
    "{broken", "[1, 2]", '"text"', '{"rating": 4}',
]


@pytest.fixture
def source(tmp_path):
    folder = tmp_path / "messages"
    folder.mkdir()
    (folder / "a.txt").write_text("\n".join(MESSAGES[:4]) + "\n")
    (folder / "b.txt").write_text("\n".join(MESSAGES[4:]) + "\n")
    return str(folder)


def batch(spark, source):
    return E.decode(E.parse_messages(spark.read.text(source), F.lit("2024-01-01 00:00:00").cast("timestamp")))


def test_enrichment(spark, source):
    now = F.lit("2024-01-01 01:00:00").cast("timestamp")
    rows = {row["event_id"]: row for row in E.enrich(batch(spark, source), now).collect()}
    assert len(rows) == 8
    assert rows["e1"]["sentiment_label"] == "positive" and rows["e2"]["sentiment_label"] == "negative"
    assert rows["e1"]["processing_latency_ms"] == 3_600_000
    assert rows["e3"]["revenue_impact"] == 240.0 and rows["e3"]["purchase_category"] == "high_value"
    assert rows["e4"]["bounce_rate"] == 1 and rows["e5"]["activity_score"] == 10.0
    assert rows["e6"]["revenue_impact"] == 10.0 and rows["e6"]["purchase_category"] == "low_value"
    unknown = next(row for row in rows.values() if row["event_type"] == "unknown")
    assert len(unknown["event_id"]) == 8 and unknown["rating"] == 4


def test_windows(spark, source):
    found = {row["window_id"][-6:]: row for row in W.window_aggregates(batch(spark, source).where("event_type <> 'unknown'")).collect()}
    assert found["000000"]["event_count"] == 3 and found["000000"]["avg_rating"] == 3.0
    assert found["000030"]["total_revenue"] == 120.0 and found["000030"]["product_view_events"] == 1
    assert found["000100"]["event_count"] == 3 and found["000100"]["total_revenue"] == 10.0


def test_stream_equals_batch(spark, source, tmp_path):
    stream = EventStream(spark, str(tmp_path / "out"), watermark="10 seconds")
    stream.run(source)
    finished = stream.windows().count()
    every = stream.windows().unionByName(stream.flush_open_windows())
    want = W.window_aggregates(batch(spark, source).where("event_type <> 'unknown'"))
    got = every.where("start_time < '2024-01-02'")
    columns = ["window_id", "event_count", "avg_rating", "total_revenue"]
    assert sorted(map(tuple, got.select(columns).collect()), key=repr) == sorted(map(tuple, want.select(columns).collect()), key=repr)
    assert 0 < finished < every.count()
    assert spark.read.text(stream.path("malformed")).count() == 3
    assert stream.processed().count() == 8


def test_last_version_of_an_event_wins(spark, tmp_path):
    folder = tmp_path / "m"
    folder.mkdir()
    stream = EventStream(spark, str(tmp_path / "out"))
    for at, amount in enumerate((1.0, 2.0, 3.0)):
        (folder / f"{at}.txt").write_text(message(1, "purchase", 0, amount=amount) + "\n")
        stream.store_processed(message_source(spark, str(folder))).awaitTermination()
    rows = stream.processed().collect()
    assert len(rows) == 1 and rows[0]["amount"] == 3.0


def test_figures_by_batch(spark, source, tmp_path):
    stream = EventStream(spark, str(tmp_path / "out"))
    stream.store_batch_figures(message_source(spark, source)).awaitTermination()
    assert spark.read.parquet(f"{stream.path('figures')}/purchases").agg(F.sum("total_orders")).first()[0] == 2
    assert spark.read.parquet(stream.path("by_type")).where("event_type = 'review'").count() == 2


def placements(stream):
    windows = stream.windows().unionByName(stream.flush_open_windows())
    return windows.agg(F.sum("event_count")).first()[0] + stream.late_rows().count()


def test_windows_close_by_the_watermark_over_restarts(spark, tmp_path):
    """Batch by batch in new queries: a window is closed once, late rows are kept apart, nothing is lost or doubled."""
    folder = tmp_path / "m"
    folder.mkdir()
    sent = 0
    for at, seconds in enumerate(([5, 20], [100, 400], [10, 390, 410], [1000, 405], [15, 2000])):
        (folder / f"{at}.txt").write_text("".join(message(at * 10 + n, "view", second) + "\n" for n, second in enumerate(seconds)))
        sent += 2 * len(seconds)
        stream = EventStream(spark, str(tmp_path / "out"), watermark="2 minutes")
        stream.store_windows(message_source(spark, str(folder))).awaitTermination()
        if at != 2:  # the closing query may lag behind
            stream.close_windows().awaitTermination()
            assert placements(stream) == sent
    finished = [row["window_id"] for row in stream.windows().collect()]
    assert len(finished) == len(set(finished))
    # 10 came after 400 - 120, and 15 after 1000 - 120; 405 came after 410, which is no 120 before it
    assert sorted(F_second(row) for row in stream.late_rows().collect()) == [10, 10, 15, 15]


def F_second(row):
    return row["timestamp"].minute * 60 + row["timestamp"].second


def test_a_repeated_batch_adds_nothing(spark, tmp_path):
    folder = tmp_path / "m"
    folder.mkdir()
    stream = EventStream(spark, str(tmp_path / "out"))
    (folder / "0.txt").write_text(message(1, "view", 5) + "\n" + message(2, "view", 50) + "\n")
    stream.store_windows(message_source(spark, str(folder))).awaitTermination()
    stream.close_windows().awaitTermination()
    # the batch's commit is lost after the closing query has read its parts
    for name in ("0", ".0.crc"):
        (tmp_path / "out" / "_checkpoint" / "windows" / "commits" / name).unlink(missing_ok=True)
    stream.store_windows(message_source(spark, str(folder))).awaitTermination()
    stream.close_windows().awaitTermination()
    assert placements(stream) == 4


def test_compaction_survives_a_crash_at_any_point(spark, tmp_path, monkeypatch):
    folder = tmp_path / "m"
    folder.mkdir()
    stream = EventStream(spark, str(tmp_path / "out"))

    def send(at, amount):
        (folder / f"{at}.txt").write_text(message(at % 2, "purchase", at, amount=amount) + "\n")
        stream.store_processed(message_source(spark, str(folder))).awaitTermination()

    def amounts():
        return sorted((row["event_id"], row["amount"]) for row in stream.processed().collect())

    for at in range(4):
        send(at, float(at))
    want = [("e0", 2.0), ("e1", 3.0)]
    # before anything is whole: a folder without its mark
    (tmp_path / "out" / "processed_until" / "2").mkdir(parents=True)
    assert amounts() == want
    with monkeypatch.context() as patch:  # after the compaction is whole, before anything is deleted
        patch.setattr(EventStream, "_forget", lambda self, base: (_ for _ in ()).throw(OSError("crash")))
        with pytest.raises(OSError):
            stream.compact(2)
    assert amounts() == want
    stream.compact(2)
    assert amounts() == want
    send(4, 9.0)
    want = [("e0", 9.0), ("e1", 3.0)]
    assert amounts() == want
    stream.compact(4)
    assert amounts() == want
    assert [path.name for path in (tmp_path / "out" / "processed_until").iterdir()] == ["4"]
    assert sorted(path.name for path in (tmp_path / "out" / "processed").iterdir() if path.is_dir()) == ["batch=4"]
