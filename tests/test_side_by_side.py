"""Parts of a run overlap, fail alone and are cancelled alone."""

import threading
import time

import pytest

from reviewlake.plans.side_by_side import SideBySide
from reviewlake.plans.transform import Job, execute_all_jobs, transform_datasets


def slow(spark, seconds, tasks=1):
    """A Spark job whose tasks sleep."""
    def sleep(parts):
        for part in parts:
            time.sleep(seconds)
            yield part
    return lambda: spark.range(tasks).repartition(tasks).mapInArrow(sleep, "id long").count()


def test_parts_overlap(spark):
    spans = {}

    def timed(name):
        def work():
            began = time.monotonic()
            found = slow(spark, 1.5)()
            spans[name] = (began, time.monotonic())
            return found
        return work
    found = SideBySide(spark, 3).run({name: timed(name) for name in "abc"})
    assert list(found.items()) == [("a", 1), ("b", 1), ("c", 1)]
    assert max(began for began, _ in spans.values()) < min(end for _, end in spans.values())


def test_a_failure_is_a_result(spark):
    def broken():
        raise ValueError("no")
    found = SideBySide(spark, 2).run({"bad": broken, "good": slow(spark, 0.1)})
    assert isinstance(found["bad"], ValueError) and found["good"] == 1
    assert SideBySide(spark).run({}) == {}


def test_one_part_is_cancelled_alone(spark):
    together = SideBySide(spark, 2)
    threading.Timer(1.5, lambda: together.cancel("long")).start()
    began = time.monotonic()
    found = together.run({"long": slow(spark, 40), "short": slow(spark, 3), "later": slow(spark, 0.1)})
    assert isinstance(found["long"], Exception) and found["short"] == 1 and found["later"] == 1
    assert time.monotonic() - began < 30
    assert spark.range(3).count() == 3  # the caller's thread is in no group


def test_jobs_share_nothing(spark, tmp_path):
    for at in range(4):
        spark.range(at + 1).write.parquet(str(tmp_path / f"in{at}"))
    jobs = [Job("file", str(tmp_path / f"in{at}"), str(tmp_path / f"out{at}"), "parquet", job_id=str(at)) for at in range(4)]
    together = SideBySide(spark, 2)
    together.cancel("2")
    log = {row["job_id"]: row for row in execute_all_jobs(spark, jobs, together=together).collect()}
    assert [log[str(at)]["records_processed"] for at in range(4)] == [1, 2, 0, 4]
    assert log["2"]["status"] == "failed" and "cancelled" in log["2"]["errors"][0]
    with pytest.raises(ValueError, match="same id"):
        execute_all_jobs(spark, [Job("file", "x", "y", "csv", job_id="1"), Job("file", "x", "z", "csv", job_id="1")])


def test_datasets_without_frames(spark):
    assert transform_datasets({}) == {}
