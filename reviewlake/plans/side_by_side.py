"""Independent work side by side on one session: a driver thread, a scheduler pool and a job group for each part."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

T = TypeVar("T")


@dataclass
class SideBySide:
    """Runs named parts with at most `workers` at a time.

    Under the FAIR scheduler (`build_session` asks for it) parts share the executors evenly, each in a pool of its
    own; under FIFO they only fill what the others leave idle. All Spark jobs of a part are one job group, so ending a
    part ends nothing else.
    """

    spark: SparkSession
    workers: int = 4
    _run: str = field(default_factory=lambda: uuid.uuid4().hex)
    _cancelled: set[str] = field(default_factory=set)

    def group(self, name: str) -> str:
        return f"{self._run}-{name}"

    def cancel(self, name: str) -> None:
        """End the jobs of one part; it fails, or does not begin, and the others go on."""
        self._cancelled.add(name)
        self.spark.sparkContext.cancelJobGroup(self.group(name))

    def run(self, parts: Mapping[str, Callable[[], T]]) -> dict[str, T | Exception]:
        """What each part gave, or the exception that ended it, in the given order."""
        def one(name: str, work: Callable[[], T]) -> T | Exception:
            context = self.spark.sparkContext
            if name in self._cancelled:
                return RuntimeError(f"{name} was cancelled before it began")
            try:
                context.setJobGroup(self.group(name), name, interruptOnCancel=True)
                context.setLocalProperty("spark.scheduler.pool", self.group(name))
                return work()
            except Exception as error:  # noqa: BLE001 - a part that fails is a result
                context.cancelJobGroup(self.group(name))  # what it started besides
                return error
            finally:  # the thread goes on to another part
                context.setLocalProperty("spark.scheduler.pool", None)
                context.setLocalProperty("spark.jobGroup.id", None)

        with ThreadPoolExecutor(max_workers=max(1, min(self.workers, len(parts)))) as threads:
            # the wrapper hands the caller's properties to the thread, so each part is wrapped anew
            started = {name: threads.submit(inheritable_thread_target(self.spark)(one), name, work) for name, work in parts.items()}
            return {name: future.result() for name, future in started.items()}
