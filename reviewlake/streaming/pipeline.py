"""Streaming queries: landing, enrichment with upsert, windows, per-batch figures."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from reviewlake.operators import summaries
from reviewlake.sources.lake import latest_versions
from reviewlake.streaming.events import decode, enrich, malformed_messages, parse_messages
from reviewlake.streaming.windows import add_parts, merge_windows, window_parts


def message_source(spark: SparkSession, path: str, files_per_batch: int = 100) -> DataFrame:
    """A growing folder of JSON lines. What has been read is kept in the checkpoint of each query."""
    return spark.readStream.schema("value string").option("maxFilesPerTrigger", files_per_batch).text(path)


@dataclass
class EventStream:
    """The queries over one message source; everything they write is below `root`."""

    spark: SparkSession
    root: str
    size: str = "60 seconds"
    slide: str = "30 seconds"
    watermark: str = "10 minutes"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _start(self, writer, name: str, available_now: bool) -> StreamingQuery:
        writer = writer.option("checkpointLocation", self.path(f"_checkpoint/{name}"))
        writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="5 seconds")
        return writer.start()

    # Sinks -------------------------------------------------------------------------------------

    def land_raw(self, messages: DataFrame, available_now: bool = True, hourly: bool = False) -> StreamingQuery:
        """Every event as it came, in folders by type and date, or by type, date and hour."""
        events = parse_messages(messages)
        stamped = events.withColumns({"type": F.col("event_type"), "date": F.to_date("timestamp")})
        folders = ["type", "date"]
        if hourly:
            stamped, folders = stamped.withColumn("hour", F.hour("timestamp")), [*folders, "hour"]
        writer = stamped.writeStream.format("json").option("path", self.path("raw")).partitionBy(*folders)
        return self._start(writer, "raw", available_now)

    def quarantine(self, messages: DataFrame, available_now: bool = True) -> StreamingQuery:
        """What could not be parsed."""
        writer = malformed_messages(messages).writeStream.format("text").option("path", self.path("malformed"))
        return self._start(writer, "malformed", available_now)

    def _each_batch(self, frame: DataFrame, name: str, handle: Callable[[DataFrame, int], None],
                    available_now: bool) -> StreamingQuery:
        return self._start(frame.writeStream.foreachBatch(handle), name, available_now)

    def store_processed(self, messages: DataFrame, available_now: bool = True) -> StreamingQuery:
        """Enriched events, last one per event_id wins.

        Each micro-batch owns one folder; a repeated batch overwrites it, so a retry
        after a failure changes nothing.
        """
        def handle(batch: DataFrame, batch_id: int) -> None:
            batch.withColumn("_row", F.monotonically_increasing_id()).write.mode("overwrite").parquet(
                f"{self.path('processed')}/batch={batch_id}")
        return self._each_batch(enrich(decode(parse_messages(messages))), "processed", handle, available_now)

    def processed(self) -> DataFrame:
        """Newest version of every processed event: of the newest compaction and the batches after it."""
        base, batches = self._compacted(), self.spark.read.parquet(self.path("processed"))
        if base is not None:
            compacted = self.spark.read.parquet(self.path(f"processed_until/{base}"))
            batches = batches.where(F.col("batch") > base).unionByName(compacted)
        return latest_versions(batches, ["event_id"], "batch")

    def store_windows(self, messages: DataFrame, available_now: bool = True) -> StreamingQuery:
        """What each micro-batch adds to its windows, and the rows that come too late for theirs.

        A window takes no more rows once the query's watermark has passed its end; rows that come later go to the
        folder `late`, once for each such window. Each micro-batch owns one folder of each kind and its watermark is
        that of Spark's offset log, so a repeated batch changes nothing. See `close_windows` for the windows.
        """
        def handle(batch: DataFrame, batch_id: int) -> None:
            batch = batch.persist()
            passed = F.timestamp_millis(F.lit(self._watermark("windows", batch_id)))
            placed = batch.withColumn("window", F.window("timestamp", self.size, self.slide))
            placed.where(F.col("window.end") <= passed).withColumn("window_end", F.col("window.end")).drop("window").write.mode(
                "overwrite").parquet(f"{self.path('late')}/batch={batch_id}")
            parts = window_parts(batch, self.size, self.slide).where(F.col("end_time") > passed)
            # one file a batch, of one row a window: whoever reads on takes a batch as a whole
            parts.coalesce(1).write.mode("overwrite").parquet(f"{self.path('window_parts')}/batch={batch_id}")
            batch.unpersist()
        events = decode(parse_messages(messages)).withWatermark("timestamp", self.watermark)
        return self._each_batch(events, "windows", handle, available_now)

    def _watermark(self, name: str, batch_id: int) -> int:
        """The watermark (milliseconds) that Spark gave a batch when it planned it."""
        log = self.spark.read.text(f"{self.path('_checkpoint')}/{name}/offsets/{batch_id}")
        return log.select(F.get_json_object("value", "$.batchWatermarkMs").cast("bigint").alias("ms")).where("ms IS NOT NULL").first()[0]

    def close_windows(self, available_now: bool = True) -> StreamingQuery:
        """Sum up the parts of each window in Spark's state store and append a window when the watermark has passed it.

        A part that comes again from a repeated batch is dropped. Parts lag behind events by a window's length at most,
        which the watermark adds, so no part that `store_windows` took comes too late here.
        """
        schema = window_parts(decode(parse_messages(self.spark.createDataFrame([], "value string"))), self.size, self.slide).schema
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path("window_parts"))
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).mkdirs(folder)
        parts = self.spark.readStream.schema(schema.add("batch", "long")).parquet(self.path("window_parts"))
        once = parts.withWatermark("end_time", f"{self.watermark} {self.size}").dropDuplicates(["batch", "start_time", "end_time"])
        writer = add_parts(once.drop("batch")).writeStream.format("parquet").option("path", self.path("windows")).outputMode("append")
        return self._start(writer, "closed", available_now)

    def windows(self) -> DataFrame:
        """Finished windows."""
        return merge_windows(self.spark.read.parquet(self.path("windows")))

    def flush_open_windows(self) -> DataFrame:
        """Windows that are not finished, as far as they are: what the state store holds."""
        state = self.spark.read.format("statestore").load(f"{self.path('_checkpoint')}/closed")
        parts = self.spark.read.parquet(self.path("window_parts")).drop("batch")
        sums = StructType([field for field in parts.schema if field.name not in ("start_time", "end_time")])
        held = state.select("key.start_time", "key.end_time", F.col("value").cast(sums).alias("parts"))
        return merge_windows(held.select("start_time", "end_time", "parts.*"))

    def late_rows(self) -> DataFrame:
        """Placements of events into windows that were finished before they came."""
        return self.spark.read.parquet(self.path("late"))

    def _compacted(self) -> int | None:
        """The batch that the newest whole compaction reaches up to."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        folder = hadoop.Path(self.path("processed_until"))
        system = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        found = [status.getPath() for status in system.listStatus(folder)] if system.exists(folder) else []
        return max((int(path.getName()) for path in found if system.exists(hadoop.Path(path, "_SUCCESS"))), default=None)

    def compact(self, up_to_batch: int) -> None:
        """Merge the processed events of the batches up to one, which must be over, into one folder.

        The folder has a name of its own and counts once it is whole; only then what it replaces is deleted. A crash at
        any point leaves a state that `processed` reads right and from which `compact` can be called again.
        """
        base = self._compacted()
        if base is None or base < up_to_batch:
            batches = self.spark.read.parquet(self.path("processed")).where(F.col("batch") <= up_to_batch)
            if base is not None:
                batches = batches.where(F.col("batch") > base).unionByName(self.spark.read.parquet(self.path(f"processed_until/{base}")))
            latest_versions(batches, ["event_id"], "batch", keep_batch=True).write.mode("overwrite").parquet(
                self.path(f"processed_until/{up_to_batch}"))
        self._forget(self._compacted())

    def _forget(self, base: int) -> None:
        """Delete what the compaction up to `base` holds; one batch folder stays, as the schema of the batches."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        for name, label in (("processed", "batch="), ("processed_until", "")):
            folder = hadoop.Path(self.path(name))
            system = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
            for status in system.listStatus(folder):
                number = status.getPath().getName().removeprefix(label)
                if number.isdigit() and int(number) < base:
                    system.delete(status.getPath(), True)

    def store_batch_figures(self, messages: DataFrame, available_now: bool = True) -> StreamingQuery:
        """Per micro-batch: the events by type, and review and purchase figures."""
        def handle(batch: DataFrame, batch_id: int) -> None:
            batch.persist()
            target = self.path("figures")
            batch.write.mode("overwrite").partitionBy("event_type").parquet(
                f"{self.path('by_type')}/batch={batch_id}")
            reviews = batch.where(F.col("event_type") == "review")
            purchases = batch.where(F.col("event_type") == "purchase")
            summaries.review_batch(reviews).write.mode("overwrite").parquet(f"{target}/reviews/batch={batch_id}")
            summaries.purchase_batch(purchases).write.mode("overwrite").parquet(
                f"{target}/purchases/batch={batch_id}")
            batch.unpersist()
        return self._each_batch(enrich(decode(parse_messages(messages))), "figures", handle, available_now)

    # Whole run ---------------------------------------------------------------------------------

    def start(self, source: str, available_now: bool = True) -> list[StreamingQuery]:
        """All queries over one source folder."""
        messages = message_source(self.spark, source)
        started = [start(messages, available_now) for start in (
            self.land_raw, self.quarantine, self.store_processed, self.store_windows)]
        return started if available_now else [*started, self.close_windows(False)]

    def run(self, source: str) -> None:
        """Read what there is, then stop."""
        for query in self.start(source, True):
            query.awaitTermination()
        self.close_windows().awaitTermination()
