"""Layered lake on plain files: versioned writes, catalog, upserts, compaction, retention, copies.

A dataset folder holds one folder per write, `v=<number>`, and the catalog one row per write. A dataset is what was
appended since its last replacement; that is derived when the catalog is read, so writers at the same time lose
nothing. Nothing that is being read is rewritten.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reviewlake.operators.relational import read_with
from reviewlake.session import size_in_bytes

LAYERS = ("raw", "processed", "curated", "archive")
FORMATS = ("parquet", "json", "csv")
TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
TARGET_FILE_BYTES = 256 * 1024 * 1024

#: One write: kind is 'append', 'replace' or 'drop'.
WRITES = (
    "dataset string, layer string, kind string, seq bigint, path string, format string, compression string, "
    "partitions array<string>, schema string, files bigint, bytes bigint, row_count bigint, nulls bigint, cells bigint, "
    "tags array<string>, written_at timestamp")


def with_date_parts(df: DataFrame, names: Sequence[str], source: str = "created_at") -> DataFrame:
    """Add year, month, day from `source` where they are wanted and absent."""
    parts = {"year": F.year, "month": F.month, "day": F.dayofmonth}
    missing = [name for name in names if name in parts and name not in df.columns and source in df.columns]
    return df.withColumns({name: parts[name](F.col(source).cast("timestamp")) for name in missing})


def write_files(df: DataFrame, path: str, file_format: str = "parquet", partition_columns: Sequence[str] = (),
                compression: str = "snappy", mode: str = "overwrite", target_bytes: int | None = None,
                rows_per_file: int = 0) -> None:
    """One dataset folder with hive-style partition folders, and with files of about `target_bytes` if that is given.

    Before a partitioned write the rows are rebalanced by the partition columns:
    small values share a task, a large one is split over several, so there are
    neither thousands of tiny files nor one task that writes a third of the data.
    """
    if file_format not in FORMATS:
        raise ValueError(f"unsupported file format: {file_format}")
    chosen = compression if file_format == "parquet" or compression != "snappy" else "none"
    if partition_columns or target_bytes:
        df = df.hint("rebalance", *[F.col(name) for name in partition_columns])
    writer = df.write.mode(mode).option("maxRecordsPerFile", rows_per_file).option("compression", chosen).option("timestampFormat", TIMESTAMP_FORMAT)
    if file_format == "parquet":
        writer = writer.option("parquet.page.size", 1024 * 1024).option("parquet.enable.dictionary", True)
    if file_format == "csv":
        writer = writer.option("header", True).option("escape", '"').option("quoteAll", False)
    if partition_columns:
        writer = writer.partitionBy(*partition_columns)
    conf, advised = df.sparkSession.conf, "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = conf.get(advised)
    try:
        if target_bytes:
            conf.set(advised, str(target_bytes))  # what a task of the rebalanced write holds
        writer.format(file_format).save(path)
    finally:
        conf.set(advised, before)


@dataclass
class Lake:
    """A root folder with layers and a catalog table."""

    spark: SparkSession
    root: str

    # Catalog ---------------------------------------------------------------------------------

    @property
    def _catalog_path(self) -> str:
        return f"{self.root}/_catalog"

    def _exists(self, path: str) -> bool:
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(target)

    def catalog(self) -> DataFrame:
        """One row for each dataset and layer: what was written since the last replacement, if it was not dropped."""
        rows = self._writes()
        by = ["dataset", "layer"]
        ends = rows.groupBy(*by).agg(F.max(F.when(F.col("kind") != "append", F.col("seq"))).alias("since"),
                                     F.min("written_at").alias("created_at"))
        current = rows.join(ends, by).where((F.col("seq") >= F.coalesce("since", F.lit(0))) & (F.col("kind") != "drop"))
        newest = {name: F.max_by(name, "seq").alias(name) for name in ("format", "compression", "partitions", "tags")}
        return current.groupBy(*by).agg(
            *newest.values(), F.sort_array(F.collect_list(F.struct("seq", "path", "schema"))).alias("writes"),
            F.sum("files").alias("total_files"), F.sum("bytes").alias("total_bytes"), F.sum("row_count").alias("row_count"),
            F.greatest(F.lit(0.0), 1 - F.coalesce(F.try_divide(F.sum("nulls"), F.sum("cells")), F.lit(0.0))).alias("quality_score"),
            F.min("created_at").alias("created_at"), F.max("written_at").alias("updated_at"))

    def _record(self, **entry: Any) -> None:
        entry = {"seq": time.time_ns(), **entry}
        schema = StructType.fromDDL(WRITES)
        row = [tuple(entry.get(name) for name in schema.names)]
        (self.spark.createDataFrame(row, schema).withColumn("written_at", F.current_timestamp()).coalesce(1)
         .write.mode("append").parquet(self._catalog_path))

    def _compacted(self) -> int | None:
        """The `seq` that the newest whole compaction of the catalog reaches up to."""
        folder = f"{self.root}/_catalog_until"
        if not self._exists(folder):
            return None
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        system = hadoop.Path(folder).getFileSystem(self.spark._jsc.hadoopConfiguration())
        found = [status.getPath() for status in system.listStatus(hadoop.Path(folder))]
        return max((int(path.getName()) for path in found if system.exists(hadoop.Path(path, "_SUCCESS"))), default=None)

    def _writes(self) -> DataFrame:
        """The catalog's rows: those of the newest compaction and what was recorded after it."""
        if not self._exists(self._catalog_path):
            return self.spark.createDataFrame([], WRITES)
        rows, base = self.spark.read.schema(WRITES).parquet(self._catalog_path), self._compacted()
        if base is None:
            return rows
        return rows.where(F.col("seq") > base).unionByName(self.spark.read.schema(WRITES).parquet(f"{self.root}/_catalog_until/{base}"))

    def compact_catalog(self) -> None:
        """Rewrite the catalog's rows as one file; to be run while nobody writes.

        The file stands in a folder of its own, which counts once it is whole; only then what it replaces is deleted.
        A crash at any point leaves a catalog that reads right.
        """
        last = self._writes().agg(F.max("seq")).first()[0]
        if last is not None and last != self._compacted():
            self._writes().coalesce(1).write.mode("overwrite").parquet(f"{self.root}/_catalog_until/{last}")
        if last is not None:
            self._forget(last)

    def _forget(self, base: int) -> None:
        """Delete the records that the compaction up to `base` holds, and earlier compactions."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        system = hadoop.Path(self.root).getFileSystem(self.spark._jsc.hadoopConfiguration())
        rows = self.spark.read.schema(WRITES).parquet(self._catalog_path)
        files = rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.max("seq").alias("last"))
        for row in files.where(F.col("last") <= base).collect():  # a file for each write since the last compaction
            system.delete(hadoop.Path(unquote(row["file"])), False)
        for status in system.listStatus(hadoop.Path(f"{self.root}/_catalog_until")):
            if int(status.getPath().getName()) < base:
                system.delete(status.getPath(), True)

    def _entry(self, name: str, layer: str | None = None) -> dict[str, Any]:
        found = self.catalog().where(F.col("dataset") == name)
        if layer:
            found = found.where(F.col("layer") == layer)
        order = F.array_position(F.array(*[F.lit(one) for one in LAYERS]), F.col("layer"))
        row = found.orderBy(order).first()
        if row is None:
            raise KeyError(f"no dataset {name!r}" + (f" in layer {layer!r}" if layer else ""))
        entry = row.asDict()
        merged: dict[str, Any] = {}
        for write in entry["writes"]:  # columns that came later are null in the rows before, and the other way round
            for field in StructType.fromJson(json.loads(write["schema"])).fields:
                merged.setdefault(field.name, field)
        return {**entry, "schema": StructType(list(merged.values())), "paths": [write["path"] for write in entry["writes"]]}

    def list_datasets(self, layer: str | None = None) -> DataFrame:
        entries = self.catalog()
        return entries if layer is None else entries.where(F.col("layer") == layer)

    def get_dataset_metadata(self, name: str) -> dict[str, Any]:
        return self._entry(name)

    # Writing and reading -----------------------------------------------------------------------

    def _read_paths(self, paths: Sequence[str], file_format: str, schema: StructType) -> DataFrame:
        """All folders in one scan."""
        reader = self.spark.read.schema(schema).option("timestampFormat", TIMESTAMP_FORMAT)
        if file_format == "csv":
            reader = reader.option("header", True).option("escape", '"')
        return reader.format(file_format).load(list(paths))

    def write_dataset(self, data: DataFrame, name: str, layer: str = "raw",
                      partition_columns: Sequence[str] | None = None, file_format: str = "parquet",
                      compression: str = "snappy", overwrite: bool = False, tags: Sequence[str] | None = None,
                      target_bytes: int | None = None, rows_per_file: int = 0) -> str:
        """Append to a dataset, or replace it. The figures of the catalog are observed while the rows are written."""
        if layer not in LAYERS:
            raise ValueError(f"layer must be one of {LAYERS}")
        partitions = list(partition_columns or [])
        df = with_date_parts(data, partitions)
        try:
            old = self._entry(name, layer)
        except KeyError:
            old = None
        if old and not overwrite:
            if old["format"] != file_format:
                raise ValueError(f"{name} is stored as {old['format']}")
            if file_format == "csv" and old["schema"].names != df.columns:
                raise ValueError(f"{name} has the columns {old['schema'].names}")
        path = f"{self.root}/{layer}/{name}/v={uuid.uuid4().hex}"
        seen = Observation()
        nulls = [F.when(F.col(f"`{column}`").isNull(), 1).otherwise(0) for column in df.columns]
        watched = df.observe(seen, F.count(F.lit(1)).alias("rows"), F.sum(sum(nulls[1:], nulls[0])).alias("nulls"))
        write_files(watched, path, file_format, partitions, compression, target_bytes=target_bytes,
                    rows_per_file=rows_per_file)
        found = seen.get
        part = self._read_paths([path], file_format, df.schema)
        rows = found["rows"] or 0
        self._record(dataset=name, layer=layer, kind="replace" if overwrite else "append", path=path, format=file_format,
                     compression=compression, partitions=partitions, schema=df.schema.json(), files=len(part.inputFiles()),
                     bytes=size_in_bytes(part), row_count=rows, nulls=found["nulls"] or 0, cells=rows * len(df.columns),
                     tags=list(tags or [layer]))
        return path

    def read_dataset(self, name: str, layer: str | None = None, columns: Sequence[str] | None = None,
                     filters: Iterable[tuple[str, str, Any]] = (), limit: int | None = None) -> DataFrame:
        """Current rows with filters, projection and limit pushed to the scan."""
        entry = self._entry(name, layer)
        df = self._read_paths(entry["paths"], entry["format"], entry["schema"])
        return read_with(df, columns, filters, limit, strict=entry["format"] == "parquet")

    def retrieve(self, name: str, columns: Sequence[str] | None = None,
                 filters: Iterable[tuple[str, str, Any]] = (), limit: int | None = None) -> DataFrame:
        """A lake dataset of the first layer that has it, else a table or view of the session."""
        try:
            return self.read_dataset(name, None, columns, filters, limit)
        except KeyError:
            return read_with(self.spark.table(name), columns, filters, limit)

    # Upserts -----------------------------------------------------------------------------------

    def upsert(self, data: DataFrame, name: str, key: Sequence[str], layer: str = "processed",
               batch: int | None = None) -> str:
        """Append new versions of rows; `latest` picks the newest per key. No stored row is rewritten."""
        numbered = encode_maps(data).withColumns({
            "_batch": F.lit(batch if batch is not None else time.time_ns()).cast("bigint"),
            "_row": F.monotonically_increasing_id()})
        return self.write_dataset(numbered, name, layer)

    def latest(self, name: str, key: Sequence[str], layer: str = "processed") -> DataFrame:
        return latest_versions(self.read_dataset(name, layer), key)

    # Maintenance -------------------------------------------------------------------------------

    def optimize_dataset(self, name: str, layer: str = "processed", key: Sequence[str] | None = None,
                         target_bytes: int = TARGET_FILE_BYTES) -> str:
        """Rewrite as Parquet files of about `target_bytes`; superseded versions go when a key is given."""
        entry = self._entry(name, layer)
        df = self.read_dataset(name, layer)
        if key:
            df = latest_versions(df, key, keep_batch=True)
        # tasks hold about the target; the number of rows splits what one task has of a single partition value
        rows = -(-entry["row_count"] * target_bytes // max(1, entry["total_bytes"]))
        return self.write_dataset(df, name, layer, entry["partitions"], "parquet", entry["compression"]
                                  if entry["format"] == "parquet" else "snappy", overwrite=True, target_bytes=target_bytes,
                                  rows_per_file=rows)

    def drop_dataset(self, name: str, layer: str) -> None:
        """Take a dataset out of the catalog."""
        self._entry(name, layer)
        self._record(dataset=name, layer=layer, kind="drop")

    def copy_dataset(self, name: str, source: str, target: str, target_name: str | None = None,
                     compression: str = "snappy") -> str:
        """Copy between layers as Parquet."""
        df = self.read_dataset(name, source)
        return self.write_dataset(df, target_name or name, target, None, "parquet", compression, overwrite=True)

    def backup(self, name: str, layer: str = "processed", stamp: str | None = None) -> str:
        """Gzip copy in the archive under a stamped name."""
        stamp = stamp or time.strftime("%Y%m%d_%H%M%S")
        return self.copy_dataset(name, layer, "archive", f"{name}_{stamp}", "gzip")

    def migrate(self, name: str, layer: str, table: str) -> None:
        """Move a dataset into a table of the session catalog."""
        self.read_dataset(name, layer).write.mode("overwrite").saveAsTable(table)

    def cleanup_old_data(self, retention_days: int, as_of: Column) -> list[str]:
        """Archive and drop datasets created before the retention period."""
        old = self.catalog().where((F.col("layer") != "archive") & (
            F.unix_micros("created_at") < F.unix_micros(as_of) - retention_days * 86_400_000_000))
        done = []
        for row in old.select("dataset", "layer").collect():  # catalog rows, not data
            self.copy_dataset(row["dataset"], row["layer"], "archive")
            self.drop_dataset(row["dataset"], row["layer"])
            done.append(f"{row['dataset']} ({row['layer']})")
        return done


def encode_maps(df: DataFrame) -> DataFrame:
    """Struct and map columns as JSON text."""
    nested = [name for name, dtype in df.dtypes if dtype.startswith(("struct", "map"))]
    return df.withColumns({name: F.to_json(name) for name in nested})


def latest_versions(df: DataFrame, key: Sequence[str], version: str = "_batch", keep_batch: bool = False) -> DataFrame:
    """Newest row per key: of the last batch, and in it the last row by `_row` where that is known.

    An aggregate, so many versions of one key are reduced before the shuffle.
    """
    row = F.struct(*df.columns)
    order = F.struct(version, "_row") if "_row" in df.columns else F.col(version)
    newest = (df.groupBy(*[F.col(name).alias(f"_k_{name}") for name in key])
              .agg(F.max_by(row, order).alias("_newest")).select("_newest.*"))
    return newest if keep_batch else newest.drop(version, "_row")


def retained(df: DataFrame, ts: str, days: int, as_of: Column) -> DataFrame:
    """Rows no older than `days`."""
    return df.where(F.unix_micros(ts) >= F.unix_micros(as_of) - days * 86_400_000_000)


def export(df: DataFrame, path: str, file_format: str = "csv") -> str:
    """CSV or JSON records for download."""
    write_files(df, path, file_format, compression="none")
    return path


def append_job_log(spark: SparkSession, rows: DataFrame, path: str) -> None:
    """Add job or metric rows to a log table."""
    rows.write.mode("append").parquet(path)


def extract_tables(tables: Mapping[str, DataFrame], path: str, limit: int = 100) -> dict[str, list[str]]:
    """The first rows of every table as CSV and JSON: a preview, ordered by the first column."""
    written = {}
    for name, df in tables.items():
        few = df.orderBy(df.columns[0]).limit(limit)
        flat = encode_maps(few)
        written[name] = [export(flat, f"{path}/csv/{name}", "csv"), export(few, f"{path}/json/{name}", "json")]
    return written


def query_data(spark: SparkSession, sql: str, args: Mapping[str, Any] | None = None,
               json_columns: Mapping[str, str] | None = None) -> DataFrame:
    """Parameterised SQL over the session's tables; JSON text columns are parsed with the given schemas."""
    df = spark.sql(sql, args=dict(args or {}))
    return df.withColumns({name: F.from_json(name, ddl) for name, ddl in (json_columns or {}).items()})
