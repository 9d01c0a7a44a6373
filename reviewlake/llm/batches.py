"""Run numpy or plain Python over Arrow batches of a DataFrame and keep the other columns."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from reviewlake.session import scratch_path

#: values of the asked columns, as lists -> lists of values of the new columns
Rows = Callable[..., tuple]

#: What tasks leave in a worker for later tasks of their step, and what the task that begins has asked for.
_kept: dict = {}
_asked: set = set()


def kept_in_worker(key, make: Callable):
    """What `make()` gives, made once in a worker for all tasks of one step; what another step left goes first."""
    _asked.add(key)
    if key not in _kept:
        _kept.clear()
        _kept[key] = make()
    return _kept[key]


def started(start: Callable[[], Rows]) -> Rows:
    """A task's function; what earlier steps left in this worker is given up unless `start` asks for it again."""
    _asked.clear()
    rows = start()
    for key in set(_kept) - _asked:
        del _kept[key]
    return rows


def fields(ddl: str) -> StructType:
    return _parse_datatype_string(ddl)


def others(df: DataFrame, taken: list[str], keep: list[str] | None = None) -> list[str]:
    """Columns that stay beside new ones: a new column replaces one of its name, whatever the case."""
    names = {name.lower() for name in taken}
    return [name for name in (df.columns if keep is None else keep) if name.lower() not in names]


def free_name(df: DataFrame) -> str:
    """A name that no column has."""
    return "_" * (max(map(len, df.columns)) + 1)


def add_columns(df: DataFrame, inputs: list[str], outputs: str, start: Callable[[], Rows],
                keep: list[str] | None = None, size: int | None = None) -> DataFrame:
    """One row for each row: the `keep` columns (default: all) and those that `start()` gives a task.

    With `size`, Python holds about so many bytes of the first input, texts, at a time, or one longer text.
    """
    new = fields(outputs)
    kept = others(df, new.names, keep)
    source = df.select(*[df[name] for name in dict.fromkeys([*kept, *inputs])])
    schema = StructType([source.schema[name] for name in kept] + new.fields)
    arrow = to_arrow_schema(schema)

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            if size is None:
                yield part
                continue
            for begin, end in portions(part.column(part.schema.get_field_index(inputs[0])), size):
                yield part.slice(begin, end - begin)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = started(start)
        for part in cut(parts):
            made = rows(*[part.column(part.schema.get_field_index(name)).to_pylist() for name in inputs])
            columns = [part.column(part.schema.get_field_index(name)) for name in kept]
            columns = [column.cast(field.type) for column, field in zip(columns, arrow)]
            columns += [pa.array(values, field.type) for values, field in zip(made, list(arrow)[len(kept):])]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return source.mapInArrow(run, schema)


def portions(texts: pa.Array, size: int) -> Iterator[tuple[int, int]]:
    """Rows (start, end) that hold about `size` bytes of text together; a longer text stands alone."""
    upto = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())))
    start = 0
    while start < len(upto):
        end = int(np.searchsorted(upto, (upto[start - 1] if start else 0) + size, "right"))
        yield start, max(end, start + 1)
        start = max(end, start + 1)


def add_to_texts(df: DataFrame, text: str, outputs: str, rows: Rows, keep: list[str] | None = None,
                 size: int = 4 * 2 ** 20) -> DataFrame:
    """One row for each row: the `keep` columns (default: all) and those that `rows` makes of a list of texts.

    Python holds about `size` bytes of texts at a time, or one longer text, however many rows a batch has.
    """
    new = fields(outputs)
    kept = others(df, new.names, keep)
    source = df.select(*[df[name] for name in kept], df[text].cast("string").alias(free_name(df)))
    schema = StructType(source.schema.fields[:len(kept)] + new.fields)
    arrow = to_arrow_schema(schema)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        started(lambda: rows)
        for part in parts:
            for start, end in portions(part.columns[-1], size):
                some = part.slice(start, end - start)
                columns = [column.cast(field.type) for column, field in zip(some.columns[:len(kept)], arrow)]
                made = rows(some.columns[-1].to_pylist())
                columns += [pa.array(values, field.type) for values, field in zip(made, list(arrow)[len(kept):])]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return source.mapInArrow(run, schema)


def make_rows(df: DataFrame, inputs: list[str], outputs: str, start: Callable[[], Rows], size: int = 4 * 2 ** 20) -> DataFrame:
    """Any number of rows for each batch; `start()` gives a task its function of lists to columns.

    Python holds the rows of about `size` bytes of the first column of texts or bytes at a time.
    """
    schema = fields(outputs)
    arrow = to_arrow_schema(schema)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = started(start)
        for part in parts:
            texts = [column for column in part.columns if pa.types.is_string(column.type) or pa.types.is_binary(column.type)
                     or pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)]
            for begin, end in portions(texts[0], size) if texts else [(0, part.num_rows)]:
                made = rows(*[column.to_pylist() for column in part.slice(begin, end - begin).columns])
                made = [pa.array(values, field.type) for values, field in zip(made, arrow)]
                if len(made[0]):
                    yield pa.RecordBatch.from_arrays(made, schema=arrow)

    return df.select(*inputs).mapInArrow(run, schema)


def drop_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of DataFrames that nothing refers to any more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def share_file(spark: SparkSession, data: bytes, label: str) -> str:
    """Put `data` as a file before every executor; tasks find it by the returned name with SparkFiles.get.

    The file is written to the shared folder, from where each executor fetches it once, lost ones again.
    """
    place = scratch_path(spark, label)
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    try:
        out.write(bytearray(data))
    finally:
        out.close()
    spark.sparkContext.addFile(place)
    return place.rpartition("/")[2]


class Scratch:
    """Tables in the shared folder that outlive lost executors, until `drop` deletes them.

    Dropping also lets Spark delete the shuffle files of the jobs that are over, so that an operator's disk use is
    that of its largest step.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def store(self, df: DataFrame, label: str) -> DataFrame:
        path = scratch_path(self.spark, label)
        df.write.parquet(path)
        stored = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(stored)] = path
        return stored

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.paths.pop(id(table)))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        drop_shuffles(self.spark)
