"""Session factory and shared scratch space."""

from __future__ import annotations

import tempfile
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: The folder of a local run that names none.
_own: tempfile.TemporaryDirectory | None = None
_own_lock = threading.Lock()


def build_session(app: str = "reviewlake", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings this library is written for."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.scheduler.mode": "FAIR",
        **{key.replace("__", "."): str(value) for key, value in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of the cluster; for local runs without one a temporary folder that goes with the process."""
    global _own
    context = spark.sparkContext
    base = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if base is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        with _own_lock:  # parts of a run may ask side by side
            _own = _own or tempfile.TemporaryDirectory(prefix="reviewlake-", ignore_cleanup_errors=True)
        base = _own.name
        context.setCheckpointDir(base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder name below the shared folder, grouped by application."""
    app = spark.sparkContext.applicationId
    return f"{scratch_root(spark)}/reviewlake/{app}/{label}-{uuid.uuid4().hex}"


def release_scratch(spark: SparkSession) -> None:
    """Delete what this application wrote to the shared folder."""
    app = spark.sparkContext.applicationId
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{scratch_root(spark)}/reviewlake/{app}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, label: str, *folders: str, schema: StructType | None = None) -> DataFrame:
    """Write `df` to the shared folder and read it back, by `schema` if its types stand for what is stored.

    Cuts the lineage with a table that outlives lost executors, and gives the
    planner exact sizes. Columns, and with `folders` also partitions, are still
    pruned on the way back.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    (df.write.partitionBy(*folders) if folders else df.write).parquet(path)
    return spark.read.schema(schema or df.schema).parquet(path)


def size_in_bytes(df: DataFrame) -> int:
    """Spark's own size estimate of a plan (exact file bytes for a scan)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Use every core for a CPU-heavy projection over few, large row groups.

    Only inputs below one split per core are moved; a large table already has
    more splits than cores and is returned as it is.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    # the setting may have any unit, as in 16m
    split = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    if size_in_bytes(df) > cores * split:
        return df
    return df.repartition(cores, *[F.col(key) for key in keys])


def shuffle_partitions(df: DataFrame) -> int:
    """Partitions for an explicit range partitioning."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
