"""Intermediate tables, written once to the cluster's shared folder.

A written table cuts the lineage, survives the loss of executors and carries
its real size, so Catalyst can tell a small dimension (broadcast) from a large
one (shuffle) without being told.
"""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

_used: set[str] = set()


def shared_folder(spark: SparkSession) -> str:
    """This application's folder for intermediate tables, deleted when it ends.

    It lies in ``spark.checkpoint.dir`` or, where that is unset, in the warehouse,
    unless that is a folder of one machine and the executors run on others.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir")
        if folder.startswith("file:") and not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = f"{folder}/tagweave/{spark.sparkContext.applicationId}"
    if path not in _used:
        _used.add(path)
        atexit.register(clear, spark, path)
    return path


def clear(spark: SparkSession, path: str | None = None) -> None:
    """Delete the application's intermediate tables; results that still read them are lost."""
    path = path or shared_folder(spark)
    _used.discard(path)
    context = spark.sparkContext
    if context._jsc is None:  # stopped: the folder may be expired
        return
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder as Parquet and read it back."""
    path = new_path(df.sparkSession, label)
    df.write.mode("error").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(written: DataFrame) -> None:
    """Delete a table of :func:`materialize` that no result reads any more, before the application ends."""
    context = written.sparkSession.sparkContext
    for folder in {file.rsplit("/", 1)[0] for file in written.inputFiles()}:
        path = context._jvm.org.apache.hadoop.fs.Path(context._jvm.java.net.URI.create(folder))
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def materialize_observed(df: DataFrame, label: str, **metrics: Column) -> tuple[DataFrame, Row]:
    """:func:`materialize`, and aggregates over the rows that come along with the write: no job of their own."""
    seen = Observation()
    written = materialize(df.observe(seen, *[column.alias(name) for name, column in metrics.items()]), label)
    return written, Row(**seen.get)


def spread(df: DataFrame, key: str | None = None) -> DataFrame:
    """Give every core work when the input comes in few splits.

    A file without row groups, or a CSV file with quoted line breaks, is read
    by one task. Only inputs that would leave more than half of the cores idle
    are shuffled; large inputs have more splits than the cluster has cores. The
    key is the whole row, so null ids do not meet, or a column without nulls,
    which keeps the others prunable. The number of partitions is left to
    adaptive execution.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(F.xxhash64(*([key] if key else df.columns))) if 2 * df.rdd.getNumPartitions() <= cores else df
