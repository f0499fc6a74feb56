"""Tables whose versions are committed by a manifest.

A version's files are written to a folder of their own. Only when they are all
there, a manifest with each file's rows and range of keys is written, and its
success marker, which Spark writes last, is the commit. Readers take the folder
that the last committed manifest names; what a failed write left is never read.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_COMMITS, _MARKER = "_commits", "_SUCCESS"
_SCHEMA = "folder string, file string, partition map<string,string>, rows long, least string, most string"


def _files(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _versions(spark: SparkSession, path: str) -> list[int]:
    files, target = _files(spark, f"{path}/{_COMMITS}")
    if not files.exists(target):
        return []
    names = [status.getPath().getName() for status in files.listStatus(target)]
    marker = spark._jvm.org.apache.hadoop.fs.Path
    return sorted(int(n) for n in names if n.isdigit() and files.exists(marker(f"{path}/{_COMMITS}/{n}/{_MARKER}")))


def last_version(spark: SparkSession, path: str) -> int:
    """The last committed version of a table; 0 if there is none."""
    return max(_versions(spark, path), default=0)


def manifest(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """``folder, file, partition, rows, least, most`` of a version's files, the last by default."""
    version = version or last_version(spark, path)
    if not version:
        raise ValueError(f"no committed version in {path}")
    return spark.read.schema(_SCHEMA).json(f"{path}/{_COMMITS}/{version:08d}")


def commit_table(df: DataFrame, path: str, partition_by: Sequence[str], key: str, max_records: int = 0) -> int:
    """Write ``df`` as the next version, laid out by ``partition_by``; gives its number.

    If the write fails, the versions before stay as they are. Two writers at the
    same time must not share a table: the second of them fails or comes later. A
    table without rows is committed as well, but Spark cannot read it back without
    a schema.
    """
    spark = df.sparkSession
    version = last_version(spark, path) + 1
    name = f"data-{version:08d}-{uuid.uuid4().hex}"
    writer = df.repartition(*partition_by).write.mode("error").partitionBy(*partition_by)
    writer.option("maxRecordsPerFile", max_records).parquet(f"{path}/{name}")
    written = spark.read.schema(df.schema).parquet(f"{path}/{name}")
    # Reads the key column alone; one row a file.
    where = F.create_map(*[x for c in partition_by for x in (F.lit(c), F.col(c).cast("string"))])
    listed = written.groupBy(*partition_by, F.col("_metadata.file_name").alias("file")).agg(
        F.count("*").alias("rows"), F.min(key).cast("string").alias("least"), F.max(key).cast("string").alias("most")
    )
    listed = listed.select(F.lit(name).alias("folder"), "file", where.alias("partition"), "rows", "least", "most")
    # A manifest without marker is what a failed commit left: it may be replaced.
    listed.write.mode("overwrite").json(f"{path}/{_COMMITS}/{version:08d}")
    return version


def read_committed(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The rows of a committed version, the last by default."""
    first = manifest(spark, path, version).select("folder").first()
    if first is None:
        raise ValueError(f"the version of {path} has no rows")
    return spark.read.parquet(f"{path}/{first['folder']}")
