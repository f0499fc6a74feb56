"""What the operators of this package share: reading, Arrow maps, text classes."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# White space of all word rules here, and a word in Java's and Python's syntax.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def slim(docs: DataFrame, id_col: str, text_col: str, **more: Column) -> DataFrame:
    """Only the id and the text, under fixed names, so that no other column can clash."""
    return docs.select(
        docs[id_col].cast("long").alias("doc_id"),
        F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"),
        *[column.alias(name) for name, column in more.items()],
    )


def free_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def map_batches(df: DataFrame, make: Callable[..., dict], schema: str, **settings: object) -> DataFrame:
    """Apply ``make(batch, **settings) -> {column: values}`` to every Arrow batch of ``df``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield to_batch(make(batch, **settings), schema)

    return df.mapInArrow(run, schema)


@contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Within it, Arrow batches hold at most ``rows`` rows: for rows with long binary values."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(name)
    spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.set(name, old)


_ARROW = {
    "long": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "boolean": pa.bool_(),
    "string": pa.string(),
    "binary": pa.binary(),
}


def to_batch(columns: dict, schema: str) -> pa.RecordBatch:
    """A record batch of a schema such as ``a long, b string`` from lists or Arrow arrays."""
    fields = [field.split() for field in schema.split(",")]
    arrays = [c if isinstance(c := columns[n], pa.Array) else pa.array(c, _ARROW[kind]) for n, kind in fields]
    return pa.RecordBatch.from_arrays(arrays, names=[n for n, _ in fields])


def digest_spans(spans: Iterable[str]) -> str:
    return hashlib.sha256(",".join(spans).encode()).hexdigest()


def utf8_column(batch: pa.RecordBatch, name: str) -> tuple[memoryview, list[int]]:
    """All texts of a batch as one run of UTF-8 bytes, and where each begins (one end more)."""
    column = batch.column(name)
    if pa.types.is_large_string(column.type):
        column = column.cast(pa.string())
    offsets = memoryview(column.buffers()[1]).cast("i")[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return memoryview(data) if data is not None else memoryview(b""), list(offsets)
