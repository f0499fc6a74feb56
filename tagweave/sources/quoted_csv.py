"""CSV whose quoted fields may hold line breaks, read by many tasks per file.

Whether a line begins inside quotes depends on all lines before it. Each split of a
file is scanned once for what it does to that state, whichever state it begins in;
a window over one row per split then tells the state in which each begins. A second
scan puts lines together to records. Only the records that cross a split, two
pieces a split at most, are joined afterwards; all are parsed by Spark's own parser.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagweave.sources.tables import materialize

QUOTE = '"'
_LINES = ("value", "file", "block")
# A whole record; the end of one that began before its split, or a split that lies
# inside one; the beginning of one that goes on behind its split.
WHOLE, REST, BEGINNING = 0, 1, 2


def ends_inside(line: str, inside: bool, sep: str) -> bool:
    """Whether the text behind a line is still inside quotes.

    A quote opens a field only at its very beginning and is text anywhere else in
    an unquoted one; two quotes within quotes are one; after the closing quote
    anything up to the separator is text.
    """
    if QUOTE not in line:
        return inside
    parts = line.split(QUOTE)
    state = "in" if inside else "start"
    last = len(parts) - 1
    for i, part in enumerate(parts):
        if part and state != "in":
            state = "start" if part.endswith(sep) else "text"
        if i < last:
            state = {"start": "in", "text": "text", "in": "closed", "closed": "in"}[state]
    return state == "in"


def _splits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, pa.RecordBatch, bool]]:
    """The lines of each split of a task, in pieces; the flag marks a split's first piece."""
    at = None
    for batch in batches:
        files, blocks = batch.column("file").to_pylist(), batch.column("block").to_pylist()
        begin = 0
        for i in range(1, len(batch) + 1):
            if i == len(batch) or blocks[i] != blocks[begin] or files[i] != files[begin]:
                here = (files[begin], blocks[begin])
                yield *here, batch.slice(begin, i - begin), here != at
                at, begin = here, i


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")
    )


def split_states(lines: DataFrame, sep: str) -> DataFrame:
    """``file, block, inside, crlf``: how each split begins, and whether its file's first line ends in ``\\r\\n``."""
    schema = "file string, block long, from_outside boolean, from_inside boolean, first string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[list] = []
        for file, block, piece, first in _splits(batches):
            lines = piece.column("value").to_pylist()
            if first:
                rows.append([file, block, False, True, lines[0][-1:]])
            row = rows[-1]
            for line in lines:
                if QUOTE in line:
                    row[2], row[3] = ends_inside(line, row[2], sep), ends_inside(line, row[3], sep)
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
        kinds = (pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[f.split()[0] for f in schema.split(", ")])

    scanned = materialize(lines.mapInArrow(run, schema), "csv-splits")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    up_to = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    # A split either sets the state, flips it, or leaves it.
    fixed = F.when(F.col("from_outside") == F.col("from_inside"), F.col("from_outside").cast("int"))
    marked = scanned.withColumn("fixed", fixed).withColumn(
        "flips", F.sum((F.col("from_outside") & ~F.col("from_inside")).cast("int")).over(up_to)
    )
    since = F.coalesce(F.max("flips").over(before), F.lit(0)) - F.coalesce(
        F.last(F.when(F.col("fixed").isNotNull(), F.col("flips")), ignorenulls=True).over(before), F.lit(0)
    )
    state = F.coalesce(F.last("fixed", ignorenulls=True).over(before), F.lit(0)) + since
    crlf = F.first("first").over(up_to) == "\r"
    return materialize(marked.select("file", "block", (state % 2 == 1).alias("inside"), crlf.alias("crlf")), "csv-states")


def _records(lines: DataFrame, states: DataFrame, sep: str) -> DataFrame:
    """``file, block, place, kind, record`` of all lines, put together within their splits."""
    schema = "file string, block long, place long, kind int, record string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        held: list[str] = []
        file, block, place, inside, kind = "", 0, 0, False, WHOLE

        def close(as_kind: int) -> None:
            nonlocal place, held
            if held:
                out.append((file, block, place, as_kind, "\n".join(held)))
                place, held = place + 1, []

        def batch() -> pa.RecordBatch:
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string())
            columns = list(zip(*out, strict=True)) if out else [[]] * 5
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[f.split()[0] for f in schema.split(", ")])

        for of_file, of_block, piece, first in _splits(batches):
            if first:
                close(REST if kind == REST else BEGINNING)
                file, block, place = of_file, of_block, 0
                inside, crlf = piece.column("inside")[0].as_py(), piece.column("crlf")[0].as_py()
                kind = REST if inside else WHOLE
            for line in piece.column("value").to_pylist():
                if crlf and line.endswith("\r"):
                    line = line[:-1]
                inside = ends_inside(line, inside, sep)
                held.append(line)
                if not inside:
                    close(kind)
                    kind = WHOLE
            yield batch()
        close(REST if kind == REST else BEGINNING)
        yield batch()

    # One row per split of a file, so small beside the text.
    known = lines.join(F.broadcast(states), ["file", "block"]).select(*_LINES, "inside", "crlf")
    return known.mapInArrow(run, schema)


def read_quoted_csv(spark: SparkSession, path: str, schema: T.StructType, sep: str = "|") -> DataFrame:
    """The records of all files that ``path`` matches, by the given schema.

    Gives what Spark's reader gives with ``multiLine`` in the same dialect (quotes
    doubled within quotes, no header), except that order is not kept. Blank lines
    are no records; fields that do not parse are null; a file that ends inside
    quotes ends its last record. In a file whose first line ends in ``\\r\\n`` all
    such line ends count as ``\\n``.
    """
    lines = _lines(spark, path)
    options = {"sep": sep, "quote": QUOTE, "escape": QUOTE}
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parsed = lambda record: F.from_csv(record, ddl, options)
    whole = F.when(F.col("kind") == WHOLE, F.col("record"))
    rows = _records(lines, split_states(lines, sep), sep)
    # Parsed as they are written; only pieces keep their text.
    rows = rows.where((F.col("kind") != WHOLE) | (F.col("record") != "")).select(
        "file", "block", "place", "kind", F.when(F.col("kind") != WHOLE, F.col("record")).alias("piece"), parsed(whole).alias("row")
    )
    rows = materialize(rows, "csv-records")
    pieces = rows.where(F.col("kind") != WHOLE)
    in_order = Window.partitionBy("file").orderBy("block", "place")
    number = F.sum((F.col("kind") == BEGINNING).cast("int")).over(in_order)
    joined = pieces.withColumn("number", number).groupBy("file", "number").agg(
        F.sort_array(F.collect_list(F.struct("block", "place", "piece"))).alias("pieces")
    )
    crossing = joined.select(parsed(F.array_join(F.transform("pieces", lambda p: p["piece"]), "\n")).alias("row"))
    return rows.where(F.col("kind") == WHOLE).select("row.*").unionByName(crossing.select("row.*"))
