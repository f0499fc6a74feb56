"""Exact deduplication by recipes of content-defined chunks.

A text without its white space is cut where a rolling hash of its own bytes says
so; equal texts are cut alike. Chunks are told apart by SHA-256, and every digest
met twice is verified against the bytes, which are moved only for such chunks. A
text is then the list of its chunks' identifiers, and two texts are equal exactly
if their lists are: long texts are compared, grouped and joined without moving.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tagweave.llm.common import SPACES, documents, map_batches, slim
from tagweave.llm.rolling import BLOCK, window_hashes
from tagweave.sources.tables import materialize

WINDOW = 48
MASK = 0x1FFF
SMALLEST, LARGEST = 2_048, 65_536

_DROP = SPACES.encode()

def _cuts(data: np.ndarray) -> np.ndarray:
    """Ends of all windows whose hash has the cutting bits."""
    found = [np.empty(0, np.int64)]
    for at in range(0, len(data), BLOCK):
        hashes = window_hashes(data[at : at + BLOCK + WINDOW - 1], WINDOW)
        found.append(np.flatnonzero(hashes & np.uint64(MASK) == 0) + at + WINDOW)
    return np.concatenate(found)


def chunk_ends(data: bytes) -> list[int]:
    """Where the chunks of ``data`` end; the last one ends with it."""
    ends, last = [], 0
    cuts = _cuts(np.frombuffer(data, np.uint8)).tolist() if len(data) > SMALLEST else []
    for cut in [*cuts, len(data)]:
        while cut - last > LARGEST:
            last += LARGEST
            ends.append(last)
        if cut - last >= SMALLEST or cut == len(data):
            last = cut
            ends.append(last)
    return ends


def sha(data: bytes) -> bytes:
    return hashlib.sha256(data).digest()


def _chunk_rows(batch: pa.RecordBatch, digest: Callable[[bytes], bytes]) -> dict:
    out: dict[str, list] = {
        n: [] for n in ("row", "doc_id", "n_chars", "text_sha256", "recipe", "place", "digest", "content")
    }
    for row, doc_id, text in zip(*(batch.column(n).to_pylist() for n in ("row", "doc_id", "text")), strict=True):
        data = text.encode("utf-8", "surrogatepass").translate(None, _DROP)
        start, ids = 0, []
        ends = chunk_ends(data)
        for place, end in enumerate(ends):
            content = data[start:end]
            ids.append(digest(content))
            out["place"].append(place)
            out["digest"].append(ids[-1])
            out["content"].append(content)
            start = end
        n = len(ends)
        for name, value in (
            ("row", row),
            ("doc_id", doc_id),
            ("n_chars", len(text)),
            ("text_sha256", hashlib.sha256(data).hexdigest()),
            ("recipe", b"".join(ids)),
        ):
            out[name] += [value, *[value if name == "row" else None] * (n - 1)]
    return out


def _chunk_table(docs: DataFrame, id_col: str, text_col: str, row: Column, digest: Callable[[bytes], bytes]) -> DataFrame:
    """One row per chunk; a text's first chunk also carries what belongs to the text."""
    rows = slim(docs, id_col, text_col, row=row)
    schema = (
        "row long, doc_id long, n_chars long, text_sha256 string, recipe binary, place int, digest binary, content binary"
    )
    return materialize(map_batches(rows, _chunk_rows, schema, digest=digest), "chunks")


def _collided(chunks: DataFrame) -> DataFrame:
    """Digests that stand for several contents; copies are put together before they are moved."""
    contents = chunks.select("digest", "content").distinct()
    several = contents.groupBy("digest").agg(F.count("*").alias("n")).where("n > 1")
    return materialize(several.select("digest"), "collided-digests")


def _numbers(chunks: DataFrame, collided: DataFrame) -> DataFrame:
    """Every row's places with such a digest, each with its content's number among the digest's contents."""
    contents = chunks.join(collided, "digest").select("digest", "content").distinct()
    numbered = contents.withColumn("number", F.row_number().over(Window.partitionBy("digest").orderBy("content")))
    return (
        chunks.join(numbered, ["digest", "content"])
        .groupBy("row")
        .agg(F.to_json(F.sort_array(F.collect_list(F.struct("place", "number")))).cast("binary").alias("numbers"))
    )


def recipes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    row_col: str | None = None,
    digest: Callable[[bytes], bytes] = sha,
) -> DataFrame:
    """One row per input row: row, doc_id, n_chars, text_sha256 and ``recipe``, its verified identifiers in order.

    An identifier is a chunk's digest. Should one digest stand for several
    contents, those chunks are numbered and their recipes carry the numbers too.
    """
    row = docs[row_col] if row_col else F.monotonically_increasing_id()
    chunks = _chunk_table(docs, id_col, text_col, row, digest)
    texts = chunks.where("place = 0").select("row", "doc_id", "n_chars", "text_sha256", "recipe")
    collided = _collided(chunks)
    if collided.isEmpty():
        return texts
    return texts.join(_numbers(chunks, collided), "row", "left").select(
        "row",
        "doc_id",
        "n_chars",
        "text_sha256",
        F.concat("recipe", F.coalesce("numbers", F.lit(b""))).alias("recipe"),
    )


def deduplicate(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    row_col: str | None = None,
    digest: Callable[[bytes], bytes] = sha,
) -> DataFrame:
    """For every input row the row that stays for its text, ignoring white space.

    Of equal texts the one with most code points stays, then the smallest id (a
    null id last), then the first of repeated rows: exactly one row a group has
    ``kept``. Null and blank texts are equal to the empty text. An empty table
    gives an empty result. Returns doc_id, keep_id, group_size, kept,
    text_sha256 and row, which is ``row_col`` (unique) or a number for each input
    row as Spark reads it.
    """
    texts = recipes(docs, id_col, text_col, row_col, digest)
    order = F.struct(-F.col("n_chars"), F.col("doc_id").isNull(), F.col("doc_id"), F.col("row"))
    groups = materialize(
        texts.groupBy("recipe")
        .agg(F.count("*").alias("group_size"), F.min_by(F.struct("doc_id", "row"), order).alias("stays"))
        .where("group_size > 1")
        .select(F.col("recipe").alias("of"), "group_size", "stays"),
        "equal-texts",
    )
    alone = F.col("group_size").isNull()
    return texts.join(groups, F.col("recipe") == F.col("of"), "left").select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("stays.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("row") == F.col("stays.row"))).alias("kept"),
        "text_sha256",
        "row",
    )


def op6_chunk_recipes(spark: SparkSession, folder: str) -> DataFrame:
    return deduplicate(documents(spark, folder)).drop("row")


OP6_SQL = r"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS bare FROM documents
), groups AS (
  SELECT *, count(*) OVER (PARTITION BY bare) AS group_size,
         first_value(doc_id) OVER (PARTITION BY bare ORDER BY length(text) DESC, doc_id) AS keep_id FROM texts
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(bare) AS text_sha256 FROM groups
"""
