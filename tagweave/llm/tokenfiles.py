"""Token ids in ORC files, in the order of document ids.

The texts are range-partitioned by id and encoded in that order, so every file
holds one run of ids and every row knows how many ids its own file has before
it; one total per file then gives each document's place in the whole. ORC packs
the ids as run-length integers, splits into stripes that are read in parallel,
and keeps per-stripe indexes and Bloom filters of ``doc_id``, which let a lookup
skip files, stripes and row groups by metadata alone.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tagweave.llm.common import documents, map_batches, slim
from tagweave.llm.tokens import TOKENIZER, encoder
from tagweave.sources.tables import shared_folder

END_ID = 2
SCHEMA = "part int, doc_id long, local_start long, n_tokens long, ids array<int>"
ORC = {
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "orc.create.index": "true",
    "orc.row.index.stride": "1000",
    "orc.stripe.size": str(64 << 20),
    "orc.compress": "ZSTD",
}


def write_token_files(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str = TOKENIZER,
    end_id: int = END_ID,
) -> None:
    """Encode every text, append ``end_id`` and write the ids by ascending id (null ids first).

    A null text counts as empty and still gets its end id. Repeated ids stand
    next to each other, by text. The range key includes a hash of the text, so
    one id with very many rows still spreads over partitions.
    """
    keys = ["doc_id", "tie"]
    rows = slim(docs, id_col, text_col).withColumn("tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys, "text").select("doc_id", "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(tokenizer).encode_all, np.array([end_id], "<u4").tobytes()
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            ids = [x + end for x in encode(batch.column("text").to_pylist())]
            sizes = np.array([len(x) // 4 for x in ids], np.int64)
            ends = np.cumsum(sizes)
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate(([0], ends)), pa.int32()), pa.array(np.frombuffer(b"".join(ids), "<i4"))
            )
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(ids), part, np.int32)),
                    batch.column("doc_id"),
                    pa.array(ends - sizes + before),
                    pa.array(sizes),
                    lists,
                ],
                names=["part", "doc_id", "local_start", "n_tokens", "ids"],
            )
            before += int(sizes.sum())

    ordered.mapInArrow(encode, SCHEMA).write.mode("error").options(**ORC).orc(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids of every document, from the files.

    The window runs over one total per written partition, not over documents. Rows
    of one id, or of none, are apart; a folder that was written from an empty table
    gives an empty one.
    """
    rows = spark.read.schema(SCHEMA).orc(path)
    ends = rows.groupBy("part").agg(F.max(F.col("local_start") + F.col("n_tokens")).alias("tokens"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = ends.select(F.col("part").alias("of"), F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"))
    return rows.join(F.broadcast(parts), F.col("part") == F.col("of")).select(
        "doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids"
    )


def find_documents(spark: SparkSession, path: str, doc_ids: Sequence[int]) -> DataFrame:
    """The rows of some ids, all rows of repeated ones; the filter reaches the files' indexes and Bloom filters."""
    return spark.read.schema(SCHEMA).orc(path).where(F.col("doc_id").isin(list(doc_ids))).select("doc_id", "ids")


def _checksums(batch: pa.RecordBatch) -> dict:
    lists = batch.column("ids")
    at = lists.offsets.to_numpy()
    data = memoryview(np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), "<i4")).cast("B")
    return {
        "doc_id": batch.column("doc_id"),
        "start": batch.column("start"),
        "n_tokens": batch.column("n_tokens"),
        "ids_crc32": [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)],
    }


def token_checksums(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the CRC-32 of the ids as little-endian unsigned 32-bit integers."""
    return map_batches(tokens, _checksums, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op5_orc_tokens(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{shared_folder(spark)}/token-files-{uuid.uuid4().hex}"
    write_token_files(documents(spark, folder), path)
    return token_checksums(read_token_files(spark, path))
