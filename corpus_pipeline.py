"""A corpus from raw documents to packed sequences, in five stages.

Each stage gets what its predecessor kept, as Parquet, and returns the columns of
``documents``; the last returns the pieces of the packed sequences. Every stage
takes rows one by one, also where ids repeat or are missing, and an empty table
gives an empty one. Further columns go along, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagweave.llm import chunks, lines, mixing, packing, sketches
from tagweave.llm.common import documents, free_name
from tagweave.sources.tables import materialize


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """The documents with a number for each row, and its name; written, so that the numbers hold."""
    row = free_name(docs, "row")
    return materialize(docs.withColumn(row, F.monotonically_increasing_id()), "numbered"), row


def _without(numbered: DataFrame, row: str, dropped: DataFrame) -> DataFrame:
    """The rows whose number is not in ``dropped``; those are the fewer, and may be broadcast."""
    return numbered.join(materialize(dropped, "dropped"), row, "left_anti").drop(row)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are mostly content by their lines' labels.

    A null or blank text has no words and goes. Labels of absent documents and null
    labels count for nothing; without any label only the base rules decide.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return lines.keep_documents(docs, lines.fit(docs, labels))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, ignoring white space.

    The longest original stays, then the smallest id, one without id last, and of
    equal rows any one. Null texts equal empty ones.
    """
    numbered, row = _numbered(docs)
    judged = chunks.deduplicate(numbered, row_col=row)
    return _without(numbered, row, judged.where(~F.col("kept")).select(F.col("row").alias(row)))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by similarity, over any number of links, the one with the smallest id.

    Of equal ids one row stays, and a row without id only where no other has one.
    Null and blank texts are linked with nothing and stay.
    """
    numbered, row = _numbered(docs)
    groups = sketches.near_duplicates(numbered, id_col=row).select(F.col("doc_id").alias(row), "component_id")
    grouped = materialize(groups.join(numbered.select(row, "doc_id"), row), "near-groups")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", row)
    stays = grouped.groupBy("component_id").agg(F.min_by(row, order).alias("stays"), F.count("*").alias("n"))
    several = materialize(stays.where("n > 1").select("component_id", "stays"), "near-stays")
    return _without(numbered, row, grouped.join(several, "component_id").where(F.col(row) != F.col("stays")).select(row))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target asks for, from never to three times.

    A null source is a source of its own; documents without words are never taken.
    """
    return mixing.take(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 1,024 tokens; a null text is one end id."""
    return packing.pack(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_dedup),
    ("n-gram Jaccard join", near_dedup),
    ("mixing sources to target weights", source_mix),
    ("packing", packed),
]

# Line labels and tokens have no SQL; tests hold run() against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), "pipeline")
    return STAGES[-1][1](spark, docs, sf_dir)
