"""Posts derived from general tables that hold no posts of their own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagweave.operators.skew import skew_join
from tagweave.options import UNDEFINED_DOMAIN
from tagweave.sources.tables import spread


def post_text(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as posts: the first line is the title, the language the domain."""
    text = F.col("text")
    end = F.locate("\n", text)
    documents = spark.read.parquet(f"{folder}/documents.parquet").select(
        F.col("doc_id").alias("uniqueID"), "text", "lang"
    )
    return spread(documents, "uniqueID").select(
        "uniqueID",
        F.when(end > 0, F.substring(text, F.lit(1), end - 1)).otherwise(text).alias("title"),
        F.when(end > 0, F.substring(text, end + 1, F.length(text))).otherwise("").alias("body"),
        F.col("lang").alias("domain"),
    )


def post_tags(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as tagged posts: the brands of their lines, once per return flag.

    The distinct (flag, brand) pairs bound the list by the two small domains,
    however many lines one order has. Lines meet their part by a skew join, so a
    part that fills a third of the lines does not meet in one task. A brand can
    occur under several flags, so the parser has repeats to remove. The domain is the document's language if the id is a document,
    else the order's priority.
    """

    def read(name: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/{name}.parquet")

    lines = read("lineitem").select(F.col("l_orderkey").alias("uniqueID"), "l_partkey", "l_returnflag")
    brands = read("part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    lines = skew_join(spread(lines, "uniqueID"), brands.where("p_brand IS NOT NULL"), ["l_partkey"], right_unique=True)
    languages = read("documents").select(F.col("doc_id").alias("uniqueID"), "lang")
    priorities = read("orders").select(F.col("o_orderkey").alias("uniqueID"), "o_orderpriority")
    pairs = F.sort_array(F.collect_set(F.struct("l_returnflag", "p_brand")))
    return (
        lines.groupBy("uniqueID")
        .agg(F.array_join(F.transform(pairs, lambda p: p["p_brand"]), ",").alias("tags"))
        .join(languages, "uniqueID", "left")
        .join(priorities, "uniqueID", "left")
        .select(
            "uniqueID",
            "tags",
            F.coalesce("lang", "o_orderpriority", F.lit(UNDEFINED_DOMAIN)).alias("domain"),
        )
    )


def language_tags(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as posts tagged with their language, all in one domain: tags that the text tells."""
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    return documents.select(F.col("doc_id").alias("uniqueID"), F.col("lang").alias("tags"), F.lit("documents").alias("domain"))
