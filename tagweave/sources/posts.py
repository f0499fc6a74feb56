"""Readers for the post tables and for the tables the jobs write."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagweave.functions.text import strip_carriage_return, strip_math
from tagweave.sources.manifest import last_version, read_committed
from tagweave.sources.quoted_csv import read_quoted_csv
from tagweave.sources.tables import spread

TEXT_SCHEMA = T.StructType(
    [
        T.StructField("uniqueID", T.LongType()),
        T.StructField("title", T.StringType()),
        T.StructField("body", T.StringType()),
        T.StructField("domain", T.StringType()),
    ]
)
TAG_SCHEMA = T.StructType(
    [
        T.StructField("uniqueID", T.LongType()),
        T.StructField("tags", T.StringType()),
        T.StructField("domain", T.StringType()),
    ]
)

# The dialect and file names of the input format.
CSV_DIALECT = {"header": False, "sep": "|", "quote": '"', "escape": '"'}
TEXT_FILES = "postText*.csv"
TAG_FILES = "postTag*.csv"


def clean_text(posts: DataFrame, dotall: bool = False) -> DataFrame:
    """Null strings become empty, ``\\r`` leaves the domain, formulas leave the text."""
    return posts.na.fill("").withColumns(
        {
            "domain": strip_carriage_return(F.col("domain")),
            "title": strip_math(F.col("title"), dotall),
            "body": strip_math(F.col("body"), dotall),
        }
    )


def clean_tags(tags: DataFrame) -> DataFrame:
    return tags.na.fill("").withColumn("domain", strip_carriage_return(F.col("domain")))


def read_post_text(spark: SparkSession, folder: str, dotall: bool = False) -> DataFrame:
    """Posts of ``postText*.csv``: headerless, ``|``-separated, quotes may span lines.

    A written table: files of any size are read by many tasks, and read once.
    """
    raw = read_quoted_csv(spark, f"{folder}/{TEXT_FILES}", TEXT_SCHEMA)
    return clean_text(spread(raw), dotall)


def read_post_tags(spark: SparkSession, folder: str) -> DataFrame:
    raw = read_quoted_csv(spark, f"{folder}/{TAG_FILES}", TAG_SCHEMA)
    return clean_tags(spread(raw))


def write_posts(text: DataFrame, tag_rows: DataFrame, folder: str) -> None:
    """Both post tables in the input dialect, as folders that the readers' patterns match."""
    dialect = CSV_DIALECT | {
        "quoteAll": True,
        "ignoreLeadingWhiteSpace": False,
        "ignoreTrailingWhiteSpace": False,
    }
    for df, schema, name in ((text, TEXT_SCHEMA, "postText.csv"), (tag_rows, TAG_SCHEMA, "postTags.csv")):
        df.select(*schema.names).write.mode("overwrite").options(**dialect).csv(f"{folder}/{name}")


def distinct_domains(posts: DataFrame) -> DataFrame:
    return posts.select("domain").distinct()


def read_samples(
    spark: SparkSession, output: str, domain: str | None = None, set_name: str | None = None
) -> DataFrame:
    """Sample table, optionally one domain and one set of it (partition pruning).

    If the table has committed versions, the last of them.
    """
    folder = f"{output}/dataset"
    samples = read_committed(spark, folder) if last_version(spark, folder) else spark.read.parquet(folder)
    wanted: list[Column] = []
    if domain is not None:
        wanted.append(F.col("domain") == domain)
    if set_name is not None:
        wanted.append(F.col("set") == set_name)
    for condition in wanted:
        samples = samples.where(condition)
    return samples


LOOKUPS = {
    "dictionary": ("dictionary", "hash long, token string, index int"),
    "global_tags": ("global_tags", "tag string, tagGlobalRank int"),
    "domain_tags": ("tags/domain_tags", "tag string, tagInDomainCount long, tagRankInDomain int, domain string"),
    "vocabulary": ("bagWordsDictionary", "words string, rank int"),
}


def read_lookups(spark: SparkSession, output: str, output_format: str = "parquet") -> dict[str, DataFrame]:
    """The dimension tables next to the samples, in either format they are written in."""
    if output_format == "parquet":
        return {name: spark.read.parquet(f"{output}/{path}") for name, (path, _) in LOOKUPS.items()}
    separators = dict.fromkeys(LOOKUPS, "|") | {"vocabulary": ","}
    return {
        name: spark.read.schema(schema).option("sep", separators[name]).csv(f"{output}/{path}")
        for name, (path, schema) in LOOKUPS.items()
    }
