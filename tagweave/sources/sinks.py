"""Writers for samples, lookup tables, transactions and the run report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagweave.operators.lookup import heavy_by_count, lookup
from tagweave.operators.mining import item_appearances, signed_items, transaction_lines
from tagweave.operators.samples import flatten_samples
from tagweave.options import SET_NAMES, Options
from tagweave.sources.manifest import commit_table

SAMPLE_LAYOUT = ("domain", "set", "rng")
# Rows of a shard that one task writes, if the size of the shard is known.
ROWS_PER_WRITER = 50_000


def write_samples(
    samples: DataFrame, output: str, opts: Options, summary_metadata: bool = False, counts: DataFrame | None = None
) -> None:
    """Sample table, laid out by domain, set and shard.

    The shard is part of the shuffle key, so a domain that holds most of the
    posts is written by many tasks. With the ``counts`` of rows by domain and set
    that the shards were cut by, a shard of more than ``ROWS_PER_WRITER`` rows is
    dealt by id to several tasks, each of which writes a file of its own.
    """
    by = list(SAMPLE_LAYOUT)
    if counts is not None:
        samples = lookup(samples, counts, ["domain", "set"], heavy_by_count(counts, "rows"), "uniqueID")
        shard = F.col("rows") / F.ceil(F.col("rows") / F.lit(opts.rows_per_shard))
        writers = F.coalesce(F.ceil(shard / F.lit(ROWS_PER_WRITER)), F.lit(1))
        samples = samples.withColumn("_writer", F.pmod(F.xxhash64("uniqueID"), writers)).drop("rows")
        by.append("_writer")
    samples = samples.repartition(*by).drop("_writer")
    if opts.output_format == "csv":
        samples = flatten_samples(samples)
    writer = samples.write.partitionBy(*SAMPLE_LAYOUT).mode("overwrite")
    writer = writer.option("maxRecordsPerFile", opts.max_records_per_file)
    if summary_metadata:
        writer = writer.option("parquet.summary.metadata.level", "ALL")
    if opts.output_format == "csv":
        writer.option("delimiter", "|").csv(f"{output}/dataset")
    else:
        writer.parquet(f"{output}/dataset")


def commit_samples(samples: DataFrame, output: str, opts: Options) -> int:
    """The sample table as the next version under a manifest; Parquet only. Gives the version."""
    return commit_table(samples, f"{output}/dataset", SAMPLE_LAYOUT, "uniqueID", opts.max_records_per_file)


def write_lookup(
    df: DataFrame,
    path: str,
    opts: Options,
    partition_by: str | None = None,
    delimiter: str = "|",
    single_file: bool = False,
) -> None:
    """A dimension table as Parquet or CSV; one file only on request."""
    writer = (df.coalesce(1) if single_file else df).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if opts.output_format == "csv":
        writer.option("delimiter", delimiter).csv(path)
    else:
        writer.parquet(path)


def write_lookups(tables: dict[str, DataFrame], output: str, opts: Options, single_file: bool = False) -> None:
    """Global tags, domain tags, dictionary and bag vocabulary."""
    write_lookup(tables["global_tags"].select("tag", "tagGlobalRank"), f"{output}/global_tags", opts, single_file=single_file)
    write_lookup(tables["domain_tags"], f"{output}/tags/domain_tags", opts, "domain", single_file=single_file)
    write_lookup(tables["dictionary"], f"{output}/dictionary", opts, single_file=single_file)
    write_lookup(
        tables["vocabulary"].select("words", "rank"), f"{output}/bagWordsDictionary", opts, delimiter=",", single_file=single_file
    )


# What the report calls the totals of a run.
TOTALS = {"dictionary": "dictionary_tokens", "global_tags": "global_tags", "samples": "samples", "vocabulary": "bag_vocabulary"}


def run_report(domain_tags: DataFrame, totals: dict[str, int]) -> DataFrame:
    """Statistics of a run: ``metric, key, value``; the totals were counted as the tables were written."""
    per_domain = domain_tags.groupBy("domain").agg(F.count("tag").alias("value")).select(
        F.lit("tags_in_domain").alias("metric"), F.col("domain").alias("key"), "value"
    )
    rows = [(metric, "", totals[name]) for name, metric in TOTALS.items()]
    return per_domain.unionByName(domain_tags.sparkSession.createDataFrame(rows, "metric string, key string, value long"))


def write_report(report: DataFrame, output: str) -> None:
    """One row per domain and metric: small enough for one file."""
    report.coalesce(1).write.mode("overwrite").json(f"{output}/metadata")


def write_transactions(samples: DataFrame, output: str, single_file: bool = False) -> None:
    """Per set, the transactions and the item appearances that rule miners read."""
    signed = signed_items(samples)
    lines = transaction_lines(signed)
    roles = item_appearances(signed).select("set", F.concat_ws(" ", F.col("item").cast("string"), "role").alias("both"))
    for name in SET_NAMES:
        of_set = F.col("set") == name
        transactions = lines.where(of_set).select("line")
        appearances = roles.where(of_set).select("both")
        if single_file:
            transactions, appearances = transactions.coalesce(1), appearances.coalesce(1)
        folder = f"{output}/{name.lower()}"
        transactions.write.mode("overwrite").text(f"{folder}.transactions")
        appearances.write.mode("overwrite").option("header", True).option("quote", "").csv(f"{folder}.appearances")
