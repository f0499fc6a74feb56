"""Assembling, sharding and flattening the sample table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagweave.functions.hashing import stable_hash
from tagweave.operators.lookup import heavy_by_count, lookup
from tagweave.operators.ordering import ordered_index
from tagweave.operators.skew import skew_join
from tagweave.sources.tables import materialize


def empty_labels() -> Column:
    return F.array().cast("array<int>")


def assemble_samples(text: DataFrame, encoded: DataFrame, how: str = "left") -> DataFrame:
    """Join encoded tags to the processed text of the same post.

    Posts without tags keep empty label sets and count 0; the domain is the
    text's. Posts without id have no tags; a left join keeps each of them.
    """
    return label_samples(skew_join(text, encoded.drop("domain"), ["uniqueID"], how, right_unique=True))


def label_samples(labelled: DataFrame) -> DataFrame:
    """The sample columns of text that already carries its encoded tags."""
    return labelled.select(
        "uniqueID",
        "title",
        "body",
        "domain",
        F.coalesce("globalTags", empty_labels()).alias("globalLabels"),
        F.coalesce("domainTags", empty_labels()).alias("domainSpecificLabels"),
        F.coalesce(F.col("originalTagCount").cast("int"), F.lit(0)).alias("originalTagCount"),
        "set",
    )


def attach_features(samples: DataFrame, features: DataFrame) -> DataFrame:
    """Left join of a separate feature table; samples without id stay, without features."""
    return skew_join(samples, features, ["uniqueID"], "left")


def shard_counts(samples: DataFrame) -> DataFrame:
    """Rows per (domain, set), written: also the true row count of the report."""
    counts = samples.groupBy("domain", "set").agg(F.count("*").alias("rows"))
    return materialize(counts, "shard-counts")


def shard_by_hash(samples: DataFrame, counts: DataFrame, rows_per_shard: int) -> DataFrame:
    """Add ``rng``: pieces of about ``rows_per_shard`` rows of each (domain, set).

    The piece depends on the post's id, not on where the row happens to lie, so
    a rewritten row returns to its piece. No row moves for it.
    """
    found = lookup(samples, counts, ["domain", "set"], heavy_by_count(counts, "rows"), "uniqueID")
    pieces = F.ceil(F.col("rows") / F.lit(rows_per_shard))
    return found.withColumn("rng", F.pmod(stable_hash(F.col("uniqueID")), pieces)).drop("rows")


def shard_exactly(samples: DataFrame, rows_per_shard: int) -> DataFrame:
    """Add ``rng``: consecutive ids of a (domain, set) in pieces of exactly that size."""
    placed = ordered_index(
        samples, [F.asc("uniqueID")], "_position", by=["domain", "set"], dtype="long"
    )
    return placed.withColumn("rng", F.floor(F.col("_position") / rows_per_shard)).drop("_position")


def flatten_samples(samples: DataFrame) -> DataFrame:
    """Array columns as blank-separated text, for formats that hold no arrays; bags as ``rank:value``."""
    arrays = ("title", "body", "globalLabels", "domainSpecificLabels")
    flat = {a: F.array_join(F.col(a).cast("array<string>"), " ") for a in arrays}
    cell = lambda c: F.concat_ws(":", c["rank"].cast("string"), c["value"].cast("string"))
    bags = [c for c in samples.columns if c.endswith("Bag")]
    flat |= {b: F.array_join(F.transform(b, cell), " ") for b in bags}
    return samples.withColumns(flat)
