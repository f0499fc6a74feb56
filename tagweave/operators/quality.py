"""Checks on inputs and samples, as small result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagweave.operators.rows import explode_rows
from tagweave.operators.text import FIELDS


def row_and_id_counts(posts: DataFrame) -> DataFrame:
    return posts.agg(F.count("*").alias("rows"), F.count_distinct("uniqueID").alias("ids"))


def lost_ids(samples: DataFrame, posts: DataFrame) -> DataFrame:
    """Number of post ids that no sample has."""
    missing = posts.select("uniqueID").join(samples.select("uniqueID"), "uniqueID", "left_anti")
    return missing.agg(F.count("*").alias("lost"))


def split_shares(samples: DataFrame) -> DataFrame:
    """Rows and share of each set."""
    counts = samples.groupBy("set").agg(F.count("*").alias("rows"))
    # The window spans the three counted sets, not the rows.
    sets = Window.partitionBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return counts.withColumn("share", F.col("rows") / F.sum("rows").over(sets))


def share_violations(shares: DataFrame, wanted: dict[str, float], tolerance: float = 0.2) -> DataFrame:
    """Sets whose share is off by more than the tolerance, relative to the wanted share."""
    pairs = [x for name, share in wanted.items() for x in (F.lit(name), F.lit(float(share)))]
    target = F.create_map(*pairs)[F.col("set")]
    return shares.where(F.abs(F.col("share") - target) > F.lit(tolerance) * target)


def feature_violations(bag: DataFrame, tokens: DataFrame) -> DataFrame:
    """Per field, how many posts have more distinct features than tokens.

    ``bag`` is the long form with ``field``; posts without features cannot violate.
    """
    pair = F.array(*[F.struct(F.lit(f).alias("field"), F.size(f).alias("tokens")) for f in FIELDS])
    sizes = explode_rows(tokens, ["uniqueID"], pair, "pair").select("uniqueID", "pair.field", "pair.tokens")
    features = bag.groupBy("uniqueID", "field").agg(F.count("*").alias("features"))
    return (
        features.join(sizes, ["uniqueID", "field"])
        .groupBy("field")
        .agg(F.count("*").alias("posts"), F.count_if(F.col("features") > F.col("tokens")).alias("violations"))
    )


def multi_label_posts(samples: DataFrame) -> DataFrame:
    return samples.groupBy("set").agg(F.count_if(F.size("domainSpecificLabels") > 1).alias("multiLabel"))


def label_disagreements(decoded: DataFrame) -> DataFrame:
    """Posts whose global and domain labels decode to different tags."""
    return decoded.agg(
        F.count("*").alias("posts"),
        F.count_if(F.col("globalNames") != F.col("domainNames")).alias("different"),
    )


def layout_report(table: DataFrame, by: list[str]) -> DataFrame:
    """Per value of the layout columns, the files of a table as read: ``files, rows, largest``."""
    files = table.groupBy(*by, F.col("_metadata.file_path").alias("_file")).agg(F.count("*").alias("_rows"))
    return files.groupBy(*by).agg(
        F.count("*").alias("files"), F.sum("_rows").alias("rows"), F.max("_rows").alias("largest")
    )


def skewed_parts(sizes: DataFrame, factor: float = 4.0) -> DataFrame:
    """The parts that hold more than ``factor`` times the mean ``rows``; none if the table lies evenly."""
    mean = sizes.agg(F.avg("rows")).first()[0]
    return sizes.where(F.col("rows") > F.lit(mean) * factor)


def partition_sizes(df: DataFrame) -> DataFrame:
    """Rows per partition of the frame as it stands; uneven numbers show skew."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count("*").alias("rows"))
