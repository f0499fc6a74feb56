"""Reproducible training, test and validation sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagweave.functions.hashing import uniform_draw
from tagweave.options import SET_NAMES, Options

TRAINING, TEST, VALIDATION = SET_NAMES


def set_name(key: Column, opts: Options) -> Column:
    """Name of the set a key belongs to: a function of the key and the seed only."""
    draw = uniform_draw(key, opts.seed)
    return (
        F.when(draw < opts.training_share, TRAINING).when(draw < opts.test_bound, TEST).otherwise(VALIDATION)
    )


def assign_sets(posts: DataFrame, opts: Options) -> DataFrame:
    """Add ``set``. Text and tags of a post agree without being joined."""
    return posts.withColumn("set", set_name(F.col("uniqueID"), opts))


def training_rows(posts: DataFrame) -> DataFrame:
    return posts.where(F.col("set") == TRAINING)


def with_tag_row(text: DataFrame, tags: DataFrame) -> DataFrame:
    """Posts that have a row in the tag table; repeated tag rows multiply nothing."""
    return text.join(tags.select("uniqueID"), "uniqueID", "left_semi")


def bernoulli_sample(posts: DataFrame, fraction: float, seed: int = 0) -> DataFrame:
    """Each post with probability ``fraction``, by its id and the seed: the same in any partitioning."""
    return posts.where(uniform_draw(F.col("uniqueID"), seed) < fraction)
