"""The token dictionary, and the way back from hashes to tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagweave.functions.hashing import hash_tokens
from tagweave.operators.lookup import heavy_by_rank, lookup_items
from tagweave.operators.ordering import ordered_index
from tagweave.operators.text import item_counts, merge_fields
from tagweave.options import Options
from tagweave.sources.tables import materialize


def count_tokens(tokens: DataFrame) -> DataFrame:
    """Occurrences of each token over title and body."""
    counts = item_counts(merge_fields(tokens), "titleBody", [], "token")
    return counts.groupBy("token").agg(F.sum("n").alias("tokenCount"))


def index_tokens(counts: DataFrame, opts: Options) -> DataFrame:
    """Tokens used more often than the threshold, with hash and dense index.

    Index 0 is the most frequent token; ties are ordered by name.
    """
    kept = counts.where(F.col("tokenCount") > opts.token_usage_threshold)
    indexed = ordered_index(kept, [F.desc("tokenCount"), F.asc("token")], "index")
    hashed = hash_tokens(F.array("token"), opts.hash_method)
    return indexed.select(hashed[0].alias("hash"), "token", "index")


def build_dictionary(training_tokens: DataFrame, opts: Options) -> DataFrame:
    """(hash, token, index) learned from training posts only, so that nothing leaks."""
    return index_tokens(count_tokens(training_tokens), opts)


def decode_tokens(
    rows: DataFrame, dictionary: DataFrame, array: str, name: str, missing: str | None = None
) -> DataFrame:
    """Hashes of an array column back to tokens, in their original order.

    Unknown hashes vanish, and with them rows that have no known hash; with a
    placeholder in ``missing`` every position and every row stays: one row per
    sample, copies included.
    """
    # A number of its own keeps the copies of a post apart, so that one group is
    # never more than the tokens of one row; it is written, so that it holds.
    own = materialize(rows.select("uniqueID", array).withColumn("_copy", F.monotonically_increasing_id()), "decode-rows")
    found = lookup_items(own, ["uniqueID"], "_copy", F.col(array), dictionary, "hash", "token", heavy_by_rank("index"))
    if missing is None:
        known = F.filter("_values", lambda t: t.isNotNull())
        return found.select("uniqueID", known.alias(name)).where(F.size(name) > 0)
    return found.select("uniqueID", F.transform("_values", lambda t: F.coalesce(t, F.lit(missing))).alias(name))


def join_tokens(decoded: DataFrame, name: str) -> DataFrame:
    """A decoded token array as one comma-joined string."""
    return decoded.withColumn(name, F.array_join(name, ","))


def compare_with_original(decoded: DataFrame, posts: DataFrame, fields: list[str]) -> DataFrame:
    """Recovered text next to the original text of the same post."""
    return decoded.join(posts.select("uniqueID", *fields), "uniqueID")
