"""Tokenising posts and counting the tokens of each post."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import NGram, StopWordsRemover
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagweave.functions import text as fn
from tagweave.functions.hashing import hash_tokens
from tagweave.functions.stemming import stem_tokens
from tagweave.functions.stopwords import ENGLISH
from tagweave.options import Options

FIELDS = ("title", "body")


def remove_stop_words(posts: DataFrame, fields: Sequence[str] = FIELDS) -> DataFrame:
    """Drop English stop words, in any case, from the token arrays."""
    fields = list(fields)
    cleaned = [f"_clean_{f}" for f in fields]
    remover = StopWordsRemover(inputCols=fields, outputCols=cleaned, stopWords=ENGLISH)
    return remover.transform(posts).withColumns(
        {f: F.col(c) for f, c in zip(fields, cleaned)}
    ).drop(*cleaned)


def add_ngrams(posts: DataFrame, n: int, fields: Sequence[str] = FIELDS) -> DataFrame:
    """Add ``<field>NGrams``: runs of exactly ``n`` tokens joined by a blank."""
    for field in fields:
        posts = NGram(n=n, inputCol=field, outputCol=f"{field}NGrams").transform(posts)
    return posts


def _tokens(text: Column, opts: Options) -> Column:
    document = fn.assemble_document(text)
    if opts.normalize:
        tokens = fn.split_normalized_words(document, opts.lower_case)
    else:
        tokens = fn.split_words(document, opts.keep_punct)
    return stem_tokens(tokens) if opts.stem else tokens


def tokenize(posts: DataFrame, opts: Options) -> DataFrame:
    """Text fields to token arrays, with n-gram columns if ``opts.ngrams`` > 1.

    One narrow stage: cleaning, splitting, normalising, stemming, stop words and
    n-grams never move a row.
    """
    columns = ["uniqueID", *FIELDS, "domain"]
    extra = [c for c in posts.columns if c not in columns]
    tokens = posts.withColumns({f: _tokens(F.col(f), opts) for f in FIELDS})
    tokens = remove_stop_words(tokens)
    if opts.ngrams > 1:
        tokens = add_ngrams(tokens, opts.ngrams)
        columns += [f"{f}NGrams" for f in FIELDS]
    return tokens.select(*columns, *extra)


def merge_ngrams(tokens: DataFrame) -> DataFrame:
    """Append each field's n-grams to its tokens, if there are any."""
    for field in FIELDS:
        grams = f"{field}NGrams"
        if grams in tokens.columns:
            tokens = tokens.withColumn(field, F.concat(field, grams)).drop(grams)
    return tokens


def merge_fields(tokens: DataFrame, name: str = "titleBody") -> DataFrame:
    return tokens.withColumn(name, F.concat(*FIELDS))


def hash_fields(tokens: DataFrame, opts: Options) -> DataFrame:
    """Token arrays to arrays of 64-bit hashes; order and repeats stay."""
    return tokens.withColumns({f: hash_tokens(F.col(f), opts.hash_method) for f in FIELDS})


def count_items(rows: DataFrame, array: str) -> DataFrame:
    """Add ``_item`` and ``_times``: the distinct values of an array and their counts.

    The array is sorted and cut into runs inside its row, so a post of any
    length is counted in n log n without leaving its partition.
    """
    return (
        rows.withColumn("_sorted", F.sort_array(array))
        .withColumn("_starts", fn.run_starts(F.col("_sorted")))
        .withColumn("_item", fn.run_values(F.col("_sorted"), F.col("_starts")))
        .withColumn("_times", fn.run_counts(F.col("_sorted"), F.col("_starts")))
        .drop("_sorted", "_starts")
    )


def item_counts(rows: DataFrame, array: str, keep: Sequence[str], item: str = "term") -> DataFrame:
    """Long form: one row per distinct value of each row's array, with its count ``n``."""
    return count_items(rows.select(*keep, array), array).select(
        *keep, F.inline(F.arrays_zip(F.col("_item").alias("_item"), F.col("_times").alias("_times"))).alias(item, "n")
    )


def token_occurrences(samples: DataFrame, tokens: DataFrame, opts: Options) -> DataFrame:
    """Per sample, maps from token hash to count for title and body."""
    hashed = hash_fields(tokens.select("uniqueID", *FIELDS), opts)
    kept = [c for c in samples.columns if c not in FIELDS]
    joined = samples.select(*kept).join(hashed, "uniqueID")
    for field in FIELDS:
        joined = count_items(joined, field).withColumn(
            f"{field}Features", F.map_from_arrays("_item", "_times")
        ).drop("_item", "_times", field)
    return joined
