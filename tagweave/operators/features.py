"""Bag-of-words vocabulary, counts and TF-IDF, as rows and as one array per post."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagweave.operators.lookup import heavy_by_rank, lookup
from tagweave.operators.ordering import ordered_index
from tagweave.operators.split import training_rows
from tagweave.operators.text import FIELDS, item_counts, merge_fields, merge_ngrams
from tagweave.operators.topk import top_rows
from tagweave.options import IDF_ALGORITHM, Options
from tagweave.sources.tables import materialize

def term_statistics(tokens: DataFrame) -> DataFrame:
    """Term frequency and document frequency of every term, in one aggregate."""
    merged = merge_fields(merge_ngrams(tokens))
    return (
        item_counts(merged, "titleBody", [])
        .groupBy("term")
        .agg(F.sum("n").alias("tf"), F.count("*").alias("df"))
    )


def top_terms(statistics: DataFrame, opts: Options) -> DataFrame:
    """The ``vocab_size`` most frequent terms found in at least ``min_df`` posts.

    Columns ``words``, ``rank``, ``tf`` and ``df``; ties are ordered by name.
    ``statistics`` should be a written table: histograms of ``tf`` find the least
    frequency of the vocabulary, and only terms that reach it are sorted, on all
    executors.
    """
    common = top_rows(statistics.where(F.col("df") >= opts.min_df), "tf", opts.vocab_size)
    ranked = ordered_index(common, [F.desc("tf"), F.asc("term")], "rank")
    return ranked.where(F.col("rank") < opts.vocab_size).select(
        F.col("term").alias("words"), "rank", "tf", "df"
    )


def build_vocabulary(tokens: DataFrame, opts: Options) -> DataFrame:
    return top_terms(materialize(term_statistics(tokens), "term-statistics"), opts)


def vocabulary_table(vocabulary: DataFrame) -> DataFrame:
    return vocabulary.select("words", "rank")


def idf_weight(df: Column, posts: Column) -> Column:
    return F.log((posts + 1) / (df + 1))


def idf_weights(vocabulary: DataFrame, posts: int) -> DataFrame:
    """Add ``weight`` to the vocabulary, ``posts`` being the number of fitted posts."""
    return vocabulary.withColumn("weight", idf_weight(F.col("df"), F.lit(posts)))


def bag_long(tokens: DataFrame, vocabulary: DataFrame, opts: Options) -> DataFrame:
    """Counts as rows ``(uniqueID, [field,] rank, words, n)``; ``field`` unless combined.

    Tokens are counted inside each row first, so one row per distinct term of a
    post reaches the join, and the vocabulary's frequent end is broadcast.
    """
    merged = merge_ngrams(tokens)
    if opts.combine:
        counts = item_counts(merge_fields(merged), "titleBody", ["uniqueID"])
    else:
        both = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("items")) for f in FIELDS]))
        fields = merged.select("uniqueID", both.alias("part")).select("uniqueID", "part.field", "part.items")
        counts = item_counts(fields, "items", ["uniqueID", "field"])
    words = vocabulary.withColumnRenamed("words", "term")
    found = lookup(counts, words, ["term"], heavy_by_rank("rank"), "uniqueID")
    return found.where(F.col("rank").isNotNull()).withColumnRenamed("term", "words")


def tfidf_long(bag: DataFrame) -> DataFrame:
    """Scale the counts of a long bag whose vocabulary carries ``weight``."""
    return bag.withColumn("tfidf", F.col("n") * F.col("weight"))


def decode_bag(bag: DataFrame) -> DataFrame:
    """The words of each post's bag in vocabulary order, joined by commas."""
    pairs = F.sort_array(F.collect_set(F.struct("rank", "words")))
    return bag.groupBy("uniqueID").agg(F.array_join(F.transform(pairs, lambda p: p["words"]), ",").alias("words"))


def bag_table(tokens: DataFrame, vocabulary: DataFrame, opts: Options, posts: int) -> DataFrame:
    """``uniqueID`` and ``titleBodyBag``, or ``titleBag`` and ``bodyBag``, of every post with a known term.

    A bag is the sparse vector as an array of (rank, value), sorted by rank; it
    has no limit of size, and an empty vocabulary gives an empty table. Posts
    without id have no bag, as none could be told from the others.
    """
    tokens = tokens.where("uniqueID IS NOT NULL")
    known = vocabulary
    if opts.algorithm == IDF_ALGORITHM:
        known = materialize(idf_weights(vocabulary, posts), "weighted-vocabulary")
    long = bag_long(tokens, known, opts)
    value = F.col("n") * F.col("weight") if opts.algorithm == IDF_ALGORITHM else F.col("n").cast("double")
    cell = F.struct("rank", value.alias("value"))
    names = {"titleBodyBag": F.lit(True)} if opts.combine else {f"{f}Bag": F.col("field") == f for f in FIELDS}
    return long.groupBy("uniqueID").agg(
        *[F.sort_array(F.collect_list(F.when(of, cell))).alias(name) for name, of in names.items()]
    )


def bag_names(opts: Options) -> list[str]:
    return ["titleBodyBag"] if opts.combine else [f"{f}Bag" for f in FIELDS]


def fill_bags(rows: DataFrame, opts: Options) -> DataFrame:
    """Posts without a known term get empty bags."""
    empty = F.array().cast("array<struct<rank:int,value:double>>")
    return rows.withColumns({b: F.coalesce(b, empty) for b in bag_names(opts)})


def fit_features(tokens: DataFrame, opts: Options) -> tuple[DataFrame, int]:
    """Written vocabulary and number of posts, from all or from the training posts.

    ``tokens`` needs the column ``set`` if ``opts.fit_on`` is ``training``. The
    job passes only posts with a tag row in that case.
    """
    fitted = tokens if opts.fit_on == "all" else training_rows(tokens)
    return materialize(build_vocabulary(fitted, opts), "vocabulary"), fitted.count()
