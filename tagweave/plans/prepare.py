"""The preparation job: posts and tags to samples, lookup tables and a report."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagweave.operators import dictionary, features, samples, split, tags
from tagweave.operators.skew import skew_join
from tagweave.operators.text import count_items, hash_fields, tokenize
from tagweave.options import Options
from tagweave.sources import posts as readers
from tagweave.sources import sinks
from tagweave.sources.tables import materialize, materialize_observed


@dataclass(frozen=True)
class Prepared:
    """Results of :func:`prepare`; ``samples`` is lazy, the lookups are written tables.

    ``totals`` has the rows of the samples and of each lookup, counted as they were written.
    """

    samples: DataFrame
    lookups: dict[str, DataFrame]
    totals: dict[str, int]

    def report(self) -> DataFrame:
        return sinks.run_report(self.lookups["domain_tags"], self.totals)


def token_statistics(posts: DataFrame, opts: Options) -> DataFrame:
    """Every term once, with the counts the dictionary and the vocabulary need.

    ``posts`` are tokens with ``set`` and ``tagged``. Terms are counted inside
    each post, so only partially aggregated counts move. The dictionary learns
    from training posts that have a tag row, the vocabulary from all posts or
    from those same ones. A term with a blank is an n-gram and has no place in
    the dictionary. Rare terms, which neither table can use, are dropped before
    the table is written.
    """
    merged = features.merge_fields(features.merge_ngrams(posts))
    learned = (F.col("set") == split.TRAINING) & F.col("tagged")
    counted = count_items(merged.select(learned.alias("learned"), "titleBody"), "titleBody")
    terms = counted.select("learned", F.inline(F.arrays_zip("_item", "_times")).alias("term", "n"))
    fitted = F.lit(True) if opts.fit_on == "all" else F.col("learned")
    statistics = terms.groupBy("term").agg(
        F.coalesce(F.sum(F.when(F.col("learned"), F.col("n"))), F.lit(0)).alias("tokenCount"),
        F.coalesce(F.sum(F.when(fitted, F.col("n"))), F.lit(0)).alias("tf"),
        F.count_if(fitted).alias("df"),
    )
    for_dictionary = (F.col("tokenCount") > opts.token_usage_threshold) & ~F.col("term").contains(" ")
    useful = statistics.where(for_dictionary | (F.col("df") >= opts.min_df))
    return materialize(useful, "token-statistics")


def _counted(tables: dict[str, DataFrame], label: str, table: DataFrame, totals: dict[str, int]) -> None:
    tables[label], seen = materialize_observed(table, label, rows=F.count(F.lit(1)))
    totals[label] = seen["rows"]


def rank_tables(tag_rows: DataFrame, opts: Options) -> tuple[dict[str, DataFrame], dict[str, int]]:
    """Global and domain ranks, from the training posts, and their numbers of rows.

    ``fraction_of_tags`` trims the ranks of each domain only: labels that a
    domain does not keep still have a global rank, as in the original job.
    """
    counts = tags.count_tags(split.training_rows(tag_rows))
    domain_tags = tags.rank_tags_in_domains(counts)
    if opts.fraction_of_tags < 1:
        domain_tags = tags.most_used_fraction(materialize(domain_tags, "domain-tags"), opts.fraction_of_tags)
    tables: dict[str, DataFrame] = {}
    totals: dict[str, int] = {}
    _counted(tables, "domain_tags", domain_tags, totals)
    _counted(tables, "global_tags", tags.rank_tags_globally(counts), totals)
    return tables, totals


def prepare(text: DataFrame, tag_rows: DataFrame, opts: Options, with_bags: bool = True) -> Prepared:
    """All steps from cleaned posts to sharded samples.

    The tag rows give ranks without the text, and labels for the ids that have one.
    The text is read, but for its ids, tokenised and shuffled once, for the join with
    its labels, and written; the statistics and the samples are narrow passes over that table. Only bags need
    one more join by id, of compact hashes with their counted terms.
    """
    text = split.assign_sets(text, opts)
    tag_rows = materialize(split.assign_sets(tag_rows, opts), "tag-rows")
    lookups, totals = rank_tables(tag_rows, opts)
    found = tags.tags_of(tag_rows, text)
    encoded = tags.encode_tags(found, lookups["global_tags"], lookups["domain_tags"], keep_untagged=True)
    labels = encoded.drop("domain").withColumn("tagged", F.lit(True))
    posts = skew_join(tokenize(text, opts), labels, ["uniqueID"], "left")
    learned = (F.col("set") == split.TRAINING) & F.col("tagged")
    posts, seen = materialize_observed(
        posts.withColumn("tagged", F.coalesce("tagged", F.lit(False))),
        "tagged-posts",
        posts=F.count(F.lit(1)),
        tagged=F.count_if("tagged"),
        learned=F.count_if(learned),
    )
    totals["samples"] = seen["tagged"]

    statistics = token_statistics(posts, opts)
    unigrams = statistics.where(~F.col("term").contains(" ")).withColumnRenamed("term", "token")
    _counted(lookups, "dictionary", dictionary.index_tokens(unigrams, opts), totals)
    _counted(lookups, "vocabulary", features.top_terms(statistics, opts), totals)

    tagged = posts.where("tagged")
    rows = samples.label_samples(hash_fields(tagged, opts))
    if with_bags:
        number = seen["posts"] if opts.fit_on == "all" else seen["learned"]
        bags = features.bag_table(tagged, lookups["vocabulary"], opts, number)
        rows = features.fill_bags(samples.attach_features(rows, bags), opts)
    lookups["shard_counts"] = samples.shard_counts(tagged)
    sharded = samples.shard_by_hash(rows, lookups["shard_counts"], opts.rows_per_shard)
    return Prepared(sharded, lookups, totals)


def run(spark: SparkSession, source: str, output: str, opts: Options, committed: bool = False) -> Prepared:
    """Read the CSV posts of ``source``, prepare them and write everything to ``output``.

    With ``committed`` the sample table is written under a manifest, so that a run
    that dies leaves the samples of the last one readable.

    What is returned reads intermediate tables, which go when the application
    ends or with :func:`tagweave.sources.tables.clear`.

    The readers turn CSV into columnar tables, which can be pruned.
    """
    text = readers.read_post_text(spark, source, opts.dotall)
    tag_rows = readers.read_post_tags(spark, source)
    prepared = prepare(text, tag_rows, opts)
    write = sinks.commit_samples if committed else sinks.write_samples
    write(prepared.samples, output, opts)
    sinks.write_lookups(prepared.lookups, output, opts)
    sinks.write_report(prepared.report(), output)
    return prepared
