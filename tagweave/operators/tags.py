"""Parsing, counting, ranking and encoding tags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagweave.operators.lookup import heavy_by_count, lookup
from tagweave.operators.ordering import ordered_index
from tagweave.operators.rows import explode_rows
from tagweave.operators.skew import row_number_of_keyless
from tagweave.options import UNDEFINED_DOMAIN
from tagweave.sources.tables import materialize


def parse_tags(tags: Column) -> Column:
    """Distinct, trimmed, non-empty tags of a comma-joined string."""
    parts = F.transform(F.split(F.coalesce(tags, F.lit("")), ","), lambda t: F.trim(t))
    return F.array_distinct(F.filter(parts, lambda t: t != ""))


def tag_sets(posts: DataFrame) -> DataFrame:
    """Add ``tagSet`` and ``uniqueTagCount``; a missing domain gets its default."""
    return posts.withColumns(
        {
            "tagSet": parse_tags(F.col("tags")),
            "domain": F.coalesce("domain", F.lit(UNDEFINED_DOMAIN)),
        }
    ).withColumn("uniqueTagCount", F.size("tagSet"))


def explode_tags(posts: DataFrame) -> DataFrame:
    """One row per (post, tag)."""
    return explode_rows(tag_sets(posts), ["uniqueID", "domain"], "tagSet", "tag")


def count_tags(posts: DataFrame) -> DataFrame:
    """Posts per (domain, tag): the one aggregate behind both rankings."""
    counts = explode_tags(posts).groupBy("domain", "tag").agg(F.count("*").alias("tagInDomainCount"))
    return materialize(counts, "tag-counts")


def rank_tags_in_domains(counts: DataFrame) -> DataFrame:
    """Rank 0 is the most used tag of a domain; ties are ordered by name."""
    return ordered_index(counts, [F.desc("tagInDomainCount"), F.asc("tag")], "tagRankInDomain", by=["domain"])


def rank_tags_globally(counts: DataFrame) -> DataFrame:
    """Rank 0 is the tag used by most posts over all domains; ties by name."""
    totals = counts.groupBy("tag").agg(F.sum("tagInDomainCount").alias("tagGlobalCount"))
    return ordered_index(totals, [F.desc("tagGlobalCount"), F.asc("tag")], "tagGlobalRank")


def tags_per_domain(counts: DataFrame) -> DataFrame:
    return counts.groupBy("domain").agg(F.count("tag").alias("tags"))


def most_used_fraction(domain_tags: DataFrame, fraction: float) -> DataFrame:
    """Keep the most used ``fraction`` of each domain's tags, at least one."""
    sizes = materialize(tags_per_domain(domain_tags), "domain-sizes")
    sized = lookup(domain_tags, sizes, ["domain"], heavy_by_count(sizes, "tags"), "tag")
    return sized.where(F.col("tagRankInDomain") < F.ceil(F.lit(fraction) * F.col("tags"))).drop("tags")


def rank_gaps(domain_tags: DataFrame) -> DataFrame:
    """Per domain, how far its ranks are from the run 0 .. n-1; all gaps are 0 if none."""
    return domain_tags.groupBy("domain").agg(
        F.count("*").alias("tags"),
        (F.max("tagRankInDomain") + 1 - F.count_distinct("tagRankInDomain")).cast("long").alias("gaps"),
        (F.count("*") - F.count_distinct("tagRankInDomain")).alias("repeats"),
    )


def tags_of(posts: DataFrame, text: DataFrame) -> DataFrame:
    """The tag rows of the posts in ``text``: all that a join with it by id can meet."""
    return posts.join(text.select("uniqueID").distinct(), "uniqueID", "left_semi").select(*posts.columns)


def encode_tags(
    posts: DataFrame, global_tags: DataFrame, domain_tags: DataFrame, keep_untagged: bool = False
) -> DataFrame:
    """Tag names to sorted sets of ranks.

    Tags without a rank drop out but stay in ``originalTagCount``. Posts with no
    tags give no row unless ``keep_untagged``. Tag rows of one id are merged; rows
    without id stay apart. Both rank tables must be written tables
    (:func:`tagweave.sources.tables.materialize`).
    """
    kept = ["uniqueID", "_own", "domain", "uniqueTagCount"]
    sets = tag_sets(posts).withColumn("_own", row_number_of_keyless(["uniqueID"]))
    exploded = explode_rows(sets, kept, "tagSet", "tag", outer=keep_untagged)
    with_global = lookup(
        exploded,
        global_tags.select("tag", "tagGlobalRank", "tagGlobalCount"),
        ["tag"],
        heavy_by_count(global_tags, "tagGlobalCount"),
        "uniqueID",
    )
    ranked = lookup(
        with_global,
        domain_tags.select("domain", "tag", "tagRankInDomain", "tagInDomainCount"),
        ["domain", "tag"],
        heavy_by_count(domain_tags, "tagInDomainCount"),
        "uniqueID",
    )
    merged = ranked.groupBy("uniqueID", "_own").agg(
        F.sort_array(F.collect_set("tagGlobalRank")).alias("globalTags"),
        F.sort_array(F.collect_set("tagRankInDomain")).alias("domainTags"),
        F.max("uniqueTagCount").cast("long").alias("originalTagCount"),
        F.max("domain").alias("domain"),
    )
    return merged.drop("_own")


def cap_labels(labels: Column, cap: int) -> Column:
    """Labels of rank below ``cap``."""
    return F.filter(labels, lambda rank: rank < cap)


def decode_labels(encoded: DataFrame, global_tags: DataFrame, domain_tags: DataFrame) -> DataFrame:
    """Ranks back to sorted tag names: ``globalNames`` and ``domainNames``; rows without id stay apart."""
    either = F.array_union(
        F.transform("globalTags", lambda r: F.struct(F.lit("g").alias("kind"), r.alias("rank"))),
        F.transform("domainTags", lambda r: F.struct(F.lit("d").alias("kind"), r.alias("rank"))),
    )
    rows = encoded.withColumn("_own", row_number_of_keyless(["uniqueID"]))
    long = explode_rows(rows, ["uniqueID", "_own", "domain"], either, "label").select(
        "uniqueID", "_own", "label.kind", "label.rank", F.when(F.col("label.kind") == "d", F.col("domain")).otherwise("").alias("domain")
    )
    names = domain_tags.select(
        F.lit("d").alias("kind"), F.col("tagRankInDomain").alias("rank"), "domain", "tag", F.col("tagInDomainCount").alias("count")
    ).unionByName(
        global_tags.select(
            F.lit("g").alias("kind"), F.col("tagGlobalRank").alias("rank"), F.lit("").alias("domain"), "tag", F.col("tagGlobalCount").alias("count")
        )
    )
    named = lookup(long, names, ["kind", "rank", "domain"], heavy_by_count(names, "count"), "uniqueID")

    def of(kind: str) -> Column:
        return F.sort_array(F.collect_set(F.when(F.col("kind") == kind, F.col("tag"))))

    decoded = named.groupBy("uniqueID", "_own").agg(of("g").alias("globalNames"), of("d").alias("domainNames"))
    return decoded.drop("_own")
