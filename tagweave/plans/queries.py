"""Every operator as a query over the general tables: name -> (spark, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagweave.functions import text as fn
from tagweave.functions.hashing import hash_tokens
from tagweave.functions.stemming import stem_tokens
from tagweave.operators import class_rules, dictionary, features, mining, quality, samples, split, tags
from tagweave.operators import text as tx
from tagweave.operators.lookup import heavy_by_count, heavy_by_most, lookup, lookup_items
from tagweave.operators.rows import explode_rows
from tagweave.options import SET_NAMES, Options
from tagweave.plans.prepare import Prepared
from tagweave.plans.prepare import prepare as prepare_posts
from tagweave.sources import adapters, posts, sinks
from tagweave.sources.manifest import manifest
from tagweave.sources.tables import discard, materialize, new_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

DEFAULTS = Options()
NORMAL = Options(normalize=True, lower_case=True)
STEMMED = replace(NORMAL, stem=True)
# Settings of the mining queries; also read by their SQL counterparts.
TEXT_RULES = Options(min_support=0.2, min_confidence=0.3, normalize=True, lower_case=True)
LABEL_RULES = Options(support_count=20, min_confidence=0.7, normalize=True, lower_case=True)
SHARD_ROWS = 100
SAMPLE_SHARE, SAMPLE_SEED = 0.1, 7
LOOKED_UP = 77
TAG_FRACTION = 0.5
LABEL_CAP = 5
NGRAM = 2


def query(fn_: Query) -> Query:
    QUERIES[fn_.__name__] = fn_
    return fn_


# Inputs


def _text(spark: SparkSession, folder: str) -> DataFrame:
    return split.assign_sets(posts.clean_text(adapters.post_text(spark, folder)), DEFAULTS)


def _tags(spark: SparkSession, folder: str) -> DataFrame:
    return split.assign_sets(posts.clean_tags(adapters.post_tags(spark, folder)), DEFAULTS)


def _tokens(spark: SparkSession, folder: str, opts: Options = DEFAULTS) -> DataFrame:
    return tx.tokenize(_text(spark, folder), opts)


def _training_tokens(spark: SparkSession, folder: str) -> DataFrame:
    return split.training_rows(_tokens(spark, folder))


def _tag_table(spark: SparkSession, folder: str) -> DataFrame:
    """The tag rows, written: for queries that need them more than once."""
    return materialize(_tags(spark, folder), "tag-rows")


def _counted(tag_rows: DataFrame) -> DataFrame:
    return tags.count_tags(split.training_rows(tag_rows))


def _tag_counts(spark: SparkSession, folder: str) -> DataFrame:
    return _counted(_tags(spark, folder))


def _rank_tables(tag_rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    counts = _counted(tag_rows)
    return (
        materialize(tags.rank_tags_globally(counts), "global-tags"),
        materialize(tags.rank_tags_in_domains(counts), "domain-tags"),
    )


def _encoded(spark: SparkSession, folder: str) -> DataFrame:
    tag_rows = _tag_table(spark, folder)
    return tags.encode_tags(tag_rows, *_rank_tables(tag_rows))


def _encoded_posts(spark: SparkSession, folder: str) -> DataFrame:
    """The encoded tags of the posts that have a text; the ranks are those of all tag rows."""
    tag_rows = _tag_table(spark, folder)
    return tags.encode_tags(tags.tags_of(tag_rows, _text(spark, folder)), *_rank_tables(tag_rows))


def _samples(spark: SparkSession, folder: str) -> DataFrame:
    """Samples of all documents, also of those without a tag row."""
    hashed = tx.hash_fields(_tokens(spark, folder), DEFAULTS)
    return samples.assemble_samples(hashed, _encoded_posts(spark, folder))


def _vocabulary(tokens: DataFrame, opts: Options) -> DataFrame:
    return materialize(features.build_vocabulary(tokens, opts), "vocabulary")


def _weighted(tokens: DataFrame, opts: Options) -> DataFrame:
    vocabulary, number = features.fit_features(tokens, opts)
    return features.idf_weights(vocabulary, number)


def _joined(array: str | Column, separator: str = " ") -> Column:
    column = F.col(array) if isinstance(array, str) else array
    return F.array_join(column.cast("array<string>"), separator)


def _fields(df: DataFrame, separator: str = " ") -> DataFrame:
    return df.select("uniqueID", *[_joined(f, separator).alias(f) for f in tx.FIELDS])


# Cleaning and text


@query
def clean_text(spark, folder):
    return _text(spark, folder).select("uniqueID", "title", "body", "domain")


@query
def clean_text_dotall(spark, folder):
    cleaned = posts.clean_text(adapters.post_text(spark, folder), dotall=True)
    return cleaned.select("uniqueID", "title", "body")


@query
def distinct_domains(spark, folder):
    return posts.distinct_domains(_text(spark, folder))


@query
def documents_assembled(spark, folder):
    cleaned = _text(spark, folder)
    return cleaned.select("uniqueID", *[fn.assemble_document(F.col(f)).alias(f) for f in tx.FIELDS])


@query
def sentences(spark, folder):
    parts = {f: fn.split_sentences(fn.assemble_document(F.col(f))) for f in tx.FIELDS}
    found = _text(spark, folder).withColumns(parts)
    sizes = [F.size(f).cast("long").alias(f"n_{f}") for f in tx.FIELDS]
    return found.select("uniqueID", *sizes, *[_joined(f, "|").alias(f) for f in tx.FIELDS])


@query
def tokens(spark, folder):
    cleaned = _text(spark, folder)
    return _fields(cleaned.withColumns({f: fn.split_words(fn.assemble_document(F.col(f))) for f in tx.FIELDS}))


@query
def tokens_punctuation(spark, folder):
    cleaned = _text(spark, folder)
    return _fields(
        cleaned.withColumns({f: fn.split_words(fn.assemble_document(F.col(f)), True) for f in tx.FIELDS})
    )


@query
def tokens_normalized(spark, folder):
    return _fields(_tokens(spark, folder, NORMAL))


@query
def stopwords(spark, folder):
    return _fields(_tokens(spark, folder))


@query
def ngrams(spark, folder):
    grams = _tokens(spark, folder, replace(DEFAULTS, ngrams=NGRAM))
    return grams.select("uniqueID", *[_joined(f"{f}NGrams", "|").alias(f) for f in tx.FIELDS])


@query
def ngrams_merged(spark, folder):
    merged = tx.merge_fields(tx.merge_ngrams(_tokens(spark, folder, replace(DEFAULTS, ngrams=NGRAM))))
    return merged.select("uniqueID", F.size("titleBody").cast("long").alias("terms"), _joined("titleBody", "|").alias("titleBody"))


@query
def stems(spark, folder):
    words = F.concat(*[fn.split_normalized_words(fn.assemble_document(F.col(f)), True) for f in tx.FIELDS])
    both = _text(spark, folder).select(words.alias("words")).select("words", stem_tokens("words").alias("stems"))
    pairs = both.select(F.inline_outer(F.arrays_zip("words", "stems")).alias("token", "stem"))
    return pairs.where(F.col("token").isNotNull()).distinct()


@query
def tokens_stemmed(spark, folder):
    return _fields(_tokens(spark, folder, STEMMED))


@query
def token_hash(spark, folder):
    """Both hashes keep distinct tokens apart."""
    words = F.concat(*tx.FIELDS)
    hashed = _tokens(spark, folder).select(
        F.inline_outer(
            F.arrays_zip(
                words.alias("token"),
                hash_tokens(words).alias("xx"),
                hash_tokens(words, "murmur3_128").alias("murmur"),
            )
        ).alias("token", "xx", "murmur")
    )
    return hashed.distinct().agg(
        F.count_distinct("token").alias("tokens"),
        F.count_distinct("xx").alias("xxhash64"),
        F.count_distinct("murmur").alias("murmur3_128"),
    )


@query
def token_hash_values(spark, folder):
    """Every distinct token with the value of its hash."""
    words = F.array_distinct(F.concat(*tx.FIELDS))
    found = _tokens(spark, folder).select(
        F.inline_outer(F.arrays_zip(words.alias("token"), hash_tokens(words, "murmur3_128").alias("murmur"))).alias("token", "murmur")
    )
    return found.where(F.col("token").isNotNull()).distinct()


@query
def token_occurrences(spark, folder):
    found = tx.token_occurrences(_samples(spark, folder), _tokens(spark, folder), DEFAULTS)
    out = []
    for field in tx.FIELDS:
        counts = F.map_values(f"{field}Features")
        out += [
            F.size(counts).cast("long").alias(f"{field}_distinct"),
            F.aggregate(counts, F.lit(0).cast("long"), lambda a, b: a + b).alias(f"{field}_total"),
            F.coalesce(F.array_max(counts), F.lit(0)).cast("long").alias(f"{field}_most"),
        ]
    return found.select("uniqueID", "domain", "originalTagCount", *out)


@query
def token_counts(spark, folder):
    return dictionary.count_tokens(_training_tokens(spark, folder))


# Split


@query
def split_assign(spark, folder):
    return _tags(spark, folder).select("uniqueID", "set")


@query
def split_text(spark, folder):
    tagged = split.with_tag_row(_text(spark, folder), _tags(spark, folder))
    return tagged.select("uniqueID", "domain", "set")


@query
def split_shares(spark, folder):
    shares = quality.split_shares(_tags(spark, folder))
    return shares.select("set", "rows", F.round("share", 6).alias("share"))


@query
def share_violations(spark, folder):
    wanted = {
        split.TRAINING: DEFAULTS.training_share,
        split.TEST: DEFAULTS.test_share,
        split.VALIDATION: DEFAULTS.validation_share,
    }
    off = quality.share_violations(quality.split_shares(_tags(spark, folder)), wanted)
    return off.agg(F.count("*").alias("violations"))


# Tags


@query
def tag_sets(spark, folder):
    return tags.tag_sets(_tags(spark, folder)).select(
        "uniqueID", "domain", _joined("tagSet", ",").alias("tagSet"), F.col("uniqueTagCount").cast("long").alias("uniqueTagCount")
    )


@query
def tag_explode(spark, folder):
    return tags.explode_tags(_tags(spark, folder))


@query
def tag_counts(spark, folder):
    return _tag_counts(spark, folder)


@query
def tag_rank_domain(spark, folder):
    return tags.rank_tags_in_domains(_tag_counts(spark, folder))


@query
def tag_rank_global(spark, folder):
    return tags.rank_tags_globally(_tag_counts(spark, folder)).orderBy("tagGlobalRank")


@query
def tags_per_domain(spark, folder):
    return tags.tags_per_domain(_tag_counts(spark, folder))


@query
def tag_fraction(spark, folder):
    ranked = materialize(tags.rank_tags_in_domains(_tag_counts(spark, folder)), "domain-tags")
    return tags.most_used_fraction(ranked, TAG_FRACTION)


@query
def rank_gaps(spark, folder):
    return tags.rank_gaps(tags.rank_tags_in_domains(_tag_counts(spark, folder)))


@query
def tag_encode(spark, folder):
    return _encoded(spark, folder).select(
        "uniqueID",
        _joined("globalTags").alias("globalTags"),
        _joined("domainTags").alias("domainTags"),
        "originalTagCount",
        "domain",
    )


def _decoded_labels(spark, folder):
    tag_rows = _tag_table(spark, folder)
    ranks = _rank_tables(tag_rows)
    return tags.decode_labels(tags.encode_tags(tag_rows, *ranks), *ranks)


@query
def label_decode(spark, folder):
    return _decoded_labels(spark, folder).select(
        "uniqueID", *[_joined(c, ",").alias(c) for c in ("globalNames", "domainNames")]
    )


@query
def label_agreement(spark, folder):
    return quality.label_disagreements(_decoded_labels(spark, folder))


@query
def top_labels(spark, folder):
    labels = tags.cap_labels(F.col("domainTags"), LABEL_CAP)
    return _encoded(spark, folder).select("uniqueID", _joined(labels).alias("labels"))


# Dictionary and decoding


def _dictionary(spark, folder):
    tagged = split.with_tag_row(_training_tokens(spark, folder), _tags(spark, folder))
    return dictionary.build_dictionary(tagged, DEFAULTS)


def _decoded(spark, folder, missing):
    known = materialize(_dictionary(spark, folder), "dictionary")
    hashed = tx.hash_fields(_tokens(spark, folder), DEFAULTS)
    fields = [
        dictionary.decode_tokens(hashed, known, f, "recovered", missing).withColumn("field", F.lit(f)) for f in tx.FIELDS
    ]
    return dictionary.join_tokens(fields[0].unionByName(fields[1]), "recovered")


@query
def token_dictionary(spark, folder):
    return _dictionary(spark, folder).select("token", "index")


@query
def decode_known(spark, folder):
    return _decoded(spark, folder, None)


@query
def decode_missing(spark, folder):
    return _decoded(spark, folder, "NOTFOUND")


@query
def decode_compare(spark, folder):
    """Each recovered field next to the same field of the original post."""
    both = dictionary.compare_with_original(_decoded(spark, folder, "NOTFOUND"), _text(spark, folder), list(tx.FIELDS))
    original = F.when(F.col("field") == "title", F.col("title")).otherwise(F.col("body"))
    return both.select("uniqueID", "field", "recovered", original.alias("original"))


# Features


@query
def vocabulary(spark, folder):
    return features.build_vocabulary(_tokens(spark, folder), DEFAULTS)


@query
def vocabulary_training(spark, folder):
    fitted, number = features.fit_features(_tokens(spark, folder), replace(DEFAULTS, fit_on="training"))
    return features.vocabulary_table(fitted).withColumn("posts", F.lit(number).cast("long"))


@query
def vocabulary_ngrams(spark, folder):
    opts = replace(NORMAL, ngrams=NGRAM, vocab_size=1000)
    return features.vocabulary_table(features.build_vocabulary(_tokens(spark, folder, opts), opts))


@query
def bag_combined(spark, folder):
    rows = _tokens(spark, folder)
    bag = features.bag_long(rows, _vocabulary(rows, DEFAULTS), DEFAULTS)
    return bag.select("uniqueID", "rank", F.col("n").cast("long").alias("n"))


@query
def bag_separate(spark, folder):
    opts = replace(DEFAULTS, combine=False)
    rows = _tokens(spark, folder)
    bag = features.bag_long(rows, _vocabulary(rows, opts), opts)
    return bag.select("uniqueID", "field", "rank", F.col("n").cast("long").alias("n"))


def _entries(bags: DataFrame, column: str) -> DataFrame:
    return bags.select("uniqueID", F.inline(column).alias("rank", "value"))


@query
def bag_vectors(spark, folder):
    opts = replace(DEFAULTS, algorithm="counts")
    rows = _tokens(spark, folder)
    bags = features.bag_table(rows, _vocabulary(rows, opts), opts, 0)
    return _entries(bags, "titleBodyBag").select("uniqueID", "rank", F.col("value").cast("long").alias("n"))


@query
def bag_decode(spark, folder):
    rows = _tokens(spark, folder)
    return features.decode_bag(features.bag_long(rows, _vocabulary(rows, DEFAULTS), DEFAULTS))


@query
def idf(spark, folder):
    weighted = _weighted(_tokens(spark, folder), DEFAULTS)
    return weighted.select("words", "rank", "df", F.round("weight", 6).alias("weight"))


@query
def tfidf(spark, folder):
    rows = _tokens(spark, folder)
    bag = features.tfidf_long(features.bag_long(rows, _weighted(rows, DEFAULTS), DEFAULTS))
    return bag.select("uniqueID", "rank", F.round("tfidf", 6).alias("tfidf"))


def _cells_of(field: str) -> Column:
    """A field's bag, each cell with the field: so both bags leave one pass."""
    cell = lambda c: F.struct(F.lit(field).alias("field"), c["rank"].alias("rank"), c["value"].alias("value"))
    return F.transform(f"{field}Bag", cell)


@query
def tfidf_separate_vectors(spark, folder):
    opts = replace(DEFAULTS, combine=False)
    rows = _tokens(spark, folder)
    bags = features.bag_table(rows, *_fit(rows, opts))
    cells = explode_rows(bags, ["uniqueID"], F.concat(*[_cells_of(f) for f in tx.FIELDS]), "cell")
    return cells.select("uniqueID", "cell.field", "cell.rank", F.round("cell.value", 6).alias("tfidf"))


def _fit(rows: DataFrame, opts: Options):
    fitted, number = features.fit_features(rows, opts)
    return fitted, opts, number


# Samples


def _sample_columns(df: DataFrame, *more: str) -> DataFrame:
    return df.select(
        "uniqueID",
        "domain",
        "set",
        _joined("globalLabels").alias("globalLabels"),
        _joined("domainSpecificLabels").alias("domainSpecificLabels"),
        F.col("originalTagCount").cast("long").alias("originalTagCount"),
        F.size("title").cast("long").alias("title_tokens"),
        F.size("body").cast("long").alias("body_tokens"),
        *more,
    )


def _prepared(spark, folder, opts: Options = DEFAULTS, with_bags: bool = True) -> Prepared:
    text = posts.clean_text(adapters.post_text(spark, folder))
    return prepare_posts(text, posts.clean_tags(adapters.post_tags(spark, folder)), opts, with_bags)


@query
def assembled_samples(spark, folder):
    return _sample_columns(_samples(spark, folder))


@query
def samples_with_features(spark, folder):
    rows = _tokens(spark, folder)
    bags = features.bag_table(rows, *_fit(rows, DEFAULTS))
    joined = features.fill_bags(samples.attach_features(_samples(spark, folder), bags), DEFAULTS)
    cells = joined.select("uniqueID", "set", F.inline_outer("titleBodyBag").alias("rank", "value"))
    return cells.select("uniqueID", "set", "rank", F.round("value", 6).alias("tfidf"))


def _weight(bag: str) -> Column:
    return F.round(F.aggregate(bag, F.lit(0.0), lambda a, b: a + b["value"]), 4)


@query
def prepare(spark, folder):
    """The whole job, with shards and bags."""
    ranks = _joined(F.transform("titleBodyBag", lambda c: c["rank"]))
    result = _prepared(spark, folder).samples.withColumns({"weight": _weight("titleBodyBag"), "ranks": ranks})
    return _sample_columns(result, "rng", "weight", "ranks")


@query
def samples_csv(spark, folder):
    flat = samples.flatten_samples(_samples(spark, folder))
    return flat.select(
        "uniqueID",
        "globalLabels",
        "domainSpecificLabels",
        *[F.size(F.regexp_extract_all(f, F.lit(r"-?\d+"), 0)).cast("long").alias(f"{f}_tokens") for f in tx.FIELDS],
    )


@query
def partitioned_scan(spark, folder):
    """Write the sample table, read one domain and set of it back."""
    output = new_path(spark, "output")
    counts = samples.shard_counts(_text(spark, folder))
    sharded = samples.shard_by_hash(_samples(spark, folder), counts, DEFAULTS.rows_per_shard)
    sinks.write_samples(sharded, output, DEFAULTS, counts=counts)
    return _sample_columns(posts.read_samples(spark, output, "en", split.TRAINING), "rng")


@query
def shards(spark, folder):
    rows = _tag_table(spark, folder)
    sharded = samples.shard_by_hash(rows, samples.shard_counts(rows), SHARD_ROWS)
    return sharded.groupBy("domain", "set", "rng").agg(F.count("*").alias("rows"))


@query
def shards_exact(spark, folder):
    sharded = samples.shard_exactly(_tags(spark, folder), SHARD_ROWS)
    return sharded.select("uniqueID", "domain", "set", "rng")


@query
def run_report(spark, folder):
    return _prepared(spark, folder, with_bags=False).report()


# Mining


def _mined_samples(spark, folder) -> DataFrame:
    """The tagged posts, which are what the job's sample table holds, with all tokens and labels."""
    return samples.assemble_samples(_tokens(spark, folder, TEXT_RULES), _encoded_posts(spark, folder), how="inner")


def _baskets(spark, folder) -> DataFrame:
    return materialize(mining.build_baskets(_mined_samples(spark, folder), TEXT_RULES), "baskets")


def _as_text(array: str | Column) -> Column:
    column = F.col(array) if isinstance(array, str) else array
    return F.array_join(F.sort_array(column), ",")


@query
def baskets(spark, folder):
    return _baskets(spark, folder).select("id", "set", *[_as_text(c).alias(c) for c in ("tokens", "labels", "items")])


@query
def itemsets(spark, folder):
    found = mining.fit_rules(_baskets(spark, folder), TEXT_RULES).itemsets
    return found.select(_as_text("items").alias("items"), "freq")


@query
def rules(spark, folder):
    found = mining.fit_rules(_baskets(spark, folder), TEXT_RULES).rules
    return found.select(
        _as_text("antecedent").alias("antecedent"),
        F.explode("consequent").alias("consequent"),
        F.round("confidence", 6).alias("confidence"),
    )


def _language_baskets(spark, folder) -> DataFrame:
    """The documents' tokens with their language as the label."""
    tag_rows = materialize(split.assign_sets(posts.clean_tags(adapters.language_tags(spark, folder)), DEFAULTS), "tag-rows")
    encoded = tags.encode_tags(tag_rows, *_rank_tables(tag_rows))
    rows = samples.assemble_samples(_tokens(spark, folder, LABEL_RULES), encoded, how="inner")
    return materialize(mining.build_baskets(rows, LABEL_RULES), "baskets")


@query
def label_rules(spark, folder):
    """Minimal rules that conclude a label, at a support of 20 posts."""
    found = class_rules.fit_label_rules(_language_baskets(spark, folder), LABEL_RULES).rules
    return found.select(
        _as_text("antecedent").alias("antecedent"), F.explode("consequent").alias("consequent"), "freq", F.round("confidence", 6).alias("confidence")
    )


def _predicted(spark, folder) -> DataFrame:
    rows = _baskets(spark, folder)
    return mining.predict(rows, mining.fit_rules(rows, TEXT_RULES))


@query
def predict(spark, folder):
    return _predicted(spark, folder).select("id", "set", _as_text("prediction").alias("prediction"))


@query
def predict_joined(spark, folder):
    """What is predicted, as rows."""
    return _predicted(spark, folder).select("id", F.explode("prediction").alias("item"))


def _predicted_labels(spark, folder) -> DataFrame:
    rows = _language_baskets(spark, folder)
    return mining.predict(rows, class_rules.fit_label_rules(rows, LABEL_RULES))


@query
def confusion(spark, folder):
    return mining.confusion(_predicted_labels(spark, folder)).select(
        "id", "set", *[_as_text(c).alias(c.lower()) for c in ("TP", "FP", "FN")]
    )


@query
def scores(spark, folder):
    found = mining.micro_scores(mining.confusion(_predicted_labels(spark, folder)))
    return found.select("set", "tp", "fp", "fn", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")])


@query
def transactions(spark, folder):
    """Posts, tokens and labels of the exported lines; labels also by their sum."""
    lines = mining.transaction_lines(mining.signed_items(_samples(spark, folder)))
    items = F.split("line", " ")
    labels = F.transform(F.filter(items, lambda i: i.rlike("^[0-9]")), lambda i: i.cast("long"))
    return lines.groupBy("set").agg(
        F.count("*").alias("posts"),
        F.sum(F.size(F.filter(items, lambda i: i.startswith("-")))).alias("tokens"),
        F.sum(F.size(labels)).alias("labels"),
        F.sum(F.aggregate(labels, F.lit(0).cast("long"), lambda a, b: a + b)).alias("label_sum"),
    )


@query
def transaction_lines(spark, folder):
    """Every exported line: its labels as they stand, its tokens by their number."""
    exported = mining.transaction_lines(mining.signed_items(_samples(spark, folder)))
    items = F.split("line", " ")
    return exported.select(
        "set",
        _joined(F.filter(items, lambda i: i.rlike("^[0-9]"))).alias("labels"),
        F.size(F.filter(items, lambda i: i.startswith("-"))).cast("long").alias("tokens"),
    )


@query
def appearances(spark, folder):
    roles = mining.item_appearances(mining.signed_items(_samples(spark, folder)))
    label = F.when(F.col("role") == "head", F.col("item"))
    return roles.groupBy("set", "role").agg(
        F.count("*").alias("items"), F.coalesce(F.sum(label), F.lit(0)).alias("label_sum")
    )


def _exported(spark, folder) -> tuple[str, DataFrame]:
    """Exported files, and what each exported token number spells: ``item, token, n``."""
    output = new_path(spark, "export")
    written = materialize(_samples(spark, folder), "samples")
    sinks.write_transactions(written, output)
    discard(written)
    words = tx.item_counts(tx.merge_fields(_tokens(spark, folder)), "titleBody", [], "token")
    words = words.groupBy("token").agg(F.count("*").alias("n"))
    number = -F.abs(hash_tokens(F.array("token"), DEFAULTS.hash_method)[0])
    return output, materialize(words.select(number.cast("string").alias("item"), "token", "n"), "spelling")


def _spelled(rows: DataFrame, spelling: DataFrame, spread: str) -> DataFrame:
    """Add ``name``: a label's rank, or the token behind an exported number."""
    found = lookup(rows, spelling.select("item", "token", "n"), ["item"], heavy_by_count(spelling, "n"), spread)
    return found.withColumn("name", F.coalesce(F.concat(F.lit("t:"), "token"), F.concat(F.lit("l:"), "item")))


@query
def transaction_contents(spark, folder):
    """Every line of the exported files, its numbers turned back to tokens."""
    output, spelling = _exported(spark, folder)
    lines = [spark.read.text(f"{output}/{name.lower()}.transactions").withColumn("set", F.lit(name)) for name in SET_NAMES]
    items = F.transform(F.filter(F.split("value", " "), lambda i: i != ""), lambda i: i.cast("long"))
    numbered = reduce(DataFrame.unionByName, lines).select("set", items.alias("items"), F.monotonically_increasing_id().alias("row"))
    # Written as numbers, so that the rows keep their place: less than half of the text's size.
    numbered = materialize(numbered, "lines").withColumn("labels", F.filter("items", lambda i: i >= 0))
    spelling = spelling.select(F.col("item").cast("long").alias("item"), "token", "n")
    tokens = F.filter("items", lambda i: i < 0)
    found = lookup_items(numbered, ["set", "labels"], "row", tokens, spelling, "item", "token", heavy_by_most(spelling, "n"))
    names = F.concat(
        F.transform("_values", lambda v: F.concat(F.lit("t:"), F.coalesce(v, F.lit("")))),
        F.transform("labels", lambda i: F.concat(F.lit("l:"), i.cast("string"))),
    )
    return found.select("set", _as_text(names).alias("items"))


@query
def appearance_contents(spark, folder):
    """Every exported appearance, its number turned back to the token."""
    output, spelling = _exported(spark, folder)
    read = [
        spark.read.option("header", True).option("quote", "").csv(f"{output}/{name.lower()}.appearances").withColumn("set", F.lit(name))
        for name in SET_NAMES
    ]
    both = F.split("both", " ")
    rows = reduce(DataFrame.unionByName, read).select("set", both[0].alias("item"), both[1].alias("role"))
    return _spelled(rows, spelling, "item").select("set", "name", "role")


# Sources and sinks, written and read back


def _csv_folder(spark, folder) -> str:
    """The posts and their tags as files of the input dialect."""
    path = new_path(spark, "csv-posts")
    text, tag_rows = adapters.post_text(spark, folder), adapters.post_tags(spark, folder)
    posts.write_posts(text, tag_rows, path)
    return path


@query
def csv_post_text(spark, folder):
    return posts.read_post_text(spark, _csv_folder(spark, folder))


@query
def csv_post_tags(spark, folder):
    return posts.read_post_tags(spark, _csv_folder(spark, folder))


def _lookup_rows(tables: dict[str, DataFrame]) -> DataFrame:
    """The dimension tables below each other: table, key, name and number."""
    none = F.lit("")
    return (
        tables["dictionary"].select(F.lit("dictionary").alias("source"), none.alias("domain"), F.col("token").alias("name"), F.col("index").cast("long").alias("number"))
        .unionByName(tables["global_tags"].select(F.lit("global_tags").alias("source"), none.alias("domain"), F.col("tag").alias("name"), F.col("tagGlobalRank").cast("long").alias("number")))
        .unionByName(tables["domain_tags"].select(F.lit("domain_tags").alias("source"), "domain", F.col("tag").alias("name"), F.col("tagRankInDomain").cast("long").alias("number")))
        .unionByName(tables["vocabulary"].select(F.lit("vocabulary").alias("source"), none.alias("domain"), F.col("words").alias("name"), F.col("rank").cast("long").alias("number")))
    )


def _written_lookups(spark, folder, opts: Options) -> DataFrame:
    path = new_path(spark, "lookups")
    sinks.write_lookups(_prepared(spark, folder, with_bags=False).lookups, path, opts)
    return _lookup_rows(posts.read_lookups(spark, path, opts.output_format))


@query
def lookups_parquet(spark, folder):
    return _written_lookups(spark, folder, DEFAULTS)


@query
def lookups_csv(spark, folder):
    return _written_lookups(spark, folder, replace(DEFAULTS, output_format="csv"))


# Checks


@query
def input_counts(spark, folder):
    text = quality.row_and_id_counts(_text(spark, folder)).withColumn("input", F.lit("text"))
    return text.unionByName(quality.row_and_id_counts(_tags(spark, folder)).withColumn("input", F.lit("tags")))


@query
def lost_ids(spark, folder):
    """Documents that the tag table restricts away."""
    text = _text(spark, folder)
    return quality.lost_ids(split.with_tag_row(text, _tags(spark, folder)), text)


@query
def feature_check(spark, folder):
    opts = replace(DEFAULTS, combine=False)
    rows = _tokens(spark, folder)
    return quality.feature_violations(features.bag_long(rows, _vocabulary(rows, opts), opts), rows)


@query
def multi_label(spark, folder):
    return quality.multi_label_posts(_samples(spark, folder))


@query
def partition_report(spark, folder):
    """The sample table's files as they lie: per domain, set and shard."""
    output = new_path(spark, "output")
    rows = _samples(spark, folder)
    sinks.write_samples(samples.shard_by_hash(rows, samples.shard_counts(rows), SHARD_ROWS), output, DEFAULTS)
    report = quality.layout_report(spark.read.parquet(f"{output}/dataset"), list(sinks.SAMPLE_LAYOUT))
    return report.select("domain", "set", F.col("rng").cast("long").alias("rng"), "files", "rows", "largest")


@query
def sample_manifest(spark, folder):
    """A committed sample table whose overwrite fails half-way: rows and id ranges by manifest, and the rows still read."""
    output = new_path(spark, "output")
    rows = samples.shard_by_hash(_samples(spark, folder), samples.shard_counts(_text(spark, folder)), SHARD_ROWS)
    sinks.commit_samples(rows, output, DEFAULTS)
    broken = F.when(F.col("uniqueID") % 50 == 7, F.raise_error(F.lit("a task fails"))).otherwise(F.col("domain"))
    try:
        sinks.commit_samples(rows.withColumn("domain", broken.cast("string")), output, DEFAULTS)
    except Exception as failure:
        if "a task fails" not in str(failure):
            raise
    files = manifest(spark, f"{output}/dataset")
    listed = files.groupBy(F.col("partition.domain").alias("domain"), F.col("partition.set").alias("set")).agg(
        F.sum("rows").alias("rows"), F.min(F.col("least").cast("long")).alias("least"), F.max(F.col("most").cast("long")).alias("most")
    )
    read = posts.read_samples(spark, output).groupBy("domain", "set").agg(F.count("*").alias("read"))
    return listed.join(read, ["domain", "set"], "left")


@query
def post_by_id(spark, folder):
    return _text(spark, folder).where(F.col("uniqueID") == LOOKED_UP).select("uniqueID", "title", "domain")


@query
def post_sample(spark, folder):
    """A sampling operator: each post with the same probability, by its id."""
    return split.bernoulli_sample(_text(spark, folder), SAMPLE_SHARE, SAMPLE_SEED).select("uniqueID", "domain")


@query
def default_domain(spark, folder):
    """Tag rows whose domain is missing get the default one."""
    bare = _tags(spark, folder).withColumn("domain", F.when(F.col("uniqueID") % 2 == 0, F.col("domain")))
    return tags.tag_sets(bare).groupBy("domain").agg(F.count("*").alias("rows"))
