"""Baskets, FP-growth rules, rule prediction and its scores."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagweave.operators.rows import explode_rows
from tagweave.operators.rule_tree import build_tree, match_rules
from tagweave.operators.skew import skew_join
from tagweave.operators.split import training_rows
from tagweave.operators.tags import cap_labels
from tagweave.options import Options
from tagweave.sources.tables import materialize

# Items are strings, so a label and a token can never be the same item.
TOKEN, LABEL = "t:", "l:"


def _prefixed(values: Column, prefix: str) -> Column:
    return F.transform(values, lambda v: F.concat(F.lit(prefix), v.cast("string")))


def is_label(item: Column) -> Column:
    return item.startswith(LABEL)


def token_items(samples: DataFrame) -> Column:
    return _prefixed(F.array_distinct(F.concat("title", "body")), TOKEN)


def label_items(opts: Options, labels: str = "domainSpecificLabels") -> Column:
    return _prefixed(cap_labels(F.col(labels), opts.label_cap), LABEL)


def build_baskets(samples: DataFrame, opts: Options) -> DataFrame:
    """``id, tokens, labels, items, set``: the distinct items of each post.

    ``tokens`` alone is what a prediction sees, ``items`` also holds the labels
    below the cap and is what rules are learned from.
    """
    return (
        samples.select(
            F.col("uniqueID").alias("id"),
            token_items(samples).alias("tokens"),
            F.array_distinct(label_items(opts)).alias("labels"),
            "set",
        )
        .withColumn("items", F.concat("tokens", "labels"))
        .select("id", "tokens", "labels", "items", "set")
    )


def signed_items(samples: DataFrame) -> DataFrame:
    """``set, items``: distinct tokens as negative hashes and all labels as ranks, for export."""
    tokens = F.transform(F.concat("title", "body"), lambda h: -F.abs(h))
    labels = F.col("domainSpecificLabels").cast("array<bigint>")
    return samples.select("uniqueID", "set", F.array_distinct(F.concat(tokens, labels)).alias("items"))


@dataclass(frozen=True)
class Mined:
    """Frequent itemsets and rules of a fit, as written tables."""

    itemsets: DataFrame
    rules: DataFrame


def fit_rules(baskets: DataFrame, opts: Options, items: str = "items") -> Mined:
    """FP-growth on the training baskets; support as a number or a share of posts.

    The fit passes over its input several times, so the baskets are written
    first; itemsets and rules are written once for all that use them. The model
    keeps the frequent items on the driver: with a share of posts their number
    does not grow with the posts, with an absolute ``support_count`` it does.
    """
    training = materialize(training_rows(baskets).select(items), "training-baskets")
    support = opts.min_support
    if support is None:
        support = min(1.0, opts.support_count / max(training.count(), 1))
    model = FPGrowth(itemsCol=items, minSupport=support, minConfidence=opts.min_confidence).fit(training)
    return Mined(materialize(model.freqItemsets, "itemsets"), materialize(model.associationRules, "rules"))


def label_rules(rules: DataFrame) -> DataFrame:
    """Rules that conclude a label."""
    return rules.where(is_label(F.col("consequent")[0]))


def predict(baskets: DataFrame, mined: Mined, items: str = "tokens") -> DataFrame:
    """Add ``prediction``: consequents of the rules whose antecedent the basket holds.

    The antecedents are a prefix tree in the order of their items' frequency, and
    each basket walks it. Every row has a prediction of its own, also where ids
    repeat or are missing.
    """
    rows = materialize(baskets.withColumn("_row", F.monotonically_increasing_id()), "predicted-baskets")
    conclusions = mined.rules.groupBy(F.sort_array("antecedent").alias("antecedent")).agg(
        F.array_distinct(F.flatten(F.collect_set("consequent"))).alias("then")
    )
    conclusions = materialize(conclusions.withColumn("rule", F.monotonically_increasing_id()), "conclusions")
    single = mined.itemsets.where(F.size("items") == 1).select(F.col("items")[0].alias("item"), "freq")
    tree = build_tree(conclusions.select("rule", "antecedent"), single)
    met = match_rules(rows, tree, "_row", items)
    then = conclusions.select("rule", F.explode("then").alias("_then"))
    found = skew_join(met, then, ["rule"]).groupBy("_row").agg(F.collect_set("_then").alias("_then"))
    none = F.array().cast("array<string>")
    return (
        rows.join(found, "_row", "left")
        .withColumn("prediction", F.array_except(F.coalesce("_then", none), items))
        .drop("_then", "_row")
    )


def confusion(predicted: DataFrame) -> DataFrame:
    """Per post the labels predicted rightly (TP), wrongly (FP) and missed (FN)."""
    labels = F.filter("prediction", is_label)
    return predicted.select(
        "id",
        "set",
        F.array_intersect(labels, "labels").alias("TP"),
        F.array_except(labels, "labels").alias("FP"),
        F.array_except("labels", labels).alias("FN"),
    )


def micro_scores(confused: DataFrame) -> DataFrame:
    """Precision, recall and F1 of each set from its summed counts; 0/0 is null."""
    sums = confused.groupBy("set").agg(
        *[F.sum(F.size(c)).cast("long").alias(c.lower()) for c in ("TP", "FP", "FN")]
    )
    precision = F.try_divide("tp", F.col("tp") + F.col("fp"))
    recall = F.try_divide("tp", F.col("tp") + F.col("fn"))
    return sums.withColumns({"precision": precision, "recall": recall}).withColumn(
        "f1", F.try_divide(F.col("precision") * F.col("recall") * 2.0, F.col("precision") + F.col("recall"))
    )


def transaction_lines(signed: DataFrame) -> DataFrame:
    """One post per line: its items, blank-separated."""
    return signed.select("set", F.array_join(F.col("items").cast("array<string>"), " ").alias("line"))


def item_appearances(signed: DataFrame) -> DataFrame:
    """Each item of a set once, with the side of a rule it may appear on."""
    item = F.col("item")
    return (
        explode_rows(signed, ["set"], "items", "item")
        .distinct()
        .select("set", "item", F.when(item < 0, "body").otherwise("head").alias("role"))
    )
