"""Baskets that walk a tree of antecedents, against containment tests."""

import random

import pytest
from pyspark.sql import functions as F

from tagweave.operators import lookup as lookup_module
from tagweave.operators import mining, rule_tree
from tagweave.sources.tables import materialize


def tree_of(spark, sets, frequencies):
    rules = [(i, sorted(s)) for i, s in enumerate(sets)]
    table = materialize(spark.createDataFrame(rules, "rule long, antecedent array<string>"), "rules")
    return rule_tree.build_tree(table, spark.createDataFrame(frequencies, "item string, freq long"))


@pytest.mark.parametrize("heavy", [50_000, 3])
def test_matches_are_the_contained_antecedents(spark, monkeypatch, heavy):
    """With all edges broadcast, and with most of them joined by shuffle."""
    monkeypatch.setattr(lookup_module, "HEAVY_KEYS", heavy)
    monkeypatch.setattr(rule_tree, "HEAVY_KEYS", heavy)
    draw = random.Random(8)
    words = [f"w{i}" for i in range(14)]
    sets = sorted({frozenset(draw.sample(words, draw.randrange(1, 6))) for _ in range(120)}, key=sorted)
    baskets = [(i, draw.choices(words + ["other"], k=draw.randrange(0, 12))) for i in range(150)] + [(150, None), (151, [])]
    tree = tree_of(spark, sets, [(w, i * 3) for i, w in enumerate(words[2:])])
    assert tree.small == (heavy > 100) and tree.depth == 5
    found = rule_tree.match_rules(spark.createDataFrame(baskets, "row long, items array<string>"), tree, "row", "items")
    expected = {(i, r) for i, basket in baskets for r, s in enumerate(sets) if s <= set(basket or [])}
    rows = [tuple(r) for r in found.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == expected


def test_an_empty_tree_matches_nothing(spark):
    tree = tree_of(spark, [], [("a", 1)])
    assert rule_tree.match_rules(spark.createDataFrame([(1, ["a"])], "row long, items array<string>"), tree, "row", "items").collect() == []


def test_a_frequent_item_may_begin_very_many_antecedents(spark):
    """100,000 antecedents of one frequent item and another: edges are rows, and no row holds them all."""
    n = 100_000
    rules = spark.range(n).select(F.array(F.lit("hot"), F.concat(F.lit("x"), "id")).alias("antecedent"), F.array(F.concat(F.lit("l:"), F.col("id") % 7)).alias("consequent"))
    singles = spark.createDataFrame([(["hot"], 5)], "items array<string>, freq long")
    # "hot" is the rarest by these frequencies, so all antecedents begin with it.
    singles = singles.unionByName(spark.range(n).select(F.array(F.concat(F.lit("x"), "id")).alias("items"), F.lit(9).cast("long").alias("freq")))
    baskets = spark.range(400, numPartitions=4).select(
        F.col("id"), F.array(F.lit("hot"), F.concat(F.lit("x"), F.col("id") % 100), F.lit("y")).alias("tokens"), F.lit("Test").alias("set")
    )
    predicted = mining.predict(baskets, mining.Mined(singles, rules)).collect()
    assert len(predicted) == 400
    assert all(r["prediction"] == [f"l:{r['id'] % 100 % 7}"] for r in predicted)


def test_rows_without_id_and_repeated_ids_are_predicted_apart(spark):
    rows = [(None, ["t:a"], "Test"), (None, ["t:b"], "Test"), (1, ["t:a"], "Test"), (1, [], "Test"), (1, None, "Test")]
    baskets = spark.createDataFrame(rows, "id long, tokens array<string>, set string")
    rules = spark.createDataFrame([(["t:a"], ["l:1"]), (["t:b"], ["l:2"])], "antecedent array<string>, consequent array<string>")
    itemsets = spark.createDataFrame([(["t:a"], 5), (["t:b"], 9)], "items array<string>, freq long")
    found = [(r["id"], r["tokens"], r["prediction"]) for r in mining.predict(baskets, mining.Mined(itemsets, rules)).collect()]
    expected = [(None, ["t:a"], ["l:1"]), (None, ["t:b"], ["l:2"]), (1, ["t:a"], ["l:1"]), (1, [], []), (1, None, None)]
    assert sorted(found, key=repr) == sorted(expected, key=repr)
