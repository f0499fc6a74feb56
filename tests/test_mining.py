import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from tagweave.operators import mining
from tagweave.options import Options

SAMPLES = "uniqueID long, title array<long>, body array<long>, domainSpecificLabels array<int>, set string"


@pytest.fixture(scope="module")
def samples(spark):
    draw = random.Random(5)
    rows = []
    for i in range(300):
        words = [draw.randrange(1, 12) for _ in range(draw.randrange(6))]
        labels = sorted({w % 4 for w in words if draw.random() < 0.8} | ({120} if i % 50 == 0 else set()))
        rows.append((i, words[:2], words[2:], labels, ("Training", "Test", "Validation")[i % 3]))
    return rows, spark.createDataFrame(rows, SAMPLES)


OPTS = Options(support_count=5, min_confidence=0.5)


def plain_baskets(rows):
    return {
        i: (
            {f"t:{w}" for w in t + b},
            {f"l:{x}" for x in labels if x < 100},
            s,
        )
        for i, t, b, labels, s in rows
    }


def test_baskets_are_distinct_and_capped(samples):
    rows, df = samples
    expected = plain_baskets(rows)
    for r in mining.build_baskets(df, OPTS).collect():
        tokens, labels, name = expected[r["id"]]
        assert len(r["items"]) == len(set(r["items"]))
        assert (set(r["tokens"]), set(r["labels"]), r["set"]) == (tokens, labels, name)
        assert set(r["items"]) == tokens | labels


def brute_force(rows):
    training = [t | lb for t, lb, s in plain_baskets(rows).values() if s == "Training"]
    need = -(-OPTS.support_count / len(training)) * len(training)
    counts = {}
    for basket in training:
        for size in range(1, len(basket) + 1):
            for items in combinations(sorted(basket), size):
                counts[items] = counts.get(items, 0) + 1
    frequent = {k: v for k, v in counts.items() if v >= round(need, 6)}
    rules = {}
    for items, freq in frequent.items():
        for then in items:
            before = tuple(x for x in items if x != then)
            if before and freq / frequent[before] >= OPTS.min_confidence:
                rules[(before, then)] = freq / frequent[before]
    return frequent, rules


def test_itemsets_rules_and_predictions_against_brute_force(samples):
    rows, df = samples
    baskets = mining.build_baskets(df, OPTS)
    mined = mining.fit_rules(baskets, OPTS)
    frequent, rules = brute_force(rows)
    assert {tuple(sorted(r["items"])): r["freq"] for r in mined.itemsets.collect()} == frequent
    found = {(tuple(sorted(r["antecedent"])), r["consequent"][0]): r["confidence"] for r in mined.rules.collect()}
    assert found == pytest.approx(rules)
    heads = {r["consequent"][0] for r in mining.label_rules(mined.rules).collect()}
    assert heads == {then for _, then in rules if then.startswith("l:")}
    expected = {
        i: {then for (before, then) in rules if set(before) <= tokens and then not in tokens}
        for i, (tokens, _, _) in plain_baskets(rows).items()
    }
    predicted = mining.predict(baskets, mined)
    assert {r["id"]: set(r["prediction"]) for r in predicted.collect()} == expected

    totals = {}
    for i, (_, labels, name) in plain_baskets(rows).items():
        guess = {x for x in expected[i] if x.startswith("l:")}
        tp, fp, fn = totals.get(name, (0, 0, 0))
        totals[name] = (tp + len(guess & labels), fp + len(guess - labels), fn + len(labels - guess))
    for r in mining.micro_scores(mining.confusion(predicted)).collect():
        tp, fp, fn = totals[r["set"]]
        assert (r["tp"], r["fp"], r["fn"]) == (tp, fp, fn)
        assert r["precision"] == pytest.approx(tp / (tp + fp)) and r["recall"] == pytest.approx(tp / (tp + fn))


def test_scores_without_predictions_are_null(spark):
    rows = [(1, "Test", ["l:1"], ["l:1"], []), (2, "Test", ["l:2"], ["l:2"], [])]
    df = spark.createDataFrame(rows, "id long, set string, labels array<string>, items array<string>, prediction array<string>")
    scores = mining.micro_scores(mining.confusion(df)).first()
    assert scores["precision"] is None and scores["recall"] == 0 and scores["f1"] is None


def test_signed_items_lines_and_appearances(spark):
    df = spark.createDataFrame([(1, [7, -7], [3], [0, 2, 500], "Training"), (2, [3], [], [2], "Test")], SAMPLES)
    signed = mining.signed_items(df)
    lines = {(r["set"], r["line"]) for r in mining.transaction_lines(signed).collect()}
    assert lines == {("Training", "-7 -3 0 2 500"), ("Test", "-3 2")}
    roles = {(r["set"], r["item"], r["role"]) for r in mining.item_appearances(signed).collect()}
    assert ("Training", 0, "head") in roles and ("Training", -7, "body") in roles and ("Training", 500, "head") in roles and len(roles) == 7


def test_support_as_a_share(samples):
    _, df = samples
    baskets = mining.build_baskets(df, OPTS)
    mined = mining.fit_rules(baskets, Options(min_support=0.5, min_confidence=0.5))
    assert mined.itemsets.where(F.col("freq") < 50).count() == 0


def test_a_long_post_is_cut_to_the_items_of_rules(spark):
    """Only items of antecedents are copied, however many words a post has."""
    words = [f"w{i}" for i in range(20_000)]
    rows = [(1, ["t:a", "t:b", *words], "Test"), (2, ["t:b"], "Test"), (3, [], "Test")]
    baskets = spark.createDataFrame(rows, "id long, tokens array<string>, set string")
    rules = spark.createDataFrame([(["t:a"], ["l:1"]), (["t:a", "t:b"], ["l:2"])], "antecedent array<string>, consequent array<string>")
    itemsets = spark.createDataFrame([(["t:a"], 5), (["t:b"], 9)], "items array<string>, freq long")
    predicted = mining.predict(baskets, mining.Mined(itemsets, rules))
    assert {r["id"]: sorted(r["prediction"]) for r in predicted.collect()} == {1: ["l:1", "l:2"], 2: [], 3: []}
