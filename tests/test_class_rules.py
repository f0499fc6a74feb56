"""Minimal rules that conclude a label, against all subsets of all baskets."""

import random
from itertools import combinations

import pytest

from tagweave.operators import class_rules, mining
from tagweave.options import Options
from tagweave.plans import queries as q

SCHEMA = "id long, tokens array<string>, labels array<string>, set string"


def baskets_of(seed, n, copies=0):
    """Tokens that tell a label alone, in pairs, or not at all; and near copies."""
    draw, rows = random.Random(seed), []
    for i in range(n):
        tokens = [f"t:{draw.randrange(9)}" for _ in range(draw.randrange(7))]
        held = set(tokens)
        labels = [f"l:{k}" for k in range(3) if {f"t:{k}", f"t:{k + 3}"} <= held or (f"t:{k + 6}" in held and draw.random() < 0.6)]
        rows.append((i, tokens, labels, ("Training", "Training", "Test")[i % 3]))
    shared = [f"t:c{k}" for k in range(12)]
    for i in range(copies):
        rows.append((n + i, [*shared, f"t:{i % 9}"], ["l:0"] if i % 4 else ["l:1"], "Training"))
    return rows


def plain_rules(rows, opts):
    training = [(set(t or []), set(x or [])) for _, t, x, s in rows if s == "Training"]
    support = class_rules.least_support(len(training), opts)
    valid = {}
    for label in {x for _, labels in training for x in labels}:
        for size in range(1, 1 + (opts.max_antecedent or 99)):
            seen = {}
            for tokens, labels in training:
                for s in combinations(sorted(tokens), size):
                    a, b = seen.get(s, (0, 0))
                    seen[s] = (a + (label in labels), b + 1)
            if not seen:
                break
            for s, (a, b) in seen.items():
                if a >= support and a / b >= opts.min_confidence:
                    valid[label, s] = (a, a / b)
    return valid, {k: v for k, v in valid.items() if not any((k[0], s) in valid for n in range(1, len(k[1])) for s in combinations(k[1], n))}


CASES = [
    (1, 240, 0, Options(support_count=6, min_confidence=0.8)),
    (2, 150, 30, Options(support_count=9, min_confidence=0.7)),
    (3, 200, 0, Options(min_support=0.03, min_confidence=0.95, max_antecedent=2)),
    (4, 120, 0, Options(support_count=4, min_confidence=1.0, max_antecedent=1)),
    (5, 90, 0, Options(support_count=80, min_confidence=0.5)),
]


@pytest.mark.parametrize("largest", [4_000_000, 8])
@pytest.mark.parametrize(("seed", "n", "copies", "opts"), CASES)
def test_rules_are_the_minimal_valid_ones_and_predict_as_all_do(spark, seed, n, copies, opts, largest):
    """Searched in tasks, and with bases cut again and again."""
    rows = baskets_of(seed, n, copies) + [(9_000, None, ["l:0"], "Training"), (9_001, ["t:0"], None, "Training"), (9_002, [], [], "Training")]
    valid, minimal = plain_rules(rows, opts)
    baskets = spark.createDataFrame(rows, SCHEMA)
    mined = class_rules.fit_label_rules(baskets, opts, largest)
    found = {(r["consequent"][0], tuple(r["antecedent"])): (r["freq"], r["confidence"]) for r in mined.rules.collect()}
    assert mined.rules.count() == len(found) and found == minimal
    expected = {i: {label for label, s in valid if set(s) <= set(t or [])} for i, t, _, _ in rows}
    predicted = {r["id"]: set(r["prediction"] or []) for r in mining.predict(baskets, mined).collect()}
    assert predicted == expected


def test_some_rules_are_long_and_near_copies_collapse(spark):
    """A family of 40 near copies with 12 tokens of its own gives 12 rules, not 4,095."""
    rows = [(i, [*[f"t:c{k}" for k in range(12)], f"t:{i}"], ["l:0"], "Training") for i in range(40)]
    rows += [(100 + i, [f"t:{i % 5}", f"t:{i % 7}", f"t:{i % 3}"], ["l:1"], "Training") for i in range(200)]
    mined = class_rules.fit_label_rules(spark.createDataFrame(rows, SCHEMA), Options(support_count=20, min_confidence=0.9))
    found = [(r["consequent"][0], r["antecedent"]) for r in mined.rules.collect()]
    assert sorted(a for label, a in found if label == "l:0") == sorted([f"t:c{k}"] for k in range(12))


def test_copies_that_no_set_makes_confident_are_not_searched(spark):
    """Every copy lacks one of 40 tokens and two of five have the label: some 2 ** 40 frequent sets, none valid."""
    rows = [(i, [f"t:c{k}" for k in range(40) if k != i % 40], ["l:0"] if i // 40 < 2 else ["l:1"], "Training") for i in range(200)]
    rows += [(200 + i, ["t:a", "t:b"] if i % 2 else ["t:a", "t:c"], ["l:0"] if i % 2 else ["l:1"], "Training") for i in range(60)]
    rows += [(300 + i, ["t:b"], ["l:1"], "Training") for i in range(30)]
    mined = class_rules.fit_label_rules(spark.createDataFrame(rows, SCHEMA), Options(support_count=20, min_confidence=0.7))
    found = sorted((r["consequent"][0], sorted(r["antecedent"]), r["freq"]) for r in mined.rules.collect())
    assert found == [("l:0", ["t:a", "t:b"], 30), ("l:1", ["t:c"], 30)]


def test_nothing_to_learn_from(spark):
    for rows in ([], [(1, ["t:a"], ["l:0"], "Test")], [(1, [], [], "Training")]):
        baskets = spark.createDataFrame(rows, SCHEMA)
        mined = class_rules.fit_label_rules(baskets, Options(support_count=1))
        assert mined.rules.collect() == []
        assert [r["prediction"] for r in mining.predict(baskets, mined).collect()] == [[] for _ in rows]


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01", "sf0.1"])
def test_rules_conclude_labels_at_every_scale(spark, scale):
    """At the original support of 20 posts and confidence of 0.7."""
    baskets = q._language_baskets(spark, f"/root/testdata/{scale}")
    mined = class_rules.fit_label_rules(baskets, q.LABEL_RULES)
    assert mined.rules.count() > 20
    scores = {r["set"]: r for r in mining.micro_scores(mining.confusion(mining.predict(baskets, mined))).collect()}
    assert all(scores[s]["tp"] > 0 and scores[s]["precision"] > 0.6 for s in ("Training", "Test", "Validation"))
