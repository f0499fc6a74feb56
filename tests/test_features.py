import math
from collections import Counter

import pytest
from pyspark.ml.feature import IDF, CountVectorizer, CountVectorizerModel

from tagweave.operators import dictionary, features, quality
from tagweave.operators import lookup as lookup_module
from tagweave.operators import text as tx
from tagweave.options import Options
from tagweave.plans import queries
from tagweave.sources.tables import materialize

TOKENS = "uniqueID long, title array<string>, body array<string>, domain string"


@pytest.fixture(scope="module")
def posts(spark):
    rows = [
        (i, [f"w{(i * k) % 11}" for k in range(1, 4)], [f"w{(i + k) % 13}" for k in range(i % 6)], "d")
        for i in range(60)
    ]
    rows.append((99, [], [], "d"))
    return rows, spark.createDataFrame(rows, TOKENS)


def test_dictionary_fixture(spark):
    rows = (
        [(1, ["A", "B", "C"], ["D"], "")] * 6
        + [(2, ["D", "Y"], [], ""), (3, [], ["X"], "")]
        + [(4, [], [], "")] * 6
    )
    tokens = spark.createDataFrame(rows, TOKENS)
    found = dictionary.build_dictionary(tokens, Options(token_usage_threshold=1)).collect()
    assert {r["token"]: r["index"] for r in found} == {"D": 0, "A": 1, "B": 2, "C": 3}
    assert len({r["hash"] for r in found}) == 4


@pytest.mark.parametrize("heavy", [50_000, 1])
@pytest.mark.parametrize("method", ["xxhash64", "murmur3_128"])
def test_decoding_keeps_order_copies_and_placeholders(spark, monkeypatch, heavy, method):
    monkeypatch.setattr(lookup_module, "HEAVY_KEYS", heavy)
    opts = Options(token_usage_threshold=1, hash_method=method)
    rows = [(1, ["b", "a", "b", "rare"], [], "")] * 3 + [(2, [], [], ""), (3, ["once"], [], "")]
    tokens = spark.createDataFrame(rows, TOKENS)
    known = materialize(dictionary.build_dictionary(tokens, opts), "dictionary")
    hashed = tx.hash_fields(tokens, opts)
    found = [(r["uniqueID"], r["t"]) for r in dictionary.decode_tokens(hashed, known, "title", "t").collect()]
    assert found == [(1, ["b", "a", "b", "rare"])] * 3
    filled = sorted((r["uniqueID"], r["t"]) for r in dictionary.decode_tokens(hashed, known, "title", "t", "?").collect())
    assert filled == [(1, ["b", "a", "b", "rare"])] * 3 + [(2, []), (3, ["?"])]


def test_vocabulary_against_the_estimator(spark, posts):
    rows, tokens = posts
    opts = Options(vocab_size=6, min_df=10)
    vocabulary = features.build_vocabulary(tokens, opts).orderBy("rank").collect()
    tf, df = Counter(), Counter()
    for _, title, body, _ in rows:
        tf.update(title + body)
        df.update(set(title + body))
    expected = sorted((w for w in tf if df[w] >= 10), key=lambda w: (-tf[w], w))[:6]
    assert [(r["words"], r["tf"], r["df"]) for r in vocabulary] == [(w, tf[w], df[w]) for w in expected]
    merged = tx.merge_fields(tokens)
    model = CountVectorizer(inputCol="titleBody", outputCol="v", vocabSize=100, minDF=10).fit(merged)
    everything = features.build_vocabulary(tokens, Options(vocab_size=100, min_df=10)).collect()
    assert {r["words"] for r in everything} == set(model.vocabulary)


@pytest.mark.parametrize("combine", [True, False])
def test_bags_and_long_form_agree_with_the_estimators(spark, posts, combine):
    _, tokens = posts
    opts = Options(vocab_size=50, min_df=2, combine=combine)
    vocabulary, number = features.fit_features(tokens, opts)
    bags = features.bag_table(tokens, vocabulary, opts, number)
    assert bags.columns == ["uniqueID", "titleBodyBag"] if combine else ["uniqueID", "titleBag", "bodyBag"]
    weighted = features.idf_weights(vocabulary, number)
    long = features.tfidf_long(features.bag_long(tokens, weighted, opts)).collect()
    column = "titleBodyBag" if combine else "bodyBag"
    cells = {}
    for r in long:
        if combine or r["field"] == "body":
            cells[(r["uniqueID"], r["rank"])] = r["tfidf"]
    seen = 0
    for r in bags.collect():
        ranks = [c["rank"] for c in r[column]]
        assert ranks == sorted(set(ranks))
        seen += len(ranks)
        assert all(math.isclose(c["value"], cells[(r["uniqueID"], c["rank"])], abs_tol=1e-9) for c in r[column])
    assert seen == len(cells)
    # The weights are those of the estimator on the same counts.
    words = [r["words"] for r in vocabulary.orderBy("rank").collect()]
    model = CountVectorizerModel.from_vocabulary(words, inputCol="titleBody", outputCol="v")
    idf = IDF(inputCol="v", outputCol="o").fit(model.transform(tx.merge_fields(tokens))).idf.toArray()
    ours = [r["weight"] for r in weighted.orderBy("rank").collect()]
    assert all(math.isclose(a, b, abs_tol=1e-9) for a, b in zip(idf, ours))


def test_features_of_the_training_posts_only(spark):
    rows = [(i, ["a"] if i < 5 else ["b"], [], "d", "Training" if i < 5 else "Test") for i in range(10)]
    tokens = spark.createDataFrame(rows, TOKENS + ", set string")
    opts = Options(min_df=1, fit_on="training")
    vocabulary, number = features.fit_features(tokens, opts)
    assert [r["words"] for r in vocabulary.collect()] == ["a"] and number == 5
    assert features.fit_features(tokens, Options(min_df=1))[1] == 10


@pytest.mark.parametrize("heavy", [50_000, 2])
def test_bag_decodes_to_its_words(spark, posts, monkeypatch, heavy):
    monkeypatch.setattr(lookup_module, "HEAVY_KEYS", heavy)
    rows, tokens = posts
    opts = Options(vocab_size=50, min_df=1)
    vocabulary = materialize(features.build_vocabulary(tokens, opts), "vocabulary")
    bag = features.bag_long(tokens, vocabulary, opts)
    found = {r["uniqueID"]: set(r["words"].split(",")) for r in features.decode_bag(bag).collect()}
    assert found == {i: set(t + b) for i, t, b, _ in rows if t + b}
    separate = features.bag_long(tokens, vocabulary, Options(vocab_size=50, min_df=1, combine=False))
    checks = quality.feature_violations(separate, tokens).collect()
    assert {r["field"]: r["violations"] for r in checks} == {"title": 0, "body": 0}
    doubled = separate.withColumnRenamed("rank", "r").unionByName(separate.withColumnRenamed("rank", "r"))
    assert sum(r["violations"] for r in quality.feature_violations(doubled, tokens).collect()) > 0


def test_no_vocabulary_gives_empty_bags(spark, posts):
    _, tokens = posts
    opts = Options(min_df=1000)
    vocabulary, number = features.fit_features(tokens, opts)
    bags = features.bag_table(tokens, vocabulary, opts, number)
    assert bags.count() == 0
    filled = features.fill_bags(tokens.join(bags, "uniqueID", "left"), opts)
    assert {len(r["titleBodyBag"]) for r in filled.collect()} == {0}


def test_both_bags_of_a_post_leave_one_pass(spark):
    plan = queries.QUERIES["tfidf_separate_vectors"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("documents.parquet") + plan.count("Relation [doc_id") == 1, plan
