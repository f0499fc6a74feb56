"""Hot keys by sketch, and the join that spreads them."""

import os

import pytest
from pyspark.sql import functions as F

from tagweave.operators import lookup as lookup_module
from tagweave.operators import dictionary, samples, skew, tags
from tagweave.operators.lookup import heavy_by_count, lookup, lookup_items
from tagweave.options import Options
from tagweave.plans import prepare, queries
from tagweave.sources import tables
from tagweave.sources.tables import discard, materialize


@pytest.fixture()
def unadapted(spark):
    """Without adaptive execution and broadcasts nothing but the lanes balances a join."""
    names = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "32"}
    old = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def sizes(df):
    return [r[0] for r in df.groupBy(F.spark_partition_id()).count().select("count").collect()]


def plain(rows):
    return sorted(map(tuple, rows), key=repr)


def test_hot_keys_are_found_and_rare_ones_are_not(spark):
    n = 200_000
    rows = spark.range(n, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 1000 == 1, "warm").when(F.col("id") % 10 == 2, None).otherwise(F.col("id").cast("string")).alias("k"),
        F.lit(1).alias("j"),
    )
    expected = spark.createDataFrame([("hot", 1), ("warm", 1)], "k string, j int").select(F.xxhash64("k", "j")).collect()
    assert sorted(skew.hot_keys(rows, ["k", "j"])) == sorted(r[0] for r in expected)


def test_no_rows_have_no_hot_keys(spark):
    none = spark.createDataFrame([(None,)], "k string")
    assert skew.hot_keys(none, ["k"]) == [] and skew.hot_keys(none.limit(0), ["k"]) == []


@pytest.mark.parametrize("how", ["inner", "left"])
def test_skew_join_equals_a_join(spark, how):
    """Hot on the left, hot on the right, hot on both sides, absent, repeated and missing keys."""
    left = [("both", 1, i) for i in range(60)] + [("left", 1, i % 3) for i in range(900)] + [(None, 1, i) for i in range(400)]
    left += [("right", 2, 1), ("gone", 1, 7), ("left", None, 5), *[(f"k{i}", i % 2, i) for i in range(500)]]
    right = [("both", 1, f"b{i}") for i in range(40)] + [("left", 1, "x"), ("left", 1, "y"), ("left", 3, "z"), (None, 1, "n")]
    right += [("right", 2, str(i % 5)) for i in range(900)] + [(f"k{i}", i % 2, "v") for i in range(0, 900, 2)]
    a = materialize(spark.createDataFrame(left, "k string, j int, x int").repartition(4), "left")
    b = materialize(spark.createDataFrame(right, "k string, j int, y string").repartition(4), "right")
    assert plain(skew.skew_join(a, b, ["k", "j"], how).collect()) == plain(a.join(b, ["k", "j"], how).collect())
    assert skew.skew_join(a, b, ["k", "j"], how).columns == a.join(b, ["k", "j"], how).columns
    assert skew.skew_join(a.limit(0), b, ["k", "j"], how).count() == 0


def test_other_joins_are_refused(spark):
    df = spark.createDataFrame([("a",)], "k string")
    with pytest.raises(ValueError):
        skew.skew_join(df, df, ["k"], "full")


def test_hot_and_missing_keys_stay_balanced(unadapted):
    """A third of the rows without key and a third of one key, on either side, over many tasks."""
    spark, n = unadapted, 60_000
    key = F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, "hot").otherwise(F.col("id").cast("string"))
    facts = materialize(spark.range(n, numPartitions=8).select(key.alias("k"), F.col("id").alias("x")), "facts")
    few = materialize(spark.createDataFrame([("hot", 1), ("2", 2), ("no", 3)], "k string, y int"), "few")
    for joined, rows in (
        (skew.skew_join(facts, few, ["k"], "left"), n),
        (skew.skew_join(facts, few, ["k"]), n // 3 + 1),
        (skew.skew_join(few, facts, ["k"]), n // 3 + 1),
    ):
        held = sizes(joined)
        assert sum(held) == rows and max(held) < 4 * rows / 32


def posts_without_ids(spark, n=30_000):
    """A third of the posts and of the tag rows have no id."""
    own = F.when(F.col("id") % 3 > 0, F.concat(F.lit("p"), F.col("id").cast("string")))
    base = spark.range(n, numPartitions=8).withColumn("uniqueID", own).withColumn("domain", F.lit("d"))
    text = base.select("uniqueID", F.lit("alpha beta").alias("title"), F.concat(F.lit("w"), F.col("id") % 50).alias("body"), "domain")
    rows = base.select("uniqueID", F.when(F.col("id") % 2 == 0, "a,b").otherwise("b").alias("tags"), "domain")
    return materialize(text, "posts"), materialize(rows, "tags")


def test_posts_without_id_stay_balanced_and_whole(unadapted):
    """J4, J5, A5 and the whole job; tag rows without id are not collapsed into one."""
    spark, n = unadapted, 30_000
    text, tag_rows = posts_without_ids(spark, n)
    prepared = prepare.prepare(text, tag_rows, Options(vocab_size=20, min_df=1, rows_per_shard=10_000))
    # A tag row without id belongs to no post, so only posts with id are samples.
    found = prepared.samples
    assert found.count() == found.where("uniqueID IS NOT NULL").count() == 2 * n // 3
    ranks = prepared.lookups
    encoded = tags.encode_tags(prepare.split.assign_sets(tag_rows, Options()), ranks["global_tags"], ranks["domain_tags"])
    held = sizes(encoded)
    assert sum(held) == n and max(held) < 4 * n / 32
    assert plain(encoded.where("uniqueID IS NULL").groupBy("originalTagCount").count().collect()) == [(1, n // 6), (2, n // 6)]
    hashed = text.withColumns({f: F.array(F.xxhash64(f)) for f in ("title", "body")}).withColumn("set", F.lit("Training"))
    assembled = samples.assemble_samples(materialize(hashed, "hashed"), materialize(encoded, "encoded"))
    held = sizes(assembled)
    assert sum(held) == n and max(held) < 4 * n / 32
    names = tags.decode_labels(materialize(encoded, "encoded"), ranks["global_tags"], ranks["domain_tags"])
    assert names.count() == n


def test_lookup_evaluates_its_facts_once_and_aggregates_no_keys(spark, monkeypatch):
    monkeypatch.setattr(lookup_module, "HEAVY_KEYS", 2)
    calls = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(x):
        calls.add(1)
        return x

    facts = spark.range(3_000, numPartitions=4).select(F.col("id"), counted(F.concat(F.lit("k"), F.col("id") % 40)).alias("k"))
    dimension = materialize(spark.range(40).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").alias("v"), F.lit(1).alias("n")), "dimension")
    written, write = [], lookup_module.materialize

    def keep(df, label):
        written.append((label, df._jdf.queryExecution().optimizedPlan().toString()))
        return write(df, label)

    monkeypatch.setattr(lookup_module, "materialize", keep)
    found = lookup(facts, dimension, ["k"], heavy_by_count(dimension, "n") & (F.col("v") < 2), "id")
    assert found.where(F.col("v") == F.col("id") % 40).count() == 3_000
    assert calls.value == 3_000
    assert [label for label, _ in written] == ["looked-up"]
    assert not any("Aggregate" in plan for _, plan in written)


def test_answered_rows_stay_out_of_the_shuffle(spark):
    """Broadcast, shuffled, absent, repeated and missing keys; only those without an answer reach the join."""
    keys = [("k0", i) for i in range(300)] + [(f"k{i}", i) for i in range(40)] + [("gone", 1), ("gone", 2), (None, 3)]
    facts = materialize(spark.createDataFrame(keys, "k string, id long"), "facts")
    dim = [(f"k{i}", i, 1) for i in range(40)] + [("k7", 70, 1), ("k0", 100, 1)]
    dimension = materialize(spark.createDataFrame(dim, "k string, v int, n int"), "dimension")
    found = lookup(facts, dimension, ["k"], F.col("v") < 2, "id")
    wanted = facts.join(dimension.where("v < 2"), "k").unionByName(
        facts.join(dimension.where("v < 2"), "k", "left_anti").join(dimension.where("v >= 2"), "k", "left")
    )
    # A key with a broadcast answer has its shuffled ones as little as before.
    assert plain(found.select("k", "id", "v", "n").collect()) == plain(wanted.select("k", "id", "v", "n").collect())
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and "NOT coalesce(_hit" in plan


ARRAYS = [(0, "a", [5, 1, 99, 5, None, 30]), (1, "a", []), (2, None, None), (3, "b", [30, 31, 98, 2]), (4, "b", [97])]


@pytest.mark.parametrize("heavy", [0, 3, 1000])
def test_items_are_looked_up_inside_their_arrays(spark, monkeypatch, heavy):
    """Frequent, rare, absent, repeated and missing items, in order; nothing is written and the arrays stay whole."""
    monkeypatch.setattr(lookup_module, "materialize", None)
    rows = materialize(spark.createDataFrame(ARRAYS, "row long, k string, items array<bigint>"), "arrays")
    known = {i: f"v{i}" if i != 2 else "y" * 300 for i in range(40)}
    dimension = materialize(spark.createDataFrame([(i, v, i) for i, v in known.items()], "item long, value string, rank int"), "dimension")
    found = lookup_items(rows, ["k"], "row", F.col("items"), dimension, "item", "value", F.col("rank") < heavy)
    assert found.columns == ["k", "row", "_values"]
    got = {r["row"]: (r["k"], r["_values"]) for r in found.collect()}
    assert got == {n: (k, [known.get(i) for i in items or []]) for n, k, items in ARRAYS}


@pytest.mark.parametrize("missing", [None, "?"])
def test_decoding_writes_no_tokens(spark, monkeypatch, missing):
    """Before, every token was written as a row of its own."""
    known = materialize(spark.createDataFrame([(10, "a", 0), (11, "b", 1), (12, "c", 2)], "hash long, token string, index int"), "dictionary")
    rows = spark.createDataFrame([(1, [12, 10, 10, 7]), (1, [11]), (None, []), (2, [7])], "uniqueID long, title array<bigint>")
    monkeypatch.setattr(lookup_module, "HEAVY_KEYS", 1)
    monkeypatch.setattr(lookup_module, "materialize", None)
    found = dictionary.decode_tokens(rows, known, "title", "t", missing).collect()
    want = [(1, ["b"]), (1, ["c", "a", "a"])] if missing is None else [(1, ["b"]), (1, ["c", "a", "a", "?"]), (2, ["?"]), (None, [])]
    assert sorted(((r["uniqueID"], r["t"]) for r in found), key=str) == want


def test_exported_lines_are_read_back_without_a_row_for_each_token(spark, monkeypatch):
    """Before, tokens and names were written as rows, and the samples stayed to the end."""
    written, write = [], tables.materialize

    def keep(df, label):
        written.append((label, table := write(df, label)))
        return table

    for module in (lookup_module, queries):
        monkeypatch.setattr(module, "materialize", keep)
    found = queries.transaction_contents(spark, "/root/testdata/sf0.001")
    monkeypatch.setattr(lookup_module, "HEAVY_KEYS", 100)
    assert queries.transaction_contents(spark, "/root/testdata/sf0.001").exceptAll(found).isEmpty()
    rows = {label: table for label, table in written if "item" in table.columns and label != "spelling"}
    assert not rows
    folder = dict(written)["samples"].inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://")
    assert not os.path.exists(folder)


def test_a_discarded_table_is_gone(spark):
    written = materialize(spark.range(10), "short-lived")
    kept = materialize(spark.range(10), "kept")
    folder = written.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://")
    assert os.path.isdir(folder)
    discard(written)
    assert not os.path.exists(folder) and kept.count() == 10


def test_the_most_frequent_keys_are_no_more_than_may_be_broadcast(spark, monkeypatch):
    dimension = materialize(spark.createDataFrame([(f"k{i}", n) for i, n in enumerate([9, 7, 7, 4, 4, 4, 1])], "k string, n long"), "dimension")
    for most, expected in ((0, 0), (1, 1), (2, 1), (3, 3), (5, 3), (6, 6), (7, 7), (50, 7)):
        monkeypatch.setattr(lookup_module, "HEAVY_KEYS", most)
        assert dimension.where(lookup_module.heavy_by_most(dimension, "n")).count() == expected
    assert materialize(dimension.where("false"), "none").where(lookup_module.heavy_by_most(dimension.where("false"), "n")).count() == 0
