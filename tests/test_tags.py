import pytest
from pyspark.sql import functions as F

from tagweave.operators import lookup as lookup_module
from tagweave.operators import quality, samples, split, tags
from tagweave.sources import adapters, tables
from tagweave.operators.lookup import heavy_by_count, heavy_by_rank, lookup
from tagweave.operators.ordering import ordered_index
from tagweave.options import SET_NAMES, Options
from tagweave.sources.tables import materialize

TAGS = "uniqueID long, tags string, domain string"

RANKED_POSTS = (
    [("A", "2"), ("A,B,E", "2"), ("A,B,C", "2"), ("A,B,E", "2"), ("C,D", "1"), ("C,A,D", "1"), ("", "1")]
    + [("C,F", "1")] * 5
    + [("C,E", "1")] * 12
    + [("C,A", "1")] * 2
)


@pytest.fixture(scope="module")
def ranked(spark):
    rows = [(i, t, d) for i, (t, d) in enumerate(RANKED_POSTS)]
    posts = spark.createDataFrame(rows, TAGS)
    counts = tags.count_tags(posts)
    return (
        posts,
        materialize(tags.rank_tags_globally(counts), "g"),
        materialize(tags.rank_tags_in_domains(counts), "d"),
    )


def test_parse(spark):
    rows = [(1, " a, b,,a ", None), (2, "", "x"), (3, None, "x"), (4, " , ", "x")]
    found = tags.tag_sets(spark.createDataFrame(rows, TAGS)).orderBy("uniqueID").collect()
    assert [r["tagSet"] for r in found] == [["a", "b"], [], [], []]
    assert [r["uniqueTagCount"] for r in found] == [2, 0, 0, 0]
    assert found[0]["domain"] == "undefined_domain"


def test_global_rank(ranked):
    found = {r["tag"]: (r["tagGlobalCount"], r["tagGlobalRank"]) for r in ranked[1].collect()}
    assert found == {"C": (22, 0), "E": (14, 1), "A": (7, 2), "F": (5, 3), "B": (3, 4), "D": (2, 5)}


def test_domain_rank(ranked):
    found = {(r["domain"], r["tag"]): (r["tagInDomainCount"], r["tagRankInDomain"]) for r in ranked[2].collect()}
    assert found == {
        ("2", "A"): (4, 0), ("2", "B"): (3, 1), ("2", "E"): (2, 2), ("2", "C"): (1, 3),
        ("1", "C"): (21, 0), ("1", "E"): (12, 1), ("1", "F"): (5, 2), ("1", "A"): (3, 3), ("1", "D"): (2, 4),
    }
    assert all(r["gaps"] == 0 and r["repeats"] == 0 for r in tags.rank_gaps(ranked[2]).collect())
    sizes = {r["domain"]: r["tags"] for r in tags.tags_per_domain(ranked[2]).collect()}
    assert sizes == {"1": 5, "2": 4}


def test_rank_gaps_are_found(spark):
    broken = spark.createDataFrame([("d", 0), ("d", 2), ("e", 0), ("e", 0)], "domain string, tagRankInDomain int")
    found = {r["domain"]: (r["gaps"], r["repeats"]) for r in tags.rank_gaps(broken).collect()}
    assert found["d"] == (1, 0) and found["e"][1] == 1


def test_equal_counts_are_ordered_by_name(spark):
    posts = spark.createDataFrame([(1, "b,c,a", "x"), (2, "d", "x"), (3, "d", "x")], TAGS)
    found = tags.rank_tags_in_domains(tags.count_tags(posts)).orderBy("tagRankInDomain").collect()
    assert [r["tag"] for r in found] == ["d", "a", "b", "c"]


def test_fraction_of_tags(ranked):
    kept = tags.most_used_fraction(ranked[2], 0.5).collect()
    assert {(r["domain"], r["tag"]) for r in kept} == {("1", "C"), ("1", "E"), ("1", "F"), ("2", "A"), ("2", "B")}
    assert tags.most_used_fraction(ranked[2], 1.0).count() == ranked[2].count()


@pytest.mark.parametrize("heavy", [50_000, 2])
def test_encoding_and_decoding(spark, ranked, monkeypatch, heavy):
    monkeypatch.setattr(lookup_module, "HEAVY_KEYS", heavy)
    posts, global_tags, domain_tags = ranked
    more = spark.createDataFrame([(256, "", "2"), (123, "X", "2")], TAGS)
    encoded = tags.encode_tags(posts.unionByName(more), global_tags, domain_tags)
    rows = {r["uniqueID"]: r for r in encoded.collect()}
    assert all(len(r["globalTags"]) == len(r["domainTags"]) for r in rows.values())
    assert rows[123]["globalTags"] == [] and rows[123]["originalTagCount"] == 1
    assert 256 not in rows and 6 not in rows and len(rows) == len(RANKED_POSTS)
    assert rows[5]["globalTags"] == [0, 2, 5] and rows[5]["domainTags"] == [0, 3, 4]
    decoded = {r["uniqueID"]: r for r in tags.decode_labels(encoded, global_tags, domain_tags).collect()}
    assert all(r["globalNames"] == r["domainNames"] for r in decoded.values())
    assert decoded[5]["globalNames"] == ["A", "C", "D"]
    different = quality.label_disagreements(tags.decode_labels(encoded, global_tags, domain_tags)).first()
    assert different["different"] == 0
    everyone = tags.encode_tags(posts.unionByName(more), global_tags, domain_tags, keep_untagged=True)
    assert everyone.count() == len(RANKED_POSTS) + 2
    assert everyone.where("uniqueID = 256").first()["originalTagCount"] == 0


@pytest.mark.parametrize("partitions", ["3", "8"])
def test_ordered_index_matches_a_sort_when_one_group_dominates(spark, partitions):
    rows = [("hot" if i % 3 else f"g{i % 7}", (i * 7919) % 1000, i) for i in range(4000)]
    df = spark.createDataFrame(rows, "g string, n long, id long").repartition(5)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        found = ordered_index(df, [F.desc("n"), F.asc("id")], "at", by=["g"]).collect()
        whole = ordered_index(df, [F.desc("n"), F.asc("id")], "at").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    expected = {}
    for g in {r[0] for r in rows}:
        members = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1], r[2]))
        expected.update({r[2]: i for i, r in enumerate(members)})
    assert {r["id"]: r["at"] for r in found} == expected
    order = sorted(rows, key=lambda r: (-r[1], r[2]))
    assert {r["id"]: r["at"] for r in whole} == {r[2]: i for i, r in enumerate(order)}


def test_ordered_index_of_nothing_and_of_null_groups(spark):
    empty = spark.createDataFrame([], "g string, n long")
    assert ordered_index(empty, [F.asc("n")], "at", by=["g"]).count() == 0
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 5)], "g string, n long")
    found = {(r["g"], r["n"]): r["at"] for r in ordered_index(df, [F.asc("n")], "at", by=["g"]).collect()}
    assert found == {(None, 1): 0, (None, 2): 1, ("a", 5): 0}


@pytest.mark.parametrize("heavy", [50_000, 3])
def test_lookup_equals_a_left_join(spark, monkeypatch, heavy):
    monkeypatch.setattr(lookup_module, "HEAVY_KEYS", heavy)
    keys = ["hot"] * 400 + [None] * 200 + [f"k{i % 40}" for i in range(400)] + ["x" * 1000]
    facts = spark.createDataFrame(list(enumerate(keys)), "id long, key string")
    names = ["hot", "x" * 1000] + [f"k{i}" for i in range(30)]
    dim = materialize(spark.createDataFrame([(k, i, 1000 - i) for i, k in enumerate(names)], "key string, rank int, n long"), "dim")
    expected = {i: names.index(k) if k in names else None for i, k in enumerate(keys)}
    for heavy_keys in (heavy_by_rank("rank"), heavy_by_count(dim, "n")):
        found = lookup(facts, dim, ["key"], heavy_keys, "id")
        assert {r["id"]: r["rank"] for r in found.collect()} == expected
        assert found.columns == ["id", "key", "rank", "n"]


def test_answered_rows_leave_the_partition_of_their_hot_key(spark, monkeypatch):
    monkeypatch.setattr(lookup_module, "HEAVY_KEYS", 1)
    keys = ["hot"] * 3000 + [None] * 3000 + [f"k{i % 500}" for i in range(3000)]
    facts = spark.createDataFrame(list(enumerate(keys)), "id long, key string")
    dim = materialize(spark.createDataFrame([("hot", 0)] + [(f"k{i}", i + 1) for i in range(500)], "key string, rank int"), "dim")
    adaptive, threshold = (spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = lookup(facts, dim, ["key"], heavy_by_rank("rank"), "id")
        sizes = [r["rows"] for r in quality.partition_sizes(found).collect()]
        assert "hashpartitioning(key#" in found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert len(sizes) == 8 and sum(sizes) == 9000 and max(sizes) < 1600


def test_split_is_reproducible_and_close_to_its_shares(spark):
    opts = Options()
    rows = split.assign_sets(spark.range(20000).withColumnRenamed("id", "uniqueID"), opts)
    again = split.assign_sets(spark.range(20000).repartition(3).withColumnRenamed("id", "uniqueID"), opts)
    assert rows.exceptAll(again).count() == 0
    shares = quality.split_shares(rows)
    wanted = dict(zip(SET_NAMES, (0.6, 0.3, 0.1)))
    assert quality.share_violations(shares, wanted).count() == 0
    assert quality.share_violations(shares, dict(zip(SET_NAMES, (0.1, 0.3, 0.6)))).count() == 2
    other = split.assign_sets(spark.range(20000).withColumnRenamed("id", "uniqueID"), Options(seed=1))
    assert rows.exceptAll(other).count() > 0


def test_repeated_tag_rows_multiply_nothing(spark):
    text = spark.createDataFrame([(1, "t"), (2, "t")], "uniqueID long, title string")
    tag_rows = spark.createDataFrame([(1, "a", "d"), (1, "b", "d"), (3, "c", "d")], TAGS)
    assert [r["uniqueID"] for r in split.with_tag_row(text, tag_rows).collect()] == [1]
    assert quality.lost_ids(split.with_tag_row(text, tag_rows), text).first()["lost"] == 1


def test_shards_have_about_the_wanted_size(spark):
    rows = spark.range(5000).select(
        F.col("id").alias("uniqueID"), F.when(F.col("id") % 3 == 0, "small").otherwise("hot").alias("domain"), F.lit("Training").alias("set")
    )
    counts = samples.shard_counts(rows)
    sizes = samples.shard_by_hash(rows, counts, 100).groupBy("domain", "rng").count().collect()
    assert sum(r["count"] for r in sizes) == 5000
    assert len([r for r in sizes if r["domain"] == "hot"]) == 34
    assert all(50 < r["count"] < 160 for r in sizes)
    exact = samples.shard_exactly(rows, 100).groupBy("domain", "rng").count().collect()
    assert sorted(r["count"] for r in exact if r["domain"] == "hot") == [33] + [100] * 33


@pytest.mark.parametrize(
    "wrong",
    [
        {"output_format": "orc"},
        {"training_share": 0.9},
        {"fit_on": "test"},
        {"fraction_of_tags": 0},
        {"hash_method": "md5"},
        {"vocab_size": 0},
        {"min_support": 2.0},
    ],
)
def test_wrong_options_are_refused(wrong):
    with pytest.raises(ValueError):
        Options(**wrong)


@pytest.mark.parametrize("hot", ["absent", "y" * 300])
def test_hot_keys_of_the_facts_spread(spark, monkeypatch, hot):
    """A hot key that the dimension lacks, or that is very long, does not meet in one partition."""
    monkeypatch.setattr(lookup_module, "HEAVY_KEYS", 50)
    facts = spark.range(6000).selectExpr("id", f"CASE WHEN id % 3 < 2 THEN '{hot}' ELSE concat('k', id % 900) END AS key")
    names = [(f"k{i}", i) for i in range(900)] + ([(hot, 1000)] if hot != "absent" else [])
    dim = tables.materialize(spark.createDataFrame(names, "key string, rank int"), "dim")
    old = spark.conf.get("spark.sql.adaptive.enabled"), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = lookup(facts, dim, ["key"], heavy_by_rank("rank"), "id")
        sizes = [len(p) for p in found.rdd.glom().collect()]
        rows = {(r["id"], r["rank"]) for r in found.collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old[0])
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old[1])
    assert max(sizes) < 2 * 6000 / len(sizes)
    assert rows == {(r["id"], dict(names).get(r["key"])) for r in facts.collect()}


def test_only_tags_of_posts_with_a_text_are_encoded(spark):
    rows = spark.createDataFrame([(1, "a,b", "d"), (2, "c", "d"), (1, "c", "d"), (None, "a", "d")], "uniqueID long, tags string, domain string")
    text = spark.createDataFrame([(1,), (1,), (3,), (None,)], "uniqueID long")
    found = tags.tags_of(rows, text)
    assert found.columns == rows.columns
    assert sorted(tuple(r) for r in found.collect()) == [(1, "a,b", "d"), (1, "c", "d")]


def test_the_tag_adapter_writes_no_lines(spark, monkeypatch):
    def refuse(*_):
        raise AssertionError("a table was written")

    for module in (tables, lookup_module):
        monkeypatch.setattr(module, "materialize", refuse)
    monkeypatch.setattr(adapters, "HEAVY_KEYS", 5, raising=False)
    found = adapters.post_tags(spark, "/root/testdata/sf0.001").collect()
    assert found and all(r.tags and r.domain for r in found)
