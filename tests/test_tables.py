"""Top values by histogram, counts in passing, layout reports and committed tables."""

import random

import pytest
from pyspark.sql import functions as F

from tagweave.operators import features, ordering, quality, samples, topk
from tagweave.options import Options
from tagweave.plans import queries as q
from tagweave.sources import manifest, posts, sinks, tables


@pytest.mark.parametrize("seed", range(4))
def test_the_least_of_the_top_is_exact(spark, seed):
    draw = random.Random(seed)
    values = [draw.choice([1, 2, 3, draw.randrange(1, 50), draw.randrange(1, 10**6), (1 << 62) + draw.randrange(5)]) for _ in range(300)]
    rows = tables.materialize(spark.createDataFrame([(v,) for v in [*values, None]], "v long"), "values")
    for k in (1, 2, 7, 150, 299, 300):
        least = sorted(values, reverse=True)[k - 1]
        assert topk.least_of_top(rows, "v", k) == least
        assert topk.top_rows(rows, "v", k).count() == sum(v >= least for v in values)
    assert topk.least_of_top(rows, "v", 301) is None
    assert topk.least_of_top(rows.limit(0), "v", 1) is None


def test_only_terms_of_the_vocabulary_are_sorted(spark, monkeypatch):
    """No more than the vocabulary and the terms that tie with its last one are written."""
    rows = [(f"w{i}", 1 + 1000 // (i + 1), 20) for i in range(3_000)]
    statistics = tables.materialize(spark.createDataFrame(rows, "term string, tf long, df long"), "statistics")
    sorted_rows = []

    def keep(df, label, write=ordering.materialize):
        written = write(df, label)
        sorted_rows.append(written.count())
        return written

    monkeypatch.setattr(ordering, "materialize", keep)
    found = features.top_terms(statistics, Options(vocab_size=40)).collect()
    expected = sorted(rows, key=lambda r: (-r[1], r[0]))[:40]
    assert [(r["words"], r["tf"]) for r in sorted(found, key=lambda r: r["rank"])] == [r[:2] for r in expected]
    assert sorted_rows == [sum(r[1] >= expected[-1][1] for r in rows)] and sorted_rows[0] < 60


def test_rows_are_counted_as_they_are_written(spark):
    rows = spark.range(1_000, numPartitions=7)
    written, seen = tables.materialize_observed(rows, "rows", n=F.count(F.lit(1)), even=F.count_if(F.col("id") % 2 == 0), most=F.max("id"))
    assert (seen["n"], seen["even"], seen["most"]) == (1_000, 500, 999) and written.count() == 1_000
    _, none = tables.materialize_observed(rows.limit(0), "rows", n=F.count(F.lit(1)))
    assert none["n"] == 0


def test_the_run_report_counts_nothing_again(spark):
    prepared = q._prepared(spark, "/root/testdata/sf0.001", with_bags=False)
    plan = prepared.report()._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1 and plan.count("Aggregate") == 1
    found = {r["metric"]: r["value"] for r in prepared.report().collect() if not r["key"]}
    assert found["dictionary_tokens"] == prepared.lookups["dictionary"].count()
    assert found["bag_vocabulary"] == prepared.lookups["vocabulary"].count()
    assert found["samples"] == prepared.samples.count()


def test_a_skewed_layout_is_reported(spark, tmp_path):
    """Most rows in one of eight partitions, and in one of a table's folders."""
    even = spark.range(4_000).repartition(8)
    skewed = spark.range(4_000).repartition(8, F.when(F.col("id") % 10 > 0, 0).otherwise(F.col("id")))
    assert quality.skewed_parts(quality.partition_sizes(even)).count() == 0
    assert quality.skewed_parts(quality.partition_sizes(skewed)).count() == 1
    rows = spark.range(1_000).selectExpr("id AS uniqueID", "if(id < 900, 'hot', concat('d', id % 9)) AS domain", "'Test' AS set", "0L AS rng")
    sinks.write_samples(rows, str(tmp_path), Options(max_records_per_file=400))
    report = quality.layout_report(spark.read.parquet(f"{tmp_path}/dataset"), ["domain"])
    assert [(r["domain"], r["files"], r["rows"], r["largest"]) for r in quality.skewed_parts(report).collect()] == [("hot", 3, 900, 400)]


def committed(spark, n=100, shift=0):
    return spark.range(n).selectExpr(f"id + {shift} AS uniqueID", "concat('d', id % 3) AS domain", "'Test' AS set", "0L AS rng")


def test_versions_are_committed_one_after_the_other(spark, tmp_path):
    output = str(tmp_path)
    assert manifest.last_version(spark, f"{output}/dataset") == 0
    with pytest.raises(ValueError):
        manifest.manifest(spark, f"{output}/dataset")
    assert sinks.commit_samples(committed(spark), output, Options(max_records_per_file=20)) == 1
    files = manifest.manifest(spark, f"{output}/dataset").collect()
    assert sum(r["rows"] for r in files) == 100 and max(r["rows"] for r in files) <= 20 and len(files) >= 5
    assert {r["partition"]["domain"] for r in files} == {"d0", "d1", "d2"}
    assert all(int(r["least"]) <= int(r["most"]) for r in files)
    assert sinks.commit_samples(committed(spark, 30, 1_000), output, Options()) == 2
    assert posts.read_samples(spark, output).agg(F.min("uniqueID")).first()[0] == 1_000
    assert manifest.read_committed(spark, f"{output}/dataset", 1).count() == 100
    assert posts.read_samples(spark, output, "d1", "Test").count() == 10


def test_an_overwrite_that_dies_leaves_the_old_table(spark, tmp_path):
    output = str(tmp_path)
    sinks.commit_samples(committed(spark), output, Options())
    broken = committed(spark, 500).withColumn("domain", F.when(F.col("uniqueID") == 400, F.raise_error(F.lit("dies"))).otherwise(F.col("domain")).cast("string"))
    with pytest.raises(Exception, match="dies"):
        sinks.commit_samples(broken, output, Options())
    assert posts.read_samples(spark, output).count() == 100
    # A manifest that was begun and never marked is not read, and is replaced.
    committed(spark, 5).write.json(f"{output}/dataset/_commits/00000002")
    (tmp_path / "dataset/_commits/00000002/_SUCCESS").unlink()
    assert manifest.last_version(spark, f"{output}/dataset") == 1
    assert sinks.commit_samples(committed(spark, 7), output, Options()) == 2
    assert posts.read_samples(spark, output).count() == 7


def test_a_large_shard_has_several_writers(spark, tmp_path, monkeypatch):
    """The one shard of 900 rows is dealt to several tasks, the small ones stay whole; no row is lost or moved."""
    monkeypatch.setattr(sinks, "ROWS_PER_WRITER", 90)
    rows = spark.range(1_000).selectExpr("id AS uniqueID", "if(id < 900, 'hot', concat('d', id % 9)) AS domain", "'Test' AS set", "0L AS rng")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small tasks stay apart, as large ones do
    try:
        sinks.write_samples(rows, str(tmp_path), Options(), counts=samples.shard_counts(rows))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    read = spark.read.parquet(f"{tmp_path}/dataset")
    report = {r["domain"]: (r["files"], r["rows"]) for r in quality.layout_report(read, ["domain"]).collect()}
    assert 3 <= report["hot"][0] <= 8 and report["hot"][1] == 900 and all(files == 1 for d, (files, _) in report.items() if d != "hot")
    assert sorted(map(tuple, read.select("uniqueID", "domain").collect())) == sorted(map(tuple, rows.select("uniqueID", "domain").collect()))
    assert read.columns == ["uniqueID", "domain", "set", "rng"]
