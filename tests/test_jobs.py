import json
import os

import pytest
from pyspark.sql import functions as F

from tagweave.operators import dictionary, quality, samples, split
from tagweave.options import SET_NAMES, Options
from tagweave.plans import mine, prepare
from tagweave.sources import posts, sinks, tables

WORDS = "star planet orbit comet dark light sky moon sun ring".split()


@pytest.fixture(scope="module")
def source(tmp_path_factory):
    """CSV posts: CRLF ends, quoted separators, doubled quotes, quoted line breaks."""
    folder = tmp_path_factory.mktemp("source")
    text, tag_rows = [], []
    for i in range(240):
        words = [WORDS[(i * k) % 10] for k in range(1, 6)]
        title = f'Why {words[0]} | ""{words[1]}""' if i % 7 == 0 else f"Why {words[0]} {words[1]}"
        body = f"The {words[2]}\n{words[3]} $x$ {words[4]}" if i % 5 == 0 else f"The {words[2]} {words[3]} {words[4]}"
        domain = "hot.example" if i % 3 else "cold.example"
        if i != 200:
            text.append(f'{i}|"{title}"|"{body}"|{domain}')
        if i % 40 != 39:
            tags = "" if i % 40 == 38 else f"{words[0]}-tag,{words[2]}-tag"
            tag_rows.append(f"{i}|{tags}|{domain}")
    (folder / "postText0.csv").write_bytes("\r\n".join(text[:120]).encode())
    (folder / "postText1.csv").write_bytes("\r\n".join(text[120:]).encode())
    (folder / "postTags.csv").write_bytes("\r\n".join(tag_rows).encode())
    return str(folder)


OPTS = Options(vocab_size=20, min_df=5, token_usage_threshold=2, rows_per_shard=20, normalize=True, lower_case=True)


def test_csv_dialect(spark, source):
    text = {r["uniqueID"]: r for r in posts.read_post_text(spark, source).collect()}
    assert len(text) == 239
    assert text[7]["title"].startswith('Why comet | "') or '|' in text[7]["title"]
    assert '"' in text[7]["title"] and '""' not in text[7]["title"]
    assert "\n" in text[5]["body"] and "$" not in text[5]["body"]
    assert {r["domain"] for r in text.values()} == {"hot.example", "cold.example"}
    tag_rows = posts.read_post_tags(spark, source)
    assert tag_rows.count() == 234 and tag_rows.where("domain like '%\r%'").count() == 0
    assert {r[0] for r in posts.distinct_domains(tag_rows).collect()} == {"hot.example", "cold.example"}


def test_short_rows_become_empty_strings(spark, tmp_path):
    (tmp_path / "postText0.csv").write_text("1|title only\nx|bad id|b|d\n")
    rows = posts.read_post_text(spark, str(tmp_path)).collect()
    assert {(r["uniqueID"], r["title"], r["body"], r["domain"]) for r in rows} == {
        (1, "title only", "", ""),
        (None, "bad id", "b", "d"),
    }


def test_whole_job_and_its_outputs(spark, source, tmp_path):
    output = str(tmp_path)
    prepared = prepare.run(spark, source, output, OPTS)
    written = posts.read_samples(spark, output)
    text = posts.read_post_text(spark, source)
    tag_rows = posts.read_post_tags(spark, source)
    wanted = split.with_tag_row(text, tag_rows)
    assert written.count() == wanted.count() == 233
    assert quality.lost_ids(written, wanted).first()["lost"] == 0
    assert {"title", "body", "globalLabels", "domainSpecificLabels", "originalTagCount", "titleBodyBag", "domain", "set", "rng"} <= set(
        written.columns
    )
    untagged = written.where("uniqueID = 38").first()
    assert untagged["globalLabels"] == [] and untagged["originalTagCount"] == 0

    lookups = posts.read_lookups(spark, output)
    assert lookups["dictionary"].columns == ["hash", "token", "index"]
    assert lookups["global_tags"].columns == ["tag", "tagGlobalRank"]
    assert set(lookups["domain_tags"].columns) == {"domain", "tag", "tagInDomainCount", "tagRankInDomain"}
    assert lookups["vocabulary"].columns == ["words", "rank"]
    words = {r["token"] for r in lookups["dictionary"].collect()}
    assert words <= set(WORDS) and words

    lines = [json.loads(x) for f in os.listdir(f"{output}/metadata") if f.endswith(".json") for x in open(f"{output}/metadata/{f}")]
    report = {(r["metric"], r["key"]): r["value"] for r in lines}
    assert report[("samples", "")] == 233
    assert report[("dictionary_tokens", "")] == len(words)
    assert report[("tags_in_domain", "hot.example")] == lookups["domain_tags"].where("domain = 'hot.example'").count()

    # Decoding the hashes gives back the words of the dictionary.
    decoded = dictionary.decode_tokens(written, lookups["dictionary"], "body", "body", "NOTFOUND")
    assert decoded.count() == 233
    assert {w for r in decoded.collect() for w in r["body"]} <= set(WORDS) | {"NOTFOUND"}

    plan = posts.read_samples(spark, output, "hot.example", "Training")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(domain" in plan and "(set#" in plan
    assert prepared.samples.count() == 233

    model, scores = mine.mine_domain(spark, output, "hot.example", Options(support_count=10, min_confidence=0.6))
    assert {r["set"] for r in scores.collect()} <= set(SET_NAMES)
    mine.export_domain(spark, output, "hot.example")
    hot = posts.read_samples(spark, output, "hot.example", "Training")
    assert spark.read.text(f"{output}/training.transactions").count() == hot.count()
    roles = spark.read.option("header", True).csv(f"{output}/training.appearances")
    assert roles.columns == ["both"]
    assert {r["both"].split(" ")[1] for r in roles.collect()} == {"body", "head"}


def test_training_only_features_see_no_other_post(spark, source):
    text, tag_rows = posts.read_post_text(spark, source), posts.read_post_tags(spark, source)
    opts = Options(vocab_size=20, min_df=2, token_usage_threshold=0, fit_on="training", ngrams=2, combine=False)
    prepared = prepare.prepare(text, tag_rows, opts)
    rows = split.training_rows(prepared.samples)
    assert {"titleBag", "bodyBag"} <= set(prepared.samples.columns)
    tokens = rows.select(F.explode(F.concat("title", "body")).alias("hash")).distinct().count()
    assert prepared.lookups["dictionary"].count() == tokens
    assert prepared.lookups["dictionary"].where(F.col("token").contains(" ")).count() == 0
    assert prepared.lookups["vocabulary"].where(F.col("words").contains(" ")).count() > 0


def test_result_does_not_depend_on_partitions_or_input_order(spark, source):
    text, tag_rows = posts.read_post_text(spark, source), posts.read_post_tags(spark, source)
    columns = ["uniqueID", "title", "body", "globalLabels", "domainSpecificLabels", "set", "rng"]
    first = prepare.prepare(text, tag_rows, OPTS).samples.select(columns)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        again = prepare.prepare(text.repartition(5), tag_rows.repartition(2), OPTS).samples.select(columns)
        assert first.exceptAll(again).count() == 0 and again.exceptAll(first).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_csv_output(spark, source, tmp_path):
    output = str(tmp_path)
    opts = Options(output_format="csv", vocab_size=20, min_df=5, token_usage_threshold=2)
    prepare.run(spark, source, output, opts)
    written = spark.read.option("sep", "|").csv(f"{output}/dataset")
    assert written.count() == 233
    bags = written.where("_c6 RLIKE '^[0-9]+:[0-9.]+( [0-9]+:[0-9.]+)*$'")  # the bags stay, as text
    assert bags.count() > 200
    assert len(spark.read.option("sep", "|").csv(f"{output}/dictionary").columns) == 3
    assert len(spark.read.option("sep", "|").csv(f"{output}/global_tags").columns) == 2
    assert len(spark.read.csv(f"{output}/bagWordsDictionary").columns) == 2
    assert spark.read.option("sep", "|").csv(f"{output}/tags/domain_tags").count() > 0


def test_parquet_options_of_the_sample_sink(spark, tmp_path):
    rows = spark.createDataFrame([(1, [1], [2], "d", "Training", 0)], "uniqueID long, title array<long>, body array<long>, domain string, set string, rng long")
    sinks.write_samples(rows, str(tmp_path), Options(), summary_metadata=True)
    assert posts.read_samples(spark, str(tmp_path)).count() == 1
    assert os.path.exists(tmp_path / "dataset" / "_metadata")


def test_posts_without_tags_survive_assembly(spark):
    text = spark.createDataFrame(
        [(1, [], [], "d", "Test"), (2, [5], [6], "d", "Test")],
        "uniqueID long, title array<long>, body array<long>, domain string, set string",
    )
    encoded = spark.createDataFrame(
        [(2, [0], [1], 1, "x")], "uniqueID long, globalTags array<int>, domainTags array<int>, originalTagCount long, domain string"
    )
    rows = {r["uniqueID"]: r for r in samples.assemble_samples(text, encoded).collect()}
    assert rows[1]["globalLabels"] == [] and rows[1]["originalTagCount"] == 0
    assert rows[2]["domain"] == "d" and rows[2]["domainSpecificLabels"] == [1]
    bags = spark.createDataFrame([(2, 0.5)], "uniqueID long, titleBodyBag double")
    assert samples.attach_features(samples.assemble_samples(text, encoded), bags).count() == 2
    flat = {r["uniqueID"]: r for r in samples.flatten_samples(samples.assemble_samples(text, encoded)).collect()}
    assert (flat[2]["title"], flat[1]["globalLabels"]) == ("5", "")


def test_lookup_by_id_sample_and_partition_report(spark):
    rows = spark.range(10000).withColumnRenamed("id", "uniqueID")
    assert rows.where(F.col("uniqueID") == 7).count() == 1
    assert 40 < split.bernoulli_sample(rows, 0.01, seed=3).count() < 180
    assert quality.partition_sizes(rows.repartition(4)).count() == 4
    assert quality.row_and_id_counts(rows.union(rows.limit(5))).first()["ids"] == 10000


def test_a_file_has_no_more_rows_than_asked_for(spark, tmp_path):
    rows = spark.range(100).selectExpr("id AS uniqueID", "'d' AS domain", "'Test' AS set", "0L AS rng")
    sinks.write_samples(rows, str(tmp_path), Options(max_records_per_file=30))
    assert len(posts.read_samples(spark, str(tmp_path)).inputFiles()) == 4


def test_tables_are_deleted_on_request(spark):
    path = tables.new_path(spark, "gone")
    spark.range(3).write.parquet(path)
    tables.clear(spark, path)
    assert not os.path.exists(path)


def test_tables_go_to_the_named_folder(spark):
    df = tables.materialize(spark.range(3), "check")
    assert spark.conf.get("spark.checkpoint.dir") in df.inputFiles()[0]
