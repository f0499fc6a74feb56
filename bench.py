"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from tagweave.options import Options
from tagweave.plans.prepare import prepare as prepare_posts
from tagweave.plans.queries import QUERIES
from tagweave.sources import adapters, posts
from tagweave.sources.tables import clear

HEADLINE = (
    "prepare",
    "prepare_full",
    "tokens_normalized",
    "tokens_stemmed",
    "ngrams_merged",
    "token_occurrences",
    "split_text",
    "tag_rank_domain",
    "tag_rank_global",
    "tag_encode",
    "label_decode",
    "token_dictionary",
    "decode_missing",
    "vocabulary_ngrams",
    "bag_combined",
    "bag_vectors",
    "tfidf",
    "assembled_samples",
    "partitioned_scan",
    "shards_exact",
    "run_report",
    "itemsets",
    "rules",
    "predict",
    "predict_joined",
    "scores",
    "transactions",
    "lookups_csv",
    "appearances",
)

# The settings of the original job's configuration file.
FULL_JOB = Options(ngrams=2, vocab_size=1_000_000, normalize=True, lower_case=True)


def prepare_full(spark, folder):
    text = posts.clean_text(adapters.post_text(spark, folder))
    return prepare_posts(text, posts.clean_tags(adapters.post_tags(spark, folder)), FULL_JOB).samples


# Run once before the clock starts, so that class loading is not charged to the first query.
WARM_UP = ("tokens", "tag_rank_domain", "bag_vectors")


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", os.environ.get("BENCH_TABLES", "/tmp/tagweave-bench"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    for name in WARM_UP:
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        (prepare_full if name == "prepare_full" else QUERIES[name])(spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    clear(spark)
    spark.stop()


if __name__ == "__main__":
    main()
