"""The mining jobs: rules of one domain with their scores, and the export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tagweave.operators import class_rules, mining
from tagweave.options import Options
from tagweave.sources import sinks
from tagweave.sources.posts import read_samples
from tagweave.sources.tables import materialize


def mine(samples: DataFrame, opts: Options) -> tuple[mining.Mined, DataFrame]:
    """Rules of the training posts, and precision, recall and F1 of every set."""
    baskets = materialize(mining.build_baskets(samples, opts), "baskets")
    mined = mining.fit_rules(baskets, opts)
    predicted = mining.predict(baskets, mined)
    return mined, mining.micro_scores(mining.confusion(predicted))


def mine_labels(samples: DataFrame, opts: Options) -> tuple[mining.Mined, DataFrame]:
    """Minimal rules from tokens to labels, which predict the same labels as all rules would, and their scores."""
    baskets = materialize(mining.build_baskets(samples, opts), "baskets")
    mined = class_rules.fit_label_rules(baskets, opts)
    return mined, mining.micro_scores(mining.confusion(mining.predict(baskets, mined)))


def mine_domain(spark: SparkSession, output: str, domain: str, opts: Options) -> tuple[mining.Mined, DataFrame]:
    return mine(read_samples(spark, output, domain), opts)


def export_domain(spark: SparkSession, output: str, domain: str) -> None:
    """Transaction and appearance files of one domain, next to its samples."""
    sinks.write_transactions(read_samples(spark, output, domain), output)
