"""Every query against its SQL counterpart, and the shape of the important plans."""

import math
import os
import re

import duckdb
import pytest


from tagweave.operators import dictionary, features, tags
from tagweave.plans import prepare
from tagweave.plans import queries as q
from tagweave.plans.oracles import ORACLES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def plain(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        if isinstance(v, float):
            return None if math.isnan(v) else round(v, 6)
        return v

    return sorted((tuple(cell(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(q.QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = q.QUERIES[name](spark, FOLDER)
    rows = df.collect()
    sql = ORACLES.get(name)
    if sql is None:
        assert rows
        return
    expected = duck.execute(sql)
    columns = [c[0] for c in expected.description]
    assert sorted(columns) == sorted(df.columns)
    assert plain(rows, df.columns) == plain(expected.fetchall(), columns)


def test_every_query_has_its_sql():
    assert set(q.QUERIES) == set(ORACLES)


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_exploding_tokens_does_not_tokenise_in_a_filter(spark):
    tokens = q._tokens(spark, FOLDER)
    frames = [
        dictionary.count_tokens(tokens),
        features.term_statistics(tokens),
        tags.explode_tags(q._tags(spark, FOLDER)),
    ]
    for df in frames:
        filters = [line for line in optimized(df).splitlines() if "Filter (" in line]
        assert not [line for line in filters if "regexp_extract_all" in line or "split(" in line]


def test_scans_read_the_needed_columns_only(spark):
    plan = q._tags(spark, FOLDER)._jdf.queryExecution().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_returnflag:string>" in plan
    assert "ReadSchema: struct<doc_id:bigint,lang:string>" in plan
    plan = q._text(spark, FOLDER).select("uniqueID", "domain")._jdf.queryExecution().toString()
    assert "ReadSchema: struct<doc_id:bigint,lang:string>" in plan


def test_no_python_in_the_default_text_path(spark):
    plan = q._tokens(spark, FOLDER)._jdf.queryExecution().toString()
    assert "ArrowEval" not in plan and "BatchEval" not in plan


def test_text_is_shuffled_once(spark, monkeypatch):
    """The one plan that tokenises has one join of the text; what follows reads its table."""
    written = {}

    def keep(write):
        def run(df, label, **metrics):
            written[label] = df._jdf.queryExecution().optimizedPlan().toString()
            return write(df, label, **metrics)

        return run

    for name in ("materialize", "materialize_observed"):
        monkeypatch.setattr(prepare, name, keep(getattr(prepare, name)))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        result = q._prepared(spark, FOLDER, with_bags=False).samples
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    joins = lambda plan: len(re.findall(r"Join (LeftOuter|Inner), \(+uniqueID", plan))
    assert joins(written["tagged-posts"]) == 1 and "regexp_extract_all" in written["tagged-posts"]
    after = [written["token-statistics"], result._jdf.queryExecution().optimizedPlan().toString()]
    assert not any(joins(plan) or "regexp_extract_all" in plan for plan in after)
    assert result.count() > 0
