"""Ranked lexical search against scores computed term by term."""

import math
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from helpers import FOLDER, awkward_rows, lower, ordered, prose, table

from tagweave.llm import lexical


def terms(text):
    return re.findall(lexical.TERM, lower(text))


def plain_ranks(items, docs, k=10):
    held = [(doc_id, Counter(terms(text))) for doc_id, text, *_ in docs]
    held = [(doc_id, c) for doc_id, c in held if c]
    n_docs, n_terms = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item_id, text, *_ in items:
        scored = []
        for doc_id, c in held:
            m = 10 + 90 * sum(c.values()) * n_docs // n_terms
            score = 0
            for t in set(terms(text)) & set(c):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id))
        best = sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k]
        out += [(item_id, i + 1, doc_id, -score) for i, (score, _, doc_id) in enumerate(best)]
    return out


def queries():
    return [
        (1, prose(1, 9), None),
        (1, prose(1, 9), "x"),
        (2, None, None),
        (3, "", None),
        (None, prose(3, 40), None),
        (4, prose(4, 200) + " " + prose(4, 200), None),
        (5, "zzz not-there É é 日本", None),
        (6, "One TWO, three!", None),
    ]


@pytest.mark.parametrize(("block_bytes", "piece_entries"), [(8_000_000, 2_000_000), (200, 7)])
def test_ranks_of_awkward_rows(spark, block_bytes, piece_entries):
    items = table(spark, queries()).withColumnRenamed("doc_id", "item_id")
    docs = [*awkward_rows(), *[(100 + i % 7, prose(i, 12), "s") for i in range(60)]]
    found = lexical.rank_documents(items, table(spark, docs), block_bytes=block_bytes, piece_entries=piece_entries)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert ordered(found.collect()) == ordered(plain_ranks(queries(), docs))


def test_empty_tables_rank_nothing(spark):
    items = table(spark, queries()).withColumnRenamed("doc_id", "item_id")
    none = items.limit(0)
    assert lexical.rank_documents(none, table(spark, awkward_rows())).collect() == []
    assert lexical.rank_documents(items, table(spark, awkward_rows()).limit(0)).collect() == []
    assert lexical.rank_documents(items, table(spark, [(1, None, None), (2, " .", None)])).collect() == []


def test_long_texts_and_ties(spark):
    long = prose(8, 400_000)
    docs = [(i, "alpha beta", "s") for i in range(40)] + [(50, long, "s"), (51, "alpha " * 300_000, "s")]
    items = [(1, "alpha beta", "s"), (2, long, "s")]
    found = lexical.rank_documents(table(spark, items).withColumnRenamed("doc_id", "item_id"), table(spark, docs))
    assert ordered(found.collect()) == ordered(plain_ranks(items, docs))


def test_the_search_stops_early_and_direct_accesses_push_it(spark):
    """Two lists in opposite order but for their tops: few of many documents are scored."""
    n = 20_000
    draw = np.random.default_rng(3)
    first, second = draw.integers(1, 1000, n), draw.integers(1, 1000, n)
    first[:12], second[:12] = 5000 + np.arange(12), 5000 + np.arange(12)[::-1]
    owner, term = np.repeat(np.arange(n), 2), np.tile([0, 1], n)
    lists = lexical.ImpactLists(owner, term, np.stack([first, second], 1).ravel(), n, 3)
    ids = np.arange(n)[::-1].copy()
    for asked in ([0, 1], [0], [1, 2], [2]):
        best = lexical.Best(10)
        scored = lists.search(np.array(asked), best, ids)
        total = sum((x for t, x in ((0, first), (1, second)) if t in asked), np.zeros(n, np.int64))
        order = np.lexsort((ids, -total))[: 10 if set(asked) & {0, 1} else 0]
        assert (best.id.tolist(), best.score.tolist()) == (ids[order].tolist(), total[order].tolist())
        assert scored < n / 50


def test_equal_last_scores_are_not_cut_off():
    """A document that ties with the last one kept still comes in by its smaller id."""
    n = 5_000
    lists = lexical.ImpactLists(np.arange(n), np.zeros(n, np.int64), np.full(n, 7), n, 1)
    best = lexical.Best(10)
    lists.search(np.array([0]), best, np.arange(n)[::-1].copy())
    assert best.id.tolist() == list(range(10))


def test_the_query_equals_its_sql(spark):
    duck = duckdb.connect()
    for name in ("documents", "benchmark"):
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    assert ordered(lexical.op13_best_positions(spark, FOLDER).collect()) == ordered(duck.execute(lexical.OP13_SQL).fetchall())
