"""Near-duplicate vectors against all cosines."""

import duckdb
import numpy as np
import pytest
from helpers import CLASHING, FOLDER, ordered
from pyspark.sql import functions as F

from tagweave.llm import vectors

SCHEMA = "vec_id long, embedding array<double>, label int"


def cloud(seed, centres, per_centre, width, spread, loose=300):
    """Groups around centres, and loose vectors."""
    draw = np.random.default_rng(seed)
    out = [draw.normal(size=width) for _ in range(loose)]
    for _ in range(centres):
        centre = draw.normal(size=width)
        out += [centre + spread * draw.normal(size=width) for _ in range(per_centre)]
    return [x.tolist() for x in out]


def plain_links(rows, threshold=0.9):
    valid = [vectors.unit(v) for _, v, *_ in rows]
    links = [set() for _ in rows]
    for width in {len(x) for x in valid if x is not None}:
        at = [i for i, x in enumerate(valid) if x is not None and len(x) == width]
        x = np.array([valid[i] for i in at])
        for i, j in zip(*np.nonzero(x @ x.T >= threshold), strict=True):
            if i != j:
                links[at[i]].add(at[j])
    label = list(range(len(rows)))
    for i in range(len(rows)):
        todo = [i] if label[i] == i else []
        while todo:
            k = todo.pop()
            for j in links[k]:
                if label[j] != i:
                    label[j] = i
                    todo.append(j)
    least = {}
    for (vec_id, *_), k in zip(rows, label, strict=True):
        least[k] = min((x for x in (vec_id, least.get(k)) if x is not None), default=None)
    return [(vec_id, len(links[i]), least[label[i]], vec_id == least[label[i]]) for i, (vec_id, *_) in enumerate(rows)]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).withColumns({c: F.lit(c) for c in CLASHING})


def awkward_vectors():
    some = cloud(1, 6, 12, 24, 0.1, 40)
    far, inf, nan = [1e200] * 24, float("inf"), float("nan")
    odd = [None, [], [0.0] * 24, [None, *far[1:]], [nan, *far[1:]], [inf, *far[1:]], [1.0], [2.0], [-3.0], [1.0, 2.0], [2.0, 4.0], far, [-x for x in far], [1e-200] * 24]
    rows = [(i, x, 0) for i, x in enumerate([*some, *odd])]
    rows += [(500 + i, some[-1], 1) for i in range(40)]  # copies
    rows += [(600, [3 * x for x in some[-1]], 1), (None, some[-1], 1), (None, some[0], 1), (None, None, 1), (7, some[7], 1), (7, some[-2], 1)]
    return rows


@pytest.mark.parametrize("piece", [2_000, 9])
def test_links_of_awkward_rows(spark, piece):
    """Also with buckets cut into pieces; a pair counts once, however many buckets it shares."""
    rows = awkward_vectors()
    found = vectors.link_vectors(frame(spark, rows), piece=piece)
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert ordered(found.collect()) == ordered(plain_links(rows))


def test_empty_and_unusable_tables(spark):
    assert vectors.link_vectors(frame(spark, awkward_vectors()).limit(0)).collect() == []
    found = vectors.link_vectors(frame(spark, [(2, None, 0), (1, [0.0], 0)]))
    assert ordered(found.collect()) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_a_large_group_is_linked_once_and_whole(spark):
    rows = [(i, x, 0) for i, x in enumerate(cloud(3, 1, 1_500, 64, 0.15, 200))]
    found = ordered(vectors.link_vectors(frame(spark, rows), piece=400).collect())
    assert found == ordered(plain_links(rows))


def test_recall_at_the_threshold():
    """Pairs of cosine 0.9 exactly, the hardest that count; and few of other vectors meet."""
    draw = np.random.default_rng(2)
    for width in (16, 64, 100):
        x, z = draw.normal(size=(2, 3_000, width))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        z -= (z * x).sum(1, keepdims=True) * x
        y = 0.9 * x + np.sqrt(0.19) * z / np.linalg.norm(z, axis=1, keepdims=True)
        a, b = vectors.bucket_keys(x), vectors.bucket_keys(y)
        shared = lambda a, b: np.array([len(np.intersect1d(p, q)) > 0 for p, q in zip(a, b, strict=True)])
        assert shared(a, b).mean() > 0.98
        assert a.shape == (3_000, vectors.TABLES * (1 + vectors.PROBES)) and len(np.unique(a[0])) == a.shape[1]
    assert shared(a, np.roll(b, 1, 0)).mean() < 0.01


def test_recall_of_the_operator(spark):
    """Links from 0.9 upwards, against all cosines."""
    draw = np.random.default_rng(6)
    rows = []
    for i in range(1_500):
        x, z = draw.normal(size=(2, 64))
        z -= (z @ x) / (x @ x) * x
        c = draw.uniform(0.88, 0.99)
        y = c * x / np.linalg.norm(x) + np.sqrt(1 - c * c) * z / np.linalg.norm(z)
        rows += [(2 * i, x.tolist(), 0), (2 * i + 1, y.tolist(), 0)]
    want, found = plain_links(rows), vectors.link_vectors(frame(spark, rows)).collect()
    n, right = (sum(r[1] for r in x) for x in (found, want))
    assert 0.98 * right <= n <= right and right > 2_000


def test_hadamard_is_its_own_inverse():
    x = np.random.default_rng(1).normal(size=(5, 32))
    assert np.allclose(vectors.hadamard(vectors.hadamard(x)) / 32, x)


def test_the_query_equals_its_sql(spark):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{FOLDER}/embeddings.parquet'")
    assert ordered(vectors.op11_cross_polytope(spark, FOLDER).collect()) == ordered(duck.execute(vectors.OP11_SQL).fetchall())


def test_the_sql_finds_links():
    duck = duckdb.connect()
    rows = [r for r in awkward_vectors() if r[0] not in (99,)]
    duck.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding DOUBLE[], label INT)")
    duck.executemany("INSERT INTO embeddings VALUES (?, ?, ?)", [r for r in rows if r[1] is None or all(x is None or abs(x) < 1e100 for x in r[1])])
    kept = duck.execute("SELECT vec_id, embedding FROM embeddings").fetchall()
    assert ordered(duck.execute(vectors.OP11_SQL).fetchall()) == ordered(plain_links(kept))
