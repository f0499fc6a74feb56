"""Exact and near duplicates, repeated passages."""

import re

import duckdb
import pyarrow as pa
import pytest
from helpers import FOLDER, awkward_rows, near_groups, ordered, prose, sha, stored, table, without_repeats

from tagweave.llm import chunks, graph, repeats, sketches
from tagweave.llm.registry import ORACLES


def bare(text):
    return re.sub(r"[\x20\x09-\x0D]+", "", text or "")


def expected_dedup(rows):
    out = []
    for doc_id, text, *_ in rows:
        same = [r for r in rows if bare(r[1]) == bare(text)]
        keep = min(same, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))[0]
        out.append((doc_id, keep, len(same), sha(bare(text))))
    return ordered(out)


@pytest.mark.parametrize("digest", [chunks.sha, lambda data: data[:1]])
def test_recipes_agree_with_the_texts(spark, digest):
    """Also with a digest that collides all the time: the bytes decide."""
    rows = awkward_rows()
    found = chunks.deduplicate(table(spark, rows), digest=digest).collect()
    assert ordered((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found) == expected_dedup(rows)
    assert sum(r.kept for r in found) == len({bare(t) for _, t, _ in rows})


def test_chunk_ends_follow_the_content():
    data = prose(9, 20_000).encode()
    ends = chunks.chunk_ends(data)
    assert ends[-1] == len(data) and all(0 < b - a <= chunks.LARGEST for a, b in zip(ends, ends[1:], strict=False))
    moved = chunks.chunk_ends(b"some new beginning " * 200 + data)
    shift = 19 * 200
    assert len({e + shift for e in ends} & set(moved)) > len(ends) // 2
    assert chunks.chunk_ends(b"") == [0] and chunks.chunk_ends(b"a" * 200_000)[-1] == 200_000


def test_near_duplicates_agree_with_all_pairs(spark):
    rows = awkward_rows()
    assert ordered(sketches.near_duplicates(table(spark, rows)).collect()) == ordered(near_groups(rows))


def family(n, edits, base=7, size=150):
    """``n`` near copies of one text, each with a few words of its own."""
    words = prose(base, size).split(" ")
    out = []
    for i in range(n):
        own = list(words)
        for k in range(edits):
            own[(i * 31 + k * 17) % len(own)] = f"own{i}x{k}"
        out.append(" ".join(own))
    return out


def test_near_groups_of_many_sizes_and_shared_passages(spark, monkeypatch):
    """Large groups, groups close to the limit and a passage in dissimilar texts; pieces smaller than a block."""
    monkeypatch.setattr(sketches, "GROUP_PIECE", 7)
    passage = prose(70, 60)
    texts = family(40, 2) + family(25, 4, 8) + [f"{prose(100 + i, 40)} {passage}" for i in range(40)]
    texts += [" ".join(prose(200, 200).split(" ")[: 200 - 7 * i]) for i in range(12)]
    texts += [" ".join(f"w{i}" for i in range(n)) for n in range(1, 14)]
    rows = [(i, t, None) for i, t in enumerate(texts)]
    assert ordered(sketches.near_duplicates(table(spark, rows)).collect()) == ordered(near_groups(rows))


def test_copies_that_differ_too_much_make_few_pairs(spark, monkeypatch):
    """Texts of similarity 0.66 that share most blocks: screened out, not verified pair by pair."""
    written, materialize = [], sketches.materialize

    def counting(df, label):
        out = materialize(df, label)
        written.append((label, out.count()))
        return out

    monkeypatch.setattr(sketches, "materialize", counting)
    rows = [(i, t, None) for i, t in enumerate(family(80, 3))]
    assert ordered(sketches.near_duplicates(table(spark, rows)).collect()) == ordered(near_groups(rows))
    assert sum(n for label, n in written if label == "sketch-pairs") < 1_000


def test_every_similar_pair_shares_a_signature():
    import numpy as np

    rng = np.random.default_rng(5)
    for n in [*range(1, 40), 100, 333, 1000]:
        for _ in range(20):
            a = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
            most = (100 - 75) * len(a) // 100
            gone = int(rng.integers(0, most + 1))
            keep = a[gone:]
            room = len(keep) * 100 // 75 - len(a)
            b = np.unique(np.concatenate([keep, rng.integers(0, 1 << 62, int(rng.integers(0, max(room, 0) + 1))).astype(np.uint64)]))
            both = len(np.intersect1d(a, b))
            if 100 * both >= 75 * (len(a) + len(b) - both):
                assert np.intersect1d(sketches.signatures(a), sketches.signatures(b)).size


def test_sketches_bound_the_difference():
    import numpy as np

    a, b = sketches.shingles(prose(1, 300)), sketches.shingles(prose(1, 260) + " " + prose(2, 50))
    differing = len(np.setxor1d(a, b))
    for bits in (64, 256, 1024):
        x, y = sketches.sketch(a, bits), sketches.sketch(b, bits)
        assert int(np.bitwise_count(x ^ y).sum()) <= differing
        assert (sketches.fold(sketches.sketch(a, 2 * bits), bits) == x).all()


def test_components_of_paths_stars_and_rings(spark):
    links = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(1, 40)] + [(200, 201), (201, 202), (202, 200), (300, 300)]
    found = {r.node: r.component for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**dict.fromkeys(range(51), 0), **dict.fromkeys(range(100, 140), 100), 200: 200, 201: 200, 202: 200}
    assert graph.components(spark.createDataFrame([], "a long, b long")).collect() == []


@pytest.mark.parametrize("largest", [20_000, 1])
def test_repeats_agree_with_counting_all_strings(spark, largest):
    long = prose(30, 500)
    rows = awkward_rows() + [
        (20, "x" * 1_000, None),
        (21, "ab" * 600 + prose(31, 60), None),
        (22, prose(32, 50) + long[100:900] + prose(33, 40), None),
        (23, long[500:2_000] + prose(34, 40), None),
        (24, "é" * 150 + long[:399], None),
        (25, prose(35, 30) + long[:400] + "é", None),
        (26, long[300:720] + long[310:760], None),
        (27, prose(36, 40)[:399], None),
        (28, prose(36, 40)[:399], None),
    ]
    found = repeats.remove_repeats(table(spark, rows), largest_group=largest)
    assert ordered(found.drop("kept").collect()) == ordered(without_repeats(rows))


def test_a_frequent_passage_is_not_spelled_out(spark, monkeypatch):
    """Its surroundings differ in every text: few rows each, not one for every string of 400 bytes."""
    written, materialize = [], repeats.materialize

    def counting(df, label):
        out = materialize(df, label)
        written.append((label, out.count()))
        return out

    monkeypatch.setattr(repeats, "materialize", counting)
    passage = prose(50, 200)[:700]
    rows = [(i, f"{prose(100 + i, 60)} {passage} {prose(300 + i, 60)}" + " x" * (i % 3), None) for i in range(60)]
    found = repeats.remove_repeats(table(spark, rows).repartition(4), largest_group=5)
    assert ordered(found.drop("kept").collect()) == ordered(without_repeats(rows))
    tuples = [n for label, n in written if label == "repeat-tuples"]
    assert len(tuples) > 1 and sum(tuples) < 100 * len(rows)


def test_repeats_in_the_test_documents(spark):
    rows = stored(spark)
    found = repeats.op8_induced_suffixes(spark, FOLDER).collect()
    assert ordered(found) == ordered(without_repeats(rows))


def test_long_texts_are_read_in_blocks():
    from tagweave.llm.rolling import BLOCK

    data = (prose(40, 150_000) * 2).encode()[: BLOCK * 2]
    place, _ = repeats.anchors(data)
    assert len(data) > BLOCK and (abs(place[1:] - place[:-1]) <= repeats.BEFORE + 1).all()
    assert place[0] <= repeats.BEFORE and place[-1] >= len(data) - repeats.WIDTH


@pytest.mark.parametrize("make", [chunks.deduplicate, sketches.near_duplicates, repeats.remove_repeats])
def test_empty_tables(spark, make):
    assert make(table(spark, [])).collect() == []


@pytest.mark.parametrize("name", ["op4_parity_sketches", "op6_chunk_recipes"])
def test_sql(spark, name):
    from tagweave.llm.registry import QUERIES

    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    want = duck.execute(ORACLES[name])
    columns = [c[0] for c in want.description]
    assert ordered(QUERIES[name](spark, FOLDER).select(columns).collect()) == ordered(want.fetchall())


def test_signatures_are_filed_within_their_bound(monkeypatch):
    monkeypatch.setattr(sketches, "ENTRIES_AT_ONCE", 500)
    texts = [" ".join(f"w{i}x{j}" for j in range(60)) for i in range(100)]
    batch = pa.RecordBatch.from_pydict({"text": texts})
    found = list(sketches._some_sets(iter([batch])))
    most = max(len(s) for part in found for s in part.values())
    assert max(sum(map(len, part.values())) for part in found) < 500 + most
    assert [c for part in found for c in part] == [sketches.class_of(sketches.shingles(t)) for t in texts]
