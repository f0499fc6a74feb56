"""Token ids, their files, packing, mixing and the whole pipeline."""

import os
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest
from helpers import FOLDER, awkward_rows, near_groups, ordered, prose, stored, table, words
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from tagweave.llm import lines, mixing, packing, tokenfiles
from tagweave.llm.registry import QUERIES
from tagweave.llm.tokens import TOKENIZER, Encoder, encoder


def ids_of(text, end):
    return [*np.frombuffer(encoder(TOKENIZER).direct([text or ""])[0], "<u4").tolist(), end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("ab Z'sté.,!\n\t\r 09²\xa0日"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_cached_encoding_equals_the_tokenizer(text):
    e = encoder(TOKENIZER)
    assert e.encode(text) == e.direct([text])[0]


@pytest.mark.parametrize("text", ["", " ", "\n", "a\n\nb", "a  b", " lead", "tail ", "x 's 't ''s", "<|endoftext|> x", prose(1, 500), "a \n b", "\n a"])
def test_encoding_of_white_space_and_marks(text):
    e = encoder(TOKENIZER)
    assert e.encode(text) == e.direct([text])[0] and e.encode(text) == e.encode(text)


def test_a_word_is_learned_once_whatever_mark_follows():
    e = Encoder(TOKENIZER)
    text = "alpha beta, beta. beta\nbeta,beta ...beta é. é"
    assert e.encode(text) == e.direct([text])[0]
    assert set(e._recent) == {b"alpha", b" beta", b",", b".", b"\n", b"beta", b",beta", b" ...beta", " é".encode(), " é.".encode()}


@pytest.mark.parametrize("text", ["<|endoftext|>", "a b <|endoftext|> c", "a<|endoftext|>\nb", "日<|endoftext|>", prose(2, 50) + "<|endoftext|>"])
def test_an_added_token_in_a_text_is_its_id(text):
    from tokenizers import Tokenizer

    from tagweave.llm.tokens import tokenizer_path

    library = Tokenizer.from_file(tokenizer_path(TOKENIZER)).encode(text, add_special_tokens=False).ids
    assert library.count(50256) == 1
    assert np.frombuffer(encoder(TOKENIZER).encode(text), "<u4").tolist() == library


def expected_files(rows):
    out, start = [], 0
    for doc_id, text, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = ids_of(text, 2)
        out.append((doc_id, start, len(ids), crc(ids)))
        start += len(ids)
    return out


def test_token_files_hold_all_ids_in_order(spark, tmp_path):
    rows = stored(spark)
    path = str(tmp_path / "ids")
    tokenfiles.write_token_files(table(spark, rows), path)
    found = tokenfiles.token_checksums(tokenfiles.read_token_files(spark, path)).collect()
    assert ordered(found) == ordered(expected_files(rows))
    one = tokenfiles.find_documents(spark, path, [rows[5][0]])
    assert one.first()["ids"] == ids_of(rows[5][1], 2)
    assert "PushedFilters: [In(doc_id" in one._jdf.queryExecution().toString() or "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id" in one._jdf.queryExecution().toString()
    files = [f for f in os.listdir(path) if f.endswith(".orc")]
    import pyarrow.orc as orc

    assert sum(orc.ORCFile(f"{path}/{f}").nrows for f in files) == len(rows)


def test_token_files_of_awkward_rows(spark, tmp_path):
    rows = awkward_rows()
    tokenfiles.write_token_files(table(spark, rows), str(tmp_path / "ids"))
    found = tokenfiles.token_checksums(tokenfiles.read_token_files(spark, str(tmp_path / "ids"))).collect()
    assert sum(r.n_tokens for r in found) == sum(len(ids_of(t, 2)) for _, t, _ in rows)
    assert ordered((r.doc_id, r.n_tokens, r.ids_crc32) for r in found) == ordered((d, len(ids_of(t, 2)), crc(ids_of(t, 2))) for d, t, _ in rows)
    spans = sorted((r.start, r.n_tokens) for r in found)
    assert all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:], strict=False)) and spans[0][0] == 0
    tokenfiles.write_token_files(table(spark, []), str(tmp_path / "none"))
    assert tokenfiles.read_token_files(spark, str(tmp_path / "none")).collect() == []


def check_packing(rows, pieces, window=1024):
    """Every id once, sequences gapless; the share of padding."""
    wanted = sorted((repr(d), crc(ids_of(t, 0)), len(ids_of(t, 0))) for d, t, *_ in rows)
    ids = {}
    for d, t, *_ in rows:
        ids.setdefault(d, []).append(ids_of(t, 0))
    total = sum(n for *_, n in wanted)
    assert sum(p.length for p in pieces) == total
    by_sequence = {}
    for p in pieces:
        assert any(x[p.start : p.start + p.length] and crc(x[p.start : p.start + p.length]) == p.ids_crc32 and len(x) == p.doc_tokens for x in ids[p.doc_id])
        by_sequence.setdefault(p.sequence_id, []).append((p.offset, p.length))
    padding = 0
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert 0 < at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    starts = {}
    for p in pieces:
        starts.setdefault(p.doc_id, []).append((p.start, p.length))
    for d, copies in ids.items():
        if len(copies) == 1:
            at = 0
            for start, length in sorted(starts[d]):
                assert start == at
                at += length
            assert at == len(copies[0])
    return padding / max(1, window * len(by_sequence))


def test_packing_places_every_id_once(spark, monkeypatch):
    monkeypatch.setattr(packing, "MERGED_PARTS", 2)  # several levels of merging
    rows = awkward_rows()
    check_packing(rows, packing.pack(table(spark, rows)).collect())
    rows = [(r[0] + 1_000_000, *r[1:]) for r in stored(spark)]
    share = check_packing(rows, packing.pack(table(spark, rows).repartition(7)).collect())
    assert share < 0.03
    assert packing.pack(table(spark, [])).collect() == []


def test_the_open_windows_stay_bounded():
    packer = packing.Packer(window=64, most_open=4, smallest_cut=5)
    closed = []
    for i in range(500):
        closed += packer.add(packing.Piece(i, 0, 1, b"\0" * 4 * (1 + (i * 37) % 150)))
        assert len(packer.open) == len(packer.gaps) <= 4
    assert all(sum(map(len, w)) <= 64 for w in closed)
    assert sum(sum(map(len, w)) for w in closed) > 0.95 * 64 * len(closed)


def targets(sizes, weights=(5, 2, 1)):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    full, total = set(), sum(sizes.values())
    while True:
        free = total - sum(3 * sizes[s] for s in full)
        parts = sum(w[s] for s in names if s not in full) or 1
        out = {s: 3 * sizes[s] if s in full else free * w[s] / parts for s in names}
        over = {s for s in names if s not in full and out[s] > 3 * sizes[s]}
        if not over:
            return out
        full |= over


@pytest.mark.parametrize("which", ["awkward", "stored"])
def test_mixing_meets_its_targets(spark, which):
    rows = awkward_rows() if which == "awkward" else stored(spark)
    found = mixing.mix(table(spark, rows), shares=(0.25, 1.0)).collect()
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(words(text))
    want = targets(sizes)
    taken = {}
    for r in found:
        last = r.mixes[1]
        assert last.source_size == sizes[r.source] and last.target == pytest.approx(want[r.source])
        assert last.taken <= 3 * r.size and r.mixes[0].taken <= last.taken  # nested
        taken[r.source] = taken.get(r.source, 0) + last.taken
    assert ordered((r.doc_id, r.size) for r in found) == ordered((d, len(words(t))) for d, t, _ in rows)
    largest = max(len(words(t)) for _, t, _ in rows)
    assert all(abs(taken[s] - want[s]) <= largest for s in sizes)


def test_mixing_of_nothing(spark):
    assert mixing.mix(table(spark, [])).collect() == []
    blank = mixing.mix(table(spark, [(1, None, None), (2, " ", "a")])).collect()
    assert [r.mixes[0].taken for r in blank] == [0, 0]
    assert mixing.take(table(spark, [])).collect() == []


def test_mixing_of_more_words_than_an_int_holds(spark, monkeypatch):
    """Weight times words passes 2 ** 31 from 0.43 billion words on."""
    monkeypatch.setattr(mixing, "word_count", lambda text: F.lit(200_000_000).cast("long"))
    rows = [(i, "x", "abc"[i % 3]) for i in range(9)]
    found = mixing.mix(table(spark, rows)).collect()
    assert {r.source: r.mixes[0].target for r in found} == {"a": 1_125_000_000, "b": 450_000_000, "c": 225_000_000}
    assert {r.mixes[0].source_size for r in found} == {600_000_000}
    taken = {s: sum(r.mixes[0].taken for r in found if r.source == s) for s in "abc"}
    assert taken == {"a": 1_200_000_000, "b": 400_000_000, "c": 200_000_000}


def test_mixing_has_no_python(spark):
    plan = mixing.op1_mixing(spark, FOLDER)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_mixing_equals_its_sql(spark):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    want = duck.execute(mixing.OP1_SQL)
    columns = [c[0] for c in want.description]
    plain = lambda rows: ordered(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows)
    assert plain(QUERIES["op1_mixing"](spark, FOLDER).select(columns).collect()) == plain(want.fetchall())


def test_the_pipeline_equals_a_plain_version(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    chain = lines.fit(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    rows = [r for r in stored(spark) if lines.judge(r[1] or "", chain)["kept"]]
    best = {}
    for r in rows:
        key = "".join(words(r[1]))
        if key not in best or (-len(r[1]), r[0]) < (-len(best[key][1]), best[key][0]):
            best[key] = r
    rows = sorted(best.values())
    rows = [r for r, (_, _, least) in zip(rows, near_groups(rows), strict=True) if least == r[0]]
    duck = duckdb.connect()
    duck.register("documents", pd.DataFrame(rows, columns=["doc_id", "text", "source"]))
    taken = {r[0]: r[4] // r[1] for r in duck.execute(mixing.OP1_SQL).fetchall()}
    mixed = [r for r in rows for _ in range(taken[r[0]])]
    pieces = corpus_pipeline.run(spark, FOLDER).collect()
    check_packing(mixed, pieces)
    got = {}
    for p in pieces:
        got[p.doc_id] = got.get(p.doc_id, 0) + p.length
    want = {}
    for r in mixed:
        want[r[0]] = want.get(r[0], 0) + len(ids_of(r[1], 0))
    assert got == want


def test_the_mixing_stage_takes_more_words_than_an_int_holds(spark, monkeypatch):
    monkeypatch.setattr(mixing, "word_count", lambda text: F.lit(300_000_000).cast("long"))
    docs = table(spark, [(1, "x", "a"), (2, "y", "b"), (3, "z", "b")])
    found = corpus_pipeline.source_mix(spark, docs, FOLDER).collect()
    # 643 of 900 million words for a, which has 300, and 257 for b, whose document 2 has the lower hash.
    assert Counter(r.doc_id for r in found) == {1: 2, 2: 1}


def test_stages_return_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(40)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, FOLDER)
        assert out.columns == docs.columns, name
        assert stage(spark, docs.where("false"), FOLDER).count() == 0, name


def _exact(rows):
    """Of equal texts the longest, then the smallest id, one without id last."""
    groups = {}
    for r in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", r[1] or ""), []).append(r)
    return [min(g, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0)) for g in groups.values()]


def _near(rows):
    numbered = [(i, text) for i, (_, text, *_) in enumerate(rows)]
    groups = {}
    for (i, _), (_, _, least) in zip(numbered, near_groups(numbered), strict=True):
        groups.setdefault(least, []).append(i)
    return [rows[min(g, key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i))] for g in groups.values()]


def test_stages_on_awkward_rows(spark):
    """Nulls, blanks, repeated rows and ids, long texts and columns with the operators' own names."""
    rows = awkward_rows()
    docs = table(spark, rows)
    texts = lambda found: sorted(((r[0], r[1]) for r in found), key=repr)
    stage = dict(corpus_pipeline.STAGES)
    out = {name: stage[name](spark, docs, FOLDER) for name in list(stage)[:-1]}
    assert all(df.columns == docs.columns for df in out.values())
    found = {name: [tuple(r) for r in df.select("doc_id", "text", "source").collect()] for name, df in out.items()}
    chain = lines.fit(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    assert texts(found["quality rules"]) == texts(r for r in rows if lines.judge(r[1] or "", chain)["kept"])
    exact = found["exact dedup"]
    assert texts(r for r in exact if (r[1] or "").strip()) == texts(r for r in _exact(rows) if (r[1] or "").strip())
    assert len(exact) == len(_exact(rows))
    assert sorted((r[1] or "") for r in found["n-gram Jaccard join"]) == sorted((r[1] or "") for r in _near(rows))
    taken = Counter((r[0], r[1]) for r in found["mixing sources to target weights"])
    assert set(taken) <= {(r[0], r[1]) for r in rows if words(r[1])} and max(taken.values()) <= 3 * 2
    pieces = stage["packing"](spark, docs, FOLDER).collect()
    assert sum(p.length for p in pieces) == sum(len(ids_of(r[1], 0)) for r in rows)


def test_the_fit_takes_whole_documents_and_one_row_an_id(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    good, bad = "The plain words of a sentence end with a stop.\n" * 6, "MENU | HOME | $$ ## 12\n" * 6
    rows = [(i, good if i % 2 else bad, "s") for i in range(60)]
    once = lines.fit(table(spark, rows), labels)
    again = lines.fit(table(spark, rows + [rows[0]] * 500), labels)
    assert once == again
    # A page of more lines than the bound is left out of the sample whole, not cut.
    long = [*rows[1:], (0, bad * 40, "s")]
    assert lines.fit(table(spark, long), labels) == lines.fit(table(spark, rows[1:]), labels)
    assert lines.fit(table(spark, long), labels, most_lines=300) != lines.fit(table(spark, rows[1:]), labels)
