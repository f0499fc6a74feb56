"""Aligned tokens and their corpus-wide counts against plain versions."""

import os
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from helpers import FOLDER, awkward_rows, ordered, prose, sha, stored, table

from tagweave.llm import alignment, pair_counts


class Plain:
    """The two tokenizers by their plain calls."""

    def __init__(self):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.a = Tokenizer.from_file(public_tokenizers.path(alignment.TOKENIZER_A))
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=public_tokenizers.path(alignment.TOKENIZER_B))
        # Every character of the byte-level alphabet, by what the library makes of each byte.
        assert len(ByteLevel.alphabet()) == 256
        self.byte = alignment._byte_of_character()
        assert set(self.byte) == set(ByteLevel.alphabet())

    def tokens(self, text):
        a = self.a.encode(" " + text, add_special_tokens=False).ids if text else []
        b = self.b.encode(text) if text else []
        spelled_a = [bytes(self.byte[c] for c in self.a.id_to_token(i)) for i in a]
        spelled_b = []
        for i in b:
            p = self.b.id_to_piece(i)
            spelled_b.append(bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode())
        data = (" " + text).encode()
        if not text or b"".join(spelled_a) != data or b"".join(spelled_b) != data:
            return [], []
        return list(zip(a, np.cumsum(list(map(len, spelled_a))).tolist(), strict=True)), list(zip(b, np.cumsum(list(map(len, spelled_b))).tolist(), strict=True))


def plain_alignments(rows):
    plain, aligned, count = Plain(), [], Counter()
    for doc_id, text, *_ in rows:
        a, b = plain.tokens(text or "")
        common = sorted({e for _, e in a} & {e for _, e in b})
        groups, start = [], 0
        for end in common:
            in_group = [[i for i, e in side if start < e <= end] for side in (a, b)] if len(common) < 200 else None
            groups.append(in_group)
            start = end
        if common and groups[0] is None:  # the same, by one pass over each side
            groups, i, j = [], 0, 0
            for end in common:
                x, y = i, j
                while i < len(a) and a[i][1] <= end:
                    i += 1
                while j < len(b) and b[j][1] <= end:
                    j += 1
                groups.append([[t for t, _ in a[x:i]], [t for t, _ in b[y:j]]])
        links, j = [], 0
        spans_b = [(t, s, e) for (t, e), s in zip(b, [0, *[e for _, e in b]], strict=False)]
        for (t, e), s in zip(a, [0, *[e for _, e in a]], strict=False):
            while j < len(spans_b) and spans_b[j][2] <= s:
                j += 1
            k = j
            while k < len(spans_b) and spans_b[k][1] < e:
                links.append((t, spans_b[k][0]))
                k += 1
        count.update(links)
        shown = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        aligned.append((doc_id, len(a), len(b), len(groups), links, shown))
    most = Counter()
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    return [
        (doc_id, n_a, n_b, n_groups, len(links), sum(count[x] == most[x[1]] for x in links), sum(count[x] for x in links), sha(shown) if n_a else "")
        for doc_id, n_a, n_b, n_groups, links, shown in aligned
    ]


def odd_texts():
    return [
        "<|endoftext|> <s> </s> <0x41> <unk>", "▁a ▁", "tab\tand\r\nline  ends \n\n here ", " leading", "\nline first", "\n", " ", "x",
        "it's we'll 'tis 's", "a\x00b\x1c c\x85d", "日本語 テキスト", "é ﬁ ① 🙂‍🙃", "nb\xa0sp \xadsoft", "1234567 89.10", "!!! ...\n---\n- - -", "Ⅷ ² ½ ǅ",
    ]


def test_chunks_and_whole_texts_align_alike():
    both = alignment.aligner()
    draw = random.Random(4)
    texts = [*odd_texts(), *[t for _, t, *_ in awkward_rows() if t], *[t for _, t, *_ in stored_texts()[:60]]]
    alphabet = "ab'sX1 .,\n\t\r  é\xa1ɏ-"
    texts += ["".join(draw.choices(alphabet, k=draw.randrange(1, 40))) for _ in range(3_000)]
    cut = 0
    for text in texts:
        chunks = both.chunks(text)
        if chunks is None:
            continue
        cut += len(chunks) > 1
        assert "".join(chunks) == " " + text
        parts, whole = both.look_up(list(dict.fromkeys(chunks))), both.whole(text)
        made = dict(zip(dict.fromkeys(chunks), parts, strict=True))
        joined = [made[c] for c in chunks]
        if any(isinstance(x, alignment.Differs) for x in joined):
            assert isinstance(whole, alignment.Differs)
            continue
        assert tuple(sum(x[i] for x in joined) for i in range(3)) == whole[:3]
        assert ";".join(x.groups for x in joined) == whole.groups
        assert b"".join(x.links for x in joined) == whole.links
    assert cut > 1_000


def stored_texts():
    import pyarrow.parquet as pq

    table = pq.read_table(f"{FOLDER}/documents.parquet", columns=["doc_id", "text"])
    return [r for r in zip(*table.to_pydict().values(), strict=True) if r[1]]


@pytest.mark.parametrize(("run_chunks", "fan_in"), [(1_000_000, 256), (150, 2)])
def test_counts_of_awkward_rows(spark, run_chunks, fan_in):
    """Also in runs of a few chunks, merged two at a time in several levels."""
    rows = [*awkward_rows(), *[(200 + i, t, None) for i, t in enumerate(odd_texts())], *[(300, prose(7, 25), "s")] * 30]
    found = pair_counts.align_documents(table(spark, rows), run_chunks=run_chunks, fan_in=fan_in)
    assert ordered(found.collect()) == ordered(plain_alignments(rows))


def test_empty_table_and_long_text(spark):
    assert pair_counts.align_documents(table(spark, awkward_rows()).limit(0)).collect() == []
    assert [tuple(r)[1:] for r in pair_counts.align_documents(table(spark, [(1, None, "s")])).collect()] == [(0,) * 6 + ("",)]
    rows = [(1, prose(9, 300_000), "s"), (2, "x" * 300_000 + "é日" * 50_000, "s")]
    assert ordered(pair_counts.align_documents(table(spark, rows)).collect()) == ordered(plain_alignments(rows))


def test_the_query_equals_plain_counts(spark):
    found = pair_counts.op12_spill_counted_pairs(spark, FOLDER)
    assert ordered(found.collect()) == ordered(plain_alignments(stored(spark)))


def test_a_hot_pair_is_one_record_a_run(spark):
    """However many documents hold it, its occurrences are combined before they move."""
    rows = [(i, "the the the", "s") for i in range(5_000)]
    runs = pair_counts.align_runs(spark.createDataFrame(rows, "doc_id long, text string, source string").select("doc_id", "text").repartition(2), alignment.TOKENIZER_A, alignment.TOKENIZER_B, 1_000)
    sizes = [sum(len(p) for p, _ in pair_counts.unpack(r["frames"], 2)) for r in runs.where("radix >= 0").collect()]
    assert max(sizes) == 1 and len(sizes) == runs.where("radix = -1").count() >= 15


def test_frames_round_trip():
    pairs, times = np.cumsum(np.random.default_rng(1).integers(0, 9, 10_000)), np.arange(10_000)
    for got, want in zip(pair_counts.unpack_all(pair_counts.pack(pairs, times), 2), (pairs, times), strict=True):
        assert (got == want).all()
    assert [len(c) for c in pair_counts.unpack_all([], 3)] == [0, 0, 0]
