"""Quality by line labelling: a linear-chain CRF marks content and boilerplate.

Each line with a word becomes a few binned features. The chain's weights are
fitted to a bounded sample of labelled documents, whose lines all carry their
document's label; Viterbi decoding then labels the lines of every document, and
the share of words in content lines decides whether the document stays.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagweave.llm.common import SPACES, WORD, documents, map_batches, slim

SYMBOLS = "#*$%&|<>"
FEWEST_WORDS = 50
MOST_REPEATED_PERCENT = 50
LEAST_CONTENT_SHARE = 0.5

# Bounds of the sample the chain is fitted to: whole documents, none of more lines.
FIT_DOCUMENTS = 2_000
FIT_LINES = 200
# Rows whose verdicts are put out together.
PIECE_ROWS = 500

_WORD = re.compile(WORD)
_UPPER = re.compile(r"[A-Z]+")
_MARKS = re.compile(r"[#*$%&|<>!{}=_~^@\\]")
_DIGITS = re.compile(r"[0-9]")
_ENDS = (".", "?", "!", ":", '"', "…", ".)")
# Upper bounds of the bins of each feature.
BINS = (
    (1, 2, 5, 10, 20, 40),  # words in the line
    (0.0, 0.01, 0.03, 0.1, 0.2),  # share of marks
    (0.1, 0.3, 0.6),  # share of ASCII capitals
    (0.0, 0.1, 0.3),  # share of digits
    (0.3, 0.6, 0.8),  # share of distinct words
    (2.5, 4.0, 6.0, 9.0, 14.0),  # mean length of a word
    (0.0,),  # an earlier line again
    (0.0,),  # ends like a sentence
)
_FIRST = np.cumsum([0, *(len(b) + 1 for b in BINS)]).tolist()
N_WEIGHTS = _FIRST[-1]


def line_features(line: str, seen: set[str]) -> tuple[list[int], int]:
    """The line's feature numbers, one for each entry of ``BINS``, and its number of words."""
    words = _WORD.findall(line)
    size, n = len(line), len(words)
    values = (
        n,
        len(_MARKS.findall(line)) / size,
        sum(map(len, _UPPER.findall(line))) / size,
        len(_DIGITS.findall(line)) / size,
        len(set(words)) / n,
        sum(map(len, words)) / n,
        line in seen,
        line.rstrip(SPACES).endswith(_ENDS),
    )
    found = []
    for value, bounds, first in zip(values, BINS, _FIRST, strict=False):
        at = first
        for bound in bounds:
            if value <= bound:
                break
            at += 1
        found.append(at)
    return found, n


@dataclass(frozen=True)
class Chain:
    """State 1 is content. ``emit`` adds to state 1; ``move[a][b]`` joins neighbours."""

    emit: tuple[float, ...]
    start: tuple[float, float] = (0.0, 0.0)
    move: tuple[tuple[float, float], tuple[float, float]] = ((0.0, 0.0), (0.0, 0.0))

    def decode(self, lines: list[list[int]]) -> list[int]:
        """The best labels; a tie goes to content."""
        if not lines:
            return []
        emit, ((stay0, to1), (to0, stay1)) = self.emit, self.move
        bad, good = self.start[0], self.start[1] + sum(emit[i] for i in lines[0])
        back = []
        for line in lines[1:]:
            from_bad0, from_good0 = bad + stay0, good + to0
            from_bad1, from_good1 = bad + to1, good + stay1
            back.append((from_good0 >= from_bad0, from_good1 >= from_bad1))
            bad = max(from_bad0, from_good0)
            good = max(from_bad1, from_good1) + sum(emit[i] for i in line)
        labels = [int(good >= bad)]
        for pointers in reversed(back):
            labels.append(int(pointers[labels[-1]]))
        return labels[::-1]


ALL_CONTENT = Chain((0.0,) * N_WEIGHTS)


def fit_chain(sequences: list[list[list[int]]], labels: list[int], steps: int = 150, penalty: float = 2.0) -> Chain:
    """Maximise the conditional likelihood of the labels by gradient ascent with a quadratic penalty."""
    if not sequences:
        return ALL_CONTENT
    n, longest = len(sequences), max(map(len, sequences))
    there = np.zeros((n, longest), bool)
    for i, lines in enumerate(sequences):
        there[i, : len(lines)] = True
    features = np.array([line for lines in sequences for line in lines], np.int64)
    y = np.asarray(labels)
    emit, start, move = np.zeros(N_WEIGHTS), np.zeros(2), np.zeros((2, 2))
    flat = features.ravel()
    pairs = there[:, 1:]
    seen_emit = np.bincount(flat, np.repeat(y[np.nonzero(there)[0]], len(BINS)).astype(float), N_WEIGHTS)
    seen_start = np.bincount(y, minlength=2).astype(float)
    seen_move = np.diag([float(pairs[y == k].sum()) for k in (0, 1)])
    moment = [np.zeros_like(w) for w in (emit, start, move)]
    square = [np.zeros_like(w) for w in (emit, start, move)]
    for step in range(1, steps + 1):
        score = np.zeros((n, longest, 2))
        score[there, 1] = emit[features].sum(-1)
        ahead, behind = np.zeros((n, longest, 2)), np.zeros((n, longest, 2))
        ahead[:, 0] = start + score[:, 0]
        for t in range(1, longest):
            new = np.logaddexp(ahead[:, t - 1, :1] + move[0], ahead[:, t - 1, 1:] + move[1]) + score[:, t]
            ahead[:, t] = np.where(there[:, t, None], new, ahead[:, t - 1])
        for t in range(longest - 2, -1, -1):
            after = behind[:, t + 1] + score[:, t + 1]
            new = np.logaddexp(after[:, :1] + move[:, 0], after[:, 1:] + move[:, 1])
            behind[:, t] = np.where(there[:, t + 1, None], new, 0.0)
        total = np.logaddexp(ahead[:, -1, 0], ahead[:, -1, 1])[:, None, None]
        state = np.exp(ahead + behind - total) * there[:, :, None]
        joint = np.exp(
            ahead[:, :-1, :, None] + move + (score + behind)[:, 1:, None, :] - total[..., None]
        ) * pairs[:, :, None, None]
        slopes = (
            seen_emit - np.bincount(flat, np.repeat(state[there][:, 1], len(BINS)), N_WEIGHTS) - penalty * emit,
            seen_start - state[:, 0].sum(0) - penalty * start,
            seen_move - joint.sum((0, 1)) - penalty * move,
        )
        for k, (weights, slope) in enumerate(zip((emit, start, move), slopes, strict=True)):
            moment[k] = 0.9 * moment[k] + 0.1 * slope
            square[k] = 0.99 * square[k] + 0.01 * slope**2
            rate = 0.1 * np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
            weights += rate * moment[k] / (np.sqrt(square[k]) + 1e-8)
    as_floats = lambda a: tuple(round(float(x), 6) for x in a)
    return Chain(as_floats(emit), as_floats(start), (as_floats(move[0]), as_floats(move[1])))


def _lines(text: str) -> tuple[list[list[int]], list[int], int]:
    """Features and words of the lines with a word; how many of those lines came before."""
    seen: set[str] = set()
    features, sizes = [], []
    for line in text.split("\n"):
        if line.strip(SPACES):
            found, n = line_features(line, seen)
            features.append(found)
            sizes.append(n)
            seen.add(line)
    return features, sizes, len(features) - len(seen)


def _fit_rows(batch: pa.RecordBatch, most_lines: int) -> dict:
    found = [_lines(text.as_py())[0] for text in batch.column("text")]
    found = [x if len(x) <= most_lines else [] for x in found]
    flat = [np.asarray(x, np.uint8).tobytes() for x in found]
    return {"doc_id": batch.column("doc_id"), "quality": batch.column("quality"), "features": flat}


def fit(
    docs: DataFrame,
    labels: DataFrame,
    most_documents: int = FIT_DOCUMENTS,
    most_lines: int = FIT_LINES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> Chain:
    """Fit to at most ``most_documents`` labelled documents, the first by a hash of their id.

    The documents are whole; one of more than ``most_lines`` lines with a word is
    left out of the sample. Of several rows with one id, the text of least hash
    stands for it. A document with several labels counts as bad if one of them
    says so. Without usable labels every line is content.
    """
    wanted = (
        labels.select(labels[id_col].alias("of"), labels["quality"].cast("int").alias("quality"))
        .dropna()
        .groupBy("of")
        .agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("of"), "of")
        .limit(most_documents)
    )
    labelled = slim(docs, id_col, text_col).join(F.broadcast(wanted), F.col("doc_id") == F.col("of"))
    one_text = F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")
    sample = labelled.groupBy("doc_id").agg(F.first("quality").alias("quality"), one_text)
    rows = map_batches(
        sample.select("doc_id", "quality", "text"), _fit_rows, "doc_id long, quality int, features binary", most_lines=most_lines
    ).collect()
    rows = sorted((r for r in rows if r.features), key=lambda r: (r.doc_id, bytes(r.features)))
    sequences = [np.frombuffer(r.features, np.uint8).reshape(-1, len(BINS)).tolist() for r in rows]
    return fit_chain(sequences, [int(r.quality > 0) for r in rows])


def repeated_words(words: list[str]) -> int:
    """Words inside a window of three that the text has twice or more."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    total, covered = 0, 0  # covered: how far words are counted
    for i, window in enumerate(windows):
        if counts[window] > 1:
            total += i + 3 - max(i, covered)
            covered = i + 3
    return total


def judge(text: str, chain: Chain) -> dict:
    words = _WORD.findall(text)
    features, sizes, again = _lines(text)
    labels = chain.decode(features)
    repeats = repeated_words(words)
    content = sum(n for n, label in zip(sizes, labels, strict=True) if label)
    share = content / len(words) if words else 0.0
    failed = len(words) < FEWEST_WORDS or 100 * repeats > MOST_REPEATED_PERCENT * len(words)
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(map(text.count, SYMBOLS)),
        "n_dup_lines": again,
        "n_repeat_words": repeats,
        "n_lines": len(labels),
        "n_content_lines": sum(labels),
        "content_share": share,
        "base_failed": failed,
        "kept": not failed and share >= LEAST_CONTENT_SHARE,
    }


SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
    " n_lines long, n_content_lines long, content_share double, base_failed boolean, kept boolean"
)


def _judge_rows(batch: pa.RecordBatch, chain: Chain) -> dict:
    found = [judge(text.as_py(), chain) for text in batch.column("text")]
    names = [field.split()[0] for field in SCHEMA.split(",")][1:]
    return {"doc_id": batch.column("doc_id")} | {n: [x[n] for x in found] for n in names}


def judge_documents(docs: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row with its counts, its lines' labels in sum, and the verdict.

    A null text has no words and fails, as does any text of fewer than 50 words.
    Repeated rows and null ids are judged like any others.
    """
    return map_batches(slim(docs, id_col, text_col), _judge_rows, SCHEMA, chain=chain)


def _kept(batches: Iterator[pa.RecordBatch], text_col: str, chain: Chain) -> Iterator[pa.RecordBatch]:
    """The rows that are kept, by pieces: no second copy of a batch's texts is ever held."""
    for whole in batches:
        for at in range(0, whole.num_rows, PIECE_ROWS):
            batch = whole.slice(at, PIECE_ROWS)
            verdicts = [judge(text.as_py() or "", chain)["kept"] for text in batch.column(text_col)]
            yield batch.filter(pa.array(verdicts, pa.bool_()))


def keep_documents(docs: DataFrame, chain: Chain, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text is kept, with all their columns, whatever their names.

    A null text has no words and goes, as does any text of fewer than 50 words.
    Repeated rows and rows without id are judged one by one; an empty table stays empty.
    """
    return docs.mapInArrow(lambda batches: _kept(batches, text_col, chain), docs.schema)


def content_text(text: str, chain: Chain) -> str:
    """The text's content lines, in order; nothing of a text without words."""
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    labels = chain.decode(_lines(text)[0])
    return "\n".join(line for line, label in zip(lines, labels, strict=True) if label)


def op2_line_labels(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    return judge_documents(docs, fit(docs, spark.read.parquet(f"{folder}/labels.parquet")))
