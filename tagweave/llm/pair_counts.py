"""Corpus-wide counts of linked token pairs, by external spill counting.

Documents are aligned in bounded runs. A run combines its (pair, document)
records before they move: its directory holds each pair once, sorted with B as the
major side and radix-partitioned by the B id, as frames of zstd; its body keeps
which pairs each document has. Per radix, a heap merges the directories of many
runs, so a pair's occurrences meet one after the other and are counted, and a B
id's maximum is known when its last pair has passed. Where there are more runs
than a merge may open, merges come in levels. The counts then go back to the
runs' directories, and each run adds them up for its documents. A pair that is
in every document is one record a run, so no task holds a hot pair's documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from heapq import merge
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagweave.llm.alignment import TOKENIZER_A, TOKENIZER_B, Aligned, Aligner, Differs, aligner
from tagweave.llm.common import documents, slim
from tagweave.sources.tables import materialize

# Chunks of text that a run holds; a longer document is a run of its own.
RUN_CHUNKS = 300_000
RADIXES = 64
# Directories that one merge opens.
FAN_IN = 256
FRAME = 4_096

_DOC_LISTS = ("doc_id", "n_a", "n_b", "n_groups", "n_links")
RUN_SCHEMA = "run long, radix int, frames array<binary>, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, groups_sha256 array<string>"
RESULT_SCHEMA = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
_FRAMES = pa.list_(pa.binary())


def _squeeze(*columns: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b"".join(c.astype("<i8").tobytes() for c in columns))


def pack(*columns: np.ndarray) -> list[bytes]:
    """Columns of equal length as frames; the first, if sorted, packs best as differences."""
    first = np.diff(columns[0], prepend=0)
    return [_squeeze(*(c[i : i + FRAME] for c in (first, *columns[1:]))) for i in range(0, len(first), FRAME)]


def unpack(frames: Iterable[bytes], n_columns: int) -> Iterator[tuple[np.ndarray, ...]]:
    """The columns, frame by frame."""
    expand, before = zstandard.ZstdDecompressor().decompress, 0
    for frame in frames:
        first, *more = np.frombuffer(expand(frame), "<i8").reshape(n_columns, -1)
        first = np.cumsum(first) + before
        before = int(first[-1])
        yield first, *more


def unpack_all(frames: Iterable[bytes], n_columns: int) -> list[np.ndarray]:
    parts = list(unpack(frames, n_columns))
    return [np.concatenate(c) for c in zip(*parts, strict=True)] if parts else [np.empty(0, np.int64)] * n_columns


def radix_of(pairs: np.ndarray) -> np.ndarray:
    return (pairs >> 32) % RADIXES


class _Numbers(dict):
    """Numbers its keys in the order in which they are met."""

    def __missing__(self, key: object) -> int:
        self[key] = n = len(self)
        return n


class Run:
    """Documents under alignment."""

    def __init__(self, aligner: Aligner) -> None:
        self._aligner, self._numbers, self._whole = aligner, _Numbers(), {}
        self._ids: list[int | None] = []
        self._chunks: list[np.ndarray] = []
        self.size = 0

    def add(self, doc_id: int | None, text: str) -> None:
        chunks = self._aligner.chunks(text) if text else []
        if chunks is None:
            key = (len(self._ids),)
            self._whole[key] = self._aligner.whole(text)
            chunks = [key]
        self._ids.append(doc_id)
        self._chunks.append(np.fromiter(map(self._numbers.__getitem__, chunks), np.int64, len(chunks)))
        self.size += len(chunks)

    def rows(self, number: int) -> pa.RecordBatch:
        """The run's body, with radix -1, and its directory by radix."""
        keys = [k for k in self._numbers if isinstance(k, str)]
        made = dict(zip(keys, self._aligner.look_up(keys), strict=True)) | self._whole
        known = [made[k] for k in self._numbers]
        spelled = np.array([isinstance(x, Aligned) for x in known], bool)
        known = [Aligned(0, 0, 0, "", b"") if isinstance(x, Differs) else x for x in known]
        counts = np.array([x[:3] for x in known], np.int64).reshape(-1, 3)
        groups = [x.groups for x in known]
        n_links = np.array([len(x.links) // 8 for x in known], np.int64)
        links = np.frombuffer(b"".join(x.links for x in known), np.int64)
        chunks = [c if spelled[c].all() else c[:0] for c in self._chunks]
        lengths = np.array([len(c) for c in chunks], np.int64)
        flat = np.concatenate(chunks)
        sums = _sums(np.column_stack([counts, n_links])[flat], lengths)
        digests = [hashlib.sha256(";".join(map(groups.__getitem__, c.tolist())).encode()).hexdigest() if len(c) else "" for c in chunks]
        pairs, place = np.unique(links, return_inverse=True)
        times = np.zeros(len(pairs), np.int64)
        np.add.at(times, place, np.repeat(np.bincount(flat, minlength=len(known)), n_links))
        radix = radix_of(pairs)
        slices = [(r, pack(pairs[radix == r], times[radix == r])) for r in np.unique(radix).tolist()]
        body = [_shorten(x) for x in (lengths, flat, n_links, place, radix)]
        n, none = len(slices), [None] * len(slices)
        lists = dict(zip(_DOC_LISTS, ([*self._ids], *sums.T.tolist()), strict=True))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([number] * (n + 1), pa.int64()),
                pa.array([-1, *[r for r, _ in slices]], pa.int32()),
                pa.array([body, *[f for _, f in slices]], _FRAMES),
                *[pa.array([lists[c], *none], pa.list_(pa.int64())) for c in _DOC_LISTS],
                pa.array([digests, *none], pa.list_(pa.string())),
            ],
            names=["run", "radix", "frames", *_DOC_LISTS, "groups_sha256"],
        )


def _shorten(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(values.astype("<u4").tobytes())


def _lengthen(frame: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(frame), "<u4").astype(np.int64)


def _sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sums of consecutive pieces of the given lengths; an empty piece gives 0."""
    total = np.concatenate((np.zeros((1, *values.shape[1:]), np.int64), np.cumsum(values, axis=0)))
    ends = np.cumsum(lengths)
    return total[ends] - total[ends - lengths]


def align_runs(docs: DataFrame, name_a: str, name_b: str, run_chunks: int) -> DataFrame:
    """Written bodies and directories of all runs of ``docs`` (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, done = aligner(name_a, name_b), 0
        first = TaskContext.get().partitionId() << 33
        now = Run(both)
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                now.add(doc_id, text)
                if now.size >= run_chunks or len(now._ids) >= run_chunks:
                    yield now.rows(first + done)
                    now, done = Run(both), done + 1
        if now._ids:
            yield now.rows(first + done)

    return materialize(docs.mapInArrow(run, RUN_SCHEMA), "aligned-runs")


_by_pair = itemgetter(0)


def _entries(frames: Iterable[bytes]) -> Iterator[tuple[int, int]]:
    for pairs, times in unpack(frames, 2):
        yield from zip(pairs.tolist(), times.tolist(), strict=True)


def _merged(table: pa.Table) -> Iterator[tuple[int, int]]:
    """Each pair once, in order, with the sum of its times over all directories of the table."""
    streams = merge(*(_entries(f) for f in table.column("frames").to_pylist()), key=_by_pair)
    for pair, same in groupby(streams, _by_pair):
        yield pair, sum(n for _, n in same)


class _Writer:
    """Rows of integers to frames, a frame at a time."""

    def __init__(self) -> None:
        self.frames: list[bytes] = []
        self._rows: list[tuple[int, ...]] = []
        self._last = 0

    def add(self, rows: Iterable[tuple[int, ...]]) -> None:
        self._rows.extend(rows)
        while len(self._rows) >= FRAME:
            self._flush(FRAME)

    def _flush(self, n: int) -> None:
        first, *more = np.array(self._rows[:n], np.int64).reshape(n, -1).T
        self.frames.append(_squeeze(np.diff(first, prepend=self._last), *more))
        self._last = int(first[-1])
        del self._rows[:n]

    def done(self) -> list[bytes]:
        if self._rows:
            self._flush(len(self._rows))
        return self.frames


def _combine(key: tuple, table: pa.Table) -> pa.Table:
    """The directories of a lane as one."""
    out = _Writer()
    for entry in _merged(table):
        out.add((entry,))
    return pa.table({"radix": pa.array([key[0].as_py()], pa.int32()), "run": pa.array([key[1].as_py()], pa.int64()), "frames": pa.array([out.done()], _FRAMES)})


def _count(key: tuple, table: pa.Table) -> pa.Table:
    """All pairs of a radix with their counts, and whether a pair's count is its B id's highest."""
    out = _Writer()
    for _, of_b in groupby(_merged(table), lambda entry: entry[0] >> 32):
        entries = list(of_b)
        most = max(n for _, n in entries)
        out.add((pair, n, int(n == most)) for pair, n in entries)
    return pa.table({"radix": pa.array([key[0].as_py()], pa.int32()), "frames": pa.array([out.done()], _FRAMES)})


def count_pairs(directories: DataFrame, fan_in: int) -> DataFrame:
    """``radix, frames``: counts and maxima of all pairs."""
    level = directories.select("radix", "run", "frames")
    runs = level.select("run").distinct().count()
    while runs > fan_in:
        lanes = -(-runs // fan_in)
        lane = F.pmod(F.xxhash64("run"), F.lit(lanes)).alias("lane")
        level = level.groupBy("radix", lane).applyInArrow(_combine, "radix int, run long, frames array<binary>")
        level, runs = materialize(level, "pair-directories"), lanes
    return materialize(level.groupBy("radix").applyInArrow(_count, "radix int, frames array<binary>"), "pair-counts")


def _reply(key: tuple, directories: pa.Table, counts: pa.Table) -> pa.Table:
    """To each directory of a lane, in its order, the counts of its pairs and whether they are the highest."""
    runs, frames = [], []
    pairs, n, best = unpack_all([f for x in counts.column("frames").to_pylist() for f in x], 3)
    for run, packed in zip(directories.column("run").to_pylist(), directories.column("frames").to_pylist(), strict=True):
        at = np.searchsorted(pairs, unpack_all(packed, 2)[0])
        runs.append(run)
        frames.append(pack(n[at], best[at]))
    return pa.table({"run": pa.array(runs, pa.int64()), "radix": pa.array([key[0].as_py()] * len(runs), pa.int32()), "frames": pa.array(frames, _FRAMES)})


def _finish(key: tuple, body: pa.Table, replies: pa.Table) -> pa.Table:
    """A run's documents with what the counts of their links add up to."""
    (row,) = body.to_pylist()
    lengths, flat, n_links, place, radix = map(_lengthen, row["frames"])
    found = np.zeros((len(radix), 2), np.int64)
    for reply in replies.to_pylist():
        found[radix == reply["radix"]] = np.column_stack(unpack_all(reply["frames"], 2))
    sums = _sums(_sums(found[place], n_links)[flat], lengths)
    columns = {c: row[c] for c in _DOC_LISTS} | {"n_best": sums[:, 1], "count_sum": sums[:, 0], "groups_sha256": row["groups_sha256"]}
    names = [f.split()[0] for f in RESULT_SCHEMA.split(", ")]
    return pa.table({c: pa.array(columns[c], pa.string() if c == "groups_sha256" else pa.int64()) for c in names})


def align_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    name_a: str = TOKENIZER_A,
    name_b: str = TOKENIZER_B,
    run_chunks: int = RUN_CHUNKS,
    fan_in: int = FAN_IN,
) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every row.

    A link's count is how many links of the whole table join the same two ids;
    ``n_best`` counts the links whose count is the highest of their B id, ties
    included. Null and empty texts, and texts that either tokenizer does not give
    back, have no tokens: zeros and an empty digest. Rows are kept apart when ids
    repeat or are missing, an empty table gives an empty one, and further columns
    are ignored.
    """
    runs = align_runs(slim(docs, id_col, text_col), name_a, name_b, run_chunks)
    directories = runs.where("radix >= 0").select("radix", "run", "frames")
    counts = count_pairs(directories, fan_in)
    lanes = max(1, -(-runs.where("radix = -1").count() // fan_in))
    lane = F.pmod(F.xxhash64("run"), F.lit(lanes)).alias("lane")
    back = counts.select("radix", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(lanes - 1).cast("long"))).alias("lane"), "frames")
    asked = directories.select("radix", lane, "run", "frames")
    replies = asked.groupBy("radix", "lane").cogroup(back.groupBy("radix", "lane")).applyInArrow(_reply, "run long, radix int, frames array<binary>")
    replies = materialize(replies, "pair-replies")
    bodies = runs.where("radix = -1").select("run", "frames", *_DOC_LISTS, "groups_sha256")
    return bodies.groupBy("run").cogroup(replies.groupBy("run")).applyInArrow(_finish, RESULT_SCHEMA)


def op12_spill_counted_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return align_documents(documents(spark, folder))
