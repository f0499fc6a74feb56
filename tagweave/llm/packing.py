"""Packing token sequences into fixed windows with bounded space.

Every partition streams its documents through a fixed number of open windows. A
full window's worth of a long document is closed at once; what remains goes to
the open window that it fills best. When it fits none, the fullest is emitted:
a gap worth a cut takes the beginning of the piece, a smaller one is padded.
What is still open at the end of a partition is merged over groups of partitions
until one group is left, so no task holds more than a bounded number of windows.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagweave.llm.common import documents, slim, to_batch
from tagweave.llm.tokens import TOKENIZER, encoder
from tagweave.sources.tables import materialize

WINDOW = 1024
OPEN_WINDOWS = 64
SMALLEST_CUT = 16
END_ID = 0
MERGED_PARTS = 64
ROWS_AT_ONCE = 4_000

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
SCHEMA = f"{PIECE}, part int, ids binary"
NAMES = [c.split()[0] for c in SCHEMA.split(", ")]


@dataclass(slots=True)
class Piece:
    doc_id: int | None
    start: int
    doc_tokens: int
    ids: bytes

    def __len__(self) -> int:
        return len(self.ids) // 4

    def cut(self, n: int) -> tuple[Piece, Piece]:
        return (
            Piece(self.doc_id, self.start, self.doc_tokens, self.ids[: 4 * n]),
            Piece(self.doc_id, self.start + n, self.doc_tokens, self.ids[4 * n :]),
        )


@dataclass
class Packer:
    """Open windows by their gap; ``add`` yields the windows that it closes."""

    window: int = WINDOW
    most_open: int = OPEN_WINDOWS
    smallest_cut: int = SMALLEST_CUT
    gaps: list[tuple[int, int]] = field(default_factory=list)
    open: dict[int, list[Piece]] = field(default_factory=dict)
    made: int = 0

    def _put(self, at: int, piece: Piece) -> Iterator[list[Piece]]:
        gap, key = self.gaps.pop(at)
        self.open[key].append(piece)
        if gap == len(piece):
            yield self.open.pop(key)
        else:
            insort(self.gaps, (gap - len(piece), key))

    def add(self, piece: Piece) -> Iterator[list[Piece]]:
        while len(piece) >= self.window:
            full, piece = piece.cut(self.window)
            yield [full]
        while len(piece):
            at = bisect_left(self.gaps, (len(piece), -1))
            if at < len(self.gaps):
                yield from self._put(at, piece)
                return
            if len(self.gaps) < self.most_open:
                self.made += 1
                self.open[self.made] = [piece]
                insort(self.gaps, (self.window - len(piece), self.made))
                return
            gap, key = self.gaps[0]  # the fullest
            if gap >= self.smallest_cut and len(piece) - gap >= self.smallest_cut:
                head, piece = piece.cut(gap)
                yield from self._put(0, head)
            else:
                self.gaps.pop(0)
                yield self.open.pop(key)


class _Rows:
    """Collects output rows; ids stay with a piece only while its window may still be filled."""

    def __init__(self, level: int, part: int) -> None:
        self.first, self.part, self.closed = (level << 56) + (part << 28), part, 0
        self.clear()

    def clear(self) -> None:
        self.columns: dict[str, list] = {n: [] for n in NAMES}

    def window(self, pieces: Iterable[Piece], is_open: bool = False) -> None:
        offset = 0
        for p in pieces:
            row = (
                *(p.doc_id, p.start, len(p), zlib.crc32(p.ids), p.doc_tokens),
                *(self.first + self.closed, offset, self.part, p.ids if is_open else None),
            )
            for column, value in zip(self.columns.values(), row, strict=True):
                column.append(value)
            offset += len(p)
        self.closed += 1

    def take(self) -> pa.RecordBatch:
        batch = to_batch(self.columns, SCHEMA)
        self.clear()
        return batch


def _first_level(docs: DataFrame, tokenizer: str, end_id: int, **limits: int) -> DataFrame:
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(tokenizer).encode_all, np.array([end_id], "<u4").tobytes()
        packer, rows = Packer(**limits), _Rows(0, TaskContext.get().partitionId())
        for batch in batches:
            texts = (text.as_py() for text in batch.column("text"))
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encode(texts), strict=True):
                ids += end
                for window in packer.add(Piece(doc_id, 0, len(ids) // 4, ids)):
                    rows.window(window)
                if len(rows.columns["part"]) >= ROWS_AT_ONCE:
                    yield rows.take()
        for window in packer.open.values():
            rows.window(window, is_open=True)
        yield rows.take()

    return docs.mapInArrow(pack, SCHEMA)


def _merge(leftovers: DataFrame, level: int, last: bool, **limits: int) -> DataFrame:
    """Pack the open windows of each group of partitions anew, longest pieces first."""

    def pack(table: pa.Table) -> pa.Table:
        group = table.column("part")[0].as_py() // MERGED_PARTS
        columns = [table.column(n).to_pylist() for n in ("doc_id", "start", "doc_tokens", "ids")]
        pieces = [Piece(*row) for row in zip(*columns, strict=True)]
        pieces.sort(key=lambda p: (-len(p), p.doc_id is None, p.doc_id, p.start, p.ids))
        packer, rows = Packer(**limits), _Rows(level, group)
        for piece in pieces:
            for window in packer.add(piece):
                rows.window(window)
        for window in packer.open.values():
            rows.window(window, is_open=not last)
        return pa.Table.from_batches([rows.take()])

    return leftovers.groupBy(F.floor(F.col("part") / MERGED_PARTS).alias("group")).applyInArrow(pack, SCHEMA)


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str = TOKENIZER,
    end_id: int = END_ID,
    window: int = WINDOW,
    most_open: int = OPEN_WINDOWS,
    smallest_cut: int = SMALLEST_CUT,
) -> DataFrame:
    """One row per piece of every document's ids, each id in exactly one piece.

    Returns doc_id, start (the document's ids before the piece), length,
    ids_crc32, doc_tokens, sequence_id and offset in the sequence. A null text
    counts as empty and gives its end id; repeated rows and null ids are packed
    like any others; an empty table gives no pieces.
    """
    limits = {"window": window, "most_open": most_open, "smallest_cut": smallest_cut}
    packed = materialize(_first_level(slim(docs, id_col, text_col), tokenizer, end_id, **limits), "packed")
    done, level = packed.where("ids IS NULL"), 0
    leftovers = packed.where("ids IS NOT NULL")
    parts = (leftovers.agg(F.max("part")).first()[0] or 0) + 1
    while True:
        level, parts = level + 1, -(-parts // MERGED_PARTS)
        merged = materialize(_merge(leftovers, level, parts == 1, **limits), "packed-leftovers")
        done = done.unionByName(merged.where("ids IS NULL"))
        if parts == 1:
            return done.drop("part", "ids")
        leftovers = merged.where("ids IS NOT NULL")


def op9_bounded_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(documents(spark, folder))
