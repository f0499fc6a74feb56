"""Removing passages that stand more than once, by induction from sampled suffixes.

A suffix sort of every byte would write many times the input. As in induced
sorting, only a sample of the suffixes is sorted: of all 100-byte strings in a
passage of 400 bytes the one with the least hash is the passage's anchor, so
equal passages have equal anchors at equal places, about one in 150 bytes. The
anchors that occur twice are dealt out by Spark's external sort, each with the
bytes before and after it. Within one anchor string the tuples are sorted by what
follows and by what precedes, neighbours' common prefixes are kept, and the order
of all passages around the anchors is induced from the two: a passage stands
twice exactly if another tuple has the same class on both sides.

An anchor inside a passage that stands very often has too many tuples for one task.
Those are cut by how far before the anchor their passages start; the passages of
a part have a longer string in common, which deals them anew. Parts whose
passages are all equal within a task are combined there, so only parts at the
edge of the frequent passage are cut again, down to single passages.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagweave.llm.common import documents, map_batches, slim, to_batch
from tagweave.llm.rolling import BLOCK, window_hashes
from tagweave.sources.tables import materialize

WIDTH = 400
ANCHOR = 100
BEFORE = WIDTH - ANCHOR
LARGEST_GROUP = 50_000
PARTS = 7
CELLS_AT_ONCE = 2_000_000

_PLACE_BITS = np.uint64(24)
_PLACE = (np.uint64(1) << _PLACE_BITS) - np.uint64(1)


def anchors(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the anchors of all passages of ``WIDTH`` bytes; of equal hashes the first counts."""
    places, hashes = [], []
    whole, span = np.frombuffer(data, np.uint8), BEFORE + 1
    for at in range(0, len(data) - WIDTH + 1, BLOCK - WIDTH):
        found = window_hashes(whole[at : at + BLOCK], ANCHOR)
        if len(found) < span:
            break
        keys = (found & ~_PLACE) | np.arange(len(found), dtype=np.uint64)
        n = -(-len(keys) // span) * span
        cells = np.full(n, np.iinfo(np.uint64).max, np.uint64)
        cells[: len(keys)] = keys
        rows = cells.reshape(-1, span)
        ahead = np.minimum.accumulate(rows, axis=1).ravel()
        behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(behind[: len(keys) - span + 1], ahead[span - 1 : len(keys)])
        least = least[np.concatenate(([True], least[1:] != least[:-1]))] & _PLACE
        own = np.unique(least).astype(np.int64)
        places.append(own + at)
        hashes.append(found[own].view(np.int64))
    if not places:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    place, first = np.unique(np.concatenate(places), return_index=True)
    return place, np.concatenate(hashes)[first]


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: set[int] = set()  # equal texts in a task go on once
    for batch in batches:
        digests, places, hashes = [], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for digest, text in zip(batch.column("digest").to_pylist(), batch.column("text"), strict=True):
            if digest in seen:
                continue
            seen.add(digest)
            place, found = anchors(text.as_py().encode("utf-8", "surrogatepass"))
            digests += [digest] * len(place)
            places.append(place)
            hashes.append(found)
        yield to_batch(
            {"digest": digests, "place": pa.array(np.concatenate(places)), "anchor": pa.array(np.concatenate(hashes))},
            "digest long, place long, anchor long",
        )


# A tuple to compare (before and after), or a stretch known to repeat (place and end).
# The passages of a tuple start as many bytes before the anchor as ``before`` and ``after`` leave room for.
TUPLE = "key binary, digest long, place long, low int, high int, end long, before binary, after binary"


class _Rows:
    """Tuples of one task. Of equal ones, one goes on and all are known to repeat."""

    def __init__(self) -> None:
        self.seen: dict[bytes, list] = {}
        self.clear()

    def clear(self) -> None:
        self.columns: dict[str, list] = {f.split()[0]: [] for f in TUPLE.split(", ")}

    def put(self, *values: object) -> None:
        for column, value in zip(self.columns.values(), values, strict=True):
            column.append(value)

    def add(self, key: bytes, digest: int, place: int, low: int, high: int, before: bytes, after: bytes) -> None:
        whole = len(before) + len(after) >= WIDTH
        same = hashlib.blake2b(b"%d,%d,%d:" % (low, high, len(before)) + before + after, digest_size=16).digest()
        known = self.seen.get(same)
        if known is None:
            self.seen[same] = [digest, place, whole]
            self.put(key, digest, place, low, high, None, before, after)
        elif known[:2] != [digest, place] and whole:
            self.put(None, digest, place - len(before), None, None, place + len(after), None, None)
            if known[2]:  # the first of them, once
                self.put(None, known[0], known[1] - len(before), None, None, known[1] + len(after), None, None)
                known[2] = False


def _tuples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The anchors' surroundings."""
    rows = _Rows()
    for batch in batches:
        rows.clear()
        names = ("digest", "text", "places", "anchors")
        for digest, text, places, found in zip(*(batch.column(n).to_pylist() for n in names), strict=True):
            data = text.encode("utf-8", "surrogatepass")
            for place, anchor in zip(places, found, strict=True):
                before, after = data[max(0, place - BEFORE) : place][::-1], data[place : place + WIDTH]
                rows.add(anchor.to_bytes(8, "big", signed=True), digest, place, 0, BEFORE, before, after)
        yield to_batch(rows.columns, TUPLE)


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tuples cut by where their passages start, under keys of the longer strings that these have in common."""
    rows = _Rows()
    for batch in batches:
        rows.clear()
        names = ("digest", "place", "low", "high", "before", "after")
        for digest, place, low, high, before, after in zip(*(batch.column(n).to_pylist() for n in names), strict=True):
            step = -(-(high - low + 1) // PARTS)
            for least in range(low, high + 1, step):
                most = min(high, least + step - 1)
                if len(before) < least or len(after) < WIDTH - most:
                    continue  # the text has no such passage
                shared = b"%d,%d:" % (least, most) + before[:least] + after[: WIDTH - most]
                key = hashlib.blake2b(shared, digest_size=16).digest()
                rows.add(key, digest, place, least, most, before[:most], after[: WIDTH - least])
        yield to_batch(rows.columns, TUPLE)


def _common(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    differing = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (differing.bit_length() + 7) // 8


def _order(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ranks in sorted order, and each sorted part's common prefix with the one before it."""
    order = sorted(range(len(parts)), key=parts.__getitem__)
    common = np.array([0, *(_common(parts[i], parts[j]) for i, j in zip(order, order[1:], strict=False))], np.int64)
    ranks = np.empty(len(parts), np.int64)
    ranks[order] = np.arange(len(parts))
    return ranks, common


def repeated(before: list[bytes], after: list[bytes]) -> Iterator[tuple[int, int, int]]:
    """For tuples of one anchor: (number, start, end), relative to the anchor, of stretches that others share.

    ``before`` is read backwards. Passages that start ``o`` bytes before the
    anchor are equal if the tuples agree on o bytes before and 400 - o after it,
    that is, if no smaller common prefix lies between them in either order.
    """
    n = len(before)
    if n == 2:
        left, right = _common(*before), _common(*after)
        if left + right >= WIDTH:
            yield from ((i, -left, right) for i in (0, 1))
        return
    rank_l, common_l = _order(before)
    rank_r, common_r = _order(after)
    if common_l.max() + common_r.max() < WIDTH:
        return
    size_l, size_r = (np.array([len(x) for x in parts]) for parts in (before, after))
    step = max(1, CELLS_AT_ONCE // n)
    hits = []
    for first in range(0, BEFORE + 1, step):
        offsets = np.arange(first, min(BEFORE + 1, first + step))[:, None]
        class_l = np.cumsum(common_l < offsets, axis=1)[:, rank_l]
        class_r = np.cumsum(common_r < WIDTH - offsets, axis=1)[:, rank_r]
        keys = class_l * (n + 1) + class_r
        keys = np.where((size_l >= offsets) & (size_r >= WIDTH - offsets), keys, -1 - np.arange(n))
        order = np.argsort(keys, axis=1, kind="stable")
        keys = np.take_along_axis(keys, order, axis=1)
        same = keys[:, 1:] == keys[:, :-1]
        hit = np.zeros(keys.shape, bool)
        hit[:, 1:] |= same
        hit[:, :-1] |= same
        back = np.empty_like(hit)
        np.put_along_axis(back, order, hit, axis=1)
        hits.append(back)
    hit = np.concatenate(hits)
    edges = np.diff(np.pad(hit, ((1, 1), (0, 0))).astype(np.int8), axis=0)
    for i in np.flatnonzero(hit.any(0)).tolist():
        for low, high in zip(np.flatnonzero(edges[:, i] == 1).tolist(), np.flatnonzero(edges[:, i] == -1).tolist(), strict=True):
            yield i, 1 - high, WIDTH - low


def _induce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated stretches of the tuples, which come sorted by key."""
    schema = "digest long, place long, end long"
    current, held = None, {}

    def flush(out: dict[str, list]) -> None:
        if len(held) < 2:
            return
        ids = list(held)
        for i, start, end in repeated([held[x][0] for x in ids], [held[x][1] for x in ids]):
            digest, place = ids[i]
            for column, value in zip(out.values(), (digest, place + start, place + end), strict=True):
                column.append(value)

    out: dict[str, list] = {"digest": [], "place": [], "end": []}
    for batch in batches:
        for key, digest, place, before, after in zip(
            *(batch.column(n).to_pylist() for n in ("key", "digest", "place", "before", "after")), strict=True
        ):
            if key != current:
                flush(out)
                current, held = key, {}
            held[digest, place] = (before, after)
        if out["digest"]:
            yield to_batch(out, schema)
            out = {"digest": [], "place": [], "end": []}
    flush(out)
    yield to_batch(out, schema)


def _cut_rows(batch: pa.RecordBatch) -> dict:
    out: dict[str, list] = {"digest": batch.column("digest"), "n_removed": [], "n_spans": [], "kept_sha256": [], "kept": []}
    for text, stretches in zip(batch.column("text").to_pylist(), batch.column("stretches").to_pylist(), strict=True):
        data = text.encode("utf-8", "surrogatepass")
        kept, end, spans = [], 0, 0
        for s in sorted(stretches, key=lambda s: (s["place"], s["end"])):
            if s["place"] > end or not spans:
                kept.append(data[end : s["place"]])
                spans += 1
                end = s["end"]
            end = max(end, s["end"])
        rest = b"".join([*kept, data[end:]])
        out["n_removed"].append(len(data) - len(rest))
        out["n_spans"].append(spans)
        out["kept_sha256"].append(hashlib.sha256(rest).hexdigest())
        out["kept"].append(rest)
    return out


_EMPTY = hashlib.sha256(b"").hexdigest()


def _crowded(tuples: DataFrame, largest_group: int) -> DataFrame:
    """Keys with too many tuples to gather, whose passages can still be told apart by where they start."""
    sizes = tuples.where("low < high").groupBy("key").agg(F.count("*").alias("n"))
    return materialize(sizes.where(F.col("n") > largest_group).select("key"), "repeat-crowded")


def _stretches(tuples: DataFrame, crowded: DataFrame | None) -> DataFrame:
    """Repeated stretches among the tuples, but for those of crowded keys."""
    known = tuples.where("end IS NOT NULL").select("digest", "place", "end")
    several = tuples.where("low < high").select("key", "digest", "place", "before", "after")
    if crowded is None:
        single = None
    else:
        several = several.join(crowded, "key", "left_anti")
        single = tuples.where("low = high").select("key", "digest", (F.col("place") - F.col("low")).alias("place"))
    compared = several.repartition("key").sortWithinPartitions("key").mapInArrow(_induce, "digest long, place long, end long")
    found = known.unionByName(compared)
    if single is None:
        return found
    # Tuples with a single passage have it as their key: counted, never gathered.
    where = F.struct("digest", "place")
    again = single.groupBy("key").agg(F.min(where).alias("least"), F.max(where).alias("most")).where("least != most").select("key")
    return found.unionByName(single.join(again, "key").select("digest", "place", (F.col("place") + WIDTH).alias("end")))


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", largest_group: int = LARGEST_GROUP
) -> DataFrame:
    """What is left of every input row when no byte of a twice-standing 400-byte string is kept.

    Returns doc_id, n_bytes, n_removed, n_spans, kept_sha256 and ``kept``, the
    bytes that remain where only part of a text goes (null where the text stays
    whole or goes entirely). A null text counts as empty. Texts of fewer than
    400 bytes stay; longer texts that stand in several rows, repeated rows
    included, go entirely. Equal texts are told by their length and 64-bit hash.
    An anchor with more than ``largest_group`` different surroundings is not
    gathered: its passages are dealt by longer strings that they have in common.
    """
    rows = slim(docs, id_col, text_col).withColumn("digest", F.xxhash64("text", F.octet_length("text")))
    texts = materialize(
        rows.select(
            "doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2(F.encode("text", "utf-8"), 256).alias("sha")
        ),
        "repeat-texts",
    )
    classes = materialize(
        texts.where(F.col("n_bytes") >= WIDTH).groupBy("digest").agg(F.min("doc_id").alias("of"), F.count("*").alias("copies")),
        "repeat-classes",
    )
    long_rows = rows.where(F.octet_length("text") >= WIDTH)
    found = materialize(
        long_rows.select("digest", "text").mapInArrow(_anchor_rows, "digest long, place long, anchor long"), "repeat-anchors"
    )
    where = F.struct("digest", "place")
    often = materialize(
        found.groupBy("anchor")
        .agg(F.min(where).alias("least"), F.max(where).alias("most"), F.count("*").alias("n"))
        .where("least != most")
        .select("anchor", "n"),
        "repeat-often",
    )
    wanted = (
        found.join(often, "anchor")
        .groupBy("digest")
        .agg(F.sort_array(F.collect_set(F.struct("place", "anchor"))).alias("all"))
        .join(classes.select("digest", "of"), "digest")
        .select(F.col("digest").alias("class"), "of", F.col("all.place").alias("places"), F.col("all.anchor").alias("anchors"))
    )
    wanted = materialize(wanted, "repeat-wanted")
    # One row a text: of repeated rows with one id, any.
    chosen = long_rows.join(wanted, (F.col("digest") == F.col("class")) & F.col("doc_id").eqNullSafe(F.col("of"))).drop("class", "of", "doc_id")
    chosen = materialize(chosen, "repeat-chosen")
    tuples = materialize(chosen.mapInArrow(_tuples, TUPLE), "repeat-tuples")
    crowded = None
    if not often.where(F.col("n") > largest_group).isEmpty():
        crowded = _crowded(tuples, largest_group)
    stretches = _stretches(tuples, crowded)
    while crowded is not None and not crowded.isEmpty():
        tuples = tuples.where("before IS NOT NULL").join(crowded, "key", "left_semi")
        tuples = materialize(tuples.mapInArrow(_split, TUPLE), "repeat-tuples")
        crowded = _crowded(tuples, largest_group)
        stretches = stretches.unionByName(_stretches(tuples, crowded))
    stretches = stretches.groupBy("digest").agg(F.collect_set(F.struct("place", "end")).alias("stretches"))
    cut = chosen.select("digest", "text").dropDuplicates(["digest"]).join(materialize(stretches, "repeat-stretches"), "digest")
    cut = materialize(
        map_batches(cut, _cut_rows, "digest long, n_removed long, n_spans long, kept_sha256 string, kept binary"), "repeat-cut"
    )
    copied = classes.where("copies > 1").select("digest", F.lit(True).alias("copied"))
    whole = F.col("copied").isNotNull()
    return texts.join(materialize(copied, "repeat-copied"), "digest", "left").join(cut, "digest", "left").select(
        "doc_id",
        "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(whole, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, _EMPTY).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
        F.when(~whole, F.col("kept")).alias("kept"),
    )


def op8_induced_suffixes(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(documents(spark, folder)).drop("kept")
