"""Near-duplicate documents by parity sketches of their shingle sets.

A set's sketch has one bit per place; every shingle flips the bit its hash names.
Two sketches differ in at most as many bits as the sets' symmetric difference has
shingles, and sets of similarity 0.75 differ in at most a seventh of their
joint sizes. So if a very long sketch is cut into more blocks than that, similar
sets agree on a whole block (pigeonhole). Sizes are banded by a factor of 4/3,
each band with its own number of blocks, and a set is filed in its own band and
the one below, under the XOR of its shingles in each of its first non-empty
blocks, one more of them than the shingles it may lack. Candidates are screened by
short sketches, whose differing bits are counted, and then verified on the sets.

Only groups are wanted, so a block's sets are first linked to one of them; sets
that this has joined need no further comparison. Blocks whose sets then still
lie in several groups are screened in full, in pieces of bounded size.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagweave.llm.common import documents, map_batches, slim, small_batches, to_batch
from tagweave.llm.graph import components
from tagweave.sources.tables import materialize

SHINGLE = 5
PERCENT = 75
KNOWN_WORDS = 100_000
ENTRIES_PER_BUCKET = 1_000_000
SEEDS = 4
GROUP_PIECE = 2_000
PAIRS_AT_ONCE = 256
PAIRS_KNOWN = 50_000
ROWS_AT_ONCE = 64
ENTRIES_AT_ONCE = 300_000

_U = np.uint64
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15 + 0x3C6EF372FE94F82A * i | 1 for i in range(SHINGLE)], dtype=object)
_MULTIPLIERS = np.array([m % (1 << 64) for m in _MULTIPLIERS], _U)
_SEEDS = [_U((0xD1B54A32D192ED03 * (s + 1)) % (1 << 64)) for s in range(SEEDS + 1)]


def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of a 64-bit hash: every input bit reaches every output bit."""
    x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


class _Words(dict):
    """Hashes of words; forgotten when there are too many."""

    def __missing__(self, word: bytes) -> int:
        value = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        if len(self) >= KNOWN_WORDS:
            self.clear()
        self[word] = value
        return value


_words = _Words()


def shingles(text: str) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles; A-Z are lower-cased.

    ``bytes.split`` cuts at the six ASCII white-space characters and
    ``bytes.lower`` changes A-Z only, as the rule for words asks.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, _U)
    h = np.fromiter(map(_words.__getitem__, words), _U, len(words))
    width = min(SHINGLE, len(h))
    total = np.full(len(h) - width + 1, _U(width))
    for i in range(width):
        total += _mix(h[i : len(h) - width + 1 + i] * _MULTIPLIERS[i])
    return np.unique(_mix(total))


def class_of(found: np.ndarray) -> int:
    """What stands for a set: 63 bits of a digest of all its shingles."""
    return int.from_bytes(hashlib.blake2b(found.tobytes(), digest_size=8).digest(), "little") >> 1


def _bounds() -> list[int]:
    bounds = [1]
    while bounds[-1] < 1 << 40:
        bounds.append(max(bounds[-1] + 1, -(-bounds[-1] * 4 // 3)))
    return bounds


BOUNDS = _bounds()


def band(n: int) -> int:
    return bisect_right(BOUNDS, n) - 1


def most_differing(n: int, scheme: int) -> int:
    """Shingles in which a set of size ``n`` and a similar one of the scheme can differ."""
    partner = n * 100 // PERCENT if band(n) == scheme else min(n, BOUNDS[scheme + 1] - 1)
    return (n + partner) * (100 - PERCENT) // (100 + PERCENT)


def n_blocks(scheme: int) -> int:
    return BOUNDS[scheme + 1] // 2 + 4


def sketch_bits(scheme: int) -> int:
    """A power of two above the size, twice that for small sets, so that few differing shingles meet in a bit."""
    n = BOUNDS[scheme]
    return max(64, (2 if n < 512 else 1) << n.bit_length())


def sketch(found: np.ndarray, bits: int) -> np.ndarray:
    """Which bits are flipped an odd number of times, in 64-bit words."""
    parity = np.bincount((found & _U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(parity.astype(np.uint8), bitorder="little").view(_U)


def fold(words: np.ndarray, bits: int) -> np.ndarray:
    """The shorter sketch of the same set: a bit's place is taken modulo its length."""
    while words.shape[-1] * 64 > bits:
        half = words.shape[-1] // 2
        words = words[..., :half] ^ words[..., half:]
    return words


def signatures(found: np.ndarray) -> np.ndarray:
    """The keys under which a set is filed, for its own band and the one below."""
    n, out = len(found), []
    for scheme in {band(n), max(0, band(n) - 1)}:
        need = most_differing(n, scheme) + 1
        for seed in range(SEEDS + 1):
            own = _SEEDS[seed] ^ _U(scheme * 0x2545F4914F6CDD1D % (1 << 64))
            if seed == SEEDS:  # every block alone: the least shingles that a similar set can't all lack
                out.append(_mix(np.sort(_mix(found ^ own))[: n - -(-n * PERCENT // 100) + 1] ^ own))
                break
            places = np.sort(_mix(found ^ own)) if seed else found
            blocks = ((places >> _U(32)) * _U(n_blocks(scheme))) >> _U(32)
            starts = np.flatnonzero(np.concatenate(([True], blocks[1:] != blocks[:-1])))
            ends = int(starts[need]) if len(starts) > need else n
            starts = starts[:need]
            content = np.bitwise_xor.reduceat(_mix(places[:ends] + own), starts)
            out.append(_mix(content ^ _mix(blocks[starts] + own)))
            if len(starts) == need:
                break  # too few blocks otherwise: filed under another hash as well
    return np.concatenate(out)


def _sets(batch: pa.RecordBatch) -> dict:
    out: dict[str, list] = {"n": [], "cls": [], "sketch": []}
    for text in batch.column("text"):  # one at a time, so that the batch is not held twice
        found = shingles(text.as_py())
        out["n"].append(len(found))
        out["cls"].append(class_of(found) if len(found) else None)
        out["sketch"].append(sketch(found, sketch_bits(band(len(found)))).tobytes() if len(found) else None)
    return {"doc_id": batch.column("doc_id")} | out


def _some_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[int, np.ndarray]]:
    sets: dict[int, np.ndarray] = {}
    held = 0
    for batch in batches:
        for text in batch.column("text"):
            found = shingles(text.as_py())
            if len(found) and (cls := class_of(found)) not in sets:
                sets[cls] = signatures(found)
                held += len(sets[cls])
            if held >= ENTRIES_AT_ONCE:  # within a batch, which may hold many times as many
                yield sets
                sets, held = {}, 0
    if sets:
        yield sets


_FILED = "deal int, bucket int, classes binary, tags binary, owners binary"


def _file(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Rows with the signatures of about ``ENTRIES_AT_ONCE``, one row per bucket they fall into.

    A signature that several sets share here is known to be shared: all of them
    go out as found (bucket -1), and one goes on to be met by others.
    """
    turn = 0
    for sets in _some_sets(batches):
        classes = np.fromiter(sets, np.int64, len(sets))
        keys = np.concatenate(list(sets.values()))
        owners = np.repeat(np.arange(len(sets), dtype=np.uint32), [len(k) for k in sets.values()])
        where = (keys % _U(buckets)).astype(np.int64)
        tags = where << 32 | (keys >> _U(32)).astype(np.int64)
        order = np.argsort(tags, kind="stable")
        tags, owners = tags[order], owners[order]
        first = np.concatenate(([True], tags[1:] != tags[:-1]))
        shared = np.zeros(len(tags), bool)
        shared[1:] |= ~first[1:]
        shared[:-1] |= ~first[1:]
        rows: dict[str, list] = {name.split()[0]: [] for name in _FILED.split(", ")}

        def put(deal: int, bucket: int, tags: np.ndarray, owners: np.ndarray) -> None:
            used, own = np.unique(owners, return_inverse=True)
            values = (deal, bucket, classes[used].tobytes(), tags.tobytes(), own.astype(np.uint32).tobytes())  # noqa: B023
            for column, value in zip(rows.values(), values, strict=True):  # noqa: B023
                column.append(value)

        if shared.any():
            turn += 1
            put((int(classes[0]) + turn) % buckets, -1, tags[shared], owners[shared])
        tags, owners = tags[first], owners[first]
        cuts = np.searchsorted(tags, np.arange(buckets + 1) << 32)
        for b in np.flatnonzero(np.diff(cuts)).tolist():
            part = slice(int(cuts[b]), int(cuts[b + 1]))
            put(b, b, (tags[part] & 0xFFFFFFFF).astype(np.uint32), owners[part])
        yield to_batch(rows, _FILED)


_SHARED = "tag long, cls long"


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Signatures of a bucket that two sets or more share; rows come sorted by bucket."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    current = None

    def flush() -> pa.RecordBatch | None:
        tags, classes = (np.concatenate([h[i] for h in held]) for i in (0, 1))
        order = np.lexsort((classes, tags))
        tags, classes = tags[order], classes[order]
        new = np.concatenate(([True], (tags[1:] != tags[:-1]) | (classes[1:] != classes[:-1])))
        tags, classes = tags[new], classes[new]
        again = np.zeros(len(tags), bool)
        same = tags[1:] == tags[:-1]
        again[1:] |= same
        again[:-1] |= same
        return to_batch(
            {"tag": pa.array((np.int64(current) << 32) | tags[again].astype(np.int64)), "cls": pa.array(classes[again])},
            _SHARED,
        )

    for batch in batches:
        for bucket, classes, tags, owners in zip(
            *(batch.column(n).to_pylist() for n in ("bucket", "classes", "tags", "owners")), strict=True
        ):
            of = np.frombuffer(classes, np.int64)[np.frombuffer(owners, np.uint32)]
            if bucket < 0:
                yield to_batch({"tag": pa.array(np.frombuffer(tags, np.int64)), "cls": pa.array(of)}, _SHARED)
                continue
            if bucket != current and held:
                yield flush()
                held.clear()
            current = bucket
            held.append((np.frombuffer(tags, np.uint32), of))
    if held:
        yield flush()


def _close(n: np.ndarray, m: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Whether sizes and differing bits leave room for the similarity."""
    small, large = np.minimum(n, m), np.maximum(n, m)
    return (small * 100 >= large * PERCENT) & (bits * (100 + PERCENT) <= (n + m) * (100 - PERCENT))


def _screen_rows(batch: pa.RecordBatch) -> dict:
    keep = []
    rows = zip(*(batch.column(c).to_pylist() for c in ("n_a", "sketch_a", "n_b", "sketch_b")), strict=True)
    for n, one, m, other in rows:
        x, y = np.frombuffer(one, _U), np.frombuffer(other, _U)
        bits = 64 * min(len(x), len(y))
        keep.append(bool(_close(n, m, int(np.bitwise_count(fold(x, bits) ^ fold(y, bits)).sum()))))
    mask = pa.array(keep, pa.bool_())
    return {"a": batch.column("a").filter(mask), "b": batch.column("b").filter(mask)}


def _screen(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs whose short sketches may belong to similar sets."""
    of = lambda side: nodes.select(
        F.col("cls").alias(side), F.col("n").alias(f"n_{side}"), F.col("sketch").alias(f"sketch_{side}")
    )
    return map_batches(pairs.join(of("a"), "a").join(of("b"), "b"), _screen_rows, "a long, b long")


def _set_rows(batch: pa.RecordBatch) -> dict:
    found = [shingles(text.as_py()) for text in batch.column("text")]
    return {"cls": [class_of(f) if len(f) else None for f in found], "shingles": [f.tobytes() for f in found]}


def _verify_rows(batch: pa.RecordBatch) -> dict:
    keep = []
    for one, other in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
        x, y = (np.frombuffer(s.as_buffer(), _U) for s in (one, other))
        union = len(np.union1d(x, y))
        keep.append(100 * (len(x) + len(y) - union) >= PERCENT * union)
    mask = pa.array(keep, pa.bool_())
    return {"a": batch.column("a").filter(mask), "b": batch.column("b").filter(mask)}


def _verify(pairs: DataFrame, rows: DataFrame, members: DataFrame) -> DataFrame:
    """The pairs that are similar, by their whole sets, which are made again for these documents only."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
    ids = materialize(
        members.join(wanted, "cls", "left_semi").groupBy("cls").agg(F.min("doc_id").alias("of")).select("of").distinct(),
        "sketch-ids",
    )
    texts = rows.join(ids, F.col("doc_id").eqNullSafe(F.col("of")), "left_semi").select("text")
    sets = map_batches(texts, _set_rows, "cls long, shingles binary").where("cls IS NOT NULL").dropDuplicates(["cls"])
    with small_batches(rows.sparkSession, PAIRS_AT_ONCE):
        sets = materialize(sets, "sketch-sets")
    of = lambda side: sets.select(F.col("cls").alias(side), F.col("shingles").alias(f"set_{side}"))
    both = pairs.join(of("a"), "a").join(of("b"), "b")
    with small_batches(rows.sparkSession, PAIRS_AT_ONCE):
        return materialize(map_batches(both, _verify_rows, "a long, b long"), "sketch-links")


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of different components within a piece of a block; rows come sorted by piece.

    Sets that share one block share many: a pair that this task gave lately is not given again.
    """
    key, rows, given = None, [], set()
    names = ("tag", "one", "two", "cls", "n", "component", "side", "sketch")

    def flush() -> pa.RecordBatch:
        shortest = 64 * min(len(r[7]) // 8 for r in rows)
        words = np.stack([fold(np.frombuffer(r[7], _U), shortest) for r in rows])
        cls, n, comp, side = (np.array([r[i] for r in rows], np.int64) for i in (3, 4, 5, 6))
        found: list[tuple[int, int]] = []
        for i in range(len(rows) - 1):
            rest = slice(i + 1, None)
            different = comp[rest] != comp[i]
            if key[1] != key[2]:  # pairs inside one half are another piece's
                different &= side[rest] != side[i]
            if different.any():
                at = i + 1 + np.flatnonzero(different)
                bits = np.bitwise_count(words[at] ^ words[i]).sum(1).astype(np.int64)
                at = at[_close(n[i], n[at], bits)]
                one = int(cls[i])
                found += [(one, x) if one < x else (x, one) for x in cls[at].tolist()]
        new = set(found) - given
        if len(given) > PAIRS_KNOWN:
            given.clear()
        given.update(new)
        return to_batch({"a": [a for a, _ in new], "b": [b for _, b in new]}, "a long, b long")

    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
            if row[:3] != key:
                if rows:
                    yield flush()
                key, rows = row[:3], []
            rows.append(row)
    if rows:
        yield flush()


def _unsettled(led: DataFrame, nodes: DataFrame, groups: DataFrame) -> DataFrame:
    """Screened pairs of blocks whose sets, besides the leader, lie in several components.

    A block of more than ``GROUP_PIECE`` sets is dealt into parts, and every two
    parts meet in a task of their own, so no task's memory grows with a block.
    """
    known = nodes.join(groups, F.col("cls") == F.col("node"), "left").select(
        "cls", "n", "sketch", F.coalesce("component", "cls").alias("component")
    )
    rows = materialize(led.join(known.select("cls", "component"), "cls"), "sketch-blocks")
    open_blocks = materialize(
        rows.groupBy("tag")
        .agg(F.min("component").alias("least"), F.max("component").alias("most"), F.count("*").alias("size"))
        .where("least != most")
        .select("tag", F.ceil(F.col("size") / GROUP_PIECE).cast("int").alias("parts")),
        "sketch-open",
    )
    dealt = rows.join(open_blocks, "tag").withColumn("side", F.pmod(F.xxhash64("cls"), F.col("parts")).cast("int"))
    pieces = dealt.select(
        "tag", "cls", "side", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    ).select("tag", "cls", "side", F.least("side", "other").alias("one"), F.greatest("side", "other").alias("two"))
    full = pieces.join(known, "cls").repartition("tag", "one", "two").sortWithinPartitions("tag", "one", "two", "cls")
    return full.mapInArrow(_compare, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For every input row the size of its shingle set and the smallest id its links reach.

    Texts with equal sets are one class, told by a 63-bit digest. A null or blank
    text has an empty set, is linked with nothing and keeps its own id. Repeated
    rows and ids give rows of their own; a null id takes part and counts as no
    candidate for the smallest. An empty table gives an empty result.
    """
    rows = slim(docs, id_col, text_col)
    members = materialize(map_batches(rows, _sets, "doc_id long, n long, cls long, sketch binary"), "sketch-members")
    total = members.agg(F.sum("n")).first()[0] or 0
    buckets = 1 + int(0.7 * total) // ENTRIES_PER_BUCKET
    filed = rows.select("text").mapInArrow(lambda batches: _file(batches, buckets), _FILED)
    shared = filed.repartition("deal").sortWithinPartitions("bucket").mapInArrow(_meet, _SHARED)
    with small_batches(docs.sparkSession, ROWS_AT_ONCE):  # filed rows are long
        shared = materialize(shared.distinct(), "sketch-shared")
    degrees = materialize(shared.groupBy("cls").agg(F.count("*").alias("degree")), "sketch-degrees")
    nodes = materialize(
        members.join(degrees.select("cls"), "cls", "left_semi").select("cls", "n", "sketch").dropDuplicates(["cls"]), "sketch-nodes"
    )
    # The original of many copies shares most blocks, so it leads all of them.
    first = F.max_by("cls", F.struct("degree", "cls"))
    leaders = materialize(shared.join(degrees, "cls").groupBy("tag").agg(first.alias("a"), F.max("degree").alias("reach")), "sketch-leaders")
    led = materialize(shared.join(leaders, "tag").where("a != cls"), "sketch-led")
    # First each set meets one leader only, the one that shares most: as many pairs as sets.
    # Then it meets its other leaders, but for those that this has joined it to.
    best = led.groupBy("cls").agg(F.max_by("a", F.struct("reach", "a")).alias("a"))
    stars = best.select("a", F.col("cls").alias("b"))
    links = _verify(materialize(_screen(stars, nodes), "sketch-pairs"), rows, members)
    groups = components(links)
    of = lambda side: groups.select(F.col("node").alias(side), F.col("component").alias(f"of_{side}"))
    others = led.select("a", F.col("cls").alias("b")).distinct().join(of("a"), "a", "left").join(of("b"), "b", "left")
    apart = F.coalesce("of_a", "a") != F.coalesce("of_b", "b")
    others = materialize(others.where(apart).select("a", "b").join(stars, ["a", "b"], "left_anti"), "sketch-stars")
    if not others.isEmpty():
        links = materialize(links.unionByName(_verify(materialize(_screen(others, nodes), "sketch-pairs"), rows, members)), "sketch-links")
        groups = components(links)
    more = materialize(_unsettled(led.select("tag", "cls"), nodes, groups), "sketch-pairs")
    if not more.isEmpty():
        groups = components(links.unionByName(_verify(more, rows, members)))
    placed = members.join(groups, F.col("cls") == F.col("node"), "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "cls").alias("class")
    )
    least = materialize(
        placed.where("class IS NOT NULL").groupBy(F.col("class").alias("of")).agg(F.min("doc_id").alias("least")),
        "sketch-least",
    )
    return placed.join(least, F.col("class") == F.col("of"), "left").select(
        "doc_id", "n_shingles", F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id")
    )


def op4_parity_sketches(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(documents(spark, folder))


OP4_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN [md5(array_to_string(w[i:i+4], ' ')) for i in range(1, len(w) - 3)]
                                      ELSE [md5(array_to_string(w, ' '))] END) AS s
  FROM words WHERE len(w) > 0
), sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id != b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))
), reach(doc_id, root) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.doc_id WHERE r.root < l.b
)
SELECT d.doc_id, coalesce(any_value(z.n), 0)::BIGINT AS n_shingles, min(r.root) AS component_id
FROM documents d JOIN reach r USING (doc_id) LEFT JOIN sizes z USING (doc_id) GROUP BY d.doc_id
"""
