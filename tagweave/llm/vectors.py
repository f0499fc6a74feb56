"""Near-duplicate vectors by cross-polytope hashing.

A vector is turned by pseudo-random rotations, each three rounds of sign flips and
a fast Hadamard transform, and hashed to the signed axis it then lies closest to.
``HASHES`` rotations make a bucket of a table; besides its own bucket, a vector
is filed under the buckets that it missed by least (multiprobe). Vectors that
share a bucket are compared in double precision, so no link is below the
threshold.

Equal vectors are one class and are compared once. A large bucket is cut into
pieces, and pairs of pieces are compared by matrix products, so no task holds a
bucket. No pair leaves a task: a pair that shares several buckets counts in the
first of them only, and a vector gets, per comparison, how many links it has and
one member of its local component.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagweave.llm.common import to_batch
from tagweave.llm.graph import components
from tagweave.operators.lookup import heavy_by_count, lookup
from tagweave.sources.tables import materialize

THRESHOLD = 0.9
# A pair of cosine 0.9 shares a bucket of a table with probability 0.47 at 64
# dimensions, and misses all tables with probability 0.002. With d dimensions,
# padded to a power of two, a table has (2 d) ** HASHES buckets.
TABLES, HASHES, PROBES = 10, 3, 3
# Axes per rotation that a probe may choose instead of the closest one.
NEXT_AXES = 3
PIECE = 2_000
BLOCK = 1_000
PAIRS_AT_ONCE = 50_000
ROWS_AT_ONCE = 20_000
SEED = 20


def unit(values: list[float | None] | None) -> np.ndarray | None:
    """The vector of length 1 in its direction; None if it has none."""
    if not values or any(v is None for v in values):
        return None
    x = np.array(values, np.float64)
    largest = np.abs(x).max()
    if not np.isfinite(largest) or largest == 0:
        return None
    x = x / largest
    return x / np.sqrt(x @ x) + 0.0


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of every row, whose length is a power of two."""
    n, width = x.shape
    h = 1
    while h < width:
        y = x.reshape(n, width // (2 * h), 2, h)
        x = np.concatenate((y[:, :, :1] + y[:, :, 1:], y[:, :, :1] - y[:, :, 1:]), axis=2).reshape(n, width)
        h *= 2
    return x


def bucket_keys(x: np.ndarray) -> np.ndarray:
    """The buckets of every row, TABLES x (1 + PROBES) of them: in each table its own one first."""
    width = max(2, 1 << (x.shape[1] - 1).bit_length())
    x = np.pad(x, ((0, 0), (0, width - x.shape[1]))).astype(np.float32)
    draw = np.random.default_rng([SEED, width])
    out = []
    for table in range(TABLES):
        own = np.full(len(x), table, np.int64)
        moves, costs = [], []
        for _ in range(HASHES):
            y = x
            for _ in range(3):
                y = hadamard(y * draw.choice(np.array([-1, 1], np.float32), width)) / np.float32(np.sqrt(width))
            top = np.argsort(-np.abs(y), axis=1, kind="stable")[:, : min(1 + NEXT_AXES, width)]
            value = np.take_along_axis(y, top, 1)
            axis = 2 * top + (value < 0)
            own = own * (2 * width) + axis[:, 0]
            moves = [m * (2 * width) for m in moves]
            moves += list((axis[:, 1:] - axis[:, :1]).T)
            costs += list((np.abs(value[:, :1]) - np.abs(value[:, 1:])).T)
        least = np.argsort(np.stack(costs, 1), axis=1, kind="stable")[:, :PROBES]
        out.append(np.concatenate((own[:, None], own[:, None] + np.take_along_axis(np.stack(moves, 1), least, 1)), 1))
    return np.concatenate(out, 1)


def _units(vectors: DataFrame) -> DataFrame:
    """``vec_id, digest, unit``: the SHA-256 of the unit vector, null where there is none."""
    schema = "vec_id long, digest string, unit binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [unit(v) for v in batch.column("vector").to_pylist()]
            data = [None if x is None else x.tobytes() for x in found]
            digests = [None if x is None else hashlib.sha256(x).hexdigest() for x in data]
            yield to_batch({"vec_id": batch.column("vec_id"), "digest": digests, "unit": data}, schema)

    return vectors.mapInArrow(run, schema)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, width)


def _keys(classes: DataFrame) -> DataFrame:
    """``cls, width, keys``: under which buckets a class is filed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            widths = np.array([len(x) // 8 for x in batch.column("unit").to_pylist()])
            for width in np.unique(widths).tolist():
                rows = batch.filter(pa.array(widths == width))
                for i in range(0, len(rows), ROWS_AT_ONCE):
                    some = rows.slice(i, ROWS_AT_ONCE)
                    keys = bucket_keys(_matrix(some.column("unit"), width))
                    lists = pa.FixedSizeListArray.from_arrays(pa.array(keys.ravel()), keys.shape[1]).cast(pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_arrays(
                        [some.column("cls"), pa.array([width] * len(some), pa.int32()), lists], names=["cls", "width", "keys"]
                    )

    return classes.select("cls", "unit").mapInArrow(run, "cls long, width int, keys array<long>")


def _components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest member of each member's component."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, least)
        np.minimum.at(label, b, least)
        label = label[label]
        if (label == before).all():
            return label


class _Unit:
    """Members that are compared: vectors, all their buckets, and how many rows each stands for."""

    def __init__(self, table: pa.Table) -> None:
        self.cls = table.column("cls").to_numpy()
        self.size = table.column("size").to_numpy()
        width = table.column("width")[0].as_py()
        self.x = _matrix(table.column("unit"), width)
        self.keys = table.column("keys").combine_chunks().flatten().to_numpy().reshape(len(table), TABLES, -1)
        self.key = table.column("key").to_numpy()
        self.side = table.column("side").to_numpy()

    def shares_earlier(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether two members also share a bucket before the one that they are compared in.

        Buckets of a table are taken in the order of their keys.
        """
        key, out = self.key[a], np.zeros(len(a), bool)
        for table in range(TABLES):
            one, two = self.keys[a, table], self.keys[b, table]
            for i in range(one.shape[1]):
                out |= ((two == one[:, i : i + 1]) & (one[:, i : i + 1] < key[:, None])).any(1)
        return out


def _linked(unit: _Unit, starts: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of members of the same group that are linked and are counted here."""

    def keep(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first = ~unit.shares_earlier(a, b)
        return a[first], b[first]

    sizes = np.diff(starts)
    small = np.flatnonzero(sizes <= 64)
    for size in np.unique(sizes[small]).tolist():
        one, two = np.triu_indices(size, 1)
        groups = starts[:-1][small[sizes[small] == size]]
        step = max(1, PAIRS_AT_ONCE // max(1, len(one)))
        for i in range(0, len(groups) if len(one) else 0, step):
            a = (groups[i : i + step, None] + one).ravel()
            b = (groups[i : i + step, None] + two).ravel()
            apart = unit.side[a] * unit.side[b] <= 0
            a, b = a[apart], b[apart]
            good = np.einsum("ij,ij->i", unit.x[a], unit.x[b]) >= threshold
            yield keep(a[good], b[good])
    for group in np.flatnonzero(sizes > 64).tolist():
        begin, end = int(starts[group]), int(starts[group + 1])
        for i in range(begin, end, BLOCK):
            for j in range(i, end, BLOCK):
                good = unit.x[i : min(i + BLOCK, end)] @ unit.x[j : min(j + BLOCK, end)].T >= threshold
                if i == j:
                    good = np.triu(good, 1)
                a, b = np.nonzero(good)
                a, b = a + i, b + j
                apart = unit.side[a] * unit.side[b] <= 0
                a, b = a[apart], b[apart]
                for k in range(0, len(a), PAIRS_AT_ONCE):
                    yield keep(a[k : k + PAIRS_AT_ONCE], b[k : k + PAIRS_AT_ONCE])


def _compare(entries: DataFrame, threshold: float) -> DataFrame:
    """``cls, n, root``: per comparison, how many rows a class is newly linked to, and a class of its component."""
    schema = "cls long, n long, root long"

    def compare(table: pa.Table, starts: np.ndarray) -> pa.RecordBatch:
        unit = _Unit(table)
        n, label = np.zeros(len(table), np.int64), np.arange(len(table))
        for a, b in _linked(unit, starts, threshold):
            np.add.at(n, a, unit.size[b])
            np.add.at(n, b, unit.size[a])
            root = _components(len(table), label[a], label[b])
            label = root[label]
        met = np.flatnonzero(n)
        return to_batch({"cls": pa.array(unit.cls[met]), "n": pa.array(n[met]), "root": pa.array(unit.cls[label[met]])}, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(map(len, held)) >= ROWS_AT_ONCE:
                table = pa.Table.from_batches(held)
                starts = _starts(table)
                if len(starts) > 2:  # the last group may go on in the next batch
                    yield from parts(table.slice(0, int(starts[-2])), starts[:-1])
                    held = table.slice(int(starts[-2])).to_batches()
        if held:
            table = pa.Table.from_batches(held)
            yield from parts(table, _starts(table))

    def parts(table: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        widths = table.column("width").to_numpy()[starts[:-1]]
        edges = np.concatenate(([0], np.flatnonzero(np.diff(widths)) + 1, [len(widths)]))
        for i, j in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            begin, end = int(starts[i]), int(starts[j])
            yield compare(table.slice(begin, end - begin), starts[i : j + 1] - begin)

    return entries.mapInArrow(run, schema)


_GROUP = ("width", "key", "one", "two")


def _starts(table: pa.Table) -> np.ndarray:
    """Where each comparison begins, and the end of the last."""
    columns = [table.column(c).to_numpy() for c in _GROUP]
    change = np.zeros(len(table) - 1, bool)
    for c in columns:
        change |= c[1:] != c[:-1]
    return np.concatenate(([0], np.flatnonzero(change) + 1, [len(table)]))


def _comparisons(keys: DataFrame, classes: DataFrame, piece: int) -> DataFrame:
    """One row per class and comparison that it takes part in, sorted by comparison.

    Buckets of one class are dropped before any vector moves. The members of a
    bucket of more than ``piece`` classes are dealt to pieces, and pieces ``one``
    and ``two`` meet; ``side`` is -1 and 1 for those of two different pieces, whose
    own members meet elsewhere, and 0 where a piece meets itself.
    """
    filed = keys.select("cls", "width", F.explode(F.array_distinct("keys")).alias("key"))
    counts = materialize(filed.groupBy("width", "key").agg(F.count("*").alias("members")).where("members > 1"), "buckets")
    met = lookup(filed, counts, ["width", "key"], heavy_by_count(counts, "members"), "cls").where("members IS NOT NULL")
    pieces = F.ceil(F.col("members") / F.lit(piece))
    met = met.withColumns({"pieces": pieces.cast("int"), "mine": F.pmod(F.xxhash64("cls", "key"), pieces).cast("int")})
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    met = met.select(
        "cls", "width", "key",
        F.least("mine", "other").alias("one"),
        F.greatest("mine", "other").alias("two"),
        F.signum(F.col("mine") - F.col("other")).cast("int").alias("side"),
    )
    carried = classes.select("cls", "size", "unit").join(keys.select("cls", "keys"), "cls")
    return met.join(carried, "cls").repartition(*_GROUP).sortWithinPartitions(*_GROUP)


def link_vectors(
    vectors: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id", vector_col: str = "embedding", piece: int = PIECE
) -> DataFrame:
    """``<id>, n_links, component_id, kept`` of every row.

    Two rows are linked when their cosine is at least ``threshold``. A null, empty
    or zero vector, or one with a null or non-finite component, is linked with
    nothing, and vectors of different lengths are not compared. Rows are apart
    even if ids repeat; a row without id has links, but gives no component its
    name, so its component may be null. ``kept`` is whether the id is the
    component's. An empty table gives an empty one, and further columns are
    ignored. A pair is missed if it shares no bucket; the threshold should not be
    far below 0.9. A bucket of many different vectors costs comparisons in the
    square of its size, spread over tasks of two pieces each.
    """
    rows = vectors.select(vectors[id_col].cast("long").alias("vec_id"), vectors[vector_col].cast("array<double>").alias("vector"))
    units = materialize(_units(rows), "units")
    classes = units.where("digest IS NOT NULL").groupBy("digest").agg(
        F.min("vec_id").alias("least"), F.count("*").alias("size"), F.any_value("unit").alias("unit")
    )
    classes = materialize(classes.withColumn("cls", F.monotonically_increasing_id()), "vector-classes")
    keys = materialize(_keys(classes), "vector-keys")
    compared = materialize(_compare(_comparisons(keys, classes, piece), threshold), "vector-links")
    linked = compared.groupBy("cls").agg(F.sum("n").alias("n"))
    groups = components(compared.select(F.col("cls").alias("a"), F.col("root").alias("b")))
    placed = classes.select("digest", "cls", "least", "size").join(linked, "cls", "left").join(
        groups.withColumnRenamed("node", "cls"), "cls", "left"
    ).withColumn("component", F.coalesce("component", "cls"))
    placed = materialize(placed, "placed-classes")
    names = placed.groupBy("component").agg(F.min("least").alias("component_id"), F.count("*").alias("members"))
    names = materialize(names, "component-names")
    named = lookup(placed, names, ["component"], heavy_by_count(names, "members"), "cls").select(
        "digest", "component_id", (F.coalesce("n", F.lit(0)) + F.col("size") - 1).alias("n_links"), "size"
    )
    named = materialize(named, "named-classes")
    result = lookup(units.select("vec_id", "digest"), named, ["digest"], heavy_by_count(named, "size"), "vec_id")
    component = F.when(F.col("digest").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return result.select(
        F.col("vec_id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )


def op11_cross_polytope(spark: SparkSession, folder: str) -> DataFrame:
    return link_vectors(spark.read.parquet(f"{folder}/embeddings.parquet"))


OP11_SQL = f"""
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
),
u AS (
  SELECT r, e, sqrt(list_dot_product(e, e)) AS n FROM v
  WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
links AS (
  SELECT a.r AS a, b.r AS b FROM u a JOIN u b ON a.r <> b.r AND len(a.e) = len(b.e)
  WHERE a.n > 0 AND b.n > 0 AND list_dot_product(a.e, b.e) / (a.n * b.n) >= {THRESHOLD}
),
reach AS (SELECT r AS a, r AS b FROM v UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
named AS (SELECT reach.a AS r, min(v.vec_id) AS component_id FROM reach JOIN v ON v.r = reach.b GROUP BY reach.a),
counted AS (SELECT a AS r, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(counted.n, 0) AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
FROM v JOIN named USING (r) LEFT JOIN counted USING (r)
"""
