"""Dimension lookups that stay balanced when one key fills a third of the facts."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from tagweave.operators.rows import explode_rows
from tagweave.operators.skew import HOT_LANES, LANES, hot_keys, key_hash, skew_join, without_key
from tagweave.sources.tables import materialize

# Most rows of a dimension that are ever broadcast, its most frequent keys, and
# the longest string such a row may hold: together they bound the broadcast.
HEAVY_KEYS = 50_000
HEAVY_LENGTH = 256


def heavy_by_rank(rank: str) -> Column:
    """Keys numbered 0, 1, .. from the most frequent one: the first ``HEAVY_KEYS``."""
    return F.col(rank) < HEAVY_KEYS


def heavy_by_count(dimension: DataFrame, count: str) -> Column:
    """Keys that hold at least 1/``HEAVY_KEYS`` of all occurrences.

    There can be no more than ``HEAVY_KEYS`` of them, and every other key is
    rarer than that share.
    """
    total = dimension.agg(F.sum(count)).first()[0] or 0
    return F.col(count) * HEAVY_KEYS >= F.lit(total)


def heavy_by_most(dimension: DataFrame, count: str) -> Column:
    """The keys with the highest counts: as many as ``HEAVY_KEYS``, short of those that share the last one's count."""
    most = dimension.select(count).orderBy(F.desc_nulls_last(count)).limit(HEAVY_KEYS + 1)
    n, least = most.agg(F.count("*"), F.min(count)).first()
    return F.lit(True) if n <= HEAVY_KEYS else F.col(count) > least


def lookup(facts: DataFrame, dimension: DataFrame, on: Sequence[str], heavy: Column, spread: str) -> DataFrame:
    """Left join of ``facts`` to a written ``dimension``; hot keys never meet in one task.

    ``heavy`` selects the dimension's frequent keys, at most ``HEAVY_KEYS`` of
    them, with values of bounded length; these are broadcast. If the dimension
    has more rows, the rest is joined by shuffle, which only rows enter that have
    a key and no answer yet; the others stay out of the join and are dealt by
    ``spread`` beside it, so that the result has one set of balanced partitions.
    The hot keys among those that are joined, absent ones and very long ones, are
    found by a sketch: they spread by ``spread`` over lanes, to each of which the
    dimension sends their rows, if it has any. The facts are evaluated once.
    """
    on = list(on)
    values = [c for c in dimension.columns if c not in on]
    for field in dimension.schema.fields:
        if isinstance(field.dataType, StringType):
            heavy = heavy & (F.length(field.name) <= HEAVY_LENGTH)
    heavy = F.coalesce(heavy, F.lit(False))
    frequent = dimension.where(heavy).withColumn("_hit", F.lit(True))
    first = facts.join(F.broadcast(frequent), on, "left")
    light = dimension.where(~heavy)
    if light.isEmpty():
        return first.select(*facts.columns, *values)
    # Written once: the sketch reads the keys of what the join reads in full.
    first = materialize(first, "looked-up")
    done = F.coalesce("_hit", F.lit(False)) | without_key(on)
    key = key_hash(on)
    open_rows = first.where(~done)
    hot = key.isin(hot_keys(open_rows, on))
    # The lane is part of the shuffle key. It must be computed from the row on
    # both sides: a constant would be folded into a filter beside the join.
    own = F.pmod(key, F.lit(LANES))
    shared = F.pmod(F.xxhash64(spread), F.lit(HOT_LANES)) + LANES
    lanes = F.when(hot, F.sequence(F.lit(LANES), F.lit(LANES + HOT_LANES - 1))).otherwise(F.array(own.cast("int")))
    rest = light.select(*on, *[F.col(c).alias(f"_light_{c}") for c in values], F.explode(lanes).alias("_lane"))
    lane = F.when(hot, shared).otherwise(own).cast("int")
    joined = open_rows.select(*facts.columns).withColumn("_lane", lane).join(rest, [*on, "_lane"], "left")
    joined = joined.select(*facts.columns, *[F.col(f"_light_{c}").alias(c) for c in values], "_lane")
    apart = (F.pmod(F.xxhash64(spread), F.lit(LANES)) + LANES).cast("int")
    answered = first.where(done).select(*facts.columns, *values).withColumn("_lane", apart).repartition(*on, "_lane")
    # Dealt alike, both sides share the partitions of the join, if key and lane go only
    # afterwards; so a condition reads them that always holds and is never pushed down.
    kept = F.pmod(F.xxhash64(*on, "_lane"), F.lit(LANES)) + F.rand(0) >= 0
    return answered.unionByName(joined).where(kept).drop("_lane")


def _named(arrays: DataFrame, frequent: pa.Table) -> DataFrame:
    """``_values`` for the bigints of ``_items``: what ``_more`` has for their place, else what ``frequent`` has for them, or null."""
    keys, values = (frequent.column(c).combine_chunks() for c in ("_item", "_value"))
    fields = [f for f in arrays.schema.fields if f.name not in ("_items", "_more")]
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, more = batch.column("_items"), batch.column("_more")
            starts, begins = ([0, *np.cumsum(pc.fill_null(pc.list_value_length(c), 0).to_numpy())] for c in (lists, more))
            at = pc.fill_null(pc.index_in(lists.flatten(), value_set=keys), -1).to_numpy(zero_copy_only=False).copy()
            pairs = more.flatten()
            at[np.repeat(starts[:-1], np.diff(begins)) + pairs.field("pos").to_numpy()] = len(values) + np.arange(len(pairs))
            found = pa.concat_arrays([values, pairs.field("value")]).take(pa.array(at, mask=at < 0))
            columns = [*(batch.column(c) for c in names), pa.ListArray.from_arrays(pa.array(starts, "int32"), found)]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "_values"])

    return arrays.mapInArrow(run, StructType([*fields, StructField("_values", ArrayType(StringType()))]))


def lookup_items(
    rows: DataFrame, keep: Sequence[str], row: str, items: Column, dimension: DataFrame, on: str, value: str, heavy: Column
) -> DataFrame:
    """``keep``, ``row`` and ``_values``: for each item of an array of bigints, in order, its string in a written ``dimension``, or null.

    ``row`` numbers the rows of ``rows``, a table or narrow steps over one. Null items
    and items without a row have null; a null array counts as empty. ``heavy``
    selects the frequent items as in :func:`lookup`; they are found inside the
    arrays, which stay whole. If the dimension has more rows, only the other items
    are exploded and joined, and each row's answers return to it at once.
    """
    heavy = F.coalesce(heavy & (F.length(value) <= HEAVY_LENGTH), F.lit(False))
    pair = [F.col(on).alias("_item"), F.col(value).alias("_value")]
    frequent, light = dimension.where(heavy).select(*pair), dimension.where(~heavy).select(*pair)
    arrays = rows.select(*keep, row, items.cast("array<bigint>").alias("_items"))
    answers = "array<struct<pos:int,value:string>>"
    if light.isEmpty():
        return _named(arrays.withColumn("_more", F.lit(None).cast(answers)), frequent.toArrow())
    others = explode_rows(arrays, [row], "_items", "_item", "pos")
    others = others.join(F.broadcast(frequent.select("_item")), "_item", "left_anti")
    entry = F.struct("pos", F.col("_value").alias("value"))
    more = skew_join(others, light, ["_item"]).groupBy(row).agg(F.collect_list(entry).cast(answers).alias("_more"))
    return _named(arrays.join(more, row, "left").select(*arrays.columns, "_more"), frequent.toArrow())
