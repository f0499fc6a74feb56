"""Hot keys, found by a sketch, and a join of two large tables that stays balanced with them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key is hot if it holds at least 1/``HOT_SHARE`` of the rows. A sketch of
# ``TRACKED`` keys errs by less than a quarter of that share.
HOT_SHARE = 2_000
TRACKED = 16_384
# Tasks that combine the sketches of all partitions before one combines theirs.
SKETCH_TASKS = 64
# Shuffle lanes over which the rows of hot keys are spread, and those of all others.
HOT_LANES = 64
LANES = 4096


def key_hash(on: Sequence[str]) -> Column:
    return F.xxhash64(*on)


def without_key(on: Sequence[str]) -> Column:
    missing = F.lit(False)
    for key in on:
        missing = missing | F.col(key).isNull()
    return missing


def frequent_keys(rows: DataFrame, on: Sequence[str]) -> tuple[dict[int, int], int]:
    """Hashes of the keys that hold at least 1/``HOT_SHARE`` of the rows that have a key, with their counts, and all such rows.

    One pass over the key columns with a frequent-items sketch per partition; no
    aggregate over all keys, and at most ``HOT_SHARE`` numbers reach the driver.
    Two keys with one hash would only be spread together.
    """
    keys = rows.where(~without_key(on)).select(key_hash(on).alias("_key"))
    parts = keys.groupBy(F.pmod(F.spark_partition_id(), F.lit(SKETCH_TASKS)).alias("_part")).agg(
        F.expr(f"approx_top_k_accumulate(_key, {TRACKED})").alias("_sketch"), F.count("*").alias("_n")
    )
    # Grouped, so that no rows give no sketch rather than an unusable one.
    whole = parts.groupBy(F.lit(0).alias("_all")).agg(
        F.expr(f"approx_top_k_combine(_sketch, {TRACKED})").alias("_sketch"), F.sum("_n").alias("_n")
    )
    found = whole.select(F.expr(f"approx_top_k_estimate(_sketch, {HOT_SHARE})").alias("_top"), "_n").first()
    if found is None:
        return {}, 0
    return {x["item"]: x["count"] for x in found["_top"] if x["count"] * HOT_SHARE >= found["_n"]}, found["_n"]


def hot_keys(rows: DataFrame, on: Sequence[str]) -> list[int]:
    return list(frequent_keys(rows, on)[0])


def _in_lanes(rows: DataFrame, on: Sequence[str], spread: list[int], replicated: list[int]) -> DataFrame:
    """Add ``_lane``: one lane for rows of ``spread`` keys, all lanes for those of ``replicated`` keys.

    The lane must be computed from the row: a constant would be folded into a
    filter beside the join.
    """
    key = key_hash(on)
    own = F.pmod(key, F.lit(LANES)).cast("int")
    shared = (F.pmod(F.monotonically_increasing_id(), F.lit(HOT_LANES)) + LANES).cast("int")
    lane = F.when(without_key(on) | key.isin(spread), shared).otherwise(own)
    if not replicated:
        return rows.withColumn("_lane", lane)
    everywhere = F.sequence(F.lit(LANES), F.lit(LANES + HOT_LANES - 1))
    return rows.withColumn("_lane", F.explode(F.when(key.isin(replicated), everywhere).otherwise(F.array(lane))))


def skew_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner", right_unique: bool = False) -> DataFrame:
    """``left.join(right, on, how)`` for ``inner`` and ``left``, balanced without adaptive execution.

    A key is hot if one side holds it in 1/``HOT_SHARE`` of the rows of the larger
    side. Its rows are dealt to lanes on the side that has more of them, in a left
    join always on the left, and only this key's rows on the other side are sent
    to every lane. Rows without a key match nothing; a left join keeps each of
    them, dealt to lanes. Rows are dealt by their place, so both sides should be
    tables, or narrow steps over tables.
    """
    if how not in ("inner", "left"):
        raise ValueError("how: inner or left")
    on = list(on)
    counted_left, n_left = frequent_keys(left, on)
    hot_left, hot_right = list(counted_left), []
    if how == "inner":
        left = left.where(~without_key(on))
        counted_right, n_right = ({}, 0) if right_unique else frequent_keys(right, on)
        least = max(n_left, n_right) / HOT_SHARE
        hot_left = [k for k, n in counted_left.items() if n >= max(least, counted_right.get(k, 0))]
        hot_right = [k for k, n in counted_right.items() if n >= least and k not in set(hot_left)]
    dealt = _in_lanes(left, on, hot_left, hot_right)
    met = _in_lanes(right.where(~without_key(on)), on, hot_right, hot_left)
    return dealt.join(met, [*on, "_lane"], how).drop("_lane")


def row_number_of_keyless(on: Sequence[str]) -> Column:
    """A number of its own for every row without a key, null for the others.

    Grouping by it as well keeps rows without a key apart, and spreads them.
    """
    return F.when(without_key(on), F.monotonically_increasing_id())
