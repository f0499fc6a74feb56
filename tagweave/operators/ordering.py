"""Dense 0-based positions under a total order, without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagweave.sources.tables import materialize

# ``monotonically_increasing_id`` keeps the partition number above this bit.
_PARTITION_BITS = 33


def ordered_index(
    df: DataFrame,
    order: Sequence[Column],
    name: str,
    by: Sequence[str] = (),
    dtype: str = "int",
) -> DataFrame:
    """Add ``name``: the row's position within its ``by`` group under ``order``.

    The rows are sorted by range over the whole cluster, so a group that holds
    most of the rows spans many partitions. Each row gets its place inside its
    partition in the same pass; the table is written once, and only one small
    row per (group, partition) is needed to turn places into positions. ``order``
    must be total within a group, which makes the result independent of the
    range bounds.
    """
    by = list(by)
    width = F.lit(1 << _PARTITION_BITS)
    placed = materialize(
        df.orderBy(*by, *order).withColumn("_place", F.monotonically_increasing_id()), name
    ).withColumns(
        {
            "_part": F.floor(F.col("_place") / width).cast("int"),
            "_row": F.pmod(F.col("_place"), width),
        }
    )
    keys = [*by, "_part"]
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = (
        placed.groupBy(*keys)
        .agg(F.count("*").alias("_rows"), F.min("_row").alias("_first"))
        .withColumn("_base", F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first"))
        .select(*[F.col(k).alias(f"_of_{k}") for k in keys], "_base")
    )
    if not by:
        # One row per partition of the sort: at most spark.sql.shuffle.partitions.
        pieces = F.broadcast(pieces)
    condition = F.col("_part") == F.col("_of__part")
    for k in by:
        condition = condition & F.col(k).eqNullSafe(F.col(f"_of_{k}"))
    return placed.join(pieces, condition).select(
        *df.columns, (F.col("_row") + F.col("_base")).cast(dtype).alias(name)
    )
