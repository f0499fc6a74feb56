"""The rows with the largest values, without sorting the others."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bits of the value that one histogram opens: at most 4,096 counts reach the driver.
STEP_BITS = 12


def least_of_top(rows: DataFrame, value: str, k: int) -> int | None:
    """The ``k``-th largest of a column of positive longs; None if there are fewer rows.

    A histogram by magnitude finds the bucket in which the k-th largest lies;
    only this one is opened further, some bits at a time. Every pass reads one
    column and shuffles a few counts, so ``rows`` should be a written table.
    """

    def boundary(counts: DataFrame, wanted: int) -> tuple[int, int] | None:
        """The bucket that holds the wanted row from above, and how many of its rows are wanted."""
        for bucket, n in sorted(map(tuple, counts.collect()), reverse=True):
            if n >= wanted:
                return bucket, wanted
            wanted -= n
        return None

    column = F.col(value)
    found = boundary(rows.where(column.isNotNull()).groupBy(F.length(F.bin(column)).alias("bits")).agg(F.count("*")), k)
    if found is None:
        return None
    bits, wanted = found
    low, shift = 1 << (bits - 1), bits - 1
    while shift:
        width, shift = 1 << shift, max(0, shift - STEP_BITS)
        inside = rows.where((column >= low) & (column - low < width))
        bucket, wanted = boundary(inside.groupBy(F.shiftright(column - low, shift).alias("bucket")).agg(F.count("*")), wanted)
        low += bucket << shift
    return low


def top_rows(rows: DataFrame, value: str, k: int) -> DataFrame:
    """The rows whose value is among the ``k`` largest, with all that tie with the last of them."""
    least = least_of_top(rows, value, k)
    return rows if least is None else rows.where(F.col(value) >= least)
