"""Exploding computed arrays without computing them twice."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_rows(
    rows: DataFrame,
    keep: Sequence[str],
    array: str | Column,
    item: str,
    position: str | None = None,
    outer: bool = False,
) -> DataFrame:
    """``keep`` and one row per item of ``array``, whose items are never null.

    A plain explode lets the optimizer infer the filter ``size(array) > 0`` and
    push it to the scan, where the whole expression behind a computed array runs
    again, twice. The outer form infers nothing; the rows of empty arrays are
    dropped afterwards unless ``outer``.
    """
    if position is None:
        exploded = rows.select(*keep, F.explode_outer(array).alias(item))
    else:
        exploded = rows.select(*keep, F.posexplode_outer(array).alias(position, item))
    return exploded if outer else exploded.where(F.col(item).isNotNull())
