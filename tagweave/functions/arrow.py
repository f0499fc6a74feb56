"""Arrow helpers for what has no built-in expression."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def map_distinct(tokens: pa.ListArray, fn: Callable[[str], object], out_type: pa.DataType) -> pa.Array:
    """Apply ``fn`` to the items of a list column, once per distinct item.

    The batch is dictionary-encoded first, so a word that fills a third of the
    batch is still handled once; the results are spread back by an index take.
    """
    flat = tokens.flatten()
    if isinstance(flat, pa.ChunkedArray):
        flat = flat.combine_chunks()
    encoded = flat.dictionary_encode()
    results = pa.array([None if v is None else fn(v) for v in encoded.dictionary.to_pylist()], out_type)
    values = results.take(encoded.indices)
    lengths = pc.fill_null(tokens.value_lengths(), 0).to_numpy()
    offsets = np.concatenate(([0], np.cumsum(lengths)))
    mask = tokens.is_null() if tokens.null_count else None
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values, mask=mask)


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[pa.Table]:
    """The groups of a partition that is sorted by ``keys``, one after the other.

    Only one group and one batch are held at a time, and a group costs no call
    through Spark, so there may be very many small ones.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        change = np.zeros(len(batch), bool)
        for key in keys:
            column = batch.column(key)
            change[1:] |= np.asarray(pc.not_equal(column[1:], column[:-1]))
            if held:
                change[0] |= column[0].as_py() != held[-1].column(key)[-1].as_py()
        starts = np.flatnonzero(change).tolist()
        if not starts:
            held.append(batch)
            continue
        if starts[0]:
            held.append(batch.slice(0, starts[0]))
        if held:
            yield pa.Table.from_batches(held)
        for begin, end in zip(starts, starts[1:], strict=False):
            yield pa.Table.from_batches([batch.slice(begin, end - begin)])
        held = [batch.slice(starts[-1])]
    if held:
        yield pa.Table.from_batches(held)
