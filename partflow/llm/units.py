"""Helpers of the operators that compare rows group by group.

A group too large for one task is cut into chunks, and every pair of chunks is a unit
of its own: all pairs of the group are compared, no task gets more than two chunks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def chunk_pairs(chunk: Column, chunks: Column) -> Column:
    """Units of a row in chunk ``chunk`` of ``chunks``: structs ``ci <= cj``, and which side the row is on."""
    others = F.transform(
        F.sequence(F.lit(0), chunks - 1),
        lambda other: F.struct(
            F.least(chunk, other).cast("int").alias("ci"),
            F.greatest(chunk, other).cast("int").alias("cj"),
            (chunk > other).cast("int").alias("side"),
        ),
    )
    return others


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: Sequence[str], least: int = 1) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Whole groups of rows that arrive sorted by ``keys``: tables of ``least`` rows or more, and where their groups begin.

    Groups never straddle two tables. Only rows of the group at hand are kept between batches.
    """
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if batch.num_rows == 0:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows < 2 * least:
            continue
        whole = pa.Table.from_batches(held).combine_chunks()
        starts = _starts(whole, keys)
        last = int(starts[-1])
        if last >= least:
            yield whole.slice(0, last), starts[:-1]
            rest = whole.slice(last)
            held, rows = rest.to_batches(), rest.num_rows
        else:
            held = whole.to_batches()
    if rows:
        whole = pa.Table.from_batches(held).combine_chunks()
        yield whole, _starts(whole, keys)


def _starts(rows: pa.Table, keys: Sequence[str]) -> np.ndarray:
    new = np.zeros(rows.num_rows, bool)
    new[0] = True
    for key in keys:
        values = rows.column(key).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def forest(size: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The first row that each row is linked with, over any number of the links ``i``-``j``."""
    first = np.arange(size)
    if len(i) == 0:
        return first
    while True:
        low = np.minimum(first[i], first[j])
        new = first.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if np.array_equal(new, first):
            return first
        first = new
