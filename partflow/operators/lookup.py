"""Joining many rows to at most one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from partflow.scratch import materialise


def join_lookup(rows: DataFrame, lookup: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join ``rows`` to ``lookup``, which has one row per key, so that a hot key is no hot task.

    A lookup straight from an aggregation has an unknown size and sits on top of
    its own shuffle; the planner then shuffles all rows by key and cannot split a
    skewed partition. Written out first, its size is known: a small one is
    broadcast and the rows are not shuffled at all, and next to a large one the
    partitions of hot keys are split at run time.
    """
    return rows.join(materialise(lookup, "lookup"), list(keys), how)
