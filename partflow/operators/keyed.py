"""State per key: newest, first, upsert, insert-or-ignore, delete.

All of them reduce before they shuffle (the maximum of a struct combines on the
map side), so a key that owns a third of the rows costs its task one row per
mapper.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partflow.operators.lookup import join_lookup


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[str], extreme, extra: Sequence[Column]) -> DataFrame:
    rest = [name for name in df.columns if name not in keys]
    # every column takes part in the order, after the named ones: equal ranks
    # then mean equal rows and the choice never depends on how data was split
    ranked = F.struct(*order, *[name for name in rest if name not in order])
    picked = df.groupBy(*keys).agg(extreme(ranked).alias("_row"), *extra)
    extra_names = [name for name in picked.columns if name not in (*keys, "_row")]
    return picked.select(*keys, *[F.col(f"_row.{name}").alias(name) for name in rest], *extra_names)


def newest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], *extra: Column) -> DataFrame:
    """The row with the greatest ``order`` of each key; nulls rank lowest.

    ``extra`` aggregates over all rows of the key ride along in the same shuffle.
    """
    return _pick(df, keys, order, F.max, extra)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], *extra: Column) -> DataFrame:
    """The row with the smallest ``order`` of each key."""
    return _pick(df, keys, order, F.min, extra)


def upsert(current: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Both frames as one, the later record of a key replacing the earlier."""
    both = current.unionByName(incoming, allowMissingColumns=True)
    return newest_per_key(both, keys, order)


def insert_or_ignore(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``existing`` plus the first incoming record of every key it does not hold."""
    new = first_per_key(incoming, keys, order).join(existing, list(keys), "left_anti")
    return existing.unionByName(new, allowMissingColumns=True)


def remove_keys(df: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key does not occur in ``done``."""
    return join_lookup(df, done.select(*keys).distinct(), keys, "left_anti")
