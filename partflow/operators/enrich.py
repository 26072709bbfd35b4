"""Facts widened by a looked-up profile."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partflow.operators.keyed import newest_per_key
from partflow.operators.lookup import join_lookup
from partflow.spec import EPOCH


def enrich(fact: DataFrame, profile: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """``fact`` with ``columns`` of its profile row appended, null where there is none.

    The profile is reduced to one row per key first, so the number of fact rows
    never changes. There is no broadcast hint because profiles grow with the
    data; see ``join_lookup`` for how the join adapts to the measured size.
    """
    lookup = newest_per_key(profile.select(key, *columns), [key], [])
    return join_lookup(fact, lookup, [key]).select(*fact.columns, *columns)


def match_counts(enriched: DataFrame, partition: Column, name: str) -> DataFrame:
    """Rows per partition with and without a profile name.

    A profile row without a name counts as unmatched.
    """
    total, matched = F.count(F.lit(1)), F.count(name)
    return enriched.groupBy(partition.alias("partition_value")).agg(
        total.alias("total"), matched.alias("matched"), (total - matched).alias("unmatched")
    )


@dataclass(frozen=True)
class Enrichment:
    """A derived dataset: a name, the source it widens, and how.

    ``transform`` gets the rows of all pending partitions at once.
    """

    name: str
    source: str
    transform: Callable[[DataFrame], DataFrame]
    partition_type: str = EPOCH
