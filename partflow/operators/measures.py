"""Accounting measures against an authority, and their correction.

One row per key on either side. Authority values may arrive as numeric texts; an
absent one counts as zero, one that is no number never matches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partflow.functions.text import joined_messages, whole_number

# The measures the authority publishes.
MEASURES = ("treasury", "reserves", "fees", "deposits_stake")


def _authority_value(name: str) -> Column:
    raw = F.col(name)
    return F.when(raw.isNull(), F.lit(0)).otherwise(whole_number(raw.cast("string")))


def _beside(export: DataFrame, authority: DataFrame, key: str, measures: Sequence[str]) -> DataFrame:
    """Export rows with ``_authority``, a struct of the measures, null when absent."""
    values = F.struct(*[_authority_value(name).alias(name) for name in measures])
    return export.join(authority.select(key, values.alias("_authority")), key, "left")


def compare_measures(
    export: DataFrame, authority: DataFrame, key: str, measures: Sequence[str] = MEASURES
) -> DataFrame:
    """One row per key and measure: both values, whether they match, whether there is an authority."""
    pairs = F.array(
        *[
            F.struct(
                F.lit(name).alias("field"),
                F.col(name).cast("bigint").alias("parquet"),
                F.col(f"_authority.{name}").alias("authority"),
            )
            for name in measures
        ]
    )
    available = F.col("_authority").isNotNull()
    return (
        _beside(export, authority, key, measures)
        .select(key, available.alias("authority_available"), F.explode(pairs).alias("pair"))
        .select(
            key,
            "pair.*",
            "authority_available",
            (F.col("authority_available") & F.col("pair.parquet").eqNullSafe(F.col("pair.authority"))).alias(
                "is_match"
            ),
        )
    )


def _expected_share(pot: str) -> Column:
    """The pot without its treasury fifth, which is rounded down; exact on integers."""
    return F.expr(f"`{pot}` - `{pot}` div 5")


def check_split(rows: DataFrame, pot: str = "rewards_pot", share: str = "pool_rewards_pot") -> DataFrame:
    """Rows with a positive pot, with ``expected_pool`` and ``is_match``."""
    return (
        rows.where(F.col(pot) > 0)
        .withColumn("expected_pool", _expected_share(pot))
        .withColumn("is_match", F.col(share).eqNullSafe(F.col("expected_pool")))
    )


def measure_report(
    export: DataFrame, authority: DataFrame, key: str, measures: Sequence[str] = MEASURES
) -> DataFrame:
    """One row per key: ``authority_available``, ``all_pass`` and the mismatch text.

    ``export`` also carries the pot and its pool share. Without an authority row
    nothing else is checked and the key does not pass.
    """
    available = F.col("_authority").isNotNull()
    expected = _expected_share("rewards_pot")
    differs = {name: ~F.col(name).cast("bigint").eqNullSafe(F.col(f"_authority.{name}")) for name in measures}
    bad_split = F.coalesce(F.col("rewards_pot") > 0, F.lit(False)) & ~F.col("pool_rewards_pot").eqNullSafe(expected)
    # decided on the values, so that a filter on it need not build the texts
    all_pass = available & ~bad_split
    for difference in differs.values():
        all_pass = all_pass & ~difference

    def shown(value: Column) -> Column:
        return F.coalesce(value.cast("string"), F.lit("null"))

    def pair(first: str, one: Column, second: str, other: Column) -> Column:
        return F.concat(F.lit(first), shown(one), F.lit(second), shown(other))

    texts = [
        F.when(differs[name], pair(f"{name}: parquet=", F.col(name), " authority=", F.col(f"_authority.{name}")))
        for name in measures
    ]
    texts.append(F.when(bad_split, pair("pool_ratio: got=", F.col("pool_rewards_pot"), " expected=", expected)))
    details = F.when(~available, "authority unavailable").otherwise(joined_messages(*texts, separator=", "))
    return _beside(export, authority, key, measures).select(
        key, available.alias("authority_available"), all_pass.alias("all_pass"), details.alias("error_details")
    )


def correct_measures(
    export: DataFrame, authority: DataFrame, key: str, measures: Sequence[str] = MEASURES
) -> DataFrame:
    """Export rows with the authority's measures; types, column order and the rest stay."""
    types = {field.name: field.dataType for field in export.schema.fields}
    corrected = {
        name: F.coalesce(F.col(f"_authority.{name}"), F.lit(0)).cast(types[name]) for name in measures
    }
    return _beside(export, authority, key, measures).withColumns(corrected).select(*export.columns)


def wrong_rows(
    export: DataFrame, authority: DataFrame, key: str, measures: Sequence[str] = MEASURES
) -> DataFrame:
    """Export rows that the authority knows with other measures; its missing ones are zero."""
    differs = F.lit(False)
    for name in measures:
        differs = differs | ~F.col(name).cast("bigint").eqNullSafe(F.coalesce(F.col(f"_authority.{name}"), F.lit(0)))
    return _beside(export, authority, key, measures).where(F.col("_authority").isNotNull() & differs).select(*export.columns)


def correct_known_measures(
    export: DataFrame, authority: DataFrame, key: str, measures: Sequence[str] = MEASURES
) -> DataFrame:
    """Like :func:`correct_measures`, but rows the authority does not know stay as they are."""
    types = {field.name: field.dataType for field in export.schema.fields}
    known = F.col("_authority").isNotNull()
    corrected = {
        name: F.when(known, F.coalesce(F.col(f"_authority.{name}"), F.lit(0))).otherwise(F.col(name)).cast(types[name])
        for name in measures
    }
    return _beside(export, authority, key, measures).withColumns(corrected).select(*export.columns)
