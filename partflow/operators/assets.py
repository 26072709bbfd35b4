"""Cleaning of asset snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the category a meme token must not claim.
STABLECOIN = "Stablecoin"


def clean_assets(assets: DataFrame, stablecoin: str = STABLECOIN) -> DataFrame:
    """Assets (``ticker``, ``name``, ``category``, ``is_meme``) without false stablecoins.

    A missing or empty ticker falls back to the name.
    """
    false_claim = F.coalesce(F.col("is_meme") & (F.col("category") == stablecoin), F.lit(False))
    ticker = F.coalesce(F.nullif("ticker", F.lit("")), F.col("name"))
    return assets.where(~false_claim).withColumn("ticker", ticker)
