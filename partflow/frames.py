"""Small frames made of literals; unlike frames of Python rows they need no Python worker."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _literals(schema: T.StructType, values: Mapping[str, object]):
    return [F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in schema.fields]


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows; the optimizer removes what is joined to it."""
    return spark.range(0).select(*_literals(schema, {}))


def one_row(spark: SparkSession, schema: T.StructType, values: Mapping[str, object]) -> DataFrame:
    """One row; missing values are null."""
    return spark.range(0, 1, 1, 1).select(*_literals(schema, values))


def text_column(spark: SparkSession, name: str, values: Iterable[str]) -> DataFrame:
    """One row per text."""
    texts = F.array(*[F.lit(v) for v in values])
    return spark.range(0, 1, 1, 1).select(F.explode(texts).alias(name))
