"""Small helpers the operators share."""

from __future__ import annotations

import importlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from partflow.scratch import new_dir

__all__ = ["attach", "in_batches", "in_slices", "materialise", "maybe_among", "new_dir", "numbered", "quoted", "table", "tokenizer_file"]

#: Texts handled at once by a Python task: rows, and characters, whichever comes first.
BATCH_ROWS = 256
BATCH_CHARS = 1 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def materialise(df: DataFrame, label: str, codec: str = "snappy") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: work runs once and outlives executors."""
    path = new_dir(df.sparkSession, label)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tokenizer_file(name: str) -> str:
    """Place of a public tokenizer's file on this machine; asked for where it is used, on the executor."""
    return importlib.import_module("public_tokenizers").path(name)


def in_batches(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of the batches, of bounded rows and characters, with their texts (null: empty)."""
    for part in in_slices(batches, column):
        yield part, [t or "" for t in part.column(column).to_pylist()]


def in_slices(batches: Iterator[pa.RecordBatch], column: str = "text", rows: int = BATCH_ROWS, chars: int = BATCH_CHARS) -> Iterator[pa.RecordBatch]:
    """Slices of the batches, of bounded rows and bytes of text.

    A single text above the bound is a slice of its own; no text is cut.
    """
    for batch in batches:
        texts = batch.column(column)
        lengths = pc.binary_length(texts).to_pylist()
        start = size = 0
        for i, length in enumerate(lengths):
            length = length or 0
            if i > start and (i - start >= rows or size + length > chars):
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += length
        if len(lengths) > start:
            yield batch.slice(start, len(lengths) - start)


def attach(rows: DataFrame, found: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join that also matches null keys; both sides should be tables that were written out, so that hot keys are split."""
    other = found.select(*[F.col(k).alias(f"__{k}") for k in keys], *[c for c in found.columns if c not in keys])
    same = None
    for k in keys:
        one = rows[k].eqNullSafe(other[f"__{k}"])
        same = one if same is None else same & one
    return rows.join(other, same, "left").drop(*[f"__{k}" for k in keys])


def quoted(columns: Sequence[str]) -> list[Column]:
    """Columns by their exact names, also those with dots or backticks."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in columns]


#: Largest bitmap of :func:`maybe_among`, in bits (16 MB).
BITMAP_BITS = 1 << 27


def maybe_among(keys: DataFrame, key: str) -> Callable[[Column], Column]:
    """A test for columns of numbers: false only for those that are not among ``keys``.

    The numbers set bits of a broadcast bitmap of bounded size, about one in sixteen at
    best; with so many keys that it fills up, more and more others pass. What passes has
    to be joined with ``keys``, the rest of a wide table needs no shuffle.
    """
    spark, wanted = keys.sparkSession, 1 << 16
    count = keys.count()
    while wanted < min(16 * count, BITMAP_BITS):
        wanted *= 2
    words = wanted // 64
    places = keys.select(F.xxhash64(F.col(key).cast("long"), F.lit(3)).alias("h"))
    bit = F.expr("shiftleft(1L, cast(shiftrightunsigned(h, 58) as int))")
    # a row for each 64 bits of the bitmap at most
    found = places.select(F.pmod("h", F.lit(words)).alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    bitmap = np.zeros(words, np.uint64)
    bitmap[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    shared = spark.sparkContext.broadcast(bitmap)

    @F.pandas_udf("boolean")
    def held(h: pd.Series) -> pd.Series:
        numbers = h.to_numpy()
        word = shared.value[numbers % words]
        return pd.Series((word >> (numbers.view(np.uint64) >> np.uint64(58)) & np.uint64(1)).astype(bool))

    return lambda column: held(F.xxhash64(column.cast("long"), F.lit(3)))


def numbered(docs: DataFrame) -> DataFrame:
    """The same rows with columns ``c0``, ``c1``, ...: what Python functions get, as some names can't be referred to there."""
    return docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
