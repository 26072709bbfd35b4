"""Embedding near-duplicates by an exact metric range join.

On the unit sphere a cosine of at least ``c`` is a distance of at most
``r = sqrt(2 - 2c)``. A bounded number of pivots parts the vectors of each label into
cells (nearest pivot). By the triangle inequality a vector within ``r`` of one in the
cell of pivot p is no farther than ``2r`` farther from p than from its own pivot; such
vectors are copied into that cell, to the lower-numbered pivot only, so every pair is
looked at once. Cells are then joined independently, large ones chunk by chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partflow.llm.common import materialise
from partflow.llm.graph import components
from partflow.llm.units import chunk_pairs, forest, sorted_groups

#: Pivots for all labels together; what is broadcast is this many vectors.
PIVOTS = 16
#: Vectors in a chunk of a cell.
CHUNK = 1024
#: Cosines this near the threshold are computed anew, from the vectors as they are.
_NEAR = 1e-9


def usable(vector: str):
    """Whether a vector has a direction: not null, no null or non-finite component, not all zero."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: F.coalesce(x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))
    return F.coalesce(v.isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


def _unit(m: np.ndarray) -> np.ndarray:
    m = m / np.abs(m).max(axis=1, keepdims=True)  # so that no square is lost or runs over
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def cells(classes: DataFrame, threshold: float, pivots: int = PIVOTS) -> DataFrame:
    """``label, dims, cell, core`` (whether the cell is its own) beside ``node, mult, vector``."""
    chosen = [r.vector for r in classes.orderBy(F.xxhash64("node")).select("vector").limit(pivots).collect()]
    by_dims: dict[int, np.ndarray] = {}
    for dims in {len(v) for v in chosen}:
        by_dims[dims] = _unit(np.asarray([v for v in chosen if len(v) == dims], np.float64))
    reach = 2 * np.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-6

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("dims").to_numpy()
            for dims in np.unique(sizes):
                part = batch.take(pa.array(np.flatnonzero(sizes == dims)))
                near = by_dims.get(int(dims))
                n = part.num_rows
                if near is None:
                    at, cell, core = np.arange(n), np.zeros(n, int), np.ones(n, bool)
                else:
                    gap = np.sqrt(np.maximum(0, 2 - 2 * (_unit(_matrix(part.column("vector"), int(dims))) @ near.T)))
                    own = gap.argmin(axis=1)
                    into = (gap <= gap[np.arange(n), own][:, None] + reach) & (np.arange(len(near)) < own[:, None])
                    into[np.arange(n), own] = True
                    at, cell = np.nonzero(into)
                    core = cell == own[at]
                taken = part.take(pa.array(at))
                yield pa.RecordBatch.from_arrays(
                    [*taken.columns, pa.array(cell, pa.int32()), pa.array(core)], [*taken.schema.names, "cell", "core"]
                )

    kinds = dict(classes.dtypes)
    columns = ["label", "dims", "node", "mult", "vector"]
    schema = ", ".join(f"{c} {kinds[c]}" for c in columns) + ", cell int, core boolean"
    return classes.select(*columns).mapInArrow(run, schema)


def near_classes(classes: DataFrame, threshold: float, pivots: int = PIVOTS) -> DataFrame:
    """For distinct vectors: rows ``a, b, links``. ``b`` null: a has so many linked vectors (a part of them);
    else a link of a spanning forest."""
    rows = materialise(cells(classes, threshold, pivots), "cells")
    cell = ["label", "dims", "cell"]
    sizes = rows.groupBy(*cell).agg(
        F.ceil(F.sum(F.col("core").cast("long")) / CHUNK).cast("int").alias("own"),
        F.ceil(F.sum((~F.col("core")).cast("long")) / CHUNK).cast("int").alias("guests"),
    )
    rows = rows.join(materialise(sizes, "cell-sizes"), cell)
    spread = F.xxhash64("node", F.lit(3))
    own_chunk = F.pmod(spread, F.greatest("own", F.lit(1))).cast("int")
    guest_chunk = F.pmod(spread, F.greatest("guests", F.lit(1))).cast("int")
    unit = lambda c, g, side: F.struct(c.cast("int").alias("ci"), g.cast("int").alias("cj"), side.cast("int").alias("side"))
    none = F.array().cast("array<struct<ci:int,cj:int,side:int>>")
    with_guests = F.when(
        F.col("guests") > 0,
        F.transform(F.sequence(F.lit(0), F.col("guests") - 1), lambda g: unit(own_chunk, -1 - g, F.lit(0))),
    ).otherwise(none)
    of_guests = F.when(
        F.col("own") > 0,
        F.transform(F.sequence(F.lit(0), F.col("own") - 1), lambda c: unit(c, -1 - guest_chunk, F.lit(1))),
    ).otherwise(none)
    own_pairs = chunk_pairs(own_chunk, F.greatest("own", F.lit(1)))
    units = F.when(F.col("core"), F.concat(own_pairs, with_guests)).otherwise(of_guests)
    dealt = rows.select(*cell, "node", "mult", "vector", F.explode(units).alias("u")).select(*cell, "u.ci", "u.cj", "u.side", "node", "mult", "vector")
    by = [*cell, "ci", "cj"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in sorted_groups(batches, by, 512):
            for first, last in zip(starts, np.append(starts[1:], table.num_rows)):
                if last - first > 1:
                    yield compare(table.slice(int(first), int(last - first)))

    def compare(table: pa.Table) -> pa.RecordBatch:
        raw = _matrix(table.column("vector"), table.column("dims")[0].as_py())
        node, mult = table.column("node").to_numpy(), table.column("mult").to_numpy()
        side = table.column("side").to_numpy()
        m = _unit(raw)
        if table.column("ci")[0].as_py() == table.column("cj")[0].as_py():
            a = b = np.arange(len(m))
        else:
            a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        cos = m[a] @ m[b].T
        for i, j in zip(*np.nonzero(np.abs(cos - threshold) <= _NEAR)):
            x, y = raw[a[i]], raw[b[j]]
            cos[i, j] = (x @ y) / (np.sqrt(x @ x) * np.sqrt(y @ y))
        hit = cos >= threshold
        if a is b:
            hit = np.triu(hit, 1)
        i, j = np.nonzero(hit)
        i, j = a[i], b[j]
        links = np.zeros(len(m), np.int64)
        np.add.at(links, i, mult[j])
        np.add.at(links, j, mult[i])
        to = forest(len(m), i, j)
        tree, some = np.flatnonzero(to != np.arange(len(m))), np.flatnonzero(links)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([node[tree], node[some]])),
                pa.concat_arrays([pa.array(node[to[tree]]), pa.nulls(len(some), pa.int64())]),
                pa.array(np.concatenate([np.zeros(len(tree), np.int64), links[some]])),
            ],
            ["a", "b", "links"],
        )

    return dealt.repartition(*by).sortWithinPartitions(*by).mapInArrow(run, "a long, b long, links long")


def near_vectors(rows: DataFrame, threshold: float = 0.93, pivots: int = PIVOTS, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """``key``, ``n_links``, ``component_id``, ``kept`` of every row.

    Vectors are compared only under equal labels that aren't null, and only with vectors
    of as many components. A vector that is null, empty, zero, or holds a null or
    non-finite component links with nothing: 0 links, a component of its own. Equal
    vectors are one class that is compared once; a row counts the other rows of its
    class as links. Rows that repeat a key are rows of their own; a component of null
    keys alone has a null id and is kept. Further columns are ignored; an empty table
    gives no rows.
    """
    given = rows.select(F.col(key).cast("long").alias("key"), F.col(label).alias("label"), F.col(vector).alias("vector"), (usable(vector) & F.col(label).isNotNull()).alias("ok"))
    good = given.where("ok").withColumn("dims", F.size("vector"))
    classes = good.groupBy("label", "dims", "vector").agg(F.min("key").alias("first"), F.count("*").alias("mult"))
    classes = materialise(classes.withColumn("node", F.monotonically_increasing_id()), "vector-classes")
    found = materialise(near_classes(classes, threshold, pivots), "vector-links")
    linked = components(found.where("b IS NOT NULL")).withColumnRenamed("component", "root")
    counts = materialise(found.groupBy("a").agg(F.sum("links").alias("links")).withColumnRenamed("a", "node"), "link-counts")
    of_class = classes.select("node", "first", "mult").join(linked, "node", "left").join(counts, "node", "left")
    of_class = materialise(of_class.select("node", "first", F.coalesce("root", "node").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("n_links")), "class-links")
    heads = materialise(of_class.groupBy("root").agg(F.min("first").alias("component_id")), "class-heads")
    ids = of_class.join(heads, "root").select("node", "n_links", "component_id")
    ids = materialise(classes.select("node", "label", "vector").join(ids, "node").drop("node"), "class-ids")
    good = good.select("key", "label", "vector").join(ids, ["label", "vector"]).select("key", "n_links", "component_id")
    rest = given.where("NOT ok").select("key", F.lit(0).cast("long").alias("n_links"), F.col("key").alias("component_id"))
    out = good.unionByName(rest)
    return out.select(F.col("key").alias(key), "n_links", "component_id", F.col("key").eqNullSafe(F.col("component_id")).alias("kept"))
