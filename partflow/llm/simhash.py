"""SimHash near-duplicates: fingerprints, and links found by bit-sliced comparison.

Pairs within ``radius`` bits agree in all but ``radius`` of the strips that 64 bits are
cut into, so fingerprints are put in one bucket per choice of the other strips. Within
a bucket bits lie in planes: one machine word holds one bit of 64 fingerprints. Each
plane updates the distances of all of them at once through bitwise carry-save counters,
and words whose 64 distances all exceed the radius are left out from then on.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partflow.llm.common import in_batches, materialise
from partflow.llm.graph import components
from partflow.llm.units import chunk_pairs, forest, sorted_groups

SEED = 42
#: Fingerprints in a chunk of a bucket that is compared chunk by chunk.
CHUNK = 1024
#: Rows that small buckets are put together to.
TILE = 512
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: str, width: int = 3) -> int:
    """The fingerprint of a whole text, as the module's docstring of the query contract says."""
    words = text.encode().lower().split()  # of bytes: A-Z only, and \x20 \x09-\x0D
    if not words:
        return 0
    shingles = [words] if len(words) < width else zip(*(words[i:] for i in range(width)))
    joined, digest = b" ".join, xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined(s), SEED) for s in shingles), np.uint64)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3) -> DataFrame:
    """``key`` and ``fp`` (the fingerprint as a signed long) of every row; null and wordless texts have 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in in_batches(batches):
            found = np.fromiter((fingerprint(t, width) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(found.view(np.int64))], ["key", "fp"])

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "key long, fp long").withColumnRenamed("key", key)


def strip_masks(n: int, radius: int) -> list[int]:
    """The bits of each bucket key: as few choices of strips as keep buckets of ``n`` random fingerprints small."""
    for strips in range(radius + 1, 65):
        width = 64 * (strips - radius) // strips
        if n >> width <= TILE or comb(strips + 1, radius) > 40:
            break
    edges = [64 * i // strips for i in range(strips + 1)]
    parts = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    return [sum(chosen) for chosen in itertools.combinations(parts, strips - radius)]


def near_pairs(fps: np.ndarray, allowed: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows ``i``, ``j`` with ``allowed[i, j]`` whose fingerprints differ in ``radius`` bits or fewer."""
    n = len(fps)
    words = -(-n // 64)
    bits = (fps[None, :] >> np.arange(64, dtype=np.uint64)[:, None]) & np.uint64(1)
    planes = np.zeros((64, words * 64), np.uint8)
    planes[:, :n] = bits
    planes = np.packbits(planes, axis=1, bitorder="little").view(np.uint64)
    shut = np.ones((n, words * 64), bool)
    shut[:, :n] = ~allowed
    over = np.packbits(shut, axis=1, bitorder="little").view(np.uint64)
    digits = radius.bit_length()
    begin = (1 << digits) - 1 - radius  # so that a counter runs over beyond the radius
    counters = [np.full(over.shape, _ALL if begin >> d & 1 else 0, np.uint64) for d in range(digits)]
    rows, cols = np.arange(n), np.arange(words)
    for plane in range(64):
        if plane % 8 == 0:
            open_ = over != _ALL
            live_rows, live_cols = open_.any(axis=1), open_.any(axis=0)
            if not live_rows.any():
                return np.zeros(0, np.int64), np.zeros(0, np.int64)
            if live_rows.mean() < 0.8 or live_cols.mean() < 0.8:
                at = np.ix_(live_rows, live_cols)
                over, counters = over[at], [c[at] for c in counters]
                rows, cols = rows[live_rows], cols[live_cols]
        own = np.where(bits[plane, rows] == 1, _ALL, np.uint64(0))
        carry = planes[plane, cols][None, :] ^ own[:, None]
        for c in counters:
            c ^= carry  # the sum bit; where it is 0 now and the carry came, it carries on
            carry &= ~c
        over |= carry
    hit = np.unpackbits((~over).view(np.uint8), axis=1, bitorder="little").astype(bool)
    i, j = np.nonzero(hit)
    return rows[i], cols[j // 64] * 64 + j % 64


def links_within(distinct: DataFrame, radius: int = 3, n: int | None = None) -> DataFrame:
    """Links that join what distinct ``fp`` (long) within ``radius`` bits join: ``a``, ``b``.

    Of the pairs found in a unit only a spanning forest is given on, so a group of any
    size gives no more links than it has members times the units it is in.
    """
    n = distinct.count() if n is None else n
    signed = [m - (1 << 64) if m >> 63 else m for m in strip_masks(n, radius)]
    keys = F.array(*[F.struct(F.lit(k).alias("choice"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for k, m in enumerate(signed)])
    rows = distinct.select("fp", F.explode(keys).alias("k")).select("fp", "k.choice", "k.key")
    sizes = rows.groupBy("choice", "key").agg(F.count("*").alias("size"))
    large = materialise(sizes.where(F.col("size") > CHUNK).select("choice", "key", F.ceil(F.col("size") / CHUNK).cast("int").alias("chunks")), "buckets")
    rows = rows.join(large, ["choice", "key"], "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    chunk = F.pmod(F.xxhash64("fp", F.lit(7)), F.col("chunks")).cast("int")
    units = rows.select("choice", "key", "fp", F.explode(chunk_pairs(chunk, F.col("chunks"))).alias("u")).select("choice", "key", "u.ci", "u.cj", "u.side", "fp")
    by = ["choice", "key", "ci", "cj"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, starts in sorted_groups(batches, by, TILE):
            ends = np.append(starts[1:], rows.num_rows)
            fps = rows.column("fp").to_numpy().view(np.uint64)
            side, two = rows.column("side").to_numpy(), rows.column("ci").to_numpy() != rows.column("cj").to_numpy()
            first = 0
            while first < len(starts):
                last = first + 1
                while last < len(starts) and ends[last] - starts[first] <= TILE:
                    last += 1
                a, b = int(starts[first]), int(ends[last - 1])
                if b - a > last - first:  # else every bucket has a single member
                    yield compare(fps[a:b], np.repeat(np.arange(last - first), ends[first:last] - starts[first:last]), side[a:b], two[a:b])
                first = last

    def compare(fps: np.ndarray, unit: np.ndarray, side: np.ndarray, two: np.ndarray) -> pa.RecordBatch:
        allowed = np.triu(unit[:, None] == unit[None, :], 1)
        if two.any():
            allowed &= ~two[:, None] | (side[:, None] != side[None, :])
        to = forest(len(fps), *near_pairs(fps, allowed, radius))
        linked = np.flatnonzero(to != np.arange(len(fps)))
        ends = [pa.array(fps[x].view(np.int64)) for x in (linked, to[linked])]
        return pa.RecordBatch.from_arrays(ends, ["a", "b"])

    return units.repartition(*by).sortWithinPartitions(*by, "fp").mapInArrow(run, "a long, b long")


def simhash_groups(docs: DataFrame, radius: int = 3, width: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``fingerprint`` (16 hex digits), ``component_id`` (smallest key reachable over links) of every row.

    Null and wordless texts have fingerprint zero, which links like any other. Rows that
    repeat a key are rows of their own; a null key is kept, and a component of null keys
    alone has a null id. Further columns are ignored; an empty table gives no rows.
    """
    prints = materialise(fingerprints(docs, key, text, width).select(F.col(key).alias("key"), "fp"), "fingerprints")
    rooted = _rooted(prints, radius)
    heads = materialise(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "print-heads")
    ids = materialise(rooted.join(heads, "root").select("fp", "component_id"), "print-components")
    text_of = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return prints.join(ids, "fp").select(F.col("key").alias(key), text_of.alias("fingerprint"), "component_id")


def _rooted(prints: DataFrame, radius: int) -> DataFrame:
    """``fp, first, root`` of the different fingerprints: their smallest key, and the fingerprint that stands for their component."""
    classes = materialise(prints.groupBy("fp").agg(F.min("key").alias("first")), "distinct-prints")
    linked = components(links_within(classes.select("fp"), radius)).select(F.col("node").alias("fp"), "component")
    return materialise(classes.join(linked, "fp", "left").select("fp", "first", F.coalesce("component", "fp").alias("root")), "rooted-prints")


def drop_near_duplicates(docs: DataFrame, radius: int = 3, width: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component, with all its columns: that with the smallest key.

    Components are those of :func:`simhash_groups`; null keys come last, and of rows with
    equal keys one stays.
    """
    # read back once written, the numbers of rows are fixed
    marked = docs.select(F.struct(*docs.columns).alias("row"), F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    marked = marked.withColumn("at", F.monotonically_increasing_id())
    schema = T.StructType([marked.schema["row"], marked.schema["key"], marked.schema["at"], T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in in_batches(batches):
            found = np.fromiter((fingerprint(t, width) for t in texts), np.uint64, len(texts))
            arrays = [batch.column("row"), batch.column("key"), batch.column("at"), pa.array(found.view(np.int64))]
            yield pa.RecordBatch.from_arrays(arrays, ["row", "key", "at", "fp"])

    rows = materialise(marked.mapInArrow(run, schema), "fingerprinted", "zstd")
    roots = _rooted(rows.select("key", "fp"), radius).select("fp", "root")
    of_row = rows.select("key", "at", "fp").join(roots, "fp")
    first = F.min(F.struct(F.col("key").isNull().alias("no_key"), "key", "at")).alias("first")
    kept = materialise(of_row.groupBy("root").agg(first).select("first.at"), "kept-rows")
    # the kept rows are about as many as the rows: a broadcast could only ever work on small
    # tables, so the join is a merge at every size
    return rows.join(kept.hint("merge"), "at", "left_semi").select("row.*")
