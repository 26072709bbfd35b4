"""Near copies by the Jaccard similarity of their five-word shingles, found by SimHash and verified exactly.

Equal sets of shingles are one class. Classes that agree in a band of their min-hashes are
candidates of each other; what candidates join, directly or over others, comes together.
There the SimHash fingerprints of the sets are compared bit-sliced, as in ``simhash`` but
with a radius wide enough for the similarity, and the pairs within it are compared in
full. A pair at the threshold is missed if all bands differ, which at 0.8 has a probability
of 5 in 100,000, or if its fingerprints differ in more than ``RADIUS`` bits, whose
probability is a tenth of that (as large for sets of few shingles); above 0.8 both fall.

A large group is cut into chunks. Each chunk is compared within itself and with one member
of the group, its leader. What is joined to the leader needs no comparison across chunks
with its like; only the members that are not are compared with all the others. So a large
group of copies costs one pass over its texts, whatever its size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partflow.llm.common import in_batches, materialise, maybe_among, quoted
from partflow.llm.graph import components
from partflow.llm.simhash import near_pairs
from partflow.llm.units import forest, sorted_groups

WIDTH = 5
SIMILARITY = 0.8
#: Bands of min-hashes, and min-hashes in a band.
BANDS, DEPTH = 25, 5
#: Bits in which the fingerprints of similar sets differ at most.
RADIUS = 24
#: Texts in a chunk of a group that is compared chunk by chunk.
CHUNK = 512
_AT_ONCE = 1 << 13
_ODD = np.random.default_rng(42).integers(0, 2**63, BANDS * DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = np.random.default_rng(43).integers(0, 2**63, max(WIDTH, DEPTH) + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX[-1]
    return h ^ (h >> np.uint64(29))


def shingles(text: str, width: int = WIDTH) -> np.ndarray:
    """The different shingles of a text as sorted 64-bit hashes; fewer words are one shingle, none give none."""
    words = text.encode().lower().split()  # as in simhash.fingerprint
    digest = xxhash.xxh3_64_intdigest
    h = np.fromiter(map(digest, words), np.uint64, len(words))
    if len(h) < width:
        return np.array([digest(b" ".join(words))], np.uint64) if words else h
    out = np.zeros(len(h) - width + 1, np.uint64)
    for i in range(width):
        out = _mixed(out + h[i : len(h) - width + 1 + i] * _MIX[i])
    return np.unique(out)


def bands(found: np.ndarray) -> np.ndarray:
    """One number for each band of the min-hashes of a set."""
    least = np.full(len(_ODD), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), _AT_ONCE):
        h = found[at : at + _AT_ONCE, None] * _ODD[None, :]
        least = np.minimum(least, ((h ^ (h >> np.uint64(31))) * _MIX[0]).min(axis=0))
    out = np.arange(BANDS, dtype=np.uint64)
    for one in least.reshape(BANDS, DEPTH).T:
        out = _mixed(out + one * _MIX[1])
    return out


def sketch(found: np.ndarray) -> int:
    """SimHash fingerprint of a set of hashes."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(found), 1 << 16):
        bits = np.unpackbits(found[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(found), bitorder="little").view(np.uint64)[0])


def similar_links(sets: list[np.ndarray], part: np.ndarray, similarity: float = SIMILARITY) -> list[tuple[int, int]]:
    """Pairs of sets that join what the pairs of ``similarity`` or more join.

    ``part`` is 0 or 1 for each set if only pairs across are asked for, and -1 otherwise.
    """
    sizes = np.array([len(s) for s in sets])
    fps = np.array([sketch(s) for s in sets], np.uint64)
    least, most = np.minimum.outer(sizes, sizes), np.maximum.outer(sizes, sizes)
    allowed = np.triu(least >= similarity * most - 1e-9, 1)
    allowed &= (part[:, None] < 0) | (part[:, None] != part[None, :])
    root = np.arange(len(sets))
    links = []
    first, second = near_pairs(fps, allowed, RADIUS)
    order = np.lexsort((second, first))
    first, second = first[order], second[order]
    begin = np.flatnonzero(np.diff(first, prepend=-1))
    for a, b in zip(begin.tolist(), [*begin[1:].tolist(), len(first)]):
        i = int(first[a])
        for j in second[a:b][root[second[a:b]] != root[i]].tolist():
            if root[i] == root[j]:
                continue
            both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if both >= similarity * (sizes[i] + sizes[j] - both) - 1e-9:
                links.append((i, j))
                root[root == root[j]] = root[i]
    return links


def _candidates(classes: DataFrame) -> DataFrame:
    """``set, component`` of the classes that share a band with another one."""
    banded = classes.select("set", F.explode("bands").alias("band"))
    low = banded.groupBy("band").agg(F.min("set").alias("low"), F.max("set").alias("high")).where("low < high").select("band", "low")
    low = materialise(low, "bands")
    return components(banded.join(low, "band").where("set <> low"), "set", "low").withColumnRenamed("node", "set")


def _units(rows: DataFrame, by: list[str], compare, schema: str) -> DataFrame:
    """What ``compare`` finds in each group of rows, given as columns; groups are tasks of their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in sorted_groups(batches, by):
            for start, end in zip(starts.tolist(), [*starts[1:].tolist(), table.num_rows]):
                if end - start > 1:
                    yield compare(table.slice(start, end - start))

    return rows.repartition(*by).sortWithinPartitions(*by, "set").mapInArrow(run, schema)


def _links(ids: np.ndarray, found: list[tuple[int, int]]) -> list[pa.Array]:
    return [pa.array(ids[np.array([p[k] for p in found], np.int64)], pa.int64()) for k in (0, 1)]


def _verified(texts: DataFrame, width: int, similarity: float) -> DataFrame:
    """Links ``a, b`` that join what similar texts join within a component; ``texts`` (written) has ``set, component, text``."""
    sizes = texts.groupBy("component").agg(F.count("*").alias("size"), F.min("set").alias("leader"))
    chunks = F.ceil(F.col("size") / CHUNK).cast("int").alias("chunks")
    large = materialise(sizes.where(F.col("size") > CHUNK).select("component", "leader", chunks), "large-groups")
    rows = texts.join(large, "component", "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    own = F.pmod(F.xxhash64("set", F.lit(7)), F.col("chunks")).cast("int")
    rows = rows.withColumn("own", own)
    leads = F.coalesce(F.col("set") == F.col("leader"), F.lit(False))
    at = F.when(leads, F.sequence(F.lit(0), F.col("chunks") - 1)).otherwise(F.array("own"))
    first = rows.select("component", "set", "text", "leader", F.explode(at).alias("chunk"))

    def within(unit: pa.Table) -> pa.RecordBatch:
        ids, component, leader = unit.column("set").to_numpy(), unit.column("component")[0].as_py(), unit.column("leader")[0].as_py()
        found = similar_links([shingles(t.as_py() or "", width) for t in unit.column("text")], np.full(len(ids), -1), similarity)
        a, b = _links(ids, found)
        if leader is None:
            return pa.RecordBatch.from_arrays([a, b, pa.nulls(len(found), pa.int64())], ["a", "b", "component"])
        to = forest(len(ids), *np.array(found, np.int64).reshape(-1, 2).T)
        apart = ids[to != to[np.flatnonzero(ids == leader)[0]]]
        arrays = [pa.concat_arrays([a, pa.array(apart, pa.int64())]), pa.concat_arrays([b, pa.nulls(len(apart), pa.int64())])]
        place = pa.array([None] * len(found) + [component] * len(apart), pa.int64())
        return pa.RecordBatch.from_arrays([*arrays, place], ["a", "b", "component"])

    found = materialise(_units(first, ["component", "chunk"], within, "a long, b long, component long"), "chunk-links")
    apart = found.where("component IS NOT NULL").select("component", F.col("a").alias("set"))
    groups = apart.groupBy("component").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("parts"))
    groups = materialise(groups, "groups-apart")
    every = rows.join(groups, "component").select("component", "set", "text", "chunks", "own", "parts")
    part = F.pmod(F.xxhash64("set", F.lit(8)), F.col("parts")).cast("int")
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    theirs = every.select("component", "set", "text", F.col("own").alias("chunk"), numbers("parts").alias("part"), F.lit(1).alias("side"))
    mine = every.join(apart, ["component", "set"], "left_semi")
    mine = mine.select("component", "set", "text", numbers("chunks").alias("chunk"), part.alias("part"), F.lit(0).alias("side"))

    def across(unit: pa.Table) -> pa.RecordBatch:
        ids, side = unit.column("set").to_numpy(), unit.column("side").to_numpy()
        links = similar_links([shingles(t.as_py() or "", width) for t in unit.column("text")], side, similarity)
        return pa.RecordBatch.from_arrays(_links(ids, links), ["a", "b"])

    further = _units(mine.unionByName(theirs), ["component", "chunk", "part"], across, "a long, b long")
    return found.where("b IS NOT NULL").select("a", "b").unionAll(further)


def drop_similar(docs: DataFrame, similarity: float = SIMILARITY, width: int = WIDTH, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group that texts of ``similarity`` or more join, with all its columns: that with the smallest key.

    Null keys come last, and of rows with equal keys one stays. Null and wordless texts are
    alike; a text of fewer words than ``width`` is one shingle. Whole texts are compared,
    however long. An empty table gives no rows; further columns come along, whatever they
    are called. Runs jobs when called.
    """
    # read back once written, the numbers of rows are fixed
    marked = docs.select(F.struct(*quoted(docs.columns)).alias("row"), F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    marked = marked.withColumn("at", F.monotonically_increasing_id())
    found = [T.StructField("set", T.LongType()), T.StructField("bands", T.ArrayType(T.LongType()))]
    schema = T.StructType([marked.schema["row"], marked.schema["key"], marked.schema["at"], *found])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in in_batches(batches):
            sets = [shingles(t, width) for t in texts]
            whole = np.fromiter((xxhash.xxh3_64_intdigest(s.tobytes()) for s in sets), np.uint64, len(sets))
            of_bands = pa.array([bands(s).view(np.int64) for s in sets], pa.list_(pa.int64()))
            arrays = [batch.column("row"), batch.column("key"), batch.column("at"), pa.array(whole.view(np.int64)), of_bands]
            yield pa.RecordBatch.from_arrays(arrays, ["row", "key", "at", "set", "bands"])

    rows = materialise(marked.mapInArrow(run, schema), "shingled", "zstd")
    first = F.min(F.struct(F.col("key").isNull().alias("no_key"), "key", "at", "bands")).alias("first")
    classes = materialise(rows.groupBy("set").agg(first).select("set", "first", "first.at", "first.bands"), "shingle-sets")
    near = materialise(_candidates(classes), "candidates")
    near = materialise(classes.select("set", "at").join(near, "set"), "near-rows")
    # texts are shuffled only of rows that may be among the wanted ones, see maybe_among
    texts = rows.where(maybe_among(near, "at")(F.col("at"))).select("at", F.col("row").getField(text).alias("text"))
    texts = texts.join(near.hint("merge"), "at").select("set", "component", "text")
    links = components(_verified(materialise(texts, "near-texts", "zstd"), width, similarity)).select(F.col("node").alias("set"), "component")
    roots = classes.select("set", F.struct("first.no_key", "first.key", "first.at").alias("first")).join(links, "set", "left")
    kept = materialise(roots.groupBy(F.coalesce("component", "set").alias("root")).agg(F.min("first").alias("first")).select("first.at"), "kept-rows")
    dropped = materialise(rows.select("at").join(kept, "at", "left_anti"), "dropped-rows")
    doubtful = maybe_among(dropped, "at")(F.col("at"))
    checked = rows.where(doubtful).join(dropped.hint("merge"), "at", "left_anti")
    return rows.where(~doubtful).select("row.*").unionAll(checked.select("row.*"))
