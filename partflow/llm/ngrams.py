"""Language-model scoring by stupid backoff, as joins of n-gram count tables.

Documents are dealt into chunks of bounded size. Each chunk explodes its documents into
n-grams and sends each different one once, with its count, to the part of the count table
that its hash belongs to. There the counts of all chunks are added up and joined back to
the n-grams of every chunk, whose documents then sum their scores. Parts hold n-grams by
hash, each at most once per chunk, so neither frequent n-grams nor frequent documents
make a part large; and what is shuffled grows with the corpus, not with its repetitions.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partflow.llm.common import materialise

#: Longest n-gram, factor for each step back, and occurrences below which an n-gram is not relied on.
ORDER = 2
ALPHA = 0.4
LEAST = 2
#: Characters of a chunk, and n-grams of a part of the count table, about.
CHUNK_CHARS = 8 << 20
PART_GRAMS = 1 << 21
_CACHE = 400_000
_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xD6E8FEB86659FD93)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > _CACHE:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word)
        return found


_hashes = _Hashes()


def _grams(texts: list[str | None], order: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Hashes of the n-grams that end at each word, by length (0 where a text is too short), words per text, and the text of each word.

    Words are runs without white space (\\x20, \\x09-\\x0D), A-Z lower-cased.
    """
    words = [(t or "").encode().lower().split() for t in texts]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    total = int(sizes.sum())
    ones = np.fromiter((h for w in words for h in map(_hashes.__getitem__, w)), np.uint64, total)
    place = np.arange(total) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out = [np.maximum(ones, np.uint64(1))]
    for n in range(2, order + 1):
        h = np.zeros(total, np.uint64)
        mixed = (out[-1][:-1] * _MIX + ones[1:] + np.uint64(n)) * _MIX2
        h[1:] = np.maximum(mixed ^ (mixed >> np.uint64(31)), np.uint64(1))
        h[place < n - 1] = 0
        out.append(h)
    return out, sizes, np.repeat(np.arange(len(words)), sizes)


def _different(grams: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Different n-grams of a chunk, sorted by hash, and their counts."""
    every = np.concatenate(grams)
    return np.unique(every[every > 0], return_counts=True)


def _pack(values: np.ndarray) -> bytes:
    """Numbers as the bytes of their differences, plane by plane, compressed."""
    steps = np.diff(values, prepend=values.dtype.type(0))
    planes = steps.view(np.uint8).reshape(-1, values.dtype.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def _unpack(data: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(width, -1)
    return np.cumsum(np.ascontiguousarray(raw.T).view(kind).ravel(), dtype=kind)


def _bounds(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Where each part of the count table begins and ends in sorted hashes."""
    edges = np.asarray([(i << 64) // parts for i in range(1, parts)], np.uint64)
    return np.concatenate([[0], np.searchsorted(hashes, edges), [len(hashes)]])


def score_documents(
    docs: DataFrame, order: int = ORDER, alpha: float = ALPHA, least: int = LEAST, key: str = "doc_id", text: str = "text", chunk_chars: int = CHUNK_CHARS, part_grams: int = PART_GRAMS
) -> DataFrame:
    """``key, n_words, score`` of every whole text, by a model of all texts.

    A word scores count(n-gram) / count(n-gram without its last word) for the longest
    n-gram of at most ``order`` words that ends with it, begins in the text, and occurs
    ``least`` times or more; each word that it is shorter costs a factor ``alpha``. A
    single word scores its share of all words. ``score`` is the mean of the natural
    logarithms; texts without words (null, empty) have 0 words and a null score. Null
    keys stay null; repeated rows count and are scored each; further columns are
    ignored; an empty table gives no rows. Counting characters runs a job when called.
    """
    sizes = docs.agg(F.sum(F.length(text)), F.count("*")).first()
    chunks = max(1, -(-(sizes[0] or 0) // chunk_chars))
    parts = max(1, -(-((sizes[0] or 0) // 6 * order) // part_grams))
    kind = docs.schema[key].dataType.simpleString()
    dealt = F.pmod(F.xxhash64(F.col("key"), F.monotonically_increasing_id()), F.lit(chunks)).cast("int")
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).withColumn("chunk", dealt)

    def explode(table: pa.Table) -> pa.Table:
        grams, sizes, _ = _grams(table["text"].to_pylist(), order)
        hashes, counts = _different(grams)
        at = _bounds(hashes, parts)
        packed = [(_pack(hashes[a:b]), _pack(counts[a:b].astype(np.uint64))) for a, b in zip(at, at[1:])]
        n = len(packed)
        return pa.table(
            {
                "part": pa.array(range(n), pa.int32()),
                "chunk": pa.array([table["chunk"][0].as_py()] * n, pa.int32()),
                "hashes": pa.array([p[0] for p in packed], pa.binary()),
                "counts": pa.array([p[1] for p in packed], pa.binary()),
                "words": pa.array([int(sizes.sum())] + [0] * (n - 1), pa.int64()),
            }
        )

    def join(table: pa.Table) -> pa.Table:
        each = [_unpack(h, np.uint64) for h in table["hashes"].to_pylist()]
        hashes = np.concatenate(each)
        counts = np.concatenate([_unpack(c, np.uint64) for c in table["counts"].to_pylist()]).astype(np.int64)
        different, which = np.unique(hashes, return_inverse=True)
        totals = np.bincount(which, counts, len(different)).astype(np.uint64)[which]
        ends = np.cumsum([len(e) for e in each])
        found = [_pack(totals[end - len(e) : end]) for e, end in zip(each, ends)]
        return pa.table(
            {
                "chunk": table["chunk"],
                "part": table["part"],
                "totals": pa.array(found, pa.binary()),
                "check": pa.array([zlib.crc32(e.tobytes()) for e in each], pa.int64()),
                "words": table["words"],
            }
        )

    exploded = rows.groupBy("chunk").applyInArrow(explode, "part int, chunk int, hashes binary, counts binary, words long")
    joined = exploded.groupBy("part").applyInArrow(join, "chunk int, part int, totals binary, check long, words long")

    def score(texts: pa.Table, counted: pa.Table) -> pa.Table:
        if texts.num_rows == 0:
            return pa.table({"key": texts["key"], "n_words": pa.array([], pa.int64()), "sum": pa.array([], pa.float64()), "backed": pa.array([], pa.float64())})
        grams, sizes, of = _grams(texts["text"].to_pylist(), order)
        hashes, _ = _different(grams)
        at = _bounds(hashes, parts)
        totals = np.zeros(len(hashes), np.float64)
        for part, data, check in zip(*(counted[c].to_pylist() for c in ("part", "totals", "check"))):
            a, b = at[part], at[part + 1]
            if zlib.crc32(hashes[a:b].tobytes()) != check:
                raise ValueError("a chunk was dealt differently when it was counted")
            totals[a:b] = _unpack(data, np.uint64)
        counts = [np.where(g > 0, totals[np.minimum(np.searchsorted(hashes, g), len(hashes) - 1)] if len(hashes) else 0, 0) for g in grams]
        logs = np.log(np.maximum(counts[0], 1))  # the number of all words is taken off below
        shared = np.ones(len(logs))  # whether a word's score is a share of all words
        for n in range(1, order):
            whole = counts[n]
            before = np.ones(len(whole))
            before[1:] = counts[n - 1][:-1]
            fits = whole >= least
            logs = np.where(fits, np.log(np.maximum(whole, 1)) - np.log(np.maximum(before, 1)), logs + np.log(alpha))
            shared = np.where(fits, 0.0, shared)
        n = len(sizes)
        sums, backed = (np.bincount(of, x, n).astype(np.float64) for x in (logs, shared))
        return pa.table({"key": texts["key"], "n_words": pa.array(sizes), "sum": pa.array(sums), "backed": pa.array(backed)})

    scored = rows.groupBy("chunk").cogroup(joined.groupBy("chunk")).applyInArrow(score, f"key {kind}, n_words long, sum double, backed double")
    scored = materialise(scored, "document-scores")
    words = scored.agg(F.sum("n_words")).first()[0] or 1  # known once every chunk has been counted
    mean = (F.col("sum") - F.col("backed") * float(np.log(words))) / F.col("n_words")
    return scored.select(F.col("key").alias(key), "n_words", F.when(F.col("n_words") > 0, mean).alias("score"))
