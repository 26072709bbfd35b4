"""Quality classifier: logistic regression on hashed word n-grams, trained by FTRL-proximal updates."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partflow.llm.common import in_batches, materialise, numbered

#: Features; the weights that are broadcast are this many doubles, 2 MB.
DIMS = 1 << 18
#: Labelled rows that a model is fitted on at most (those with the smallest hash of their key).
MAX_TRAIN = 20_000
#: Parts of the training rows that are learned from side by side and averaged, and passes over each.
SHARDS = 8
EPOCHS = 3
#: FTRL-proximal: step size, its offset, and the L1 and L2 penalties.
ALPHA, BETA, L1, L2 = 5.0, 1.0, 0.02, 0.01
THRESHOLD = 0.7

_WORDS = re.compile(r"\w+|[^\w\s]+")
_CACHE = 400_000
_AGAIN = "\x00again"


class Hashes(dict):
    """64-bit hashes of words, kept for a bounded number of words."""

    def __missing__(self, word: str) -> int:
        if len(self) > _CACHE:
            self.clear()
        b = word.encode("utf-8", "replace")
        self[word] = found = zlib.crc32(b) << 32 | zlib.crc32(b, 0x9E3779B9)
        return found


def features(text: str, hashes: Hashes) -> tuple[np.ndarray, np.ndarray]:
    """Features of a whole text and their values; the squares of the values add up to one.

    Words and runs of punctuation, lower-cased, alone and in pairs; a word that repeats
    the one before it counts as the mark "again". A value is the root of its share.
    """
    words = _WORDS.findall(text.lower())
    if not words:
        return np.zeros(0, np.int64), np.zeros(0)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    same = np.flatnonzero(h[1:] == h[:-1]) + 1
    h[same] = hashes[_AGAIN]
    pairs = (h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]) * np.uint64(0xD6E8FEB86659FD93)
    at = np.concatenate([h * np.uint64(0xA0761D6478BD642F), pairs]) >> np.uint64(64 - DIMS.bit_length() + 1)
    at, n = np.unique(at.astype(np.int64), return_counts=True)
    return at, np.sqrt(n / (2 * len(words) - 1))


def fit(rows: list[tuple[str, int]], epochs: int = EPOCHS) -> np.ndarray:
    """Weights (the last is the bias) after passes of FTRL-proximal over the rows in their order."""
    hashes = Hashes()
    seen = [(*features(text, hashes), label) for text, label in rows]
    z, n = np.zeros(DIMS + 1), np.zeros(DIMS + 1)

    def weights(at: np.ndarray) -> np.ndarray:
        zi = z[at]
        w = -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
        return np.where(np.abs(zi) <= L1, 0.0, w)

    for _ in range(epochs):
        for at, x, label in seen:
            at, x = np.append(at, DIMS), np.append(x, 1.0)
            w = weights(at)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - label) * x
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - sigma * w
            n[at] += g * g
    return weights(np.arange(DIMS + 1))


def remainder(key: Column) -> Column:
    """crc32 of a key as text, modulo 4; null keys: null."""
    return F.crc32(key.cast("string").cast("binary")) % 4


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", max_train: int = MAX_TRAIN, held_out: int = 2) -> np.ndarray | None:
    """Weights learned from labelled rows that aren't held out (remainder ``held_out``); None without any.

    At most ``max_train`` labelled rows with the smallest hashes of their keys; null keys
    and labels are left out, contradicting labels of a key count as 0. Shards are learned
    from apart, on the executors, and their weights averaged.
    """
    usable = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull() & (remainder(F.col(key)) != held_out))
    chosen = usable.groupBy(F.col(key).alias("key")).agg(F.min(label).cast("int").alias("label"))
    chosen = materialise(chosen.orderBy(F.xxhash64("key"), "key").limit(max_train), "training-labels")
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).join(F.broadcast(chosen), "key")
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("key", F.lit(1)), F.lit(SHARDS)).cast("int"))

    def learn(table: pa.Table) -> pa.Table:
        order = sorted(zip(table["key"].to_pylist(), table["text"].to_pylist(), table["label"].to_pylist()), key=lambda r: (r[0], r[1] or ""))
        order.sort(key=lambda r: zlib.crc32(str(r[0]).encode(), 1))
        w = fit([(t or "", y) for _, t, y in order])
        at = np.flatnonzero(w)
        at = np.union1d(at, [DIMS])
        return pa.table({"at": pa.array(at, pa.int64()), "w": pa.array(w[at])})

    parts = rows.groupBy("shard").applyInArrow(learn, "at long, w double")
    found = parts.groupBy("at").agg(F.sum("w").alias("w"), F.count("*").alias("n")).toPandas()  # bounded by DIMS
    if found.empty:
        return None
    weights = np.zeros(DIMS + 1)
    weights[found["at"].to_numpy()] = found["w"].to_numpy() / found["n"].max()  # the bias comes from every shard
    return weights


def score(docs: DataFrame, weights: np.ndarray | None, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``key, score, predicted`` of every whole text.

    A null text is scored as an empty one (by the bias alone); without a model every
    score is 0.5. Null keys stay null; repeated rows are scored each; further columns
    are ignored; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(weights if weights is not None else np.zeros(DIMS + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, hashes = shared.value, Hashes()
        for batch, texts in in_batches(batches):
            sums = np.full(len(texts), w[DIMS])
            for i, one in enumerate(texts):
                at, x = features(one, hashes)
                sums[i] += w[at] @ x
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(1 / (1 + np.exp(-np.clip(sums, -35, 35))))], ["key", "score"])

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"key {kind}, score double")
    return rows.select(F.col("key").alias(key), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, weights: np.ndarray | None, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows whose text scores ``threshold`` or more, with all their columns.

    Texts are judged as by :func:`score`. Without a model nothing is known against any
    row, and all stay.
    """
    if weights is None:
        return docs
    shared, at_text = docs.sparkSession.sparkContext.broadcast(weights), docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, hashes = shared.value, Hashes()
        least = np.log(threshold / (1 - threshold))
        for batch in batches:
            for part, texts in in_batches([batch], f"c{at_text}"):
                good = []
                for one in texts:
                    at, x = features(one, hashes)
                    good.append(bool(w[at] @ x + w[DIMS] >= least))
                yield pa.RecordBatch.from_arrays(part.filter(pa.array(good)).columns, batch.schema.names)

    rows = numbered(docs)
    return rows.mapInArrow(run, rows.schema).toDF(*docs.columns)
