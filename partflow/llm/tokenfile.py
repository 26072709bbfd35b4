"""Token ids in files, coded by a static range asymmetric numeral system (rANS).

A file set is a folder of two Parquet tables that Spark writes and commits:

``model``   one row per token id that occurs: ``id``, ``freq``; the frequencies add up to
            ``2 ** SCALE_BITS`` and are shared by all blocks.
``blocks``  one row per block: ``part``, ``block`` (their order is the order of doc_id),
            the documents in it (``doc_ids``, ``lengths``), and the coded ids.

A block holds whole documents and is coded by itself, its ids dealt in turn to ``lanes``
interleaved coders that share one stream of 32-bit words. Every ``CHECKPOINT_STEPS``
steps the coders' states and the place in the stream are kept, so that parts of a block
can be decoded in parallel too. Checksums cover the coded stream and the ids.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partflow.llm.common import in_slices, materialise, new_dir
from partflow.llm.segments import ids_memo, library

SCALE_BITS = 18
_LOW = np.uint64(1 << 31)
_WORD = np.uint64(32)
#: Ids after which a block is closed (it ends with a document), and coders in a full block.
BLOCK_IDS = 1 << 20
LANES = 1024
CHECKPOINT_STEPS = 256
#: Ids that a written partition holds, about.
PARTITION_IDS = 1 << 23
#: Texts that are cut and looked up at a time: rows, and bytes, whichever comes first.
SLICE_ROWS = 4096
SLICE_CHARS = 1 << 22
#: Pieces in a worker's cache, at some 200 bytes each.
CACHE_PIECES = 1_400_000

_BLOCK = (
    "part int, block int, n_docs int, n_ids long, lanes int, doc_ids binary, no_id binary, lengths binary,"
    " before long, states binary, places binary, payload binary, payload_crc long, ids_crc long"
)


# --- tokens ---------------------------------------------------------------------------


def tokenize(docs: DataFrame, tokenizer: str, end_id: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n``, ``ids`` (two bytes an id if the vocabulary allows, else four; little-endian).

    The last row of each task has no ids but ``counts``: how often each id occurs in all
    of the task's, as 64-bit integers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lib = library(tokenizer)
        kind = np.dtype(id_type(lib.size))
        memo = ids_memo(tokenizer, CACHE_PIECES, kind.str)
        last = np.asarray([end_id], kind).tobytes()
        counts = np.zeros(max(lib.size, end_id + 1), np.int64)
        for batch in in_slices(batches, "text", SLICE_ROWS, SLICE_CHARS):
            texts = pc.fill_null(batch.column("text"), "")
            even, pieces = lib.split(texts)
            found = iter(memo.joined(pieces))
            rest = texts.filter(pa.array(~even)).to_pylist()
            cut = [lib.pieces(one) for one in rest]
            known = iter(memo.look([p for p in cut if p is not None]))
            uncut = [one for one, p in zip(rest, cut) if p is None]
            whole = iter([np.asarray(i, kind).tobytes() for i in lib.encode(uncut)] if uncut else [])
            others = iter([next(whole) if p is None else b"".join(next(known)) for p in cut])
            ids = [next(found if one else others) + last for one in even.tolist()]
            counts += np.bincount(np.frombuffer(b"".join(ids), kind), minlength=len(counts))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(b) // kind.itemsize for b in ids], pa.int64()), pa.array(ids, pa.binary()), pa.nulls(len(ids), pa.binary())],
                ["doc_id", "n", "ids", "counts"],
            )
        row = [pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([counts.astype("<i8").tobytes()], pa.binary())]
        yield pa.RecordBatch.from_arrays(row, ["doc_id", "n", "ids", "counts"])

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, "doc_id long, n long, ids binary, counts binary"
    )


def id_type(vocabulary: int) -> str:
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def count_ids(tokens: DataFrame) -> DataFrame:
    """How often each id occurs in all documents: ``id``, ``n``; from one bounded histogram per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one in batch.column("counts").to_pylist():
                counts = np.frombuffer(one, "<i8")
                at = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(counts[at], pa.int64())], ["id", "n"])

    return tokens.select("counts").where("counts IS NOT NULL").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


# --- the coder ------------------------------------------------------------------------


class Model:
    """Frequencies of ids, in parts of ``2 ** SCALE_BITS``."""

    def __init__(self, ids: np.ndarray, freqs: np.ndarray) -> None:
        size = int(ids.max()) + 1 if len(ids) else 1
        self.freq = np.zeros(size, np.uint64)
        self.freq[ids] = freqs
        self.start = np.zeros(size, np.uint64)
        self.start[1:] = np.cumsum(self.freq)[:-1]
        self.at = np.repeat(np.arange(size, dtype=np.uint32), self.freq.astype(np.int64))

    @staticmethod
    def scaled(counts: np.ndarray) -> np.ndarray:
        """Counts of ids that occur as frequencies of one at least that add up to the whole."""
        whole = 1 << SCALE_BITS
        if len(counts) == 0:
            return counts
        if len(counts) > whole // 2:
            raise ValueError(f"more than {whole // 2} different ids")
        freqs = np.maximum(1, np.floor(counts / counts.sum() * (whole - len(counts)))).astype(np.int64)
        freqs[np.argmax(counts)] += whole - freqs.sum()
        return freqs


def encode_block(ids: np.ndarray, model: Model) -> dict:
    """Code ids: lanes, states and places of the checkpoints, payload, checksums."""
    n = len(ids)
    lanes = int(min(LANES, max(1, 1 << max(0, (n // 256)).bit_length())))
    steps = -(-n // lanes)
    state = np.full(lanes, _LOW, np.uint64)
    top = np.uint64(31 - SCALE_BITS + 32)
    scale = np.uint64(SCALE_BITS)
    words, states, written = [], [], []
    total = 0
    for t in range(steps - 1, -1, -1):
        part = ids[t * lanes : (t + 1) * lanes]
        x, f, s = state[: len(part)], model.freq[part], model.start[part]
        full = x >= (f << top)
        if full.any():
            out = x[full].astype(np.uint32)
            words.append(out)
            total += len(out)
            x = np.where(full, x >> _WORD, x)
        q = x // f
        state[: len(part)] = (q << scale) + (x - q * f) + s
        if t % CHECKPOINT_STEPS == 0:
            states.append(state.copy())
            written.append(total)
    payload = b"".join(w.astype("<u4").tobytes() for w in reversed(words))
    places = np.asarray([total - w for w in reversed(written)], "<i8")
    return {
        "lanes": lanes,
        "states": b"".join(s.astype("<u8").tobytes() for s in reversed(states)),
        "places": places.tobytes(),
        "payload": payload,
        "payload_crc": zlib.crc32(payload),
    }


def decode_block(block: dict, model: Model, first: int = 0, last: int | None = None) -> np.ndarray:
    """Ids between two checkpoints of a block (all of them by default).

    ``first`` and ``last`` count checkpoints; the ids begin at step ``first * CHECKPOINT_STEPS``.
    """
    n, lanes = block["n_ids"], block["lanes"]
    if zlib.crc32(block["payload"]) != block["payload_crc"]:
        raise ValueError(f"part {block.get('part')}, block {block.get('block')}: the coded stream is damaged")
    places = np.frombuffer(block["places"], "<i8")
    if len(places) == 0:
        return np.zeros(0, np.uint32)
    steps = -(-n // lanes)
    begin = first * CHECKPOINT_STEPS
    end = steps if last is None else min(steps, last * CHECKPOINT_STEPS)
    words = np.frombuffer(block["payload"], "<u4").astype(np.uint64)
    state = np.frombuffer(block["states"], "<u8").reshape(-1, lanes)[first].astype(np.uint64)
    at = int(places[first])
    out = np.empty(min(n, end * lanes) - begin * lanes, np.uint32)
    mask, scale = np.uint64((1 << SCALE_BITS) - 1), np.uint64(SCALE_BITS)
    for t in range(begin, end):
        count = min(lanes, n - t * lanes)
        x = state[:count]
        slot = x & mask
        ids = model.at[slot]
        x = model.freq[ids] * (x >> scale) + slot - model.start[ids]
        low = x < _LOW
        k = int(np.count_nonzero(low))
        if k:
            x[low] = (x[low] << _WORD) | words[at : at + k]
            at += k
        state[:count] = x
        out[(t - begin) * lanes : (t - begin) * lanes + count] = ids
    return out


# --- files ----------------------------------------------------------------------------


def _block(part: int, number: int, docs: list, model: Model, kind: str) -> dict:
    ids = np.frombuffer(b"".join(d[1] for d in docs), kind).astype(np.uint32)
    return {
        "part": part,
        "block": number,
        "n_docs": len(docs),
        "n_ids": len(ids),
        "doc_ids": np.asarray([d[0] or 0 for d in docs], "<i8").tobytes(),
        "no_id": np.asarray([d[0] is None for d in docs], "u1").tobytes(),
        "lengths": np.asarray([len(d[1]) // np.dtype(kind).itemsize for d in docs], "<i8").tobytes(),
        "ids_crc": zlib.crc32(ids.astype("<u4").tobytes()),
        **encode_block(ids, model),
    }


def write_token_file(docs: DataFrame, tokenizer: str, end_id: int, path: str, key: str = "doc_id", text: str = "text") -> None:
    """Tokenize all texts and write them below ``path`` in ascending order of ``key``.

    A null text is an empty document (its end id only); null keys come first; rows that
    repeat a key follow each other, ordered by a hash of their ids, so that even a key of
    very many rows is split over partitions; further columns are ignored;
    an empty table gives a file set without blocks.
    """
    spark, size = docs.sparkSession, library(tokenizer).size
    kind = id_type(size)
    tokens = materialise(tokenize(docs, tokenizer, end_id, key, text), "token-ids", "zstd")
    counts = count_ids(tokens).orderBy("id").toPandas()  # bounded by the vocabulary
    freqs = Model.scaled(counts["n"].to_numpy(np.int64))
    model_rows = list(zip(counts["id"].tolist(), freqs.tolist()))
    spark.createDataFrame(model_rows, "id long, freq long").coalesce(1).write.mode("overwrite").parquet(f"{path}/model")
    shared = spark.sparkContext.broadcast((counts["id"].to_numpy(np.int64), freqs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, part = Model(*shared.value), TaskContext.get().partitionId()
        waiting, held, number, before = [], 0, 0, 0
        fields = [f.split()[0] for f in _BLOCK.split(", ")]

        def flush() -> pa.RecordBatch:
            row = _block(part, number, waiting, model, kind) | {"before": before}
            return pa.RecordBatch.from_pydict({f: [row[f]] for f in fields}, schema=_ARROW)

        for batch in batches:
            for doc in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist()):
                waiting.append(doc)
                held += len(doc[1]) // np.dtype(kind).itemsize
                if held >= BLOCK_IDS:
                    yield flush()
                    waiting, held, number, before = [], 0, number + 1, before + held
        if waiting:
            yield flush()

    total = int(counts["n"].sum())
    ranges = tokens.where("counts IS NULL").select("doc_id", "ids").repartitionByRange(max(1, -(-total // PARTITION_IDS)), "doc_id", F.xxhash64("ids"))
    ordered = ranges.sortWithinPartitions("doc_id", F.xxhash64("ids"))
    ordered.mapInArrow(run, _BLOCK).write.mode("overwrite").option("compression", "uncompressed").parquet(f"{path}/blocks")


_ARROW = pa.schema(
    [(n, {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}[t]) for n, t in (f.split() for f in _BLOCK.split(", "))]
)


def read_token_file(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """Decode a file set, block by block in parallel, checking both checksums.

    Gives ``doc_id``, ``start`` (ids of all documents before), ``n_tokens``,
    ``ids_crc32`` (of the ids as little-endian unsigned 32-bit integers) and, if wanted,
    ``ids`` (those bytes).
    """
    model = spark.read.parquet(f"{path}/model").toPandas()  # bounded by the vocabulary
    shared = spark.sparkContext.broadcast((model["id"].to_numpy(np.int64), model["freq"].to_numpy(np.int64)))
    blocks = spark.read.parquet(f"{path}/blocks")
    # one row per written partition, that is for eight million ids or so
    per_part = blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").toPandas()
    bases = dict(zip(per_part["part"].tolist(), (per_part["n"].cumsum() - per_part["n"]).tolist()))
    known = spark.sparkContext.broadcast(bases)
    columns = ["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: 5 if with_ids else 4]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for batch in batches:
            for row in batch.to_pylist():
                ids = decode_block(row, own).astype("<u4").tobytes()
                if zlib.crc32(ids) != row["ids_crc"]:
                    raise ValueError(f"part {row['part']}, block {row['block']}: the ids are damaged")
                lengths = np.frombuffer(row["lengths"], "<i8")
                ends = np.cumsum(lengths)
                starts = ends - lengths
                docs = np.frombuffer(row["doc_ids"], "<i8")
                none = np.frombuffer(row["no_id"], "u1").astype(bool)
                seen = memoryview(ids)
                each = [seen[4 * a : 4 * b] for a, b in zip(starts.tolist(), ends.tolist())]
                base = known.value[row["part"]] + row["before"]
                arrays = [
                    pa.array(docs, pa.int64(), mask=none),
                    pa.array(starts + base, pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.array([zlib.crc32(e) for e in each], pa.int64()),
                ]
                if with_ids:
                    arrays.append(pa.array([bytes(e) for e in each], pa.binary()))
                yield pa.RecordBatch.from_arrays(arrays, columns)

    return blocks.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids)


def round_trip(docs: DataFrame, tokenizer: str, end_id: int, with_ids: bool = False) -> DataFrame:
    """Write ``docs`` as a new file set in the shared folder and read it back."""
    path = new_dir(docs.sparkSession, "token-file")
    write_token_file(docs, tokenizer, end_id, path)
    return read_token_file(docs.sparkSession, path, with_ids)
