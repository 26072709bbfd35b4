"""Token counts by a map-side two-tier lookup.

First tier: a compact table of the most frequent pieces and their token counts, found
over the whole corpus, packed into one bounded byte string and broadcast. Second tier:
each worker encodes the pieces the table lacks with the tokenizer's own library and
keeps the counts in a bounded cache. No piece is ever shuffled: the frequent ones come
from bounded summaries, one per task. Neither tier can change a count.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partflow.llm.common import in_batches
from partflow.llm.segments import counts_memo, library

#: Entries and longest entry (characters) of the broadcast table: with four bytes a
#: character at most, it can't exceed 65536 * (4 * 48 + 3) bytes, 13 MB.
TABLE_ENTRIES = 1 << 16
TABLE_CHARS = 48
#: Pieces that a task names as its most frequent, and pieces that it counts at a time.
TASK_ENTRIES = 4096
TASK_COUNTED = 1 << 18
#: Pieces in a worker's cache, the table's among them.
CACHE_PIECES = 1_000_000


def frequent_pieces(docs: DataFrame, tokenizer: str, text: str = "text", entries: int = TABLE_ENTRIES) -> DataFrame:
    """The pieces most frequent in all texts: ``piece``, ``n`` (a lower bound of its count).

    Every task counts the pieces of all its texts; when it holds ``TASK_COUNTED`` it
    forgets the rarer half. Only each task's ``TASK_ENTRIES`` most frequent are added up.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lib, counts = library(tokenizer), Counter()
        for _, texts in in_batches(batches):
            for one in texts:
                counts.update(lib.pieces(one) or ())
            if len(counts) > TASK_COUNTED:
                counts = Counter(dict(heapq.nlargest(TASK_COUNTED // 2, counts.items(), key=lambda x: (x[1], x[0]))))
        short = ((p, n) for p, n in counts.items() if n > 1 and len(p) <= TABLE_CHARS and "\0" not in p)
        best = heapq.nlargest(TASK_ENTRIES, short, key=lambda x: (x[1], x[0]))
        yield pa.RecordBatch.from_arrays(
            [pa.array([p for p, _ in best], pa.string()), pa.array([n for _, n in best], pa.int64())], ["piece", "n"]
        )

    found = docs.select(F.col(text).alias("text")).mapInArrow(count, "piece string, n long")
    return found.groupBy("piece").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "piece").limit(entries)


def pack_table(pieces: list[str], tokenizer: str) -> tuple[bytes, bytes]:
    """The compact table: the pieces with zero bytes between them, and two bytes of token count each."""
    lib = library(tokenizer)
    counts = [len(ids) // 4 for ids in lib.encode_pieces(pieces)]
    return "\0".join(pieces).encode(), b"".join(n.to_bytes(2, "little") for n in counts)


def unpack_table(packed: tuple[bytes, bytes]) -> dict[str, int]:
    pieces, counts = packed
    if not counts:
        return {}
    return dict(zip(pieces.decode().split("\0"), memoryview(counts).cast("H").tolist()))


def count_tokens(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Bytes and tokens of every whole text: ``key``, ``n_bytes``, ``n_tokens``.

    Tokens are those of the tokenizer's library without added begin, end or special
    tokens. A null text counts as empty (0, 0); a null key stays null; repeated rows
    are counted each; further columns are ignored; an empty table gives no rows.
    Finding the frequent pieces runs a job when this is called.
    """
    lib = library(tokenizer)
    common = [r.piece for r in frequent_pieces(docs, tokenizer, text).collect()] if lib.in_pieces else []
    packed = docs.sparkSession.sparkContext.broadcast(pack_table(common, tokenizer))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = library(tokenizer)
        memo = counts_memo(tokenizer, CACHE_PIECES)
        memo.known.update(unpack_table(packed.value))
        known = memo.known.__getitem__
        for batch, texts in in_batches(batches):
            cut = [own.pieces(one) for one in texts]
            memo.learn([p for p in cut if p is not None])
            whole = [one for one, p in zip(texts, cut) if p is None]
            rest = iter([len(ids) for ids in own.encode(whole)] if whole else [])
            counts = [next(rest) if p is None else sum(map(known, p)) for p in cut]
            sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), sizes, pa.array(counts, pa.int64())], ["key", "n_bytes", "n_tokens"]
            )

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(count, f"key {kind}, n_bytes long, n_tokens long").withColumnRenamed("key", key)
