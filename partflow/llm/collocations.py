"""Collocations: word n-grams counted in quotient filters.

Words get numbers; the numbers of an n-gram are packed into one key, and a one-to-one
scrambling of the key is cut into a quotient and the full remainder. A filter holds the
keys in that order: quotients as two bits a key, the remainders, and a counter each. As
nothing of the key is lost, neither is a count. Tasks fill filters, send them by ranges of
the quotient, and each range's sorted filters are merged.

N-grams are counted for one length after the other. One of ``n`` words can only be
frequent if both of ``n - 1`` words in it are; a bounded bitmap of those keeps most others
from being counted, and what slips through it is counted and found to be rare.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partflow.llm.common import in_batches, materialise
from partflow.llm.units import sorted_groups

LONGEST, LEAST, TOP = 4, 30, 2000
#: Frequent words whose numbers are their ranks, found in a broadcast table of eight bytes each
#: (32 MB at most). If there are more, words are numbered by their whole hashes instead.
RANKED_WORDS = 1 << 22
#: Bits of the bitmap of frequent n-grams (16 MB), and bits set for each.
BITMAP_BITS, BITS_EACH = 1 << 27, 2
#: Numbers in a row of the numbered corpus, n-grams a filter takes in at once, keys it holds
#: before it is sent, and n-grams of a corpus that make a range.
ROW_WORDS, TAKEN, HELD, RANGE_GRAMS = 1 << 18, 1 << 20, 1 << 21, 1 << 23
#: Words a task counts, and words it remembers the numbers of.
_COUNTED, _KNOWN = 1 << 20, 1 << 19
_PIECE, _WORD = re.compile(rb"[.,;:!?\x0a-\x0d]"), re.compile(rb"[^\x20\x09]+")
_NONE = np.uint64(2**64 - 1)  # ends a piece; also what no number is
_ODD = (np.random.default_rng(11).integers(0, 2**63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)).tolist()


# --- words ------------------------------------------------------------------------------


def pieces_of(text: str) -> list[list[bytes]]:
    """The words of a text, piece by piece."""
    return [_WORD.findall(piece) for piece in _PIECE.split(text.encode().lower())]


def _word_hash(lang: str, seed: int):
    start = xxhash.xxh3_64_intdigest(lang.encode(), seed)
    return lambda word: xxhash.xxh3_64_intdigest(word, start)


def _languages(batch: pa.RecordBatch) -> list[str]:
    return ["und" if lang is None else lang for lang in batch.column("lang").to_pylist()]


def _counted_words(docs: DataFrame, seed: int) -> DataFrame:
    """``id`` (hash of language and word), ``lang``, ``word``, ``n`` of all words; ``clash`` where two words have one hash."""

    def sent(counts: dict[tuple[str, bytes], int]) -> pa.RecordBatch:
        ids = np.array([_word_hash(lang, seed)(word) for lang, word in counts], np.uint64).view(np.int64)
        langs, words = [lang for lang, _ in counts], [word.decode() for _, word in counts]
        arrays = [pa.array(ids, pa.int64()), pa.array(langs, pa.string()), pa.array(words, pa.string()), pa.array(list(counts.values()), pa.int64())]
        return pa.RecordBatch.from_arrays(arrays, ["id", "lang", "word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[str, bytes], int] = {}
        for batch, texts in in_batches(batches):
            for lang, text in zip(_languages(batch), texts):
                for word in _WORD.findall(_PIECE.sub(b" ", text.encode().lower())):
                    counts[lang, word] = counts.get((lang, word), 0) + 1
            if len(counts) >= _COUNTED:
                yield sent(counts)
                counts = {}
        yield sent(counts)

    found = docs.mapInArrow(run, "id long, lang string, word string, n long")
    low, high = F.min(F.struct("lang", "word")).alias("low"), F.max(F.struct("lang", "word")).alias("high")
    merged = found.groupBy("id", "lang", "word").agg(F.sum("n").alias("n"))
    return merged.groupBy("id").agg(low, high, F.sum("n").alias("n")).select("id", "low.lang", "low.word", "n", (F.col("low") != F.col("high")).alias("clash"))


def all_words(docs: DataFrame) -> tuple[DataFrame, int]:
    """``id, lang, word, n`` of all words, and the seed under which no two of them share their hash."""
    for seed in range(100):
        words = materialise(_counted_words(docs, seed), "words", "zstd")
        if words.where("clash").limit(1).count() == 0:
            return words.drop("clash"), seed
    raise RuntimeError("hashes of 64 bits do not tell the words apart")


def _numbered(docs: DataFrame, seed: int, ranked: np.ndarray | None) -> DataFrame:
    """The corpus as rows of word numbers, ``_NONE`` behind every piece and for words that are not ranked."""
    shared = docs.sparkSession.sparkContext.broadcast(ranked)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, known, held, size = shared.value, {}, [], 0

        def numbers(lang: str, words: list[bytes]) -> np.ndarray:
            new = {w for w in words if (lang, w) not in known}
            if new:
                if len(known) + len(new) > _KNOWN:
                    known.clear()
                    new = set(words)
                ids = np.fromiter(map(_word_hash(lang, seed), new), np.uint64, len(new))
                if table is not None:
                    at = np.searchsorted(table, ids)
                    at[at == len(table)] = 0
                    ids = np.where(table[at] == ids, at.astype(np.uint64), _NONE) if len(table) else np.full(len(ids), _NONE)
                known.update(zip(((lang, w) for w in new), ids.tolist()))
            return np.fromiter((known[lang, w] for w in words), np.uint64, len(words))

        for batch, texts in in_batches(batches):
            for lang, text in zip(_languages(batch), texts):
                pieces = [p for p in pieces_of(text) if len(p) > 1]
                if not pieces:
                    continue
                found = numbers(lang, [w for p in pieces for w in p])
                ends = np.cumsum([len(p) for p in pieces])
                held.append(np.insert(found, ends, _NONE))
                size += len(found)
                if size >= ROW_WORDS:
                    yield _one_column(np.concatenate(held))
                    held, size = [], 0
        if held:
            yield _one_column(np.concatenate(held))

    width = "<u4" if ranked is not None else "<u8"

    def _one_column(ids: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([np.minimum(ids, np.uint64(np.iinfo(width).max)).astype(width).tobytes()], pa.binary())], ["ids"])

    return docs.mapInArrow(run, "ids binary")


# --- quotient filters -------------------------------------------------------------------


class Packing:
    """Keys of ``n`` numbers of ``bits`` bits: rows of 64-bit columns, and their one-to-one scrambling.

    The first column has the key's lowest ``low`` bits; further columns the rest.
    """

    def __init__(self, n: int, bits: int) -> None:
        self.n, self.bits = n, bits
        self.total = n * bits
        self.low = min(64, self.total)
        self.columns = -(-self.total // 64)
        self.mask = np.uint64(2**self.low - 1)

    def pack(self, numbers: Sequence[np.ndarray]) -> np.ndarray:
        key = np.zeros((self.columns, len(numbers[0])), np.uint64)
        for i, one in enumerate(numbers):
            column, shift = divmod(i * self.bits, 64)
            key[column] |= one << np.uint64(shift)
            if shift + self.bits > 64:
                key[column + 1] |= one >> np.uint64(64 - shift)
        return key

    def unpack(self, key: np.ndarray) -> list[np.ndarray]:
        out = []
        for i in range(self.n):
            column, shift = divmod(i * self.bits, 64)
            one = key[column] >> np.uint64(shift)
            if shift + self.bits > 64:
                one = one | key[column + 1] << np.uint64(64 - shift)
            out.append(one & np.uint64(2**self.bits - 1))
        return out

    def scramble(self, key: np.ndarray) -> np.ndarray:
        """The first column becomes a mixture of the whole key; the others stay, so it can be undone."""
        x = key[0]
        for i, other in enumerate(key[1:]):
            x = x ^ _mixed(other, _ODD[4 + i])  # low is 64 where there are others
        half = np.uint64(max(1, self.low // 2))
        for odd in _ODD[:2]:
            x = (x ^ x >> half) * np.uint64(odd) & self.mask
        return np.vstack([x ^ x >> half, key[1:]])

    def unscramble(self, key: np.ndarray) -> np.ndarray:
        half = max(1, self.low // 2)

        def back(x: np.ndarray) -> np.ndarray:
            out = x
            for _ in range(half, self.low, half):
                out = x ^ out >> np.uint64(half)
            return out

        x = back(key[0])
        for odd in reversed(_ODD[:2]):
            x = back(x * np.uint64(pow(odd, -1, 1 << 64)) & self.mask)
        for i, other in enumerate(key[1:]):
            x = x ^ _mixed(other, _ODD[4 + i])
        return np.vstack([x, key[1:]])


def _mixed(x: np.ndarray, odd: int) -> np.ndarray:
    x = (x ^ x >> np.uint64(32)) * np.uint64(odd)
    return x ^ x >> np.uint64(29)


def added_up(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys in order (first column first) and the sums of their counts."""
    order = np.argsort(keys[0], kind="stable") if len(keys) == 1 else np.lexsort(keys[::-1])
    keys, counts = keys[:, order], counts[order]
    new = np.ones(len(order), bool)
    new[1:] = (keys[:, 1:] != keys[:, :-1]).any(axis=0)
    begin = np.flatnonzero(new)
    return keys[:, begin], np.add.reduceat(counts, begin) if len(begin) else counts


def write_filter(keys: np.ndarray, counts: np.ndarray, low: int) -> bytes:
    """A counting quotient filter of scrambled keys in order: quotients in unary, remainders, counters.

    The quotient is what is left of the first column's ``low`` bits when the remainder
    takes whole bytes, with about as many values as there are keys.
    """
    size = len(counts)
    tail = min(8, max(0, -(-(low - max(0, size.bit_length())) // 8)))  # bytes of the remainder in the first column
    first = keys[0]
    quotient = (first >> np.uint64(8 * tail) if tail < 8 else np.zeros(size, np.uint64)).astype(np.int64)
    base = int(quotient[0]) if size else 0
    unary = np.zeros(size + (int(quotient[-1]) - base if size else 0), np.uint8)
    unary[quotient - base + np.arange(size)] = 1
    small = np.minimum(counts, 255).astype(np.uint8)
    parts = [
        np.array([size, tail, base, len(unary)], "<i8").tobytes(),
        np.packbits(unary).tobytes(),
        first.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :tail].tobytes(),
        keys[1:].astype("<u8").tobytes(),
        small.tobytes(),
        counts[small == 255].astype("<i8").tobytes(),
    ]
    return b"".join(parts)


def read_filter(data: bytes, columns: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys and counts of a filter."""
    size, tail, base, bits = np.frombuffer(data, "<i8", 4).tolist()
    at = 32
    unary = np.unpackbits(np.frombuffer(data, np.uint8, -(-bits // 8), at))[:bits]
    at += -(-bits // 8)
    first = np.zeros((size, 8), np.uint8)
    first[:, :tail] = np.frombuffer(data, np.uint8, size * tail, at).reshape(size, tail)
    at += size * tail
    quotient = (np.flatnonzero(unary) - np.arange(size) + base).astype(np.uint64)
    keys = np.empty((columns, size), np.uint64)
    keys[0] = first.view("<u8")[:, 0]
    if tail < 8:
        keys[0] |= quotient << np.uint64(8 * tail)
    keys[1:] = np.frombuffer(data, "<u8", (columns - 1) * size, at).reshape(columns - 1, size)
    at += 8 * (columns - 1) * size
    counts = np.frombuffer(data, np.uint8, size, at).astype(np.int64)
    counts[counts == 255] = np.frombuffer(data, "<i8", -1, at + size)
    return keys, counts


# --- counting n-grams -------------------------------------------------------------------


def _bits_of(key: np.ndarray, bits: int) -> list[np.ndarray]:
    """Places of a key (not scrambled) in the bitmap."""
    x = np.zeros(key.shape[1], np.uint64)
    for i, column in enumerate(key):
        x = _mixed(x + column, _ODD[i])
    return [_mixed(x, _ODD[4 + i]) % np.uint64(bits) for i in range(BITS_EACH)]


def _bitmap(spark, frequent: DataFrame, packing: Packing, ranked: np.ndarray | None) -> np.ndarray:
    """The bitmap of frequent n-grams, put together from its words of 64 bits."""
    n, bits = packing.n, BITMAP_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [batch.column(f"w{i}").to_numpy().view(np.uint64) for i in range(n)]
            if ranked is not None:
                ids = [np.searchsorted(ranked, one).astype(np.uint64) for one in ids]
            places = np.unique(np.concatenate(_bits_of(packing.pack(ids), bits)))
            slot, start = np.unique(places >> np.uint64(6), return_index=True)
            value = np.bitwise_or.reduceat(np.uint64(1) << (places & np.uint64(63)), start) if len(slot) else places
            yield pa.RecordBatch.from_arrays([pa.array(slot.astype(np.int64)), pa.array(value.view(np.int64))], ["slot", "value"])

    rows = frequent.select(*[f"w{i}" for i in range(n)]).mapInArrow(run, "slot long, value long")
    # bounded: a row for each 64 bits of the bitmap at most
    found = rows.groupBy("slot").agg(F.bit_or("value").alias("value")).toArrow()
    bitmap = np.zeros(-(-bits // 64), np.uint64)
    bitmap[found.column("slot").to_numpy()] = found.column("value").to_numpy().view(np.uint64)
    return bitmap


def _held(bitmap: np.ndarray, key: np.ndarray) -> np.ndarray:
    out = np.ones(key.shape[1], bool)
    for place in _bits_of(key, len(bitmap) * 64):
        out &= (bitmap[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)
    return out


def _frequent_grams(corpus: DataFrame, n: int, bits: int, total: int, ranked: np.ndarray | None, bitmap: np.ndarray | None, least: int) -> DataFrame:
    """``w0`` to ``w{n-1}`` (hashes of the words), ``a`` of the n-grams with ``least`` occurrences or more."""
    packing, shorter = Packing(n, bits), Packing(n - 1, bits)
    ranges = 1 << min(packing.low, max(0, -(-total // RANGE_GRAMS) - 1).bit_length())
    shift = np.uint64(packing.low - ranges.bit_length() + 1)
    width = "<u4" if ranked is not None else "<u8"
    shared = corpus.sparkSession.sparkContext.broadcast((bitmap, ranked))

    def filters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = np.zeros((packing.columns, 0), np.uint64), np.zeros(0, np.int64)
        waiting, size = [], 0

        def taken() -> tuple[np.ndarray, np.ndarray]:
            new = packing.scramble(np.concatenate(waiting, axis=1))
            new, one = added_up(new, np.ones(new.shape[1], np.int64))
            return added_up(np.concatenate([keys, new], axis=1), np.concatenate([counts, one]))

        def sent() -> pa.RecordBatch:
            part = (keys[0] >> shift).astype(np.int64) if ranges > 1 else np.zeros(len(counts), np.int64)
            begin = np.flatnonzero(np.diff(part, prepend=-1))
            end = np.append(begin[1:], len(part))
            blobs = [write_filter(keys[:, a:b], counts[a:b], packing.low) for a, b in zip(begin.tolist(), end.tolist())]
            return pa.RecordBatch.from_arrays([pa.array(part[begin], pa.int64()), pa.array(blobs, pa.binary())], ["range", "filter"])

        for batch in batches:
            for row in batch.column("ids"):
                ids = np.frombuffer(row.as_buffer(), width)
                ends = ids == np.iinfo(width).max
                ids = ids.astype(np.uint64)
                whole = ~ends
                for i in range(1, n):
                    whole = whole[:-1] & ~ends[i:]
                at = np.flatnonzero(whole)
                if bitmap_used and len(at):
                    first = shorter.pack([ids[at + i] for i in range(n - 1)])
                    second = shorter.pack([ids[at + i + 1] for i in range(n - 1)])
                    kept = shared.value[0]
                    at = at[_held(kept, first) & _held(kept, second)]
                if len(at):
                    waiting.append(packing.pack([ids[at + i] for i in range(n)]))
                    size += len(at)
                if size >= TAKEN:
                    keys, counts = taken()
                    waiting, size = [], 0
                    if len(counts) >= HELD:
                        yield sent()
                        keys, counts = keys[:, :0], counts[:0]
        if size:
            keys, counts = taken()
        if len(counts):
            yield sent()

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value[1]
        for table, starts in sorted_groups(batches, ["range"]):
            for start, end in zip(starts.tolist(), [*starts[1:].tolist(), table.num_rows]):
                keys, counts, waiting, size = np.zeros((packing.columns, 0), np.uint64), np.zeros(0, np.int64), [], 0
                for i in range(start, end):
                    waiting.append(read_filter(table.column("filter")[i].as_py(), packing.columns))
                    size += len(waiting[-1][1])
                    if size >= max(TAKEN, len(counts)) or i == end - 1:
                        keys, counts = added_up(
                            np.concatenate([keys, *[k for k, _ in waiting]], axis=1), np.concatenate([counts, *[c for _, c in waiting]])
                        )
                        waiting, size = [], 0
                often = counts >= least
                ids = packing.unpack(packing.unscramble(keys[:, often]))
                if words is not None:
                    ids = [words[one.astype(np.int64)] for one in ids]
                arrays = [*[pa.array(one.view(np.int64), pa.int64()) for one in ids], pa.array(counts[often], pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, [*[f"w{i}" for i in range(n)], "a"])

    bitmap_used = bitmap is not None
    schema = ", ".join(f"w{i} long" for i in range(n)) + ", a long"
    found = corpus.mapInArrow(filters, "range long, filter binary")
    return found.repartition(ranges, "range").sortWithinPartitions("range").mapInArrow(merged, schema)


# --- collocations -----------------------------------------------------------------------


def _key(columns: list[str]) -> Column:
    return F.array(*[F.col(c) for c in columns])


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, top: int = TOP, lang: str = "lang", text: str = "text") -> DataFrame:
    """The first ``top`` collocations of every language.

    Texts (null: empty) are lower-cased (A-Z), cut into pieces at ``[.,;:!?\\x0A-\\x0D]``
    and those into words ``[^\\x20\\x09]+``. Phrases of two to ``longest`` words in a piece
    that occur ``least`` times or more in their language (null: ``und``) are candidates,
    overlaps counted. Cut after ``k`` words, a candidate with ``a`` occurrences has the
    score ``floor(2000000 * a / (l + r))``, where its parts occur ``l`` and ``r`` times; its
    lowest cut counts, ties to the smallest ``k``. Candidates inside a longer one that
    occurs at least 0.8 times as often are dropped.

    Gives ``lang, rank, phrase, a, l, r, n, score``; ``n`` is the number of words of the
    language; ranks go by score and ``a``, both falling, and the phrase. Repeated rows
    count each; an empty table gives no rows; further columns are ignored. Runs jobs when
    called.
    """
    docs = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    words, seed = all_words(docs)
    often = materialise(words.where(F.col("n") >= least), "frequent-words")
    total, found = words.agg(F.sum("n")).first()[0] or 0, often.count()
    ranked = None
    if found <= RANKED_WORDS:
        ranked = np.sort(often.select("id").toArrow().column("id").to_numpy().view(np.uint64))  # bounded by RANKED_WORDS
    bits = max(1, int(found).bit_length()) if ranked is not None else 64
    corpus = materialise(_numbered(docs, seed, ranked), "numbered", "zstd")
    bitmap = None if ranked is not None else _bitmap(docs.sparkSession, often.withColumnRenamed("id", "w0"), Packing(1, 64), None)
    grams = []
    for n in range(2, longest + 1):
        grams.append(materialise(_frequent_grams(corpus, n, bits, total, ranked, bitmap, least), f"grams-{n}", "zstd"))
        if n < longest:
            bitmap = _bitmap(docs.sparkSession, grams[-1], Packing(n, bits), ranked)
    return _ranked(_scored(grams, often), words, often, top)


def _scored(grams: list[DataFrame], often: DataFrame) -> DataFrame:
    """``ids, a, l, r, score`` of the candidates that stay."""
    every = often.select(F.array("id").alias("ids"), F.col("n").alias("a"))
    for i, one in enumerate(grams):
        every = every.unionAll(one.select(_key([f"w{j}" for j in range(i + 2)]).alias("ids"), "a"))
    every = materialise(every, "counts", "zstd")
    candidates = every.where(F.size("ids") > 1)
    part = F.explode(F.expr("flatten(transform(sequence(2, size(ids) - 1), m -> transform(sequence(1, size(ids) - m + 1), s -> slice(ids, s, m))))"))
    inside = candidates.where(F.size("ids") > 2).select(part.alias("ids"), F.col("a").alias("longer")).groupBy("ids").agg(F.max("longer").alias("longer"))
    wide = "decimal(38,0)"
    swallowed = 100 * F.col("longer").cast(wide) >= 80 * F.col("a").cast(wide)
    kept = materialise(candidates.join(inside, "ids", "left").where(~F.coalesce(swallowed, F.lit(False))).select("ids", "a"), "kept", "zstd")
    cuts = kept.select("ids", "a", F.explode(F.expr("sequence(1, size(ids) - 1)")).alias("k"))
    cuts = cuts.select("ids", "a", "k", F.expr("slice(ids, 1, k)").alias("left"), F.expr("slice(ids, k + 1, size(ids) - k)").alias("right"))
    cuts = cuts.join(every.select(F.col("ids").alias("left"), F.col("a").alias("l")), "left").join(every.select(F.col("ids").alias("right"), F.col("a").alias("r")), "right")
    score = F.expr("(cast(2000000 as decimal(38,0)) * a) div (cast(l as decimal(38,0)) + r)")
    best = cuts.groupBy("ids", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    return best.select("ids", "a", "cut.l", "cut.r", "cut.score")


def _ranked(scored: DataFrame, words: DataFrame, often: DataFrame, top: int) -> DataFrame:
    scored = materialise(scored, "scored", "zstd")
    spelled = scored.select("ids", F.posexplode("ids").alias("at", "id")).join(often.select("id", "lang", "word"), "id")
    phrase = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda w: w["word"]), " ").alias("phrase")
    named = spelled.groupBy("ids").agg(F.min("lang").alias("lang"), phrase)
    sums = words.groupBy("lang").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    first = scored.join(named, "ids").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return first.join(sums, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
