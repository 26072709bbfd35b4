"""Benchmark decontamination: training passages as queries of a BM25 index of test items.

The index lists, for each term, the items that hold it with their BM25 impact, as a share
of the item's own score (what it gets if all its terms are found). Lists are cut into
blocks of items with the largest impact of each block. A passage asks for all items at
or above the threshold with block-max WAND. As the threshold is fixed, the lists from
which a pivot can come are known when the index is built: an item below it without any
of its essential terms is never a pivot. Pivots in blocks whose maxima add up to less
than the threshold are skipped with their block; the rest are scored in full.
Retrieved items are then verified: the passage must hold most of the item's question and
most of its answer, as runs of five words, or most of the words of an item without a
separate answer in their order.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from partflow.llm.common import in_batches, materialise, numbered

K1, B = 1.2, 0.75
#: Share of an item's own score at which it is retrieved, and share of runs that verifies it.
THRESHOLD = 0.75
OVERLAP = 0.8
RUN = 5
#: Words of a passage, doubled until it is twice as long as the item looked for; passages begin every half.
PASSAGE = 128
#: Items of an index in memory; a larger benchmark is searched by several, with the statistics of all its items.
INDEX_ITEMS = 20_000
_BLOCK = 32
_CACHE = 400_000
#: Without letters or digits at their ends.
_EDGES = "".join(chr(c) for c in range(33, 0x250) if not chr(c).isalnum()) + "‘’“”„‚‹›–—…¿¡。、，！？：；（）「」『』"


def clean(word: str) -> str:
    """A word as it is compared: lower case, without punctuation at its ends ('' if nothing is left)."""
    return word.lower().strip(_EDGES)


def words_of(text: str | None) -> list[str]:
    return [w for w in map(clean, (text or "").split()) if w]


def split_item(words: list[str]) -> tuple[list[str], list[str]]:
    """Question and answer of an item without a separate answer: its last quarter is the answer."""
    cut = len(words) - max(1, len(words) // 4)
    return (words[:cut], words[cut:]) if cut else (words, words)


def runs(words: list, width: int = RUN) -> set[tuple]:
    """Runs of five words; of fewer words the whole sequence."""
    width = min(width, len(words))
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if words else set()


def in_order(wanted: list, passage: list) -> float:
    """Share of the wanted words that stand in this order in a stretch of the passage about a quarter longer than they are.

    The longest common subsequence; the bits of an integer are the words wanted.
    """
    n = len(wanted)
    every, places = (1 << n) - 1, {}
    for i, word in enumerate(wanted):
        places[word] = places.get(word, 0) | 1 << i
    step = max(1, n // 8)
    span, most = stretch(n) + step, 0
    for begin in range(0, max(1, len(passage) - span + step), step):
        left = every
        for word in passage[begin : begin + span]:
            if word in places:
                there = left & places[word]
                left = (left + there | left - there) & every
        most = max(most, n - left.bit_count())
    return most / n


def stretch(n: int) -> int:
    """Words of a text in which an item of ``n`` words is looked for."""
    return n + n // 4


def passage_words(n: int, passage: int) -> int:
    """Words of the passages in which what takes ``n`` words is looked for; no other item has a say in it."""
    while passage < 2 * n:
        passage *= 2
    return passage


@dataclass(frozen=True)
class Statistics:
    """What BM25 asks of a benchmark: items with words, their mean length, and for terms how many items hold them."""

    items: int
    mean: float
    held: Mapping[str, int]


def statistics_of(docs: list[list[str]]) -> Statistics:
    return Statistics(len(docs), sum(map(len, docs)) / max(1, len(docs)), Counter(t for d in docs for t in set(d)))


class Index:
    """BM25 over items: ``(item_id, question words, answer words)``; no answer (None): the item is verified as a whole.

    ``statistics`` are those of the whole benchmark if these are only some of its items.
    """

    def __init__(
        self, items: list[tuple[int, list[str], list[str]]], threshold: float = THRESHOLD,
        passage: int = PASSAGE, statistics: Statistics | None = None,
    ) -> None:
        self.items = [i for i in items if i[1] or i[2]]
        self.threshold = threshold
        docs = [q + a if a is not None and q is not a else q for _, q, a in self.items]
        known = statistics or statistics_of(docs)
        held, n, mean = known.held, known.items, known.mean
        words = {t: None for d in docs for t in d}
        idf = {t: math.log(1 + (n - held[t] + 0.5) / (held[t] + 0.5)) for t in words}
        self.term = {t: i for i, t in enumerate(words)}
        # by words of a passage: the terms of which a passage must hold one, and the items that each brings
        self.must: dict[int, np.ndarray] = {}
        self.essential: dict[int, dict[int, list[int]]] = {}
        self.blocks: list[dict[int, float]] = [{} for _ in self.term]
        self.impacts: list[list[tuple[int, float]]] = []
        for at, d in enumerate(docs):
            size = passage_words(stretch(len(d)) if self.items[at][2] is None else len(d), passage)
            if size not in self.must:
                self.must[size] = np.zeros(len(self.term) + 1, bool)  # the last stands for words of no item
                self.essential[size] = {}
            tf = Counter(d)
            raw = {t: idf[t] * c * (K1 + 1) / (c + K1 * (1 - B + B * len(d) / mean)) for t, c in tf.items()}
            own = sum(raw.values())
            spare = own * (1 - threshold)
            self.impacts.append([(self.term[t], w / own) for t, w in raw.items()])
            for t in sorted(raw, key=lambda t: (held[t], -len(t), t)):  # rare ones first
                if spare > -1e-9 * own:  # without these terms the rest is below the threshold
                    self.must[size][self.term[t]] = True
                    self.essential[size].setdefault(self.term[t], []).append(at)
                spare -= raw[t]
                most = self.blocks[self.term[t]]
                most[at // _BLOCK] = max(most.get(at // _BLOCK, 0.0), raw[t] / own)
        code = lambda ws: [self.term[w] for w in ws]
        self.question = [runs(code(q)) for _, q, _ in self.items]
        self.answer = [runs(code(q if a is None else a)) for _, q, a in self.items]
        self.width = [(min(RUN, len(q)), min(RUN, len(q if a is None else a))) for _, q, a in self.items]
        self.whole = [code(q) if a is None and len(q) >= RUN else None for _, q, a in self.items]

    def search(self, terms: list[int], size: int) -> list[tuple[int, float]]:
        """Items (by place) looked for in passages of ``size`` words, with their share of their own score, if at the threshold or above."""
        limit = self.threshold - 1e-9
        pivots: dict[int, set[int]] = {}
        essential = self.essential[size]
        for t in terms:
            for item in essential.get(t, ()):
                pivots.setdefault(item // _BLOCK, set()).add(item)
        found, held = [], set(terms)
        for block in sorted(pivots):
            if sum(self.blocks[t].get(block, 0.0) for t in terms) < limit:
                continue  # no item of the block can reach it
            for item in sorted(pivots[block]):
                score = sum(w for t, w in self.impacts[item] if t in held)
                if score >= limit:
                    found.append((item, score))
        return found

    def verify(self, item: int, passage: list[int]) -> tuple[float, float]:
        """Shares of the item's question and answer that a passage holds, or twice that of the whole item."""
        if self.whole[item] is not None:
            share = in_order(self.whole[item], passage)
            return share, share
        shares = []
        for wanted, width in zip((self.question[item], self.answer[item]), self.width[item]):
            held = {tuple(passage[i : i + width]) for i in range(len(passage) - width + 1)}
            shares.append(len(wanted & held) / len(wanted) if wanted else 1.0)
        return shares[0], shares[1]


class Places(dict):
    """Term numbers of words as they stand in texts; -1: of no item, -2: nothing but punctuation."""

    def __init__(self, terms: dict[str, int]) -> None:
        super().__init__()
        self.terms = terms

    def __missing__(self, word: str) -> int:
        if len(self) > _CACHE:
            self.clear()
        cleaned = clean(word)
        self[word] = found = self.terms.get(cleaned, -1) if cleaned else -2
        return found


def passages_of(n: int, size: int) -> Iterator[tuple[int, int]]:
    """Begin and end of the passages of ``n`` words: every half passage, the last one ends the text."""
    step = max(1, size // 2)
    for begin in range(0, max(1, n - size + step), step):
        yield begin, min(n, begin + size)


def search_text(index: Index, places: Places, text: str, overlap: float = OVERLAP) -> list[tuple[int, int, float, float, float]]:
    """Per verified item: place of the item, first word of its best passage, score, question and answer overlap."""
    raw = text.split()
    at = np.fromiter(map(places.__getitem__, raw), np.int64, len(raw))
    at = at[at > -2]
    best: dict[int, tuple] = {}
    for size, must in index.must.items():
        hits = np.flatnonzero(must[at])
        if not len(hits):
            continue
        for begin, end in passages_of(len(at), size):
            k = np.searchsorted(hits, begin)
            if k == len(hits) or hits[k] >= end:
                continue
            part = at[begin:end]
            terms = np.unique(part[part >= 0]).tolist()
            for item, score in index.search(terms, size):
                question, answer = index.verify(item, part.tolist())
                if question >= overlap and answer >= overlap:
                    one = (score, question + answer, -begin, question, answer)
                    if item not in best or one > best[item]:
                        best[item] = one
    return [(item, -b[2], b[0], b[3], b[4]) for item, b in sorted(best.items())]


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    threshold: float = THRESHOLD,
    overlap: float = OVERLAP,
    passage: int = PASSAGE,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    answer: str | None = None,
    index_items: int = INDEX_ITEMS,
    whole: bool = False,
) -> DataFrame:
    """``key, item_id, first_word, score, question_overlap, answer_overlap`` for every item a document holds.

    One row for each document row and item, with the item's best passage. Without an
    ``answer`` column the last quarter of an item's words is its answer or, with
    ``whole``, an item is verified by its words in their order, which a changed word
    does not undo; both overlaps are then that of the item. Null and
    wordless texts and items match nothing. Items of fewer than five words, or parts of
    them, are looked for as a whole. Repeated rows are judged each; rows that repeat an
    item id are items of their own; further columns are ignored; empty tables give no
    rows. The benchmark passes the driver in blocks of ``index_items`` and is broadcast; each
    block is a pass over the documents and scores as one index of all items would.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind, item_kind = docs.schema[key].dataType.simpleString(), items.schema[item].dataType
    schema = f"key {kind}, item_id {item_kind.simpleString()}, first_word long, score double, question_overlap double, answer_overlap double"
    arrow_item = to_arrow_type(item_kind)
    found = None
    for shared in _blocks(items, item, item_text, answer, index_items, whole):

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            block, statistics = shared.value
            index = Index(block, threshold, passage, statistics)
            places = Places(index.term)
            for batch, texts in in_batches(batches):
                leaks = [(i, *f) for i, one in enumerate(texts) for f in search_text(index, places, one, overlap)]
                columns = list(zip(*leaks)) or [[]] * 6
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("key").take(pa.array(columns[0], pa.int64())),
                        pa.array([index.items[p][0] for p in columns[1]], arrow_item),
                        *[pa.array(c, t) for c, t in zip(columns[2:], [pa.int64(), pa.float64(), pa.float64(), pa.float64()])],
                    ],
                    ["key", "item_id", "first_word", "score", "question_overlap", "answer_overlap"],
                )

        part = rows.mapInArrow(run, schema)
        found = part if found is None else found.unionAll(part)
    return found.withColumnRenamed("key", key)


def drop_leaks(
    docs: DataFrame,
    items: DataFrame,
    threshold: float = THRESHOLD,
    overlap: float = OVERLAP,
    passage: int = PASSAGE,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    answer: str | None = None,
    index_items: int = INDEX_ITEMS,
    whole: bool = False,
) -> DataFrame:
    """The rows that hold no item as :func:`find_leaks` finds them, with all their columns."""
    at_text, names, docs = docs.columns.index(text), docs.columns, numbered(docs)
    schema = docs.schema
    for shared in _blocks(items, item, item_text, answer, index_items, whole):

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            block, statistics = shared.value
            index = Index(block, threshold, passage, statistics)
            places = Places(index.term)
            for batch in batches:
                for part, texts in in_batches([batch], f"c{at_text}"):
                    clean_ = [not search_text(index, places, one, overlap) for one in texts]
                    yield pa.RecordBatch.from_arrays(part.filter(pa.array(clean_)).columns, batch.schema.names)

        docs = docs.mapInArrow(run, schema)
    return docs.toDF(*names)


def _blocks(items: DataFrame, item: str, item_text: str, answer: str | None, size: int, whole: bool = False) -> list:
    """Broadcasts of ``(items, statistics)``, ``size`` items each; one without items if there are none.

    The statistics are of the whole benchmark, for the terms of the block: Spark counts
    them and lays them beside each item's terms. The driver holds one block at a time.
    """
    spark = items.sparkSession
    given = items.select(F.col(item).alias("item"), F.col(item_text).alias("text"), (F.col(answer) if answer else F.lit(None).cast("string")).alias("answer"))
    kind = given.schema["item"].dataType.simpleString()
    schema = f"item {kind}, question array<string>, answer array<string>, same boolean"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for text, separate in zip(batch.column("text").to_pylist(), batch.column("answer").to_pylist()):
                words = words_of(text)
                if separate is not None:
                    parts.append((words, words_of(separate)))
                else:
                    parts.append((words, None) if whole else split_item(words))
            words = pa.list_(pa.string())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("item"),
                    pa.array([q for q, _ in parts], words),
                    pa.array([a for _, a in parts], words),
                    pa.array([a is q for q, a in parts]),
                ],
                ["item", "question", "answer", "same"],
            )

    number = F.monotonically_increasing_id().alias("row")
    known = materialise(given.where(F.col("text").isNotNull()).mapInArrow(cut, schema).select("*", number), "benchmark-words")
    both = F.when(F.col("answer").isNull() | F.col("same"), F.col("question")).otherwise(F.concat("question", "answer"))
    every = known.select("row", both.alias("words")).where(F.size("words") > 0)
    total = every.agg(F.count(F.lit(1)).alias("items"), F.coalesce(F.avg(F.size("words")), F.lit(0.0)).alias("mean")).first()
    terms = every.select("row", F.explode(F.array_distinct("words")).alias("term"))
    held = materialise(terms.groupBy("term").agg(F.count(F.lit(1)).alias("held")), "benchmark-terms")
    beside = terms.join(held, "term").groupBy("row").agg(F.collect_list(F.struct("term", "held")).alias("held"))  # an item's own terms
    rows = materialise(known.join(beside, "row"), "benchmark-items").orderBy(F.size("question"), "row")
    shared, block, counts = [], [], {}
    for r in rows.toLocalIterator():
        if len(block) == size:
            shared.append(spark.sparkContext.broadcast((block, Statistics(total.items, total.mean, counts))))
            block, counts = [], {}
        question = list(r.question)
        block.append((r["item"], question, question if r.same else None if r.answer is None else list(r.answer)))
        counts.update((h.term, h.held) for h in r.held)
    if block or not shared:
        shared.append(spark.sparkContext.broadcast((block, Statistics(total.items, total.mean, counts))))
    return shared
