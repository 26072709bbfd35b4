"""Spelling variants: words that differ by one letter, found in a bidirectional FM-index.

Of a word and a word near it, either half is the same: the letter that differs is in the
other one. A search scheme has two searches. One starts at the word's end, matches its
second half exactly and goes on through the first half, where one letter may be replaced,
left out or put in; the other does the same from the beginning. What is matched so far is
an interval of suffix ranks over the words written one behind the other with a delimiter
between them; the search to the right runs in the index of the reversed words.

Words meet where the half that must agree makes them meet: by their last letters for the
first search, by their first letters for the second.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partflow.llm.common import in_batches, materialise
from partflow.llm.units import chunk_pairs, sorted_groups

#: Letters of the shortest word, and occurrences of the rarest.
LEAST_LETTERS, LEAST_COUNT = 5, 3
#: One in so many of the words of a document loses a letter.
ONE_IN = 97
#: Letters by which words meet; the shortest words' halves have as many.
LAST, FIRST = 3, 2
#: Words in an index, about; words that meet are cut into chunks of as many.
INDEX_WORDS = 1 << 15
#: Words looked for at a time, and different words a task holds before it sends their counts.
_QUERIES, _HELD = 1 << 11, 1 << 20
_RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")


# --- the words --------------------------------------------------------------------------


def words_of(doc_id: object, text: str) -> Counter[bytes]:
    """How often each word occurs in a document, as UTF-8.

    Words are the runs of ASCII letters and U+00C0 to U+00FF, A-Z in lower case. Where
    ``ONE_IN`` divides the CRC-32 ``h`` of ``<doc_id>:<run>``, the code point with the
    number ``h`` modulo their number is left out.
    """
    found = Counter(_RUN.findall(text.encode().lower()))
    start = zlib.crc32(b":" if doc_id is None else f"{doc_id}:".encode())
    hashed = [(run, zlib.crc32(run, start)) for run in found]
    cut = []
    for run, h in hashed:
        if h % ONE_IN == 0:
            letters = run.decode()
            at = h % len(letters)
            cut.append(((letters[:at] + letters[at + 1 :]).encode(), found.pop(run)))
    for word, n in cut:  # only now: what is left of one run may be another one that loses a letter
        found[word] += n
    return found


def count_words(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``word``, ``n`` of the words with ``LEAST_LETTERS`` or more that occur ``LEAST_COUNT`` times or more in all documents.

    A null text has no words; a null key is written as nothing; repeated rows count each.
    """

    def sent(counts: dict[bytes, int]) -> pa.RecordBatch:
        long = [(w.decode(), n) for w, n in counts.items() if len(w) - w.count(b"\xc3") >= LEAST_LETTERS]
        return pa.RecordBatch.from_arrays([pa.array([w for w, _ in long], pa.string()), pa.array([n for _, n in long], pa.int64())], ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, int] = {}
        for batch, texts in in_batches(batches):
            for doc_id, one in zip(batch.column("key").to_pylist(), texts):
                for word, n in words_of(doc_id, one).items():
                    counts[word] = counts.get(word, 0) + n
            if len(counts) >= _HELD:
                yield sent(counts)
                counts = {}
        yield sent(counts)

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


# --- the index --------------------------------------------------------------------------


class Index:
    """FM-index of different words: ``$word$word...$``, searched from the words' ends to their beginnings."""

    def __init__(self, words: list[str]) -> None:
        self.order = sorted(range(len(words)), key=words.__getitem__)
        text = np.array(list(map(ord, "".join("\0" + words[i] for i in self.order) + "\0")), np.int64)
        self.letters = np.unique(text)  # the first one is the delimiter
        code = np.searchsorted(self.letters, text)
        size, marks = len(code), np.flatnonzero(code == 0)
        # ranks of suffixes: by one letter, then by twice as many with each round; delimiters differ, in the order of
        # the words behind them, so no comparison goes on into the next word
        rank = code + len(marks)
        rank[marks] = np.arange(len(marks))
        step = 1
        while True:
            behind = np.zeros(size, np.int64)
            behind[:-step] = rank[step:] + 1
            names, rank = np.unique(rank * (size + len(marks) + len(self.letters) + 2) + behind, return_inverse=True)
            if len(names) == size:
                break
            step *= 2
        suffixes = np.argsort(rank)
        self.before = np.where(suffixes > 0, code[suffixes - 1], len(self.letters))  # nothing stands before the first
        self.size, self.words = size, len(marks) - 1
        kinds = len(self.letters) + 1
        self.places = np.sort(self.before * (size + 1) + np.arange(size))
        starts = np.concatenate([[0], np.cumsum(np.bincount(code, minlength=kinds))[:-1]])
        held = np.concatenate([[0], np.cumsum(np.bincount(self.before, minlength=kinds))[:-1]])
        self.shift = starts - held

    def step(self, letter: np.ndarray, at: np.ndarray) -> np.ndarray:
        """A bound of an interval after a letter is put before what is matched."""
        return self.shift[letter] + np.searchsorted(self.places, letter * (self.size + 1) + at)

    def branches(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
        """All letters (no delimiters) before what is matched: number of the interval, letter, new interval."""
        kinds = len(self.letters)
        narrow = high - low <= kinds
        some = np.flatnonzero(narrow)
        sizes = (high - low)[some]
        rows = np.repeat(low[some] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        pairs = np.unique(np.repeat(some, sizes) * (kinds + 1) + self.before[rows])
        wide = np.flatnonzero(~narrow)
        number = np.concatenate([pairs // (kinds + 1), np.repeat(wide, kinds - 1)])
        letter = np.concatenate([pairs % (kinds + 1), np.tile(np.arange(1, kinds), len(wide))])
        real = (letter > 0) & (letter < kinds)
        number, letter = number[real], letter[real]
        new_low, new_high = self.step(letter, low[number]), self.step(letter, high[number])
        some = new_low < new_high
        return number[some], letter[some], new_low[some], new_high[some]

    def near(self, words: list[str], exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (number in ``words``, number of a word of the index) that differ by one letter before the last ``exact`` ones."""
        size = np.array([len(w) for w in words])
        codes = np.full((len(words), int(size.max(initial=0)) + 1), -1, np.int64)  # letters from the end; -1: unknown
        for i, word in enumerate(words):
            points = np.array(list(map(ord, word[::-1])), np.int64)
            at = np.minimum(np.searchsorted(self.letters, points), len(self.letters) - 1)
            codes[i, : len(points)] = np.where(self.letters[at] == points, at, -1)
        low, high = np.zeros(len(words), np.int64), np.full(len(words), self.words + 1)
        alive = np.arange(len(words))
        for t in range(int(exact.max(initial=0))):
            on = alive[exact[alive] > t]
            letter = codes[on, t]
            on, letter = on[letter > 0], letter[letter > 0]
            low[on], high[on] = self.step(letter, low[on]), self.step(letter, high[on])
            alive = np.concatenate([alive[exact[alive] <= t], on[low[on] < high[on]]])
        done = np.zeros(len(words), np.int64) + exact
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        while len(alive):
            q, t = alive, done[alive]
            left = t < size[q]  # letters of the word remain
            number, letter, new_low, new_high = self.branches(low[q], high[q])
            other = left[number] & (letter != codes[q[number], t[number]])
            gone = np.flatnonzero(left)
            states = [
                (q[number], t[number], new_low, new_high),  # a letter put in
                (q[number][other], t[number][other] + 1, new_low[other], new_high[other]),  # a letter replaced
                (q[gone], t[gone] + 1, low[q[gone]], high[q[gone]]),  # a letter left out
            ]
            found.append(self._finished(*(np.concatenate(s) for s in zip(*states)), codes, size))
            alive = q[left]
            letter = codes[alive, done[alive]]
            alive, letter = alive[letter > 0], letter[letter > 0]
            low[alive], high[alive] = self.step(letter, low[alive]), self.step(letter, high[alive])
            done[alive] += 1
            alive = alive[low[alive] < high[alive]]
        pairs = np.unique(np.concatenate([q * (self.words + 1) + w for q, w in found]))
        return pairs // (self.words + 1), np.array(self.order, np.int64)[pairs % (self.words + 1)]

    def _finished(self, q, t, low, high, codes, size) -> tuple[np.ndarray, np.ndarray]:
        """Go on exactly to the beginnings of words; the words that are found."""
        found = []
        while len(q):
            ends = t == size[q]
            a, b = self.step(np.zeros(int(ends.sum()), np.int64), low[ends]), self.step(np.zeros(int(ends.sum()), np.int64), high[ends])
            found.append((q[ends][a < b], a[a < b]))  # words differ, so there is one
            q, t, low, high = (x[~ends] for x in (q, t, low, high))
            letter = codes[q, t]
            q, t, low, high, letter = (x[letter > 0] for x in (q, t, low, high, letter))
            low, high = self.step(letter, low), self.step(letter, high)
            some = low < high
            q, t, low, high = q[some], t[some] + 1, low[some], high[some]
        return tuple(np.concatenate([f[i] for f in found] or [np.zeros(0, np.int64)]) for i in (0, 1))


def near_words(words: list[str], others: list[str], from_end: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of numbers of ``words`` and ``others`` found by one of the two searches."""
    halves = [len(w) - len(w) // 2 if from_end else len(w) // 2 for w in words]
    if not from_end:
        words, others = [w[::-1] for w in words], [w[::-1] for w in others]
    index = Index(others)
    for i in range(0, len(words), _QUERIES):
        number, other = index.near(words[i : i + _QUERIES], np.array(halves[i : i + _QUERIES]))
        yield number + i, other


# --- over a table -----------------------------------------------------------------------


def near_pairs(vocabulary: DataFrame) -> DataFrame:
    """All pairs of words one letter apart, each once: ``a, n_a, b, n_b``; ``vocabulary`` (a written table) has different words and ``n``."""
    total = vocabulary.count()
    last = F.struct(F.lit(True).alias("from_end"), F.substring("word", -LAST, LAST).alias("by"))
    first = F.struct(F.lit(False).alias("from_end"), F.substring("word", 1, FIRST).alias("by"))
    rows = vocabulary.select("word", "n", F.explode(F.array(last, first)).alias("m")).select("word", "n", "m.from_end", "m.by")
    meet = rows.groupBy("from_end", "by").agg(F.count("*").alias("size"))
    large = materialise(meet.where(F.col("size") > INDEX_WORDS).select("from_end", "by", F.ceil(F.col("size") / INDEX_WORDS).cast("int").alias("chunks")), "large-groups")
    rows = rows.join(large, ["from_end", "by"], "left")
    pools = max(1, -(-total // INDEX_WORDS))
    pool = F.when(F.col("chunks").isNull(), F.pmod(F.xxhash64("by"), F.lit(pools)).cast("string")).otherwise(F.concat(F.lit("="), F.col("by")))
    chunks = F.coalesce("chunks", F.lit(1))
    chunk = F.pmod(F.xxhash64("word", F.lit(7)), chunks).cast("int")
    units = rows.select("word", "n", "from_end", pool.alias("pool"), F.explode(chunk_pairs(chunk, chunks)).alias("u"))
    units = units.select("from_end", "pool", "u.ci", "u.cj", "u.side", "word", "n")
    by = ["from_end", "pool", "ci", "cj"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in sorted_groups(batches, by):
            for start, end in zip(starts.tolist(), [*starts[1:].tolist(), table.num_rows]):
                unit = table.slice(start, end - start)
                words, n, side = unit.column("word").to_pylist(), unit.column("n").to_numpy(), unit.column("side").to_numpy()
                across = unit.column("ci")[0] != unit.column("cj")[0]
                mine = np.flatnonzero(side == 0)
                theirs = np.flatnonzero(side == 1) if across else mine
                if len(mine) == 0 or len(theirs) == 0:
                    continue
                searched = near_words([words[i] for i in mine.tolist()], [words[i] for i in theirs.tolist()], unit.column("from_end")[0].as_py())
                for number, other in searched:
                    pairs = [(i, j) for i, j in zip(mine[number].tolist(), theirs[other].tolist()) if across or words[i] < words[j]]
                    a, b = [min(p, key=words.__getitem__) for p in pairs], [max(p, key=words.__getitem__) for p in pairs]
                    arrays = [pa.array([words[i] for i in a], pa.string()), pa.array(n[a], pa.int64()), pa.array([words[i] for i in b], pa.string()), pa.array(n[b], pa.int64())]
                    yield pa.RecordBatch.from_arrays(arrays, ["a", "n_a", "b", "n_b"])

    found = units.repartition(*by).sortWithinPartitions(*by).mapInArrow(run, "a string, n_a long, b string, n_b long")
    return found.distinct()


def group_variants(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every word with the frequent word that it is a variant of.

    ``word``, ``form`` (of the words one letter apart that with the most occurrences, ties
    to the first in code-point order, if it has twice the word's or more; else null),
    ``root`` (where forms lead), ``n``, ``n_near`` (words one letter apart), ``form_n``.
    Words are those of :func:`count_words`, which says what nulls do; an empty table gives
    no rows; further columns are ignored. Runs jobs when called.
    """
    vocabulary = materialise(count_words(docs, key, text), "words")
    pairs = materialise(near_pairs(vocabulary), "near-words")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("n_b").alias("n")).unionAll(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("other"), F.col("n_a").alias("n"))
    )
    best = F.min(F.struct((-F.col("n")).alias("n"), "other")).alias("best")
    near = both.groupBy("word").agg(F.count("*").alias("n_near"), best).select("word", "n_near", F.col("best.other").alias("other"), (-F.col("best.n")).alias("other_n"))
    is_form = F.col("other_n") >= 2 * F.col("n")
    rows = vocabulary.join(near, "word", "left").select(
        "word",
        F.when(is_form, F.col("other")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(is_form, F.col("other_n")).alias("form_n"),
    )
    rows = materialise(rows, "forms")
    roots = rows.where("form is not null").select("word", F.col("form").alias("root"))
    while True:  # each round doubles the steps taken; a form has twice the occurrences, so the ways are short
        then = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = roots.join(then, "root", "left")
        roots = materialise(further.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if roots.where("moved").limit(1).count() == 0:
            break
        roots = roots.drop("moved")
    found = rows.join(roots.drop("moved"), "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
