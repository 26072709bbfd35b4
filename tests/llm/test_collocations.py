"""Collocations, held against plain counting; filters and packing against themselves."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from partflow.llm import collocations as c

SCHEMA = "lang string, text string"


def plainly(rows, least, top, longest=4):
    counts, sums = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(x.lower() if "A" <= x <= "Z" else x for x in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = re.findall("[^\x20\x09]+", piece)
            sums[lang] += len(words)
            for n in range(1, longest + 1):
                for i in range(len(words) - n + 1):
                    counts[lang, tuple(words[i : i + n])] += 1
    often = {g: a for g, a in counts.items() if len(g[1]) > 1 and a >= least}
    out = defaultdict(list)
    for (lang, words), a in often.items():
        if any(
            lang == other and len(more) > len(words) and 100 * b >= 80 * a and any(more[i : i + len(words)] == words for i in range(len(more)))
            for (other, more), b in often.items()
        ):
            continue
        cuts = [(counts[lang, words[:k]], counts[lang, words[k:]]) for k in range(1, len(words))]
        score, _, left, right = min((2000000 * a // (x + y), k, x, y) for k, (x, y) in enumerate(cuts))
        out[lang].append((-score, -a, " ".join(words).encode(), left, right))
    return {
        (lang, rank, phrase.decode(), -a, left, right, sums[lang], -score)
        for lang, found in out.items()
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1)
    }


def corpus(seed, size=120):
    rng = random.Random(seed)
    words = ["The", "of", "ÀB", "new", "york", "a\0b", "hot", "dog", "cat's", "€"]
    phrases = [" ".join(rng.choice(words) for _ in range(rng.randint(2, 6))) for _ in range(6)]
    rows = []
    for _ in range(size):
        parts = [rng.choice(phrases) if rng.random() < 0.5 else rng.choice(words) for _ in range(rng.randint(0, 12))]
        rows.append((rng.choice(["en", "de", None, ""]), rng.choice([" ", "  ", "\t", ", ", "\n"]).join(parts)))
    return [*rows, ("en", None), (None, ""), ("de", "new york " * 300), ("und", "new york! New York")]


@pytest.mark.parametrize("ranked", [True, False])
@pytest.mark.parametrize("small", [True, False])
def test_equals_plain_counting(spark, monkeypatch, ranked, small):
    if not ranked:
        monkeypatch.setattr(c, "RANKED_WORDS", 0)
    if small:
        for name, value in {"ROW_WORDS": 50, "TAKEN": 40, "HELD": 30, "RANGE_GRAMS": 64, "BITMAP_BITS": 1 << 8, "_COUNTED": 5, "_KNOWN": 4}.items():
            monkeypatch.setattr(c, name, value)
    rows = corpus(ranked + 2 * small)
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("id", F.lit(1)).withColumn("a.b", F.lit(1)).repartition(3)
    found = c.collocations(docs, least=4, top=15)
    want = plainly(rows, 4, 15)
    assert {tuple(r) for r in found.collect()} == want and len(want) > 20


def test_phrases_of_three_words_at_most(spark):
    rows = corpus(9)
    assert {tuple(r) for r in c.collocations(spark.createDataFrame(rows, SCHEMA), 3, 5, 10).collect()} == plainly(rows, 5, 10, 3)


def test_empty_and_wordless(spark):
    assert c.collocations(spark.createDataFrame([], SCHEMA)).collect() == []
    assert c.collocations(spark.createDataFrame([("en", None), (None, " . ")], SCHEMA)).collect() == []


@pytest.mark.parametrize("n, bits", [(2, 1), (2, 7), (2, 32), (3, 22), (4, 16), (4, 17), (4, 22), (2, 64), (4, 64)])
def test_keys_and_filters_lose_nothing(n, bits):
    rng = np.random.default_rng(n * bits)
    packing = c.Packing(n, bits)
    numbers = [rng.integers(0, 2**bits, 500, dtype=np.uint64) if bits < 64 else rng.integers(0, 2**64, 500, dtype=np.uint64) for _ in range(n)]
    numbers[0][:3], numbers[1][:3] = 0, np.uint64(2**bits - 1)
    key = packing.pack(numbers)
    mixed = packing.scramble(key)
    assert (mixed[0] <= packing.mask).all() and (packing.unscramble(mixed) == key).all()
    assert all((a == b).all() for a, b in zip(packing.unpack(key), numbers))
    keys, counts = c.added_up(mixed, rng.integers(1, 600, 500))
    for part in (slice(None), slice(0, 1), slice(0, 0), slice(len(counts) // 3, None)):
        back, times = c.read_filter(c.write_filter(keys[:, part], counts[part], packing.low), packing.columns)
        assert (back == keys[:, part]).all() and (times == counts[part]).all()


def test_scores_pass_64_bits(spark):
    big = 2**62
    often = spark.createDataFrame([(1, "en", "a", big), (2, "en", "b", big)], "id long, lang string, word string, n long")
    grams = [spark.createDataFrame([(1, 2, big - 1)], "w0 long, w1 long, a long")]
    (row,) = c._scored(grams, often).collect()
    assert row.score == 2000000 * (big - 1) // (2 * big)
