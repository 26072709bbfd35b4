"""Spelling variants, held against deletion neighbourhoods and plain counting."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from partflow.llm import variants


def one_apart(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain_words(rows):
    counts = Counter()
    for doc, text in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 5:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 3}


def plainly(rows):
    words = plain_words(rows)
    holes = defaultdict(set)  # words by what is left without a letter, and by itself
    for w in words:
        for i in range(len(w)):
            holes[w[:i] + w[i + 1 :]].add(w)
        holes[w].add(w)
    near = defaultdict(set)
    for met in holes.values():
        for a in met:
            near[a] |= {b for b in met if one_apart(a, b)}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda o: (-words[o], o), default=None)
        if best is not None and words[best] >= 2 * n:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, form.get(w), root(w), n, len(near[w]), words.get(form.get(w))) for w, n in words.items()}


def spelled(rng, size):
    letters = "abcdéÿa" if rng.random() < 0.5 else "ab"
    stems = ["".join(rng.choice(letters) for _ in range(rng.randint(4, 9))) for _ in range(size)]
    for w in list(stems):
        i = rng.randrange(len(w))
        stems.append(rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice(letters) + w[i:], w[:i] + rng.choice(letters) + w[i + 1 :]]))
    return stems


def test_a_run_that_becomes_another_run_that_loses_a_letter():
    # in each of these documents one run loses a letter and becomes the next one, which loses a letter as well
    text = " ".join("a" * k for k in range(39, 3, -1) for _ in range(3))
    for doc in (88, 1193, 1217):
        assert any(zlib.crc32(f"{doc}:{'a' * k}".encode()) % 97 == 0 == zlib.crc32(f"{doc}:{'a' * (k + 1)}".encode()) % 97 for k in range(4, 39))
        found = variants.words_of(doc, text)
        assert {w.decode(): n for w, n in found.items() if len(w) >= 5} == plain_words([(doc, text)])
        assert sum(found.values()) == 36 * 3


@pytest.mark.parametrize("seed", range(6))
def test_both_searches_find_all_words_one_letter_apart(seed):
    words = sorted({w for w in spelled(random.Random(seed), 120) if len(w) >= 4})
    want = {(a, b) for a in words for b in words if one_apart(a, b)}
    found = set()
    for from_end in (True, False):
        for number, other in variants.near_words(words, words, from_end):
            found |= {(words[i], words[j]) for i, j in zip(number.tolist(), other.tolist())}
    assert found == want


def test_an_index_of_one_word_and_unknown_letters():
    index = variants.Index(["abcde"])
    number, other = index.near(["abcde", "abde", "xbcde", "zzzzz", "abcdef"], np.array([2, 2, 2, 2, 0]))
    assert list(zip(number.tolist(), other.tolist())) == [(1, 0), (2, 0), (4, 0)]


@pytest.mark.parametrize("size", [1 << 15, 8])
def test_equals_plain_counting(spark, monkeypatch, size):
    rng = random.Random(size)
    words = spelled(rng, 80) + ["Straße", "STRASSE", "ÀÉÎ", "àéîõü"]
    rows = [(i, " ".join(rng.choice(words[: rng.randint(1, len(words))]) for _ in range(rng.randint(0, 40))) + "," + "9x") for i in range(150)]
    rows += [(1, None), (None, "nobody nobody nobody nobody"), (3, ""), (3, "twice " * 4), (3, "twice " * 4), (7, "q" * 20_000)]
    monkeypatch.setattr(variants, "INDEX_WORDS", size)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("word", F.lit("x")).withColumn("a.b", F.lit(1))
    found = variants.group_variants(docs.repartition(3))
    assert {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in found.collect()} == plainly(rows)
    assert found.count() == len(plain_words(rows))


def test_empty_table(spark):
    assert variants.group_variants(spark.createDataFrame([], "doc_id long, text string")).collect() == []
