"""Removal of repeated passages, held against a plain scan."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from partflow.llm import repeats

SCHEMA = "doc_id long, text string"


def plainly(rows, width):
    """Per document in order: bytes, removed bytes, runs, hash of the rest."""
    seen, out = set(), {}
    for doc, text in sorted(rows, key=lambda r: r[0]):
        data = (text or "").encode()
        mark = bytearray(len(data))
        for p in range(len(data) - width + 1):
            if data[p : p + width] in seen:
                mark[p : p + width] = b"\1" * width
            seen.add(data[p : p + width])
        kept = bytes(b for b, m in zip(data, mark) if not m)
        out[doc] = (len(data), sum(mark), len([r for r in bytes(mark).split(b"\0") if r]), hashlib.sha256(kept).hexdigest())
    return out


def removed(spark, rows, schema=SCHEMA, **settings):
    found = repeats.remove_repeats(spark.createDataFrame(rows, schema).repartition(3), **settings).collect()
    return {r["doc_id"]: tuple(r)[1:5] for r in found}


def corpus(seed, size=60):
    rng = random.Random(seed)
    words = ["alpha", "beta", "gämma", "delta", "€", "ab", "ab", "line\n"]
    passages = [" ".join(rng.choice(words) for _ in range(rng.randint(5, 60))) for _ in range(8)]
    rows = []
    for i in range(size):
        parts = []
        for _ in range(rng.randint(0, 5)):
            parts.append(rng.choice(passages) if rng.random() < 0.5 else " ".join(rng.choice(words) + str(rng.randint(0, 99)) for _ in range(rng.randint(1, 40))))
        rows.append((i, "".join(parts)))
    return rows


@pytest.mark.parametrize("width, gram", [(100, 32), (40, 8), (9, 3), (8, 1)])
def test_equals_a_plain_scan(spark, width, gram):
    rows = corpus(width)
    assert removed(spark, rows, width=width, gram=gram) == plainly(rows, width)


def test_large_groups_and_common_strings_change_nothing(spark, monkeypatch):
    rows = corpus(5) + [(1000 + i, f"{i:04d}" + "the same line in many documents, " * 2 + f"{i * 7:05d}" * 30) for i in range(80)]
    want = plainly(rows, 60)
    monkeypatch.setattr(repeats, "GROUP_CELLS", 3)
    assert removed(spark, rows, width=60, gram=16) == want
    monkeypatch.setattr(repeats, "HELD_CELLS", 7)
    assert removed(spark, rows, width=60, gram=16) == want


def test_runs_of_one_byte(spark):
    rows = [(1, "a" * 1000), (2, "a" * 150), (3, "b" * 99), (4, "c" * 100), (5, "xyz" * 400), (6, "a" * 99)]
    assert removed(spark, rows) == plainly(rows, 100)


def test_every_window_is_in_one_cell_however_long_the_text(monkeypatch):
    texts = [("a" * 1000).encode(), b"", b"xyz" * 400, bytes(range(200)) * 3, b"b" * 99]
    for stretch in (1 << 22, 64):
        monkeypatch.setattr(repeats, "_STRETCH", stretch)
        owner, first, count, offset, *_ = repeats.cells(texts)
        windows = [(o, p) for o, f, n in zip(owner.tolist(), first.tolist(), count.tolist()) for p in range(f, f + n)]
        assert windows == [(i, p) for i, t in enumerate(texts) for p in range(len(t) - 99)]
        assert (offset >= count - 1).all() and (offset <= 100 - 32).all()


def test_nulls_repeated_rows_and_clashing_columns(spark):
    text = "some text that is longer than a hundred bytes, " * 3
    other = "another text that is longer than a hundred bytes " * 3
    rows = [(1, None, "x"), (2, "", "x"), (3, text, "x"), (3, text, "x"), (None, text, "x"), (None, other, "x"), (9, other, "x"), (5, "short", "x"), (5, "short", "x")]
    found = repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string, spans string").withColumn("a.b", F.lit(1)))
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_removed) for r in found.collect())
    once = plainly([(3, text)], 100)[3][1]
    kept = plainly([(9, other)], 100)[9][1]
    assert got == sorted(
        [
            (False, 1, 0, 0),
            (False, 2, 0, 0),
            (False, 3, len(text), once),
            (False, 3, len(text), len(text)),
            (True, 0, len(text), len(text)),
            (True, 0, len(other), len(other)),
            (False, 9, len(other), kept),
            (False, 5, 5, 0),
            (False, 5, 5, 0),
        ]
    )


def test_empty_table_and_remaining_text(spark):
    assert removed(spark, [(1, "x")][:0]) == {}
    rows = [(1, "A passage: " * 4 + ">" + "p" * 60 + "q" * 60), (2, "before " + "p" * 60 + "q" * 60 + " behind")]
    found = repeats.remove_repeats(spark.createDataFrame(rows, SCHEMA), with_text=True).collect()
    assert {r.doc_id: bytes(r.kept).decode() for r in found} == {1: rows[0][1], 2: "before  behind"}
