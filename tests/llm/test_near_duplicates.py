"""Components, SimHash and vectors against brute force."""

import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from partflow.llm import simhash, vectors
from partflow.llm.graph import components, scramble, unscramble


def roots(n, pairs):
    """Smallest member of each node's component."""
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def test_scrambling_is_undone(spark):
    numbers = [0, 1, -1, 2**63 - 1, -(2**63), 12345, -987654321]
    rows = spark.createDataFrame([(n,) for n in numbers], "n long").select("n", unscramble(scramble(F.col("n"))).alias("m"))
    assert all(r.n == r.m for r in rows.collect())




@pytest.mark.parametrize("shape", ["chain", "star", "random", "none", "cliques"])
def test_components(spark, shape):
    n = 60
    random = np.random.default_rng(5)
    pairs = {
        "chain": [(i, i + 1) for i in range(n - 1)],
        "star": [(n // 2, i) for i in range(n)],
        "random": [tuple(map(int, p)) for p in random.integers(0, n, (35, 2))],
        "none": [],
        "cliques": [(i, j) for c in range(0, n, 6) for i in range(c, c + 6) for j in range(c, i)] * 2,
    }[shape]
    got = {r.node: r.component for r in components(spark.createDataFrame([*pairs, (None, 3), (4, 4)], "a long, b long")).collect()}
    want = roots(n, pairs)
    assert got == {x: want[x] for x in {x for a, b in pairs if a != b for x in (a, b)}}


# --- SimHash --------------------------------------------------------------------------


def plain_fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("aB É\t\nç\x0b\x1c ß"), max_size=40))
def test_fingerprints(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def plain_groups(rows):
    prints = [plain_fingerprint(t) for _, t in rows]
    near = [(i, j) for i in range(len(rows)) for j in range(i) if bin(prints[i] ^ prints[j]).count("1") <= 3]
    member = roots(len(rows), near)
    low = {}
    for (key, _), m in zip(rows, member):
        if key is not None:
            low[m] = min(key, low.get(m, key))
    return sorted((str(k), f"{p:016x}", str(low.get(m))) for (k, _), p, m in zip(rows, prints, member))


def docs(spark, rows, extra=False):
    if extra:
        return spark.createDataFrame([(i, t, 1, 2, "z") for i, t in rows], "doc_id long, text string, fp long, key int, component_id string")
    return spark.createDataFrame(rows, "doc_id long, text string")


def some_texts():
    random = np.random.default_rng(3)
    words = [f"w{i}" for i in range(400)]
    base = [" ".join(random.choice(words, 120)) for _ in range(12)]
    rows = [(i * 7 % 101, t) for i, t in enumerate(base)]
    for copy in range(60):  # near copies of one text, and exact ones of another
        changed = base[0].split()
        changed[copy] = "other"
        rows += [(200 + copy, " ".join(changed)), (300 + copy, base[1])]
    return [*rows, (1000, None), (1001, ""), (1002, " \n"), (1003, "Two Words"), (1004, "two words"), (7, base[3]), (7, base[3]), (None, base[4]), (None, "alone here too"), (2000, base[5] * 300)]


def test_simhash_groups(spark):
    rows = some_texts()
    got = simhash.simhash_groups(docs(spark, rows, extra=True))
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got.collect()) == plain_groups(rows)
    assert simhash.simhash_groups(docs(spark, [])).count() == 0


def test_large_buckets_are_compared_chunk_by_chunk(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CHUNK", 8)
    monkeypatch.setattr(simhash, "TILE", 16)
    random = np.random.default_rng(8)
    centres = random.integers(0, 2**64, 6, dtype=np.uint64)
    prints = {int(c) ^ sum(1 << int(b) for b in random.choice(64, random.integers(0, 5), replace=False)) for c in np.repeat(centres, 40)}
    prints = sorted(prints)
    frame = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fp long")
    links = [(r.a % 2**64, r.b % 2**64) for r in simhash.links_within(frame, 3).collect()]
    assert all(bin(a ^ b).count("1") <= 64 for a, b in links)
    place = {p: i for i, p in enumerate(prints)}
    near = [(i, j) for i in range(len(prints)) for j in range(i) if bin(prints[i] ^ prints[j]).count("1") <= 3]
    assert roots(len(prints), [(place[a], place[b]) for a, b in links]) == roots(len(prints), near)


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 5, 7])
def test_bit_sliced_distances(radius):
    random = np.random.default_rng(radius)
    fps = random.integers(0, 2**64, 150, dtype=np.uint64)
    fps[50:] = fps[:100] ^ np.array([sum(1 << int(b) for b in random.choice(64, random.integers(0, 9), replace=False)) for _ in range(100)], np.uint64)
    allowed = np.triu(random.random((150, 150)) < 0.9, 1)
    i, j = simhash.near_pairs(fps, allowed, radius)
    want = {(a, b) for a in range(150) for b in range(150) if allowed[a, b] and bin(int(fps[a] ^ fps[b])).count("1") <= radius}
    assert set(zip(i.tolist(), j.tolist())) == want and len(i) == len(want)


@pytest.mark.parametrize("n", [10, 10**8, 10**11])
def test_strips_find_every_pair_within_the_radius(n):
    masks = simhash.strip_masks(n, 3)
    random = np.random.default_rng(1)
    for _ in range(300):
        flips = sum(1 << int(b) for b in random.choice(64, 3, replace=False))
        assert any(flips & m == 0 for m in masks)


def test_one_row_of_each_group_stays(spark):
    rows = some_texts()
    kept = simhash.drop_near_duplicates(docs(spark, rows, extra=True))
    assert kept.columns == ["doc_id", "text", "fp", "key", "component_id"]
    prints = [plain_fingerprint(t) for _, t in rows]
    member = roots(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if bin(prints[i] ^ prints[j]).count("1") <= 3])
    keys = [[k for (k, _), m in zip(rows, member) if m == c and k is not None] for c in set(member)]
    heads = sorted(str(min(k)) for k in keys if k)
    got = [(r.doc_id, r.text) for r in kept.collect()]
    kept_ids = sorted(str(k) for k, _ in got if k is not None)
    assert kept_ids == sorted(heads), (set(kept_ids) ^ set(heads), len(kept_ids))
    assert (None, "alone here too") in got
    assert all(g in rows for g in got) and len(got) == len(set(member))


# --- vectors --------------------------------------------------------------------------


def plain_vectors(rows, threshold=0.93):
    def good(v, label):
        return label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)

    near = []
    for i, (_, v, a) in enumerate(rows):
        for j in range(i):
            _, w, b = rows[j]
            if good(v, a) and good(w, b) and a == b and len(v) == len(w):
                x, y = np.asarray(v, float), np.asarray(w, float)
                if x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y)) >= threshold:
                    near.append((i, j))
    member = roots(len(rows), near)
    links = [sum(i in p for p in near) for i in range(len(rows))]
    low = {}
    for (key, _, _), m in zip(rows, member):
        if key is not None:
            low[m] = min(key, low.get(m, key))
    return sorted((str(k), n, str(low.get(m)), k == low.get(m)) for (k, _, _), n, m in zip(rows, links, member))


def some_vectors():
    random = np.random.default_rng(4)
    centres = random.normal(size=(25, 8))
    rows = [(i * 13 % 997, (centres[i % 25] + random.normal(size=8) * random.choice([0.02, 0.12, 0.4])).tolist(), int(i % 3)) for i in range(300)]
    rows += [(1000 + i, rows[0][1], rows[0][2]) for i in range(40)]
    odd = [None, [], [0.0] * 8, [1.0, None] * 4, [float("nan")] * 8, [float("inf")] + [1.0] * 7, [1.0, 2.0], [2.0, 4.0], [1e-30] * 8, [1e30] * 8, [-1e30] * 8]
    rows += [(2000 + i, v, label) for i, v in enumerate(odd) for label in (0, None)]
    return [*rows, (None, rows[5][1], rows[5][2]), (None, [0.5] + [0.0] * 7, 9), (3000, rows[7][1], rows[7][2]), (3000, rows[8][1], rows[8][2])]


@pytest.mark.parametrize("chunk, pivots", [(1024, 16), (16, 4), (1024, 1)])
def test_near_vectors(spark, monkeypatch, chunk, pivots):
    monkeypatch.setattr(vectors, "CHUNK", chunk)
    rows = some_vectors()
    frame = spark.createDataFrame([(k, v, a, 1, "x") for k, v, a in rows], "vec_id long, embedding array<double>, label int, node int, mult string")
    got = vectors.near_vectors(frame, pivots=pivots)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    want = plain_vectors(rows)
    found = sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept if r.vec_id is not None else r.vec_id == r.component_id) for r in got.collect())
    assert found == want


def test_no_vectors(spark):
    assert vectors.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0
