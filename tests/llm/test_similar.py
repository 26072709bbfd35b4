"""Near copies against brute force over five-word shingles."""

import numpy as np

from partflow.llm import similar

WORDS = [f"w{i}" for i in range(300)]


def plain_shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}


def jaccard(a, b):
    a, b = plain_shingles(a), plain_shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def plain_kept(rows):
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    for n, i in enumerate(order):
        for j in order[:n]:
            if jaccard(rows[i][1], rows[j][1]) >= 0.8:
                a, b = find(i), find(j)
                first, last = sorted((a, b), key=order.index)
                parent[last] = first
    return {rows[find(i)] for i in range(len(rows))}


def some_rows():
    random = np.random.default_rng(6)
    rows = []
    for group in range(25):
        text = list(random.choice(WORDS, 150))
        for copy in range(5):  # each changed copy has 0.75 to 0.97 of the first one's shingles
            changed = list(text)
            for at in random.choice(150, copy, replace=False):
                changed[at] = f"new{random.integers(1000)}"
            if copy == 4:  # a longer edit in one place
                changed[20:20] = [f"more{i}" for i in range(group)]
            rows.append((group * 10 + copy, " ".join(map(str, changed))))
    rows += [(900, None), (901, ""), (902, "too short"), (903, "Too  SHORT"), (904, "five words are in here"), (905, rows[0][1].upper()), (None, "no key at all in here")]
    return [(int(k) if k is not None else None, t) for k, t in rows]


def test_near_copies_go_and_others_stay(spark):
    rows = some_rows()
    frame = spark.createDataFrame([(i, t, 1, "z") for i, t in rows], "doc_id long, text string, set int, at string")
    kept = similar.drop_similar(frame)
    assert kept.columns == frame.columns
    assert {(r.doc_id, r.text) for r in kept.collect()} == plain_kept(rows)
    assert similar.drop_similar(frame.limit(0)).count() == 0


def test_large_groups_are_compared_chunk_by_chunk(spark, monkeypatch):
    monkeypatch.setattr(similar, "CHUNK", 3)
    rows = some_rows()
    kept = similar.drop_similar(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {(r.doc_id, r.text) for r in kept.collect()} == plain_kept(rows)


def test_the_stage_of_the_pipeline_drops_copies_that_differ_in_more_than_three_bits(spark):
    import corpus_pipeline
    from partflow.llm import simhash

    rows = [r for r in some_rows() if r[1] and r[0] is not None]
    far = [(a, b) for a, b in zip(rows, rows[1:]) if jaccard(a[1], b[1]) >= 0.8 and bin(simhash.fingerprint(a[1]) ^ simhash.fingerprint(b[1])).count("1") > 3]
    assert len(far) > 10
    kept = dict(corpus_pipeline.STAGES)["SimHash near-dedup"](spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    assert {(r.doc_id, r.text) for r in kept.collect()} == plain_kept(rows)
