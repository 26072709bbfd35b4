"""Benchmark items of which a text has changed a word or two."""

import random

from partflow.llm import decontaminate


def some_items():
    dice = random.Random(3)
    words = [a + b for a in "re th on in er st al or".split() for b in "an es ti en he ou ne ar".split()]
    return [(i, [dice.choice(words) for _ in range(15 + i)]) for i in range(40)], words, dice


def plain_share(item, text):
    """Longest common subsequence in any stretch of the text, as in_order has them."""
    n = len(item)
    step = max(1, n // 8)
    span, most = n + n // 4 + step, 0
    for begin in range(0, max(1, len(text) - span + step), step):
        row = [0] * (n + 1)
        for word in text[begin : begin + span]:
            new = [0] * (n + 1)
            for j in range(n):
                new[j + 1] = row[j] + 1 if item[j] == word else max(row[j + 1], new[j])
            row = new
        most = max(most, row[n])
    return most / n


def test_shares_equal_plain_code():
    items, words, dice = some_items()
    for _, item in items:
        text = [dice.choice(words) for _ in range(60)] + [w for w in item if dice.random() < 0.8] + [dice.choice(words) for _ in range(30)]
        assert decontaminate.in_order(item, text) == plain_share(item, text)


def test_items_with_one_or_two_changed_words_are_found(spark):
    items, words, dice = some_items()
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    docs, want = [], set()
    for i, item in items:
        places = [(at,) for at in range(len(item))] + [(len(item) - 2, len(item) - 1), (0, len(item) - 1)]
        for at in places:
            changed = list(item)
            for a in at:
                changed[a] = "changed"
            docs.append((len(docs), " ".join([dice.choice(words) for _ in range(40)] + changed + [dice.choice(words) for _ in range(40)])))
            want.add((len(docs) - 1, i))
    for i, item in items:  # words in another order, and only the first three quarters, are no item
        docs += [(10_000 + i, " ".join(reversed(item))), (20_000 + i, " ".join(item[: len(item) * 3 // 4]))]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(frame, bench, whole=True).collect()}
    assert want <= found, (len(want), len(want - found))
    assert not {d for d, _ in found if d >= 10_000}
    kept = {r.doc_id for r in decontaminate.drop_leaks(frame, bench, whole=True).collect()}
    assert kept == {d for d, _ in docs} - {d for d, _ in found}
