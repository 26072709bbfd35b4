"""URL filter, quality classifier, decontamination and pieces against plain code."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from partflow.llm import decontaminate, pieces, quality, urls
from partflow.llm.common import tokenizer_file

MODEL = "piece_bpe_32k.model"


# --- addresses ------------------------------------------------------------------------


def plain_verdict(url):
    match = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = ("", "") if match is None else ("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in match[1]), match[2])
    fits = [r for r in urls.RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: len(r[0] + r[1]), default=None)
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in url or "")
    hit = lambda terms: sum(bool(re.search(f"(?<![a-z0-9]){t}(?![a-z0-9])", low)) for t in terms)
    strict, soft = hit(urls.STRICT), hit(urls.SOFT)
    verdict = best[2] if best else "block" if strict or soft >= 2 else "allow"
    return host, path, best and best[0] + best[1], strict, soft, verdict


URLS = [
    None, "", "no scheme", "://", "http://", "HTTP://WWW.Example.COM/DE/x", "http://www.example.com/de/x", "http://example.net/en/1", "http://example.net/de",
    "http://example.net/de/", "http://notexample.com/de/", "https://a.org/fr/?q=casino", "https://a.org/en/casino", "https://a.org/casinos", "https://cheap-pills.a.org/",
    "https://cheap.a.org/cheap/CHEAP", "https://a.com/free_win", "https://a.com#free/win", "a://b://c.net/", "http://x.net?y/", "http://x\n.net/\nz", "http://user:pw@h.net:80/p", "http://ÉÀ.org/fr/ñ", "http://a.com/" + "x" * 100_000 + "/porn",
]


def test_verdicts(spark):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(None, URLS[6]), (3, URLS[5]), (3, URLS[5])]
    frame = spark.createDataFrame([(i, u, "h", "r", 5) for i, u in rows], "page_id long, url string, host string, rule string, n_soft int")
    got = urls.judge_urls(frame)
    assert got.columns == ["page_id", "host", "path", "rule", "n_strict", "n_soft", "verdict"]
    order = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got.collect()), key=order) == sorted([(i, *plain_verdict(u)) for i, u in rows], key=order)
    assert urls.judge_urls(frame.limit(0)).count() == 0


# --- quality --------------------------------------------------------------------------


def quality_rows(n=400):
    dice = random.Random(1)
    rows = []
    for i in range(n):
        words = [dice.choice("the of and word tree house river stone light".split()) + dice.choice(["", "s", "ed"]) for _ in range(60)]
        good = dice.random() < 0.7
        rows.append((i, " ".join(words) if good else " ".join(w + "!!" for w in words) if i % 2 else " ".join(w for w in words[:6] for _ in range(10)), int(good)))
    return rows


def quality_frames(spark, rows):
    docs = spark.createDataFrame([(i, t, 1.5, i) for i, t, _ in rows], "doc_id long, text string, score double, shard long")
    return docs, spark.createDataFrame([(i, y, 0) for i, _, y in rows], "doc_id long, quality int, toxic int")


def test_held_out_accuracy_and_hidden_labels(spark):
    rows = quality_rows()
    docs, labels = quality_frames(spark, rows)
    weights = quality.train(docs, labels)
    extra = spark.createDataFrame([(1000, None), (1001, ""), (1002, "word " * 50_000), (None, "the tree"), (5, "the tree"), (5, "the tree")], "doc_id long, text string")
    scored = quality.score(docs.select("doc_id", "text").unionAll(extra), weights).collect()
    assert len(scored) == len(rows) + 6 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in scored)
    truth = {i: y for i, _, y in rows if zlib.crc32(str(i).encode()) % 4 == 2}
    right = [r.predicted == truth[r.doc_id] for r in scored if r.doc_id in truth and r.doc_id != 5]
    assert len(right) > 60 and np.mean(right) > 0.95
    blank = [r.score for r in scored if r.doc_id in (1000, 1001)]
    assert blank[0] == blank[1]
    # labels of held-out rows have no effect
    flipped = [(i, t, 1 - y if i in truth else y) for i, t, y in rows]
    assert np.array_equal(weights, quality.train(docs, quality_frames(spark, flipped)[1]))


def test_rows_kept_are_those_predicted_good(spark):
    docs, labels = quality_frames(spark, quality_rows(120))
    weights = quality.train(docs, labels.unionAll(spark.createDataFrame([(None, 1, 0), (3, None, 0)], labels.schema)))
    good = {r.doc_id for r in quality.score(docs, weights).collect() if r.predicted}
    kept = quality.keep_good(docs, weights)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == good and 0 < len(good) < 120


def test_nothing_is_known_without_labels(spark):
    docs, labels = quality_frames(spark, quality_rows(20))
    assert quality.train(docs, labels.limit(0)) is None
    assert {r.score for r in quality.score(docs, None).collect()} == {0.5}
    assert quality.keep_good(docs, None).count() == 20
    assert quality.score(docs.limit(0), None).count() == 0


def test_features_are_of_unit_length_and_mark_repeats():
    hashes = quality.Hashes()
    at, x = quality.features("a b c! a b", hashes)
    assert np.isclose((x * x).sum(), 1) and len(at) == len(set(at.tolist()))
    assert set(quality.features("dog dog dog dog", hashes)[0].tolist()) & set(quality.features("cat cat cat", hashes)[0].tolist())


# --- benchmark ------------------------------------------------------------------------


def plain_leaks(doc_rows, item_rows, threshold=decontaminate.THRESHOLD, passage=decontaminate.PASSAGE):
    """Every passage scored against every item, without an index."""
    items = [(i, decontaminate.words_of(t)) for i, t in item_rows if decontaminate.words_of(t)]
    held = Counter(w for _, d in items for w in set(d))
    n, mean = len(items), np.mean([len(d) for _, d in items]) if items else 0

    def impact(word, d):
        tf, idf = d.count(word), np.log(1 + (n - held[word] + 0.5) / (held[word] + 0.5))
        return idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(d) / mean))

    out = []
    for key, text in doc_rows:
        words = decontaminate.words_of(text)
        best = {}
        for at, (i, d) in enumerate(items):
            size = passage
            while size < 2 * len(d):
                size *= 2
            for begin, end in decontaminate.passages_of(len(words), size):
                part = words[begin:end]
                score = sum(impact(w, d) for w in set(part) & set(d)) / sum(impact(w, d) for w in set(d))
                if score < threshold - 1e-9:
                    continue
                shares = []
                for wanted in decontaminate.split_item(d):
                    width = min(5, len(wanted))
                    runs = {tuple(wanted[k : k + width]) for k in range(len(wanted) - width + 1)}
                    there = {tuple(part[k : k + width]) for k in range(len(part) - width + 1)}
                    shares.append(len(runs & there) / len(runs))
                if min(shares) >= 0.8:
                    best[at] = max(best.get(at, (0,)), (score, sum(shares), -begin, *shares))
        out += [(key, items[at][0], -b[2], round(b[0], 9), b[3], b[4]) for at, b in best.items()]
    return sorted(out, key=str)


def leak_rows():
    dice = random.Random(7)
    words = [a + b for a in "re th on in er st al or".split() for b in "an es ti en he ou ne ar".split()]
    some = lambda n: [dice.choice(words) for _ in range(n)]
    items = [(i, some(dice.randint(6, 60))) for i in range(30)] + [(30, some(3)), (31, some(1)), (32, some(150)), (33, some(400))]
    docs = []
    for i in range(60):
        text = some(dice.randint(5, 500))
        if i % 3 == 0:
            item = list(items[dice.randrange(30)][1])
            if i % 2:
                item[dice.randrange(len(item))] = "changed"
            at = dice.randrange(len(text))
            text[at:at] = [w.upper() + "," for w in item] if i % 4 == 0 else item
        docs.append((i, " ".join(text)))
    docs += [(200 + n, " ".join(some(90) + items[n][1] + some(200))) for n in (32, 33)]
    docs += [(100, None), (101, ""), (102, "!! ??"), (103, " ".join(some(9000) + items[4][1])), (None, " ".join(items[5][1])), (7, docs[0][1]), (7, docs[0][1])]
    return docs, [(i, " ".join(t)) for i, t in items] + [(40, None), (41, ""), (42, "..."), (3, " ".join(items[3][1]))]


@pytest.mark.parametrize("threshold", [0.3, 0.6, 0.9])
def test_leaks_equal_an_exhaustive_search(spark, threshold):
    docs, items = leak_rows()
    frame = spark.createDataFrame([(i, t, 1, 2) for i, t in docs], "doc_id long, text string, item_id int, key int")
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    got = decontaminate.find_leaks(frame, bench, threshold=threshold)
    assert got.columns == ["doc_id", "item_id", "first_word", "score", "question_overlap", "answer_overlap"]
    found = sorted([(r[0], r[1], r[2], round(r[3], 9), r[4], r[5]) for r in got.collect()], key=str)
    assert found == plain_leaks(docs, items, threshold) and len(found) > 15


def test_clean_rows_stay_whole(spark):
    docs, items = leak_rows()
    frame = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, extra int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    leaky = {r[0] for r in plain_leaks(docs, items)}
    kept = decontaminate.drop_leaks(frame, bench)
    assert kept.columns == frame.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i, _ in docs if i not in leaky)


def test_blocks_of_items_and_empty_tables(spark):
    docs, items = leak_rows()
    frame, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    pairs = lambda df: {(r.doc_id, r.item_id) for r in df.collect()}
    # blocks score with the statistics of all items
    cut = decontaminate.find_leaks(frame, bench, threshold=0.6, index_items=10)
    found = sorted([(r[0], r[1], r[2], round(r[3], 9), r[4], r[5]) for r in cut.collect()], key=str)
    assert found == plain_leaks(docs, items, 0.6) and {(232, 32), (233, 33)} <= {f[:2] for f in found}
    assert pairs(decontaminate.find_leaks(frame, bench.limit(0))) == pairs(decontaminate.find_leaks(frame.limit(0), bench)) == set()
    assert decontaminate.drop_leaks(frame, bench.limit(0)).count() == len(docs)


def test_a_separate_answer_has_to_be_there(spark):
    bench = spark.createDataFrame([(1, "what is the colour of the tall house by the river", "it is dark green today")], "item_id long, text string, answer string")
    docs = spark.createDataFrame([(1, "so what is the colour of the tall house by the river it is dark green today ok"), (2, "what is the colour of the tall house by the river who knows")], "doc_id long, text string")
    assert [(r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs, bench, answer="answer").collect()] == [(1, 1)]


# --- pieces ---------------------------------------------------------------------------


@pytest.fixture(scope="module")
def sentence_pieces():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=tokenizer_file(MODEL))


@settings(max_examples=600, deadline=None)
@given(st.text(st.sampled_from("theinganrous  .,▁\n\tÉéß日本🙂xQ019%"), max_size=25))
def test_pieces_equal_the_library(sentence_pieces, text):
    own = pieces.pieces(MODEL)
    words = own.words(text)
    known = own.encode_words(set(words))
    ids = [i for w in words for i in known[w]]
    assert ids == sentence_pieces.encode(text)
    assert own.decode(ids) == sentence_pieces.decode(ids)


def test_words_sharing_prefixes(sentence_pieces):
    own = pieces.pieces(MODEL)
    words = ["▁" + "international"[:n] + end for n in range(1, 14) for end in ("", "s", "ing", "☃", "日")]
    known = own.encode_words(words)
    assert all(known[w] == sentence_pieces.encode(w[1:]) for w in words)


def test_long_runs_of_spaces_and_words_behind_them(sentence_pieces):
    own = pieces.pieces(MODEL)
    for text in (" " * 200_000, "  " + "abcdefghij" * 20_000, "x" + " " * 99_999 + "y  the", "  " + "  ".join(["the", "of", "▁and"]) * 3_000):
        words = own.words(text)
        known = own.encode_words(set(words))
        assert [i for w in words for i in known[w]] == sentence_pieces.encode(text)


def test_encoding_and_decoding(spark, sentence_pieces):
    texts = [None, "", " ", "  lead", "trail  ", "The quick brown fox", "a\nb\tc", "▁mark▁", "日本語 🙂", "word " * 20_000, "x" * 3000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, "again"), (3, "again"), (None, "no key")]
    frame = spark.createDataFrame([(i, t, "d", 3) for i, t in rows], "doc_id long, text string, decoded string, ids int")
    got = pieces.encode(frame, MODEL)
    assert got.columns == ["doc_id", "ids", "n_tokens", "ids_crc32", "lossless", "decoded"]
    order = lambda r: (str(r[0]), len(r[1]))
    want = sorted([(i, sentence_pieces.encode(t or "")) for i, t in rows], key=order)
    found = sorted([(r.doc_id, r.ids, r) for r in got.collect()], key=order)
    assert [f[:2] for f in found] == want
    for _, ids, r in found:
        assert r.n_tokens == len(ids) and r.ids_crc32 == zlib.crc32(np.asarray(ids, "<u4").tobytes()) and r.decoded == sentence_pieces.decode(ids)
    assert all(r.lossless for _, _, r in found if "▁" not in str(r.decoded) and r.doc_id != 7)
    again = pieces.decode(got.select("doc_id", "ids"), MODEL)
    assert sorted(map(str, (r.text for r in again.collect()))) == sorted(str(r.decoded) for _, _, r in found)
    assert pieces.encode(frame.limit(0), MODEL).count() == 0
    odd = spark.createDataFrame([(1, None), (2, [None, 10**6, 413])], "doc_id long, ids array<int>")
    assert {r.doc_id: r.text for r in pieces.decode(odd, MODEL).collect()} == {1: None, 2: sentence_pieces.decode([413])}
