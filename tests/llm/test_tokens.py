"""Token counts and token files against the tokenizer's own library."""

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from partflow.llm import tokenfile, tokens
from partflow.llm.common import tokenizer_file
from partflow.llm.segments import counts_memo, library

BYTE_BPE = "byte_bpe_50k.json"
TEXTS = [
    None, "", " ", "  ", "\n", "a", " a", "a ", "a  b", "a \n b", "the cat sat.\nAnd  then\tit  left ", "word word, word. word!!",
    "x <|endoftext|> y", "<|endoftext|>", "don't they'll I'm 'tis", "naïve café größer ÉÉ", "日本語 テキスト mixed", "🙂🙂 emoji 👩‍👩‍👧", "1234 5,678.90 $%&",
    "a b   c", "a\x1cb c\x1d d", "é combining", "x" * 5000, "long " * 4000, "!!! ??? ...", "A.B.C. a-b_c",
]


@pytest.fixture(scope="module")
def expected():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_file(BYTE_BPE))
    return lambda t: tokenizer.encode(t or "", add_special_tokens=False).ids


def frame(spark, rows, extra=False):
    if extra:
        return spark.createDataFrame([(i, t, 7, "x", 9) for i, t in rows], "doc_id long, text string, n_tokens int, key string, n_bytes long")
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_counts_equal_the_library_on_awkward_texts(spark, expected):
    rows = list(enumerate(TEXTS)) + [(3, "again"), (3, "again"), (None, "no key here")]
    got = tokens.count_tokens(frame(spark, rows, extra=True), BYTE_BPE)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens"]
    want = [(i, len((t or "").encode()), len(expected(t))) for i, t in rows]
    order = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(map(tuple, got.collect()), key=order) == sorted(want, key=order)


def test_empty_table(spark):
    assert tokens.count_tokens(frame(spark, []), BYTE_BPE).count() == 0


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_other_tokenizers_are_given_whole_texts(spark, name):
    lib = library(name)
    assert lib.pieces("a b") is None
    got = {r.doc_id: r.n_tokens for r in tokens.count_tokens(frame(spark, [(1, "Hello there  world"), (2, None)]), name).collect()}
    assert got == {1: len(lib.encode(["Hello there  world"])[0]), 2: 0}


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab'st .,!\n\t é中1 \x1cͅ_|"), max_size=30))
def test_pieces_have_the_tokens_of_the_text(text):
    lib = library(BYTE_BPE)
    pieces = lib.pieces(text)
    joined = np.frombuffer(b"".join(lib.encode_pieces(pieces)), "<u4").tolist()
    assert joined == lib.encode([text])[0]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("abÉ.,!%9'"), max_size=6), max_size=8))
def test_memory_gives_the_same_counts_when_it_forgets(words):
    lib, memo = library(BYTE_BPE), counts_memo(BYTE_BPE, 5)
    pieces = lib.pieces(" ".join(words))
    memo.learn([pieces])
    assert sum(memo.known[p] for p in pieces) == len(lib.encode([" ".join(words)])[0])


def test_frequent_pieces_are_counted_over_all_texts(spark):
    found = {r.piece: r.n for r in tokens.frequent_pieces(frame(spark, [(i, "x of the of") for i in range(50)]), BYTE_BPE).collect()}
    assert found == {"of": 100, "the": 50, "\nx": 50}


# --- token files ----------------------------------------------------------------------


def model_of(ids):
    different, counts = np.unique(ids, return_counts=True)
    return tokenfile.Model(different, tokenfile.Model.scaled(counts))


@pytest.mark.parametrize("n", [0, 1, 2, 255, 256, 1000, 5000, 300_000])
def test_blocks_come_back(n):
    ids = (np.random.default_rng(n).zipf(1.3, n) % 50_000).astype(np.uint32)
    model = model_of(np.append(ids, 3))
    block = tokenfile.encode_block(ids, model) | {"n_ids": n}
    assert np.array_equal(tokenfile.decode_block(block, model), ids)


def test_one_symbol_costs_no_words():
    ids = np.full(10_000, 7, np.uint32)
    block = tokenfile.encode_block(ids, model_of(ids)) | {"n_ids": len(ids)}
    assert block["payload"] == b"" and np.array_equal(tokenfile.decode_block(block, model_of(ids)), ids)


def test_parts_of_a_block_are_decoded_from_checkpoints(monkeypatch):
    monkeypatch.setattr(tokenfile, "CHECKPOINT_STEPS", 16)
    ids = np.random.default_rng(1).integers(0, 900, 60_123).astype(np.uint32)
    model = model_of(ids)
    block = tokenfile.encode_block(ids, model) | {"n_ids": len(ids)}
    stops = len(block["places"]) // 8
    parts = [tokenfile.decode_block(block, model, i, i + 1) for i in range(stops)]
    assert stops > 3 and np.array_equal(np.concatenate(parts), ids)


def test_coding_is_near_the_entropy():
    ids = (np.random.default_rng(2).zipf(1.5, 400_000) % 30_000).astype(np.uint32)
    _, counts = np.unique(ids, return_counts=True)
    entropy = -(counts * np.log2(counts / len(ids))).sum() / 8
    assert len(tokenfile.encode_block(ids, model_of(ids))["payload"]) < 1.03 * entropy


def test_damage_is_noticed():
    ids = np.arange(5000, dtype=np.uint32) % 77
    block = tokenfile.encode_block(ids, model_of(ids)) | {"n_ids": len(ids)}
    block["payload"] = bytes([block["payload"][0] ^ 1]) + block["payload"][1:]
    with pytest.raises(ValueError, match="damaged"):
        tokenfile.decode_block(block, model_of(ids))


def test_round_trip_of_awkward_texts(spark, expected):
    rows = [(i * 3 % 29, t) for i, t in enumerate(TEXTS)] + [(5, "again"), (5, "again")]
    got = sorted(map(tuple, tokenfile.round_trip(frame(spark, rows, extra=True), BYTE_BPE, 2).collect()))
    ids = sorted((i, np.asarray(expected(t) + [2], "<u4").tobytes()) for i, t in rows)
    assert sorted((r[0], r[2], r[3]) for r in got) == sorted((i, len(b) // 4, zlib.crc32(b)) for i, b in ids)
    at = 0
    for key, start, n, _ in sorted(got, key=lambda r: r[1]):
        assert start == at
        at += n
    assert [r[0] for r in sorted(got, key=lambda r: r[1])] == sorted(i for i, _ in rows)


def test_round_trip_over_several_blocks_and_partitions(spark, expected, monkeypatch):
    monkeypatch.setattr(tokenfile, "PARTITION_IDS", 3000)
    rows = [(i, f"document {i} says " + "word " * (i % 50)) for i in reversed(range(300))] + [(None, "first")]
    got = sorted(tokenfile.round_trip(frame(spark, rows), BYTE_BPE, 2, with_ids=True).collect(), key=lambda r: r.start)
    at = 0
    for r, (i, t) in zip(got, sorted(rows, key=lambda r: (r[0] is not None, r[0])), strict=True):
        assert (r.doc_id, r.start) == (i, at)
        assert np.frombuffer(r.ids, "<u4").tolist() == expected(t) + [2]
        at += r.n_tokens


def test_round_trip_of_an_empty_table(spark):
    assert tokenfile.round_trip(frame(spark, []), BYTE_BPE, 2).count() == 0


def test_pieces_have_the_tokens_that_the_library_finds():
    import numpy as np
    from partflow.llm.segments import library

    lib = library("byte_bpe_50k.json")
    pieces = ["word", "Straße", "ÀÉÎõü", "\nfirst", "\nÀ", "\n", "", "don't", "\nx.", "×", "a×b", "naïve!!", "x" * 5000, "\u00ad", "ÿ", "日本", "\n日本", "a\tb"]
    want = lib.encode([p[1:] if p[:1] == "\n" else " " + p for p in pieces])
    for kind in ("<u2", "<u4"):
        assert [np.frombuffer(ids, kind).tolist() for ids in lib.encode_pieces(pieces, kind)] == want


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(st.sampled_from("abÉ' .,!\n\t中1\x1c\x85\xa0 _|"), max_size=12)), max_size=8))
def test_texts_cut_together_are_cut_as_each_by_itself(texts):
    import pyarrow as pa
    from partflow.llm.segments import ids_memo

    lib, given_texts = library(BYTE_BPE), [t or "" for t in texts]
    even, pieces = lib.split(pa.array(given_texts, pa.string()))
    cut = [t for t, one in zip(given_texts, even) if one]
    assert pieces.to_pylist() == [lib.pieces(t) for t in cut]
    assert all("  " not in t and "\n\t" not in t and "\xa0\xa0" not in t for t in cut)
    got = ids_memo(BYTE_BPE, 7, "<u2").joined(pieces)
    assert [np.frombuffer(ids, "<u2").tolist() for ids in got] == lib.encode(cut)
