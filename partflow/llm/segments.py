"""Tokenizing in pieces that no token crosses, so that equal pieces are tokenized once.

A byte-level tokenizer cuts a text into pre-tokens before it looks for tokens, and a
space between two other characters always opens a pre-token. The run of pre-tokens
from one such space to the next (mostly one word) can therefore be tokenized by itself:
its tokens are the same in every text. Tokenizers of which this isn't known, and texts
that hold a special token's string, are given to the library as a whole.
"""

from __future__ import annotations

import functools
import gc
import json
import os
import re
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from partflow.llm.common import tokenizer_file

#: A space with white space beside it may belong to the piece before it.
_UNEVEN = re.compile(r"\s\s")
#: The same where ``\\s`` is ASCII only.
_WHITE = r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_UNEVEN_RE2 = _WHITE + _WHITE
_EVEN_SPACE = re.compile(r"(?<=\S)(?= \S)")
_LINE = re.compile(r" ?\S+")
#: Pieces that the library gets at a time.
_TOGETHER = 64


class Library:
    """A tokenizer's file and the library that it is meant for."""

    def __init__(self, name: str) -> None:
        path = tokenizer_file(name)
        self.special: list[str] = []
        self.in_pieces = False
        if path.endswith(".json"):
            os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(path)
            tokenizer.no_truncation()
            tokenizer.no_padding()
            with open(path, encoding="utf-8") as file:
                settings = json.load(file)
            first = settings.get("pre_tokenizer") or {}
            self.special = [t["content"] for t in settings.get("added_tokens", [])]
            self.in_pieces = (
                settings.get("normalizer") is None
                and first.get("type") == "ByteLevel"
                and bool(first.get("use_regex", True))
                and not first.get("add_prefix_space", True)
            )
            self.size = tokenizer.get_vocab_size()
            line = tokenizer.encode("\n", add_special_tokens=False).ids
            self.line = line[0] if len(line) == 1 else -1
            self.in_pieces = self.in_pieces and len(line) == 1
            self.encode: Callable[[list[str]], list[list[int]]] = lambda texts: [
                e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            ]
        else:
            import sentencepiece

            pieces = sentencepiece.SentencePieceProcessor(model_file=path)
            self.size = pieces.get_piece_size()
            self.encode = lambda texts: pieces.encode(texts, num_threads=1)

    def pieces(self, text: str) -> list[str] | None:
        """The text as pieces without their leading space, the first one with a mark of its own; None: not to be cut.

        Joined by spaces the pieces after the first are the text. The first piece has no
        space before it in the text and so may have other tokens; it is marked with a
        leading newline unless it is empty.
        """
        if not self.in_pieces or any(s in text for s in self.special):
            return None
        if _UNEVEN.search(text):
            found = _EVEN_SPACE.split(text)
            return ["\n" + found[0], *[p[1:] for p in found[1:]]]
        found = text.split(" ")
        found[0] = "\n" + found[0]
        return found

    def split(self, texts: pa.Array) -> tuple[np.ndarray, pa.ListArray]:
        """Which texts can be cut at every space, and the pieces of these (as :meth:`pieces` gives them)."""
        if not self.in_pieces:
            return np.zeros(len(texts), bool), pa.array([], pa.list_(pa.string()))
        uneven = pc.match_substring_regex(texts, _UNEVEN_RE2)
        for special in self.special:
            uneven = pc.or_(uneven, pc.match_substring(texts, special))
        even = ~uneven.to_numpy(zero_copy_only=False)
        marked = pc.binary_join_element_wise("\n", texts.filter(pa.array(even)), "")
        return even, pc.split_pattern(marked, " ")

    def encode_pieces(self, pieces: list[str], kind: str = "<u4") -> list[bytes]:
        """Ids of each piece, as bytes of type ``kind``.

        Most pieces are given to the library many at a time, each on a line of its own: a
        line break between two pieces without white space inside is a token of its own.
        """
        width = np.dtype(kind).itemsize
        out: list[bytes | None] = [None] * len(pieces)
        given = [p[1:] if p[:1] == "\n" else " " + p for p in pieces]
        lines = [i for i, p in enumerate(pieces) if p.isalpha() or _LINE.fullmatch(given[i])]
        groups = [lines[i : i + _TOGETHER] for i in range(0, len(lines), _TOGETHER)]
        for group, ids in zip(groups, self.encode(["\n".join([given[i] for i in group]) for group in groups])):
            ids = np.asarray(ids, kind)
            data, begin = ids.tobytes(), 0
            for i, end in zip(group, np.append(np.flatnonzero(ids == self.line), len(ids)).tolist(), strict=True):
                out[i] = data[begin * width : end * width]
                begin = end + 1
        rest = [i for i, found in enumerate(out) if found is None]
        for i, ids in zip(rest, self.encode([given[i] for i in rest]) if rest else []):
            out[i] = np.asarray(ids, kind).tobytes()
        return out


@functools.lru_cache(maxsize=4)
def library(name: str) -> Library:
    """The worker's copy of a tokenizer."""
    return Library(name)


#: Punctuation that the tokenizer cuts off the letters before it.
_ENDS = ".,!?;:%*#$&"
#: Words on lines of their own: a line break with other characters on both sides is a pre-token.
_LINES = re.compile(r"\n?\S+(?:\n\S+)+")


def _is_word(text: str) -> bool:
    """Whether these are letters only, of which every version of Unicode says so."""
    return text.isalpha() and (text.isascii() or max(text) <= "ÿ")


def _units(piece: str) -> tuple[str, ...]:
    """Pieces whose tokens together are this one's; it by itself if there is no such cut."""
    if piece.find("\n", 1) < 0:
        stem = piece.rstrip(_ENDS)
        cut = len(stem) < len(piece) and _is_word(stem.removeprefix("\n"))
        return (stem, "\n" + piece[len(stem) :]) if cut else (piece,)
    if _LINES.fullmatch(piece) is None:
        return (piece,)
    first, *rest = piece[1:].split("\n")
    units = _units(piece[0] + first)
    for line in rest:
        units += ("\n\n", *_units("\n" + line))  # the break itself, and what stands behind it without a space
    return units


@contextmanager
def _no_cycles() -> Iterator[None]:
    """No search for cycles while very many small objects are made that hold none."""
    was_on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was_on:
            gc.enable()


class Memo:
    """What a worker knows of pieces (``known``); ``of`` finds it for a list of them, and adds up over parts.

    When more than ``bound`` pieces are known, all but the first half of them are
    forgotten (frequent ones tend to come first) and may be met again.
    """

    def __init__(self, bound: int, of: Callable[[list[str]], list]) -> None:
        self.known: dict[str, object] = {}
        self.bound, self.of = bound, of

    def look(self, texts: list[list[str]]) -> list[list]:
        """What is known of all pieces of these texts; those that are new are learned first."""
        known = self.known
        with _no_cycles():
            found = [list(map(known.get, pieces)) for pieces in texts]
            gaps = [[i for i, value in enumerate(values) if value is None] for values in found]
            new = [[pieces[i] for i in gap] for pieces, gap in zip(texts, gaps)]
            self._learn(new)
            for values, gap, pieces in zip(found, gaps, new):
                for i, piece in zip(gap, pieces):
                    values[i] = known[piece]
        return found

    def joined(self, lists: pa.ListArray) -> list[bytes]:
        """What is known of each list's pieces (bytes), one after the other; equal pieces of all lists are looked up once."""
        if len(lists) == 0:
            return []
        flat = lists.flatten().dictionary_encode()
        pieces = flat.dictionary.to_numpy(zero_copy_only=False).tolist()
        values = pa.array(self.look([pieces])[0], pa.large_binary())
        _, ends, data = values.take(flat.indices).buffers()
        if data is None:
            return [b""] * len(lists)
        ends = np.frombuffer(ends, np.int64)
        bounds = ends[lists.offsets.to_numpy() - lists.offsets[0].as_py()].tolist()
        seen = memoryview(data)
        return [bytes(seen[a:b]) for a, b in zip(bounds, bounds[1:])]

    def learn(self, texts: list[list[str]]) -> None:
        """Make sure that all pieces of these texts are known."""
        with _no_cycles():
            self._learn(texts)

    def _learn(self, texts: list[list[str]]) -> None:
        known = self.known
        wanted = set().union(*texts).difference(known)
        if len(known) + len(wanted) > self.bound:
            for piece in list(known)[self.bound // 2 :]:
                del known[piece]
            wanted = set().union(*texts).difference(known)
        cut, listed = [], set()
        for piece in wanted:
            units = (piece,) if piece.isalpha() else _units(piece)
            if len(units) == 1:
                listed.add(piece)
                continue
            cut.append((piece, units))
            for unit in units:
                if unit not in known:
                    listed.add(unit)
        if listed:
            ordered = list(listed)
            known.update(zip(ordered, self.of(ordered)))
        for piece, units in cut:
            whole = known[units[0]]
            for unit in units[1:]:
                whole += known[unit]
            known[piece] = whole


@functools.lru_cache(maxsize=4)
def counts_memo(name: str, bound: int) -> Memo:
    """The worker's memory of token counts; it outlives a task."""
    return Memo(bound, lambda pieces: [len(ids) // 4 for ids in library(name).encode_pieces(pieces)])


@functools.lru_cache(maxsize=4)
def ids_memo(name: str, bound: int, kind: str) -> Memo:
    """The worker's memory of token ids, as bytes of type ``kind``; it outlives a task."""
    return Memo(bound, lambda pieces: library(name).encode_pieces(pieces, kind))
