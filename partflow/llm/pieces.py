"""SentencePiece encoding and decoding with a shared-prefix Viterbi search.

A byte-pair encoding is the only segmentation whose neighbouring pieces are all
compatible: merging the two pieces' characters by themselves gives these two pieces
again. So the best path to a position depends only on the last piece before it, and a
Viterbi search over prefixes finds the encoding, its score being that of compatibility:
of all pieces ending at a position exactly one continues the path of the prefix before it.

Texts are cut into marked words (a word with its space mark before it), which no piece
crosses. The distinct words of a batch are sorted, that is, laid out as the depth-first
walk of a trie, and a word starts from the forward states of the prefix it shares with
the word before it.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partflow.llm.common import in_batches, tokenizer_file

MARK = "▁"
#: A word with the run of marks before it; only the first word of a text may be without.
_WORDS = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
_UNEVEN = re.compile(f"  |{MARK}|^ ")
_CACHE = 400_000
_PAIRS = 2_000_000


class Pieces:
    """A byte-pair SentencePiece model, read through the library's description of it."""

    def __init__(self, name: str) -> None:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as described

        path = tokenizer_file(name)
        model = described.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        kind = model.trainer_spec
        if kind.model_type != described.TrainerSpec.BPE or kind.treat_whitespace_as_suffix:
            raise ValueError("only byte-pair models with the space mark before words are read")
        normalizer = model.normalizer_spec
        self.plain = not normalizer.precompiled_charsmap and not normalizer.remove_extra_whitespaces
        self.prefix = normalizer.add_dummy_prefix
        self.normalize = sentencepiece.SentencePieceProcessor(model_file=path).normalize
        self.id, self.score, self.byte, self.unknown = {}, {}, {}, 0
        self.bytes: list[bytes] = []
        for i, p in enumerate(model.pieces):
            if p.type == described.ModelProto.SentencePiece.NORMAL:
                self.id[p.piece], self.score[p.piece] = i, p.score
            elif p.type == described.ModelProto.SentencePiece.BYTE:
                self.byte[int(p.piece[3:5], 16)] = i
            elif p.type == described.ModelProto.SentencePiece.UNKNOWN:
                self.unknown = i
            elif p.type != described.ModelProto.SentencePiece.CONTROL:
                raise ValueError("models with pieces of one's own are not read")
            shown = {described.ModelProto.SentencePiece.BYTE: lambda p: bytes([int(p.piece[3:5], 16)]),
                     described.ModelProto.SentencePiece.NORMAL: lambda p: p.piece.replace(MARK, " ").encode()}
            self.bytes.append(shown[p.type](p) if p.type in shown else b" \xe2\x81\x87 " if p.type == described.ModelProto.SentencePiece.UNKNOWN else b"")
        self.crossing = any(MARK in p.lstrip(MARK) for p in self.id)
        self.text = {i: p for p, i in self.id.items()}
        self.reversed: dict = {}
        for p, i in self.id.items():
            if self.merged(p) == [p]:
                node = self.reversed
                for c in reversed(p):
                    node = node.setdefault(c, {})
                node[""] = i
        self.pairs: dict[int, bool] = {}

    def merged(self, text: str) -> list[str]:
        """The pieces of a text by merging neighbours, best score first, the leftmost of equals.

        Merges wait in a heap, so time grows with the length and its logarithm. One is
        out of date if its two parts are not neighbours any more as they were.
        """
        score, n = self.score, len(text)
        parts: list[str | None] = list(text)
        waiting = [(-score[text[i : i + 2]], i, text[i : i + 2]) for i in range(n - 1) if text[i : i + 2] in score]
        heapify(waiting)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while waiting:
            _, at, both = heappop(waiting)
            right = after[at]
            if parts[at] is None or right == n or len(parts[at]) + len(parts[right]) != len(both) or parts[at] + parts[right] != both:
                continue
            parts[at], parts[right] = both, None
            after[at] = beyond = after[right]
            if beyond < n:
                before[beyond] = at
                longer = both + parts[beyond]
                if longer in score:
                    heappush(waiting, (-score[longer], at, longer))
            left = before[at]
            if left >= 0:
                longer = parts[left] + both
                if longer in score:
                    heappush(waiting, (-score[longer], left, longer))
        return [p for p in parts if p is not None]

    def compatible(self, a: int, b: int) -> bool:
        key = a << 32 | b
        found = self.pairs.get(key)
        if found is None:
            if len(self.pairs) > _PAIRS:
                self.pairs.clear()
            x, y = self.text[a], self.text[b]
            self.pairs[key] = found = self.merged(x + y) == [x, y]
        return found

    def ids_of(self, part: str) -> list[int]:
        """Ids of one piece or of a character that is none."""
        if part in self.id:
            return [self.id[part]]
        return [self.byte[b] for b in part.encode("utf-8", "replace")] if self.byte else [self.unknown]

    def encode_words(self, words: Iterable[str]) -> dict[str, list[int]]:
        """Ids of distinct marked words."""
        out: dict[str, list[int]] = {}
        last: list[int] = [-1]  # by length of the prefix: its last piece; -1: none before it or none that merges
        back: list[int] = [0]  # and the piece's length
        before = ""
        root, compatible = self.reversed, self.compatible
        for word in sorted(words):
            if MARK * 2 in word:  # runs of spaces: pieces of equal scores, merged one by one
                out[word] = [i for p in self.merged(word) for i in self.ids_of(p)]
                continue
            shared, most = 0, min(len(before), len(word))
            while shared < most and before[shared] == word[shared]:
                shared += 1
            del last[shared + 1 :], back[shared + 1 :]
            for end in range(shared, len(word)):
                node, at, chosen = root, end, None
                while at >= 0:
                    node = node.get(word[at])
                    if node is None:
                        break
                    piece = node.get("")
                    if piece is not None and (last[at] < 0 or compatible(last[at], piece)):
                        chosen = piece
                        break
                    at -= 1
                if chosen is None:  # a character that is no piece; nothing merges with it
                    last.append(-1)
                    back.append(1)
                else:
                    last.append(chosen)
                    back.append(end + 1 - at)
            before = word
            ids, end = [], len(word)
            while end:
                begin = end - back[end]
                ids.append([last[end]] if last[end] >= 0 else self.ids_of(word[begin:end]))
                end = begin
            out[word] = [i for part in reversed(ids) for i in part]
        return out

    def words(self, text: str) -> list[str]:
        """The marked words of a text."""
        if not text:
            return []
        if self.plain and self.prefix and not self.crossing and not _UNEVEN.search(text):
            return [MARK + w for w in text.split(" ")]
        marked = (MARK * self.prefix + text.replace(" ", MARK)) if self.plain else self.normalize(text)
        return [marked] if self.crossing else _WORDS.findall(marked)

    def decode(self, ids: list[int]) -> str:
        """The text of ids."""
        text = b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.prefix and text[:1] == " " else text


@functools.lru_cache(maxsize=2)
def pieces(name: str) -> Pieces:
    """The worker's copy of a model."""
    return Pieces(name)


def encode(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text", with_text: bool = True) -> DataFrame:
    """``key, ids`` (array<int>), ``n_tokens, ids_crc32, lossless`` and ``decoded`` of every whole text.

    Ids are those of the sentencepiece library without begin and end; ``ids_crc32`` is of
    them as little-endian unsigned 32-bit integers; ``decoded`` is the text that they stand
    for (left out without ``with_text``), ``lossless`` whether it is the text given. A null
    text is encoded as an empty one (no ids); null keys stay null; repeated rows are encoded
    each; further columns are ignored; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pieces(model)
        known: dict[str, bytes] = {}
        for batch, texts in in_batches(batches):
            cut = [own.words(one) for one in texts]
            wanted = set().union(*cut).difference(known)
            if len(known) + len(wanted) > _CACHE:
                known.clear()
                wanted = set().union(*cut)
            known.update((w, np.asarray(ids, "<i4").tobytes()) for w, ids in own.encode_words(wanted).items())
            packed = [b"".join(map(known.__getitem__, words)) for words in cut]
            offsets = np.zeros(len(packed) + 1, np.int32)
            np.cumsum([len(p) // 4 for p in packed], out=offsets[1:])
            values = pa.array(np.frombuffer(b"".join(packed), "<i4"), pa.int32())
            decoded = [own.decode(np.frombuffer(p, "<i4").tolist()) for p in packed]
            arrays = [
                batch.column("key"),
                pa.ListArray.from_arrays(pa.array(offsets), values),
                pa.array(np.diff(offsets), pa.int64()),
                pa.array([zlib.crc32(p) for p in packed], pa.int64()),
                pa.array([a == b for a, b in zip(decoded, texts)]),
            ]
            names = ["key", "ids", "n_tokens", "ids_crc32", "lossless"]
            if with_text:
                arrays, names = [*arrays, pa.array(decoded, pa.string())], [*names, "decoded"]
            yield pa.RecordBatch.from_arrays(arrays, names)

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = f"key {kind}, ids array<int>, n_tokens long, ids_crc32 long, lossless boolean" + ", decoded string" * with_text
    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)


def decode(rows: DataFrame, model: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``key, text`` of ids; null ids give a null text, null elements and ids that the model lacks count for nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pieces(model)
        for batch in batches:
            texts = [None if i is None else own.decode([x for x in i if x is not None and 0 <= x < len(own.bytes)]) for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(texts, pa.string())], ["key", "text"])

    kind = rows.schema[key].dataType.simpleString()
    return rows.select(F.col(key).alias("key"), F.col(ids).alias("ids")).mapInArrow(run, f"key {kind}, text string").withColumnRenamed("key", key)

