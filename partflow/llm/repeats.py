"""Repeated passages by a depth-limited radix sort of suffixes.

Two places repeat a passage of ``width`` bytes if the suffixes there agree in their first
``width`` bytes. Suffixes are put into groups by passes over digits, the most significant
first; a suffix alone in its group repeats nothing and drops out, and what is left
together after ``width`` bytes are the repeated windows, no more and no fewer.

The digits of the early passes are taken where the text itself chooses, so that not every
suffix has to travel. Of the ``gram``-byte strings in a window the one with the smallest
hash (leftmost of equals) is its anchor; equal windows have it at the same place. The
windows next to each other with one anchor are a cell.

1. Cells with different anchor strings have no window in common.
2. Among cells with one anchor string, those equal from end to end repeat each other
   wholly: all but the first are removed, only the first goes on.
3. First cells that share their anchor string but differ elsewhere are compared window by
   window: digits of eight bytes, most significant first, down to ``width``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partflow.llm.common import in_batches, materialise
from partflow.llm.units import sorted_groups

#: Bytes of a window and of an anchor string.
WIDTH, GRAM = 100, 32
#: Cells that a task holds before it sends them on; of equal ones among them it sends the first.
HELD_CELLS = 1 << 19
#: Cells with one anchor string that one task compares; beyond that, windows are dealt out by their content.
GROUP_CELLS = 1 << 14
#: Documents that are looked at to find anchor strings in so many documents that their cells
#: are spread over several tasks, and the share of documents that makes a string such a one.
SAMPLE_DOCS, HOT_SHARE, SPREAD = 5_000, 0.004, 64
#: Bytes of one text handled at a time; positions must fit the low bits of a hash.
_STRETCH, _PLACE_BITS = 1 << 22, np.uint64(24)
_ODD = np.random.default_rng(7).integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LAST = 2**63 - 1


# --- anchors and cells ----------------------------------------------------------------


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A hash of the ``gram`` bytes from every place on, put together from hashes of powers of two."""
    power, size, found, length = data.astype(np.uint64) + np.uint64(1), 1, None, 0
    for level in range(gram.bit_length()):
        if gram >> level & 1:
            if found is None:
                found = power
            else:
                n = max(0, len(power) - length)
                found = found[:n] * _ODD[32 + level] + power[length : length + n]
                found ^= found >> np.uint64(29)
            length += size
        n = max(0, len(power) - size)
        power = power[:n] * _ODD[level] + power[size : size + n]
        power ^= power >> np.uint64(32)
        size *= 2
    return found * _ODD[63]


def _anchors(data: np.ndarray, width: int, gram: int) -> np.ndarray:
    """Place of the anchor of the window at every place; ``data`` is shorter than ``2 ** 24`` bytes."""
    key = _gram_hashes(data, gram) >> _PLACE_BITS << _PLACE_BITS
    least = key | np.arange(len(key), dtype=np.uint64)
    size, wanted = 1, width - gram + 1
    while size * 2 <= wanted:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < wanted:
        least = np.minimum(least[: size - wanted], least[wanted - size :])
    return (least & np.uint64((1 << 24) - 1)).astype(np.int64)


def cells(texts: list[bytes], width: int = WIDTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """All cells of some texts: number of the text, first window, windows, anchor's distance from the first window, hashes of anchor string and cell."""
    whole = b"".join(texts)
    ends = np.cumsum([len(t) for t in texts])
    begins = ends - np.array([len(t) for t in texts])
    data = np.frombuffer(whole, np.uint8)
    valid = np.zeros(len(data) + 1, np.int8)  # +1 where windows of a text begin, -1 where they end
    long = ends - begins >= width
    valid[begins[long]] += 1
    valid[ends[long] - width + 1] -= 1
    valid = np.cumsum(valid[:-1]).astype(bool)
    first, count, place = [], [], []
    for at in range(0, max(0, len(data) - width + 1), _STRETCH):
        part = data[at : at + _STRETCH + width - 1]
        start = np.flatnonzero(valid[at : at + len(part) - width + 1])
        if len(start) == 0:
            continue
        anchor = _anchors(part, width, gram)[start]
        new = np.ones(len(start), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1)
        begin = np.flatnonzero(new)
        first.append(start[begin] + at)
        count.append(np.diff(np.append(begin, len(start))))
        place.append(anchor[begin] + at)
    if not first:
        none = np.zeros(0, np.int64)
        return none, none, none, none, none, none
    first, count, place = np.concatenate(first), np.concatenate(count), np.concatenate(place)
    digest = xxhash.xxh3_64_intdigest
    grams = np.fromiter((digest(whole[p : p + gram]) for p in place.tolist()), np.uint64, len(place))
    spans = zip(first.tolist(), (first + count + width - 1).tolist(), (place - first).tolist())
    hashes = np.fromiter((digest(whole[a:b], off) for a, b, off in spans), np.uint64, len(first))
    owner = np.searchsorted(ends, first, "right")
    return owner, first - begins[owner], count, place - first, grams.view(np.int64), hashes.view(np.int64)


def _shape(offset: np.ndarray, count: np.ndarray) -> np.ndarray:
    return (offset << 16 | count).astype(np.int32)


# --- the last passes --------------------------------------------------------------------


def radix_repeats(contexts: list[bytes], group: np.ndarray, offset: np.ndarray, count: np.ndarray, width: int = WIDTH) -> list[tuple[int, int, int]]:
    """Windows that an earlier member of their group has too: (member, first window, windows).

    A member is a cell: its bytes, its group, its anchor's distance, its windows. Members
    of a group are in order of their place in the corpus. Groups are refined by one digit
    of eight bytes after the other; windows alone in their group drop out.
    """
    data = np.frombuffer(b"".join(contexts) + b"\0" * 8, np.uint8)
    digit = np.zeros(len(data) - 8, np.uint64)
    for i in range(8):
        digit = digit << np.uint64(8) | data[i : i + len(digit)]
    base = np.cumsum([0] + [len(c) for c in contexts[:-1]])
    member = np.repeat(np.arange(len(contexts)), count)
    nth = np.arange(len(member)) - np.repeat(np.cumsum(count) - count, count)
    at = base[member] + nth
    same = group[member] * (1 << 16) + (offset[member] - nth + (1 << 15))  # group, and distance to the anchor
    steps = [*range(0, width - 8, 8), width - 8]
    for step in [None, *steps]:
        value = np.zeros(len(at), np.uint64) if step is None else digit[at + step]
        order = np.lexsort((value, same))
        new = np.ones(len(order), bool)
        new[1:] = (same[order][1:] != same[order][:-1]) | (value[order][1:] != value[order][:-1])
        name = np.cumsum(new) - 1
        left = np.bincount(name, minlength=1)[name] > 1
        order, same = order[left], name[left]
        member, nth, at = member[order], nth[order], at[order]
    order = np.lexsort((member, same))
    member, nth, same = member[order], nth[order], same[order]
    again = np.zeros(len(member), bool)
    again[1:] = same[1:] == same[:-1]
    member, nth = member[again], nth[again]
    order = np.lexsort((nth, member))
    member, nth = member[order], nth[order]
    new = np.ones(len(member), bool)
    new[1:] = (member[1:] != member[:-1]) | (nth[1:] != nth[:-1] + 1)
    begin = np.flatnonzero(new)
    sizes = np.diff(np.append(begin, len(member)))
    return list(zip(member[begin].tolist(), nth[begin].tolist(), sizes.tolist()))


# --- over a table -----------------------------------------------------------------------


def _units(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``id``, and by what rows are told apart and ordered: ``doc`` and ``th`` (of the text); and ``text``."""
    no_key = F.col(key).isNull()
    whole = F.coalesce(F.col(text), F.lit(""))
    th = F.shiftright(F.xxhash64(whole, F.when(no_key, 1).otherwise(0)), 32).cast("int")
    return docs.select(F.col(key).alias("id"), F.coalesce(F.col(key).cast("long"), F.lit(_LAST)).alias("doc"), th.alias("th"), whole.alias("text"))


_PASSED = "gram long, cell long, doc long, at long, shape int"
_NAMES = [f.split()[0] for f in _PASSED.split(", ")]


def _batch(*arrays: np.ndarray) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32())
    return pa.RecordBatch.from_arrays([pa.array(a, k) for a, k in zip(arrays, kinds)], _NAMES)


def _all_cells(units: DataFrame, width: int, gram: int) -> DataFrame:
    """Cells, and (shape below zero: minus the bytes) spans that an earlier cell of the same task repeats.

    ``at`` is ``th`` and the first window's place in the text.
    """

    def combined(held: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        name, hashed, doc, at, shape = (np.concatenate(c) for c in zip(*held))
        order = np.lexsort((at, doc, hashed, name))
        name, hashed, doc, at, shape = name[order], hashed[order], doc[order], at[order], shape[order]
        again, itself = np.zeros(len(name), bool), np.zeros(len(name), bool)
        again[1:] = (name[1:] == name[:-1]) & (hashed[1:] == hashed[:-1])
        itself[1:] = again[1:] & (doc[1:] == doc[:-1]) & (at[1:] == at[:-1])
        yield _batch(name[~again], hashed[~again], doc[~again], at[~again], shape[~again])
        # a row given twice is not its own repetition, and never its first one's
        first = np.maximum.accumulate(np.where(again, 0, np.arange(len(name))))
        again &= (doc != doc[first]) | (at != at[first])
        again &= ~itself
        doc, at, size = doc[again], at[again], (shape[again] & 0xFFFF) + width - 1
        order = np.lexsort((at, doc))
        doc, at, size = doc[order], at[order], size[order].astype(np.int64)
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (at[1:] > at[:-1] + size[:-1])
        begin = np.flatnonzero(new)
        if len(begin):
            end = np.append(begin[1:], len(doc)) - 1
            covered = at[end] + size[end] - at[begin]
            # names that spread the spans over the tasks
            yield _batch(doc[begin] * 2654435761 % (1 << 40), np.zeros(len(begin), np.int64), doc[begin], at[begin], -covered)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch, texts in in_batches(batches):
            doc, th = (batch.column(c).to_numpy() for c in ("doc", "th"))
            owner, first, count, offset, name, hashed = cells([t.encode() for t in texts], width, gram)
            held.append((name, hashed, doc[owner], (th[owner].astype(np.int64) << 32) + first, _shape(offset, count)))
            rows += len(name)
            if rows >= HELD_CELLS:
                yield from combined(held)
                held, rows = [], 0
        if rows:
            yield from combined(held)

    return units.select("doc", "th", "text").mapInArrow(run, _PASSED)


def _hot_grams(units: DataFrame, width: int, gram: int) -> list[int]:
    """Anchor strings (hashes) in many documents of a bounded sample. They only decide where cells are compared."""
    rows = units.count()
    sample = units.select("text").sample(min(1.0, SAMPLE_DOCS / max(1, rows)), seed=11)
    least = max(2, int(HOT_SHARE * min(rows, SAMPLE_DOCS)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in in_batches(batches):
            owner, _, _, _, name, _ = cells([t.encode() for t in texts], width, gram)
            names = np.unique(np.stack([name, owner]), axis=1)[0]
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64())], ["gram"])

    found = sample.mapInArrow(run, "gram long").groupBy("gram").count().where(F.col("count") >= least)
    return [r.gram for r in found.orderBy(F.desc("count"), "gram").limit(1024).collect()]


def _passed(found: DataFrame, hot: list[int], width: int) -> DataFrame:
    """Spans to remove (shape below zero), and first cells that share their anchor string with another one.

    Rows arrive sorted by anchor string, cell and place; nothing but the last row of one
    batch is kept for the next.
    """
    by = [F.col("gram")]
    if hot:
        by.append(F.when(F.col("gram").isin(hot), F.pmod("cell", F.lit(SPREAD))).otherwise(0))
    known = np.sort(np.array(hot, np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # gram, cell, doc and at of the first cell before, its shape, whether it was sent
        for batch in batches:
            name, hashed, doc, at, shape = (batch.column(c).to_numpy() for c in _NAMES)
            ready = shape < 0
            if ready.any():
                yield _batch(name[ready], hashed[ready], doc[ready], at[ready], shape[ready])
                name, hashed, doc, at, shape = (a[~ready] for a in (name, hashed, doc, at, shape))
            if len(name) == 0:
                continue
            if last is not None:  # the first cell before leads the rows of this batch
                name, hashed, doc, at, shape = (np.append(np.array([v], a.dtype), a) for v, a in zip(last[:5], (name, hashed, doc, at, shape)))
            new = np.ones(len(name), bool)
            new[1:] = (name[1:] != name[:-1]) | (hashed[1:] != hashed[:-1])
            begin = np.flatnonzero(new)
            first = np.repeat(begin, np.diff(np.append(begin, len(name))))
            again = (doc != doc[first]) | (at != at[first])
            sent = np.zeros(len(begin), bool)
            leads = name[begin]
            sent[1:] |= leads[1:] == leads[:-1]
            sent[:-1] |= leads[1:] == leads[:-1]
            sent |= np.isin(leads, known)
            send = sent.copy()
            if last is not None and last[5]:
                send[0], sent[0] = False, True
            if again.any():
                yield _batch(name[again], hashed[again], doc[again], at[again], -((shape[again] & 0xFFFF) + width - 1))
            pick = begin[send]
            if len(pick):
                yield _batch(name[pick], hashed[pick], doc[pick], at[pick], shape[pick])
            k = begin[-1]
            last = (name[k], hashed[k], doc[k], at[k], shape[k], bool(sent[-1]))

    return found.repartition(*by).sortWithinPartitions("gram", "cell", "doc", "at").mapInArrow(run, _PASSED)


def _contexts(units: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """The bytes of the wanted cells: ``key, doc, at, shape, bytes``; spans that need no comparison have no bytes.

    ``wanted`` has ``doc, th, gram, place, shape, large``. Windows of cells whose string
    has too many cells for one task are rows of their own, under a hash of their bytes.
    """
    per_doc = wanted.groupBy("doc", "th").agg(F.collect_list(F.struct("gram", "place", "shape", "large")).alias("cells"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows: list[tuple]) -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["key", "doc", "at", "shape", "bytes"])

        held: dict[bytes, tuple[int, int]] = {}
        for batch, texts in in_batches(batches):
            rows = []
            for doc, th, found, text in zip(*(batch.column(c).to_pylist() for c in ("doc", "th", "cells")), texts):
                data, base = text.encode(), th << 32
                for one in found:
                    place, count = one["place"], one["shape"] & 0xFFFF
                    if not one["large"]:
                        rows.append((one["gram"], doc, base + place, one["shape"], data[place : place + count + width - 1]))
                        continue
                    for p in range(place, place + count):
                        mine, other = (doc, base + p), held.get(data[p : p + width])
                        if other is None or mine < other:
                            held[data[p : p + width]] = mine
                        if other is not None and other != mine:
                            later = max(mine, other)
                            rows.append((later[0], *later, -width, None))
                if len(held) >= HELD_CELLS:
                    rows += [(xxhash.xxh64_intdigest(w) >> 1, *o, 1, w) for w, o in held.items()]
                    held = {}
            if rows:
                yield out(rows)
        if held:
            yield out([(xxhash.xxh64_intdigest(w) >> 1, *o, 1, w) for w, o in held.items()])

    return units.select("doc", "th", "text").join(per_doc, ["doc", "th"]).mapInArrow(run, "key long, doc long, at long, shape int, bytes binary")


def _compared(contexts: DataFrame, width: int) -> DataFrame:
    """Spans ``doc, at, size`` of the windows that an earlier cell has too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, starts in sorted_groups(batches, ["key"], least=2048):
            doc, at, shape = (rows.column(c).to_numpy() for c in ("doc", "at", "shape"))
            group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, rows.num_rows)))
            ready = np.flatnonzero(shape < 0)
            spans = [(doc[ready], at[ready], -shape[ready].astype(np.int64))]
            open_ = np.flatnonzero(shape > 0)
            # a row given twice is one member
            same = np.zeros(len(open_), bool)
            same[1:] = (group[open_][1:] == group[open_][:-1]) & (doc[open_][1:] == doc[open_][:-1]) & (at[open_][1:] == at[open_][:-1])
            open_ = open_[~same]
            if len(open_):
                held = [rows.column("bytes")[i].as_py() for i in open_.tolist()]
                found = radix_repeats(held, group[open_], shape[open_].astype(np.int64) >> 16, shape[open_].astype(np.int64) & 0xFFFF, width)
                if found:
                    member, nth, size = (np.array(c, np.int64) for c in zip(*found))
                    spans.append((doc[open_][member], at[open_][member] + nth, size + width - 1))
            arrays = [pa.array(np.concatenate(c), pa.int64()) for c in zip(*spans)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc", "at", "size"])

    return contexts.repartition("key").sortWithinPartitions("key", "doc", "at").mapInArrow(run, "doc long, at long, size long")


def repeated_spans(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Maximal spans of bytes that ``width``-byte strings with an earlier occurrence cover.

    One row per document that has any: ``doc, th`` (see :func:`remove_repeats`), ``spans``
    (structs ``start, end``, in order). Runs jobs when called.
    """
    units = _units(docs, key, text)
    hot = _hot_grams(units, width, gram)
    passed = materialise(_passed(_all_cells(units, width, gram), hot, width), "passes", "zstd")
    place, th = F.col("at").bitwiseAND(0xFFFFFFFF).alias("place"), F.shiftright("at", 32).cast("int").alias("th")
    wanted = passed.where("shape > 0").select("doc", th, "gram", place, "shape")
    large = materialise(wanted.groupBy("gram").count().where(F.col("count") > GROUP_CELLS).select("gram", F.lit(True).alias("large")), "large-groups")
    wanted = wanted.join(large, "gram", "left").withColumn("large", F.coalesce("large", F.lit(False)))
    compared = materialise(_compared(_contexts(units, wanted, width), width), "compared", "zstd")
    spans = passed.where("shape < 0").select("doc", "at", (-F.col("shape")).cast("long").alias("size")).unionAll(compared)
    return _merged(spans.select("doc", th, place, "size"))


def _merged(spans: DataFrame) -> DataFrame:
    """``doc, th, spans, n_removed`` of overlapping or touching ``doc, th, place, size``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, removed = [], []
            for one in batch.column("all"):
                start, size = (one.values.field(c).to_numpy() for c in ("place", "size"))
                order = np.argsort(start, kind="stable")
                start, end = start[order], np.maximum.accumulate((start + size)[order])
                new = np.ones(len(start), bool)
                new[1:] = start[1:] > end[:-1]
                begin = np.flatnonzero(new)
                start, end = start[begin], end[np.append(begin[1:], len(end)) - 1]
                found.append([{"start": a, "end": b} for a, b in zip(start.tolist(), end.tolist())])
                removed.append(int((end - start).sum()))
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            arrays = [batch.column("doc"), batch.column("th"), pa.array(found, kind), pa.array(removed, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc", "th", "spans", "n_removed"])

    per_doc = spans.groupBy("doc", "th").agg(F.collect_list(F.struct("place", "size")).alias("all"))
    return per_doc.mapInArrow(run, "doc long, th int, spans array<struct<start:bigint,end:bigint>>, n_removed long")


def remove_repeats(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, key: str = "doc_id", text: str = "text", with_text: bool = False) -> DataFrame:
    """Every document without the bytes that a ``width``-byte string with an earlier occurrence covers.

    Texts are UTF-8 bytes; matches do not cross documents; overlaps count; strings are
    judged on the input. Earlier is a smaller ``key`` (null: after all others), in equal
    keys the smaller hash of the text, in one document the earlier place. Of rows equal in
    key and text the first one is kept as it would be alone, the others are repeated from
    end to end. A null text is empty; texts shorter than ``width`` lose nothing; an empty
    table gives no rows; further columns are ignored.

    Gives ``key``, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs),
    ``kept_sha256``, and with ``with_text`` the remaining bytes as ``kept``. Runs jobs when
    called.
    """
    units = _units(docs, key, text)
    runs = materialise(repeated_spans(docs, width, gram, key, text), "runs", "zstd")
    each = units.select("id", "doc", "th", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2(F.col("text").cast("binary"), 256).alias("sha"))
    counted = each.groupBy("doc", "th", "id", "n_bytes", "sha").agg(F.count("*").alias("copies"))
    judged = counted.join(runs, ["doc", "th"], "left").withColumn("n_removed", F.coalesce("n_removed", F.lit(0).cast("long")))
    judged = materialise(judged, "judged", "zstd")
    cut = judged.select("doc", "th", "spans") if with_text else judged.where("n_removed > 0 and n_removed < n_bytes").select("doc", "th", "spans")
    columns = ["doc", "th", "kept_sha256", "kept"][: 4 if with_text else 3]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in in_batches(batches):
            kept = []
            for spans, one in zip(batch.column("spans").to_pylist(), texts):
                data, spans = one.encode(), spans or []
                ends = [0, *[s["end"] for s in spans]]
                starts = [*[s["start"] for s in spans], len(data)]
                kept.append(b"".join(data[a:b] for a, b in zip(ends, starts)))
            shas = pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())
            arrays = [batch.column("doc"), batch.column("th"), shas, pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays[: len(columns)], columns)

    schema = "doc long, th int, kept_sha256 string" + ", kept binary" * with_text
    cut = units.select("doc", "th", "text").join(cut, ["doc", "th"]).mapInArrow(run, schema).dropDuplicates(["doc", "th"])
    nothing = hashlib.sha256(b"").hexdigest()
    sha = F.when(F.col("n_removed") == 0, F.col("sha")).otherwise(F.coalesce("kept_sha256", F.lit(nothing)))
    nth = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("nth")
    rows = judged.join(cut, ["doc", "th"], "left").withColumn("kept_sha256", sha).select("*", nth)
    again = (F.col("nth") > 1) & (F.col("n_bytes") >= width)
    n_spans = F.when(F.col("n_removed") > 0, F.size("spans")).otherwise(0)
    out = [
        F.col("id").alias(key),
        F.col("n_bytes"),
        F.when(again, F.col("n_bytes")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(again, 1).otherwise(n_spans).cast("long").alias("n_spans"),
        F.when(again, nothing).otherwise(F.col("kept_sha256")).alias("kept_sha256"),
    ]
    if with_text:
        out.append(F.when(again, F.lit(b"")).otherwise(F.col("kept")).alias("kept"))
    return rows.select(*out)
