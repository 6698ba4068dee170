"""Repeated passages: every byte covered by 50 bytes that also start in a document with a smaller doc_id.

**Anchors.** Of the 27 strings of 24 bytes in a window of 50 bytes, those with the lowest hash are its anchors. Equal
windows have equal anchors, so a repeated window has an anchor that is met in several documents. A first pass finds
the anchors met more than once and keeps them in a bit set.

**Contexts.** All windows with a given anchor lie in the 76 bytes around it, its context. A second pass sends anchor
and context hash of the repeated ones. Where the same context is met in a smaller document, all its windows are
repeated. That settles the inside of repeated passages, in the tasks that read the texts as far as both are there.

**Index.** What is left are anchors with several contexts: the ends of passages. Their distinct contexts meet in a
bucket, sorted by their first document, and get a suffix array. Its Burrows-Wheeler transform is kept by runs, and
match lengths are computed at the sampled run ends only. Streaming over the text gives all others, as a
match that does not start a run is one shorter than the match before it. Suffixes with matches of 50 or more are
one set of equal windows, of which the first document keeps its own.

**Hot anchors.** The first pass also adds up, over all tasks, how many contexts each anchor has. One with more than
``HOT`` has too many for one index. Its windows are compared as such, by their hashes: a task passes on the first
document of each distinct window, so a window costs one entry per task however often it is met.

The bit sets have a bit for every eight bytes of text up to ``MAX_BITS`` (256 MB broadcast at most); beyond that
they let more through to the buckets, and the result is the same. Every bucket holds an even share of the input.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import arrays, bitsets
from ledgerloom.llm.bits import possible_members
from ledgerloom.llm.words import whole
from ledgerloom.sources.store import Store

MATCH = 50
ANCHOR = 24
SIDE = MATCH - ANCHOR  # bytes of a context on either side of its anchor
CONTEXT = MATCH + SIDE
_STARTS = SIDE + 1  # windows in a context
_GAP = 255  # no byte of UTF-8
_MARGIN = 128
_BLOCK = 1 << 20  # bytes laid out at a time
_LINES = 4096  # contexts of one index, about
_HELD = 1_000_000  # anchors a task holds before it passes them on
HOT = 2000  # contexts of an anchor, as tasks pass them on
MIN_BITS, MAX_BITS = 22, 31  # bits of a bit set, as powers of two
_HOT_BITS = 24  # of that of hot anchors
_U = np.uint64
_LAST = np.iinfo(np.int64).max  # a null doc_id


def _power(n: int) -> np.uint64:
    return _U(pow(arrays._BASE, n, 1 << 64))


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) of every run of ``width`` values."""
    span = 1
    while span * 2 <= width:
        values = pick(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return pick(values[: len(values) - rest], values[rest:]) if rest else values


@dataclass(frozen=True)
class Anchors:
    """Anchors of several texts: the number of the text, the place in it, hashes of anchor and context, and the contexts."""

    row: np.ndarray
    at: np.ndarray
    key: np.ndarray
    context: np.ndarray
    laid: np.ndarray
    place: np.ndarray
    runs: dict[int, np.ndarray]
    is_start: np.ndarray

    def windows(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The windows around the chosen anchors: number of the text, start in it, hash."""
        place = ((self.place[chosen] - SIDE)[:, None] + np.arange(_STARTS)).ravel()
        row = np.repeat(self.row[chosen], _STARTS)
        at = ((self.at[chosen] - SIDE)[:, None] + np.arange(_STARTS)).ravel()
        whole_ = self.is_start[place]
        place, row, at = place[whole_], row[whole_], at[whole_]
        return row, at, arrays.mixed(_joined(self.runs, place, (16, 16, 16, 2)))

    def text(self, chosen: np.ndarray) -> np.ndarray:
        """The bytes of the chosen contexts, one per line."""
        return self.laid[(self.place[chosen] - SIDE)[:, None] + np.arange(CONTEXT)]


def _joined(runs: dict[int, np.ndarray], place: np.ndarray, widths: tuple[int, ...]) -> np.ndarray:
    """Hash of the string from each place that is as long as the widths together."""
    total, done = np.zeros(len(place), dtype=_U), 0
    for width in widths:
        total = total * _power(width) + runs[width][place + done]
        done += width
    return total


def _parts(offsets: np.ndarray) -> Iterator[list[tuple[int, int, int, int, int]]]:
    """(text, from, to, core from, core to) in blocks; a long text in parts that overlap by a margin."""
    block, total = [], 0
    for row, size in enumerate(np.diff(offsets).tolist()):
        if size < MATCH:
            continue
        for low in range(0, size, _BLOCK):
            high = min(low + _BLOCK, size)
            start, end = max(0, low - _MARGIN), min(size, high + _MARGIN)
            block.append((row, start, end, low, high))
            total += end - start
            if total >= _BLOCK:
                yield block
                block, total = [], 0
    if block:
        yield block


def anchors(data: np.ndarray, offsets: np.ndarray) -> Iterator[Anchors]:
    """The anchors of all texts, block by block."""
    for block in _parts(offsets):
        sizes = np.array([end - start for _, start, end, _, _ in block])
        first = np.cumsum(np.r_[0, sizes[:-1] + SIDE]) + SIDE
        laid = np.full(int(sizes.sum()) + SIDE * (len(block) + 1) + CONTEXT, _GAP, dtype=np.uint8)
        is_start = np.zeros(len(laid), dtype=bool)
        for (row, start, end, _, _), at in zip(block, first.tolist(), strict=True):
            laid[at : at + end - start] = data[offsets[row] + start : offsets[row] + end]
            is_start[at : at + end - start - MATCH + 1] = True

        # hashes of all strings of 1, 2, 4, 8 and 16 bytes, then of 24
        runs = {1: arrays._BYTE[laid]}
        for n in (1, 2, 4, 8):
            runs[2 * n] = runs[n][:-n] * _power(n) + runs[n][n:]
        n = len(laid) - ANCHOR + 1
        hashed = runs[16][:n] * _power(8) + runs[8][16 : 16 + n]
        order = np.maximum((hashed * _U(0x9E3779B97F4A7C15)) >> _U(32), _U(1)).astype(np.uint32)
        lowest = _sliding(order, _STARTS, np.minimum)
        lowest[~is_start[: len(lowest)]] = 0
        around = np.zeros(n + SIDE, dtype=np.uint32)
        around[SIDE : SIDE + len(lowest)] = lowest
        place = np.flatnonzero(order == _sliding(around, _STARTS, np.maximum))

        part = np.searchsorted(first, place, side="right") - 1
        rows, starts, _, lows, highs = (np.array(c) for c in zip(*block))
        at = place - first[part] + starts[part]
        core = (at >= lows[part]) & (at < highs[part])
        place, part, at = place[core], part[core], at[core]
        context = arrays.mixed(_joined(runs, place - SIDE, (16, 16, 16, 16, 8, 4)))
        yield Anchors(rows[part], at, arrays.mixed(hashed[place]), context, laid, place, runs, is_start)


def set_bits(docs: DataFrame) -> int:
    """Bits of a bit set for these texts, as a power of two."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return min(max((size // 8).bit_length(), MIN_BITS), MAX_BITS)


def _key_bit(key: np.ndarray, bits: int) -> np.ndarray:
    return (key >> _U(64 - bits)).astype(np.uint32)


def _context_bit(key: np.ndarray, context: np.ndarray, bits: int) -> np.ndarray:
    return _key_bit(arrays.mixed(key ^ context), bits)


def _batch_texts(batch: pa.RecordBatch, column: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for part in arrays.pieces(batch, column):
        yield (part, *arrays.text_bytes(part.column(column)))


def _binary(rows: list[tuple], names: list[str], ints: int) -> pa.RecordBatch:
    """Rows of integers (the first ``ints`` columns) and binaries."""
    columns = list(zip(*rows)) or [()] * len(names)
    kinds = [pa.int64()] * ints + [pa.binary()] * (len(names) - ints)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _dealt(to: np.ndarray, arrays_: list[np.ndarray]) -> list[tuple]:
    """A row for each number in ``to``: the number, and its part of each array."""
    order = np.argsort(to, kind="stable")
    cuts = np.flatnonzero(np.diff(to[order])) + 1
    return [(int(to[p[0]]), *[a[p].tobytes() for a in arrays_]) for p in np.split(order, cuts) if len(p)]


def _bucket(key: np.ndarray, buckets: int) -> np.ndarray:
    return ((key & _U(0xFFFFFFFF)) % _U(buckets)).astype(np.int64)


def _join(parts: list[np.ndarray], kind) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, dtype=kind)


def _column(table: pa.Table, name: str, kind) -> np.ndarray:
    """The arrays in a binary column, one after the other."""
    return np.frombuffer(b"".join(table.column(name).to_pylist()), dtype=kind)


# first pass: which anchors are met in several documents


def _contexts_with(key: np.ndarray, context: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Number of distinct contexts of each anchor. ``key`` is sorted, and each anchor starts at one of ``start``."""
    count = np.diff(np.r_[start, len(key)])
    out = np.ones(len(start), dtype=np.uint32)
    again = np.repeat(count > 1, count)
    of = np.repeat(np.arange(len(start)), count)[again]
    context = context[again]
    order = np.lexsort((context, of))
    of, context = of[order], context[order]
    fresh = np.r_[True, (of[1:] != of[:-1]) | (context[1:] != context[:-1])][: len(of)]
    out[count > 1] = np.bincount(of[fresh], minlength=len(start))[count > 1]
    return out


def _met(buckets: int, bits: int):
    """The upper half of a task's distinct anchors by bucket, and how many contexts each has.

    At -1 - piece the bits of those that several texts have.
    """

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[np.ndarray] = []
        rows: list[np.ndarray] = []
        contexts: list[np.ndarray] = []
        total = texts = 0

        def passed_on() -> pa.RecordBatch:
            key, row = _join(keys, _U), _join(rows, np.int64)
            order = np.argsort(key, kind="stable")
            key, row = key[order], row[order]
            new = np.r_[True, key[1:] != key[:-1]][: len(key)]
            start = np.flatnonzero(new)
            other = np.r_[False, row[1:] != row[:-1]][: len(key)] & ~new  # another text has the anchor too
            several = np.unique(_key_bit(key[other], bits))
            counts = _contexts_with(key, _join(contexts, _U)[order], start)
            key = key[start]
            out = _dealt(_bucket(key, buckets), [(key >> _U(32)).astype(np.uint32), counts])
            out += [(-1 - piece, b, b"") for piece, b in bitsets.packed(several)]
            return _binary(out, ["bucket", "values", "counts"], 1)

        for batch in batches:
            for part, data, offsets in _batch_texts(batch, 0):
                for a in anchors(data, offsets):
                    keys.append(a.key)
                    rows.append(a.row + texts)
                    contexts.append(a.context)
                    total += len(a.key)
                texts += part.num_rows
                if total > _HELD:
                    yield passed_on()
                    keys, rows, contexts, total = [], [], [], 0
        yield passed_on()

    return met


def _met_again(bits: int, hot: int):
    """Of a bucket: the bits of the anchors that more than one task has.

    After the pieces of that set, the bits of those that have more than ``hot`` contexts in all tasks together.
    """

    def met_again(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        values = _column(table, "values", np.uint32)
        if bucket < 0:
            found = [(-1 - bucket, np.unique(values).tobytes())]
        else:
            order = np.argsort(values)
            values, counts = values[order], _column(table, "counts", np.uint32)[order].astype(np.int64)
            found = bitsets.packed(values[1:][values[1:] == values[:-1]] >> np.uint32(32 - bits))
            start = np.flatnonzero(np.r_[True, values[1:] != values[:-1]])
            crowded = values[start[np.add.reduceat(counts, start) > hot]] if len(start) else values
            crowded = bitsets.packed(crowded >> np.uint32(32 - _HOT_BITS))
            found += [(bitsets.pieces(bits) + piece, b) for piece, b in crowded]
        return pa.Table.from_batches([_binary(found, ["piece", "bits"], 1)])

    return met_again


def repeated_anchors(docs: DataFrame, store: Store, buckets: int, bits: int, hot: int) -> tuple[Broadcast, Broadcast]:
    """Bit sets of the anchors that are met in more than one row, and of those with too many contexts."""
    met = docs.select("text").mapInArrow(_met(buckets, bits), "bucket long, values binary, counts binary")
    found = store.scratch(met.groupBy("bucket").applyInArrow(_met_again(bits, hot), "piece long, bits binary"), "anchors")
    several = F.col("piece") < bitsets.pieces(bits)
    crowded = found.filter(~several).withColumn("piece", F.col("piece") - bitsets.pieces(bits))
    return bitsets.broadcast_set(found.filter(several), bits), bitsets.broadcast_set(crowded, _HOT_BITS)


# second pass: contexts of repeated anchors, and of those with several contexts the texts


@dataclass
class _Found:
    """Anchors with their documents, as arrays of equal length."""

    key: np.ndarray
    context: np.ndarray
    doc: np.ndarray
    text: np.ndarray  # hash of the document's text, which tells rows of equal doc_id apart
    at: np.ndarray

    @classmethod
    def of(cls, parts: list[tuple]) -> _Found:
        kinds = (_U, _U, np.int64, np.int64, np.int64)
        return cls(*[_join([p[i] for p in parts], kind) for i, kind in enumerate(kinds)])

    @classmethod
    def read(cls, table: pa.Table) -> _Found:
        kinds = (_U, _U, np.int64, np.int64, np.int32)
        arrays_ = [_column(table, n, k) for n, k in zip(cls.names(), kinds, strict=True)]
        return cls(*arrays_[:4], arrays_[4].astype(np.int64))

    @staticmethod
    def names() -> tuple[str, ...]:
        return ("key", "context", "doc", "text", "at")

    def __getitem__(self, chosen: np.ndarray) -> _Found:
        return _Found(*[getattr(self, n)[chosen] for n in self.names()])

    def written(self) -> list[np.ndarray]:
        return [self.key, self.context, self.doc, self.text, self.at.astype(np.int32)]

    def sorted(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The order by key, context, document, place; where a key and where a context starts in it."""
        order = np.lexsort((self.at, self.doc, self.context, self.key))
        key, context = self.key[order], self.context[order]
        new_key = np.r_[True, key[1:] != key[:-1]][: len(key)]
        return order, new_key, new_key | np.r_[True, context[1:] != context[:-1]][: len(key)]


def _first_of(found: _Found) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sorted order, key starts, context starts, and whether a row is in the first document of its context."""
    order, new_key, new_context = found.sorted()
    doc = found.doc[order]
    start = np.flatnonzero(new_context)
    first = np.repeat(doc[start], np.diff(np.r_[start, len(doc)])) if len(doc) else doc
    return order, new_key, new_context, doc == first


def _mark_rows(doc: np.ndarray, text: np.ndarray, low: np.ndarray, high: np.ndarray, groups: int) -> list[tuple]:
    """Ranges of repeated windows (first and last start), packed by a group of documents."""
    group = (arrays.mixed(doc.astype(_U) ^ text.astype(_U)) % _U(groups)).astype(np.int64)
    return _dealt(group, [doc, text, low.astype(np.int32), high.astype(np.int32)])


_MARKS = ["group", "m_doc", "m_text", "low", "high"]
_MARK_KINDS = "group long, m_doc binary, m_text binary, low binary, high binary"


def _documents(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    doc = batch.column(0).fill_null(_LAST).to_numpy(zero_copy_only=False)
    return doc, batch.column(1).to_numpy(zero_copy_only=False)


def _contexts(repeated: Broadcast, hot: Broadcast, bits: int, buckets: int, groups: int):
    """Marks of contexts that a smaller document of the task has; the others by bucket. Windows of hot anchors alike,
    by the buckets after those."""

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        windows: list[tuple] = []
        total = 0

        def passed_on(parts: list[tuple], first_bucket: int, low: int) -> pa.RecordBatch:
            found = _Found.of(parts)
            order, _, _, is_first = _first_of(found)
            found = found[order]
            later, first = found[~is_first], found[is_first]
            to = _bucket(first.key, buckets) + first_bucket
            rows = [(b, None, *v, *[None] * 4) for b, *v in _dealt(to, first.written())]
            marks = _mark_rows(later.doc, later.text, later.at - low, later.at, groups)
            rows += [(None, g, *[None] * 5, *v) for g, *v in marks]
            return _binary(rows, ["bucket", "group", *_Found.names(), *_MARKS[1:]], 2)

        for batch in batches:
            for part, data, offsets in _batch_texts(batch, 2):
                doc, text = _documents(part)
                for a in anchors(data, offsets):
                    seen = bitsets.in_set(repeated.value, _key_bit(a.key, bits))
                    crowded = bitsets.in_set(hot.value, _key_bit(a.key, _HOT_BITS))
                    row, at, window = a.windows(np.flatnonzero(crowded))
                    windows.append((window, window, doc[row], text[row], at))
                    seen &= ~crowded
                    row = a.row[seen]
                    held.append((a.key[seen], a.context[seen], doc[row], text[row], a.at[seen]))
                    total += len(row) + len(window)
                if total > _HELD // 3:
                    yield passed_on(held, 0, SIDE)
                    yield passed_on(windows, buckets, 0)
                    held, windows, total = [], [], 0
        yield passed_on(held, 0, SIDE)
        yield passed_on(windows, buckets, 0)

    return contexts


def _settled(bits: int, buckets: int, groups: int):
    """Of a bucket: marks of contexts (or of windows) that a smaller document has, and bits of the contexts that need a
    closer look."""

    def settled(table: pa.Table) -> pa.Table:
        found = _Found.read(table)
        low = SIDE if table.column("bucket")[0].as_py() < buckets else 0  # a window's context is the window
        order, new_key, new_context, is_first = _first_of(found)
        found = found[order]
        later = found[~is_first]
        rows = [(g, None, None, *v) for g, *v in _mark_rows(later.doc, later.text, later.at - low, later.at, groups)]
        start = np.flatnonzero(new_key)
        several = np.add.reduceat(new_context.astype(np.int64), start) > 1 if len(start) else np.zeros(0, dtype=bool)
        several = np.repeat(several, np.diff(np.r_[start, len(new_key)])) & new_context
        wanted = bitsets.packed(_context_bit(found.key[several], found.context[several], bits))
        rows += [(None, piece, b, *[None] * 4) for piece, b in wanted]
        names = ["group", "piece", "bits", *_MARKS[1:]]
        columns = list(zip(*rows)) or [()] * 7
        kinds = [pa.int64(), pa.int64(), *[pa.binary()] * 5]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return settled


# third pass: contexts that share an anchor with others, compared byte by byte


def _texts(wanted: Broadcast, repeated: Broadcast, hot: Broadcast, bits: int, buckets: int):
    """The contexts that need a closer look, by bucket; of each one the first document of the task."""

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        bodies: list[np.ndarray] = []
        total = 0

        def passed_on() -> pa.RecordBatch:
            found = _Found.of(held)
            body = np.concatenate(bodies) if bodies else np.zeros((0, CONTEXT), dtype=np.uint8)
            order, _, _, is_first = _first_of(found)
            order = order[is_first]
            found = found[order]
            rows = _dealt(_bucket(found.key, buckets), [*found.written(), body[order]])
            return _binary(rows, ["bucket", *_Found.names(), "body"], 1)

        for batch in batches:
            for part, data, offsets in _batch_texts(batch, 2):
                doc, text = _documents(part)
                for a in anchors(data, offsets):
                    seen = bitsets.in_set(repeated.value, _key_bit(a.key, bits))
                    seen = np.flatnonzero(seen & ~bitsets.in_set(hot.value, _key_bit(a.key, _HOT_BITS)))
                    seen = seen[bitsets.in_set(wanted.value, _context_bit(a.key[seen], a.context[seen], bits))]
                    row = a.row[seen]
                    held.append((a.key[seen], a.context[seen], doc[row], text[row], a.at[seen]))
                    bodies.append(a.text(seen))
                    total += len(seen)
                if total > _HELD // 10:
                    yield passed_on()
                    held, bodies, total = [], [], 0
        yield passed_on()

    return texts


_FIRST = 7  # bytes of the first ranks, so that their number stays positive


def _starting_bytes(body: np.ndarray) -> np.ndarray:
    """The first seven bytes of every suffix of every line as one number; nothing after the end of a line."""
    lines, width = body.shape
    padded = np.zeros((lines, width + _FIRST), dtype=np.uint8)
    padded[:, :width] = body
    out = np.zeros((lines, width), dtype=np.int64)
    for i in range(_FIRST):
        out = (out << 8) | padded[:, i : i + width]
    return out


def _dense(values: np.ndarray) -> np.ndarray:
    """Ranks of equal values are equal, from 1."""
    flat = values.ravel()
    order = np.argsort(flat)
    ordered = flat[order]
    out = np.empty(len(flat), dtype=np.int64)
    out[order] = np.cumsum(np.r_[1, ordered[1:] != ordered[:-1]][: len(flat)])
    return out.reshape(values.shape)


def _moved(rank: np.ndarray, by: int) -> np.ndarray:
    """The rank of the suffix that starts ``by`` bytes later; 0 past the end of the line."""
    out = np.zeros_like(rank)
    if by < rank.shape[1]:
        out[:, : rank.shape[1] - by] = rank[:, by:]
    return out


def suffix_order(body: np.ndarray) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
    """All suffixes of all lines (line * width + column) in order, equal ones by line, and their ranks by first bytes.

    Ranks by the first 7 bytes give ranks by the first 21, and so on; by 14 where the numbers would get too large.
    """
    lines, width = body.shape
    span, rank = _FIRST, _dense(_starting_bytes(body))
    ranks = [(span, rank)]
    while True:
        base = int(rank.max(initial=0)) + 1
        if 2 * span >= width and base * base * (lines + 1) < 1 << 62:
            last = (rank * base + _moved(rank, span)) * (lines + 1) + np.arange(lines)[:, None]
            return np.argsort(last.ravel()), ranks
        if 2 * span >= 2 * width:  # ranks are by whole suffixes
            return np.lexsort((np.arange(body.size), rank.ravel())), ranks
        longer = rank * base + _moved(rank, span)
        if base**3 < 1 << 62:
            longer, span = longer * base + _moved(rank, 2 * span), 3 * span
        else:
            span = 2 * span
        rank = _dense(longer)
        ranks.append((span, rank))


@dataclass(frozen=True)
class RunIndex:
    """Run-length Burrows-Wheeler transform of lines of text: the suffix order, and where runs of it start."""

    body: np.ndarray
    ranks: list[tuple[int, np.ndarray]]
    order: np.ndarray  # suffixes as line * width + column; equal ones by line
    run_start: np.ndarray  # places in the order at which a run of equal preceding bytes starts

    @classmethod
    def build(cls, body: np.ndarray) -> RunIndex:
        lines, width = body.shape
        order, ranks = suffix_order(body)
        # the byte before a suffix; before a line stands its own end mark, which is like no other
        before = np.empty((lines, width), dtype=np.int32)
        before[:, 1:] = body[:, :-1]
        before[:, 0] = 256 + np.arange(lines)
        transform = before.ravel()[order]
        start = np.flatnonzero(np.r_[True, transform[1:] != transform[:-1]][: len(transform)])
        return cls(body, ranks, order, start)

    def _common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Number of equal first bytes of two suffixes each."""
        width = self.body.shape[1]
        room = width - np.maximum(a % width, b % width)
        common = np.zeros(len(a), dtype=np.int64)
        for span, rank in reversed(self.ranks):
            flat = rank.ravel()
            going = np.flatnonzero(common < room)
            while len(going):  # once or twice
                going = going[flat[a[going] + common[going]] == flat[b[going] + common[going]]]
                common[going] += span
                going = going[common[going] < room[going]]
        # equal ranks past the end of a line say that the lines end alike
        inside = np.flatnonzero(common < room)
        first = _starting_bytes(self.body).ravel()
        differ = first[a[inside] + common[inside]] ^ first[b[inside] + common[inside]]
        _, bits = np.frexp(differ.astype(np.float64))
        common[inside] += np.clip((8 * _FIRST - bits) // 8, 0, _FIRST)
        return np.minimum(common, room)

    def match_lengths(self) -> np.ndarray:
        """For each suffix, in text order, how many bytes it has in common with the one before it in suffix order.

        Computed at the starts of runs. All others follow in text order, as within a run the two suffixes that
        start one byte earlier are neighbours too and have that byte more in common.
        """
        sampled = self.order[self.run_start]
        length = np.zeros(self.body.size, dtype=np.int64)
        length[sampled] = self._common(sampled, self.order[np.maximum(self.run_start - 1, 0)])
        length[sampled[:1]] = 0  # none is before the first
        last = np.zeros(self.body.size, dtype=np.int64)
        last[sampled] = sampled
        last = np.maximum.accumulate(last)  # the last sampled suffix up to each place of the text
        return np.maximum(length[last] - (np.arange(self.body.size) - last), 0)


def repeated_windows(body: np.ndarray, match: int = MATCH) -> np.ndarray:
    """For each line and start: the first line in which the window of ``match`` bytes from there occurs anywhere."""
    lines, width = body.shape
    if not lines:
        return np.zeros((0, width - match + 1), dtype=np.int64)
    index = RunIndex.build(body)
    length = index.match_lengths()[index.order]
    start = np.flatnonzero(np.r_[True, length[1:] < match])
    first = np.minimum.reduceat(index.order // width, start)
    out = np.empty(body.size, dtype=np.int64)
    out[index.order] = np.repeat(first, np.diff(np.r_[start, body.size]))
    return out.reshape(lines, width)[:, : width - match + 1]


def _marked(groups: int):
    """Of a bucket: the windows of its contexts that a smaller document has."""

    def marked(table: pa.Table) -> pa.Table:
        found = _Found.read(table)
        body = _column(table, "body", np.uint8).reshape(-1, CONTEXT)
        order, _, _, is_first = _first_of(found)
        order = order[is_first]  # contexts met in later documents are marked already
        found, body = found[order], body[order]
        # equal windows have equal anchors, so a bucket can be indexed in parts that sort fast
        part = ((found.key >> _U(40)) % _U(len(body) // _LINES + 1)).astype(np.int64)
        out = []
        for chosen in np.split(np.argsort(part, kind="stable"), np.cumsum(np.bincount(part))[:-1]) if len(part) else []:
            out += _mark_rows(*_repeated_in(found[chosen], body[chosen]), groups)
        return pa.Table.from_batches([_binary(out, _MARKS, 1)])

    return marked


def _repeated_in(found: _Found, body: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document, its text, first and last start of the windows that a smaller document has.

    ``found`` is in the order of key and context, and has each context in its first document only.
    """
    _, _, new_context, _ = _first_of(found)
    start = np.flatnonzero(new_context)
    line_of = np.cumsum(new_context) - 1
    by_doc = np.argsort(found.doc[start], kind="stable")  # lines in the order of their first documents
    line = np.empty(len(start), dtype=np.int64)
    line[by_doc] = np.arange(len(start))
    docs = found.doc[start][by_doc]
    first = repeated_windows(body[start][by_doc])
    again = docs[first] < docs[:, None]
    # runs of window starts that are repeated
    edge = np.zeros((len(docs), _STARTS + 2), dtype=np.int8)
    edge[:, 1:-1] = again
    step = np.diff(edge, axis=1)
    of_line, low = np.nonzero(step == 1)
    high = np.nonzero(step == -1)[1] - 1
    # for every place the context has in its first document
    count = np.bincount(of_line, minlength=len(docs))
    begin = np.cumsum(count) - count
    mine = line[line_of]
    times = count[mine]
    rows = np.repeat(np.arange(len(mine)), times)
    which = begin[mine[rows]] + np.arange(len(rows)) - np.repeat(np.cumsum(times) - times, times)
    base = found.at[rows] - SIDE
    return found.doc[rows], found.text[rows], base + low[which], base + high[which]


def _merged_marks(table: pa.Table) -> pa.Table:
    """Of a group of documents: for each the ranges of repeated windows, in order and without overlap."""
    doc, text = _column(table, "m_doc", np.int64), _column(table, "m_text", np.int64)
    low, high = _column(table, "low", np.int32).astype(np.int64), _column(table, "high", np.int32).astype(np.int64)
    low = np.maximum(low, 0)
    keep = high >= low
    doc, text, low, high = doc[keep], text[keep], low[keep], high[keep]
    order = np.lexsort((low, text, doc))
    doc, text, low, high = doc[order], text[order], low[order], high[order]
    new = np.r_[True, (doc[1:] != doc[:-1]) | (text[1:] != text[:-1])][: len(doc)]
    start = np.flatnonzero(new)
    names, lows, highs = [], [], []
    for a, b in zip(start.tolist(), [*start[1:].tolist(), len(doc)], strict=True):
        reach = np.maximum.accumulate(high[a:b])
        cut = np.flatnonzero(np.r_[True, low[a + 1 : b] > reach[:-1] + 1])
        names.append((int(doc[a]), int(text[a])))
        lows.append(low[a:b][cut].astype(np.int32).tobytes())
        highs.append(reach[np.r_[cut[1:] - 1, b - a - 1]].astype(np.int32).tobytes())
    columns = [pa.array([n[0] for n in names], pa.int64()), pa.array([n[1] for n in names], pa.int64())]
    columns += [pa.array(lows, pa.binary()), pa.array(highs, pa.binary())]
    return pa.Table.from_arrays(columns, names=["m_doc", "m_text", "lows", "highs"])


def _spans(size: int, lows: bytes | None, highs: bytes | None) -> np.ndarray:
    """Maximal runs of bytes covered by the windows, as lines of start and end."""
    if lows is None or size < MATCH:
        return np.zeros((0, 2), dtype=np.int64)
    low = np.frombuffer(lows, dtype=np.int32).astype(np.int64)
    high = np.minimum(np.frombuffer(highs, dtype=np.int32).astype(np.int64), size - MATCH)
    low, high = low[low <= high], high[low <= high]
    if not len(low):
        return np.zeros((0, 2), dtype=np.int64)
    apart = low[1:] > high[:-1] + MATCH
    return np.stack([low[np.r_[True, apart]], high[np.r_[apart, True]] + MATCH], axis=1)


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, data, offsets in _batch_texts(batch, 1):
            lows, highs = part.column(2).to_pylist(), part.column(3).to_pylist()
            starts, ends, counts, kept = [], [], [], []
            for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
                spans = _spans(b - a, lows[i], highs[i])
                counts.append(len(spans))
                starts += spans[:, 0].tolist()
                ends += spans[:, 1].tolist()
                edges = [0, *spans.ravel().tolist(), b - a]
                kept.append(b"".join(data[a + x : a + y].tobytes() for x, y in zip(edges[::2], edges[1::2])))
            inner = pa.StructArray.from_arrays([pa.array(starts, pa.int64()), pa.array(ends, pa.int64())], names=["start", "end"])
            spans = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)], pa.int32()), inner)
            columns = [part.column(0), pa.array(np.diff(offsets), pa.int64()), spans, pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "spans", "kept"])


def without_repeats(docs: DataFrame, store: Store, hot: int = HOT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, spans (start and end of the removed runs), kept (the other bytes).

    A byte is removed when it is covered by 50 bytes that also start in a document with a smaller doc_id, judged on
    the texts as they came. A null or empty text has no bytes, and a text below 50 bytes loses none. A null doc_id is
    larger than all others. Rows of equal doc_id take nothing from each other. Other columns are not read, and an
    empty table gives an empty result.
    """
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets, groups = 2 * partitions, partitions
    body = whole("text")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(body).alias("hash"), body.alias("text"))

    bits = set_bits(rows)
    repeated, crowded = repeated_anchors(rows, store, buckets, bits, hot)
    kinds = "bucket long, group long, key binary, context binary, doc binary, text binary, at binary, "
    found = rows.mapInArrow(_contexts(repeated, crowded, bits, buckets, groups), kinds + _MARK_KINDS.partition(", ")[2])
    found = store.scratch(found, "contexts")
    open_ = found.filter("bucket IS NOT NULL").select("bucket", *_Found.names()).groupBy("bucket")
    kinds = "group long, piece long, bits binary, " + _MARK_KINDS.partition(", ")[2]
    settled = store.scratch(open_.applyInArrow(_settled(bits, buckets, groups), kinds), "settled")
    wanted = bitsets.broadcast_set(settled.filter("piece IS NOT NULL"), bits)
    kinds = "bucket long, key binary, context binary, doc binary, text binary, at binary, body binary"
    texts = rows.mapInArrow(_texts(wanted, repeated, crowded, bits, buckets), kinds)
    ends = texts.groupBy("bucket").applyInArrow(_marked(groups), _MARK_KINDS)

    marks = found.filter("group IS NOT NULL").select(*_MARKS).unionByName(settled.filter("group IS NOT NULL").select(*_MARKS))
    merged = marks.unionByName(ends).groupBy("group").applyInArrow(
        _merged_marks, "m_doc long, m_text long, lows binary, highs binary"
    )
    merged = store.scratch(merged, "marks")
    return _apply(rows, merged).mapInArrow(
        _without, "doc_id long, n_bytes long, spans array<struct<start: bigint, end: bigint>>, kept binary"
    )


def _apply(rows: DataFrame, marks: DataFrame) -> DataFrame:
    """doc_id, text, lows, highs. Only texts that may have marks are shuffled."""
    doc = F.coalesce("doc_id", F.lit(_LAST))
    rows = rows.withColumn("key", F.xxhash64(doc, "hash"))
    marked = possible_members(rows, "key", marks.select(F.xxhash64("m_doc", "m_text").alias("key")), keep=True)
    may = marked.filter("member").join(
        marks, (doc == F.col("m_doc")) & (F.col("hash") == F.col("m_text")), "left"
    )
    others = marked.filter("NOT member").withColumns({n: F.lit(None).cast("binary") for n in ("lows", "highs")})
    names = ("doc_id", "text", "lows", "highs")
    return may.select(*names).unionByName(others.select(*names))


def removed_bytes(spans: Column) -> Column:
    """Number of bytes in an array of spans."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
