"""Repeated passages, found by hashes of windows of words in groups of suffixes with a common prefix.

The suffixes of all texts are taken at word starts and cut at a window of words. Variable-length prefixes split them
into groups that fit in memory: a prefix is one word, and where too many suffixes share it, it is extended to more
words, level by level up to the window. Which prefixes are extended is decided by counts over all documents, one
pass a level. Each task gathers whole groups and orders a group by the hash of the window: equal hashes are the
occurrences of a repeated passage. All but the first are marked, and the marks go back to the texts.

This takes the place of a suffix tree in each group. Of the tree only the leaves below nodes at window depth are
asked for, and those are the equal windows; there is no order of words, no deeper node and no maximal repeat, and words
are not compared.

A suffix travels as a 64-bit hash of its window. Suffixes meet only inside a group, so the chance that two different
windows of N suffixes agree by accident is N x group / 2^65, below one in a thousand for 10^10 suffixes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendscope.llm.common import array, doc_rows, in_batches, stored, width

WINDOW = 20
GROUP = 1_500_000  # suffixes of a group, about
HELD_WORDS = 500_000  # words that a task holds before it sends their suffixes
HELD_MARKS = 500_000  # marks that a task holds before it sends them
DEPTHS = (1, 4, 10)  # words of a prefix and of its extensions, before the last one to the window
DIGIT = 8  # bits by which a level tells the extensions of one prefix apart: a task counts 256 below each
CELL = 16  # neighbouring prefixes whose counts travel in one row
HELD_COUNTS = 2_000_000  # prefixes that a counting task holds
DENSE = 1 << 20  # prefixes of a level or a pass that are looked up or counted in a table with a place for each
CHUNK = 1_000_000  # bytes of text that are cut into words at a time, about

_U64 = np.uint64
_MIX = np.random.default_rng(20).integers(1, 1 << 63, 4096, dtype=np.uint64) * _U64(2) + _U64(1)
_LINE = 8_192  # suffixes whose hashes are added up at a time: they stay in the processor's cache
_KEEP = np.array([(1 << 8 * i) - 1 for i in range(9)], _U64)  # the first bytes of eight
_TABLE = pa.schema([("part", pa.int32()), ("rank", pa.int32()), ("data", pa.binary())])
PARTS = "part int, rank int, data binary"
LAST = np.int64((1 << 63) - 1)  # stands for a null doc_id: after all others


def word_hashes(words: list[bytes]) -> np.ndarray:
    size = np.fromiter(map(len, words), np.int64, len(words))
    return _hashes(np.frombuffer(b"".join(words), np.uint8), np.cumsum(size) - size, size)


def _hashes(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A hash of each word of ``data``, eight bytes of all words at a time."""
    eights = np.zeros(len(data) // 8 + 2, _U64)
    eights.view(np.uint8)[: len(data)] = data
    out = size.astype(_U64) * _U64(0x9E3779B97F4A7C15)
    rows, at, left = slice(None), start, size
    while len(left):
        place, shift = at >> 3, (at & 7).astype(_U64) << _U64(3)
        part = eights[place] >> shift
        part |= (eights[place + 1] << _U64(1)) << (_U64(63) - shift)
        part &= _KEEP[np.minimum(left, 8)]
        mixed = (out[rows] ^ part) * _U64(0xBF58476D1CE4E5B9)
        out[rows] = mixed ^ (mixed >> _U64(32))
        more = np.flatnonzero(left > 8)
        rows = more if isinstance(rows, slice) else rows[more]
        at, left = at[more] + 8, left[more] - 8
    out ^= out >> _U64(30)
    out *= _U64(0xBF58476D1CE4E5B9)
    out ^= out >> _U64(27)
    out *= _U64(0x94D049BB133111EB)
    return out ^ (out >> _U64(31))


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts, one after the other in ``data``, cut as bytes.split() does: starts and sizes of words, words of each text."""
    first = np.zeros(len(data) + 1, np.int8)
    first[offsets] = 1  # a word ends with its text
    word = (data != 32) & ((data - np.uint8(9)) >= 5)
    edge = np.empty(len(data) + 1, bool)
    edge[0], edge[-1] = word[:1].any(), False
    edge[1:-1] = word[1:] & (~word[:-1] | first[1:-1].view(bool))
    start = np.flatnonzero(edge)
    edge[-1] = word[-1:].any()
    edge[1:-1] = word[:-1] & (~word[1:] | first[1:-1].view(bool))
    edge[0] = False
    size = np.flatnonzero(edge) - start
    return start, size, np.diff(np.searchsorted(start, offsets))


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[int, memoryview, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, data, offsets of the texts in it, hashes of their words, words of each): a batch's texts by ``CHUNK``."""
    texts = batch["text"].cast(pa.large_binary())
    if not len(texts) or texts.buffers()[2] is None:
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data, at = memoryview(texts.buffers()[2]), 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK, "right")) - 1)
        own = data[offsets[at] : offsets[end]]
        raw, inside = np.frombuffer(own, np.uint8), offsets[at : end + 1] - offsets[at]
        if len(raw):
            start, size, count = _words(raw, inside)
            yield at, own, inside, _hashes(raw, start, size), count
        at = end


def run_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A hash of each ``n`` consecutive words."""
    return prefix_hashes(words, max(0, len(words) - n + 1), [n])[0]


def prefix_hashes(words: np.ndarray, count: int, depths: list[int]) -> list[np.ndarray]:
    """Hashes of the first words of each of the first ``count`` suffixes, for ascending depths; one sum serves them all."""
    mixed = words ^ (words >> _U64(31))
    out = [np.empty(count, _U64) for _ in depths]
    total, product = np.empty(_LINE, _U64), np.empty(_LINE, _U64)
    for at in range(0, count, _LINE):
        n, done = min(_LINE, count - at), 0
        total[:n] = 0
        for depth, found in zip(depths, out):
            for k in range(done, depth):
                np.multiply(mixed[at + k : at + k + n], _MIX[k % len(_MIX)], out=product[:n])
                total[:n] += product[:n]
            done = depth
            part = total[:n] ^ (total[:n] >> _U64(32))
            part *= _U64(0x9E3779B97F4A7C15)
            found[at : at + n] = part ^ (part >> _U64(29))
    return out


def _suffixes(count: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Of texts of so many words, one after the other: suffixes of each that hold a window, and the place of each suffix."""
    own = np.maximum(count - window + 1, 0)
    skipped = np.cumsum(count) - count - (np.cumsum(own) - own)
    return own, np.arange(int(own.sum())) + np.repeat(skipped, own)


def _order(key: np.ndarray) -> np.ndarray:
    """Rows by a key's upper bits, as many as a row's number leaves room for; equal ones as they lie."""
    low = _U64((1 << max(1, len(key).bit_length())) - 1)
    return (np.sort((key & ~low) | np.arange(len(key), dtype=_U64)) & low).astype(np.int64)


@dataclass
class Groups:
    """The prefixes above the limit, level by level, and the groups below each of them.

    A prefix is numbered by its parent's place among the extended prefixes and a digit, a hash of its words. A prefix
    that is not extended lies whole in one of its parent's groups.
    """

    window: int
    extended: list[np.ndarray]  # for each level the extended prefixes, ascending
    first: list[np.ndarray]  # for each level and parent, its first group
    count: list[np.ndarray]  # and how many groups it has
    tables: dict = field(default_factory=dict, repr=False, compare=False)

    def depths(self) -> list[int]:
        return [d for d in DEPTHS if d < self.window] + [self.window]

    def prefixes(self, words: np.ndarray, count: int) -> list[np.ndarray]:
        """Hashes of the prefixes of the first ``count`` suffixes, an array for each level."""
        return prefix_hashes(words, count, self.depths())

    def _below(self, prefixes: list[np.ndarray], level: int, at, parent) -> np.ndarray:
        """Numbers of the prefixes at a level, of suffixes ``at`` whose parents are extended."""
        return parent << DIGIT | (prefixes[level][at] >> _U64(64 - DIGIT)).astype(np.int64)

    def _looked_up(self, name: str, level: int, parents: int, number: np.ndarray, found) -> np.ndarray:
        """``found(level, number)``, from a table over all numbers where that is small."""
        if parents << DIGIT > DENSE:
            return found(level, number)
        if (name, level) not in self.tables:
            self.tables[name, level] = found(level, np.arange(parents << DIGIT))
        return self.tables[name, level][number]

    def _group(self, level: int, number: np.ndarray) -> np.ndarray:
        up = number >> DIGIT
        mixed = (number.astype(_U64) * _U64(0x9E3779B97F4A7C15)) >> _U64(33)
        return (self.first[level][up] + mixed.astype(np.int64) % self.count[level][up]).astype(np.int32)

    def _place(self, level: int, number: np.ndarray) -> np.ndarray:
        """Where each number stands among the extended prefixes; -1 if it is none."""
        place, hit = _places(self.extended[level], number)
        return np.where(hit, place, -1)

    def _parents(self, level: int) -> int:
        return len(self.extended[level - 1]) if level else 1

    def _extended(self, level: int, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which of the numbers are extended, their places)."""
        place = self._looked_up("place", level, self._parents(level), number, self._place)
        hit = np.flatnonzero(place >= 0)
        return hit, place[hit]

    def frontier(self, prefixes: list[np.ndarray], levels: int = 1) -> np.ndarray:
        """Prefixes, at the first ``levels`` that are not counted yet, of suffixes whose prefixes so far are all extended."""
        number, at = 0, slice(None)
        for level in range(len(self.extended)):
            hit, number = self._extended(level, self._below(prefixes, level, at, number))
            at = at[hit] if level else hit
        for level in range(len(self.extended), len(self.extended) + levels):
            number = self._below(prefixes, level, at, number)
        return number

    def of(self, words: np.ndarray, count: int) -> np.ndarray:
        """The group of each of the first ``count`` suffixes."""
        return self.grouped(self.prefixes(words, count))

    def grouped(self, prefixes: list[np.ndarray]) -> np.ndarray:
        """The group of each suffix, from the hashes of its prefixes."""
        out = np.zeros(len(prefixes[0]), np.int32)
        parent, at = 0, slice(None)
        for level in range(len(self.first)):
            number = self._below(prefixes, level, at, parent)
            out[at] = self._looked_up("group", level, self._parents(level), number, self._group)
            if level == len(self.extended):
                break
            hit, parent = self._extended(level, number)
            at = at[hit] if level else hit
            if not len(at):
                break
        return out


def _places(known: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(where each number stands among the known ones, whether it is one)."""
    place = np.searchsorted(known, numbers)
    if not len(known):
        return place, np.zeros(len(numbers), bool)
    return place, known[np.minimum(place, len(known) - 1)] == numbers


def group_starts(keys: np.ndarray, groups: int) -> np.ndarray:
    """First prefix of each group: frequent words are split at their longer prefixes, rare words share a group.

    ``keys`` is a sample of prefixes; it decides how even the groups are, and nothing else.
    """
    if groups < 2 or not len(keys):
        return np.zeros(1, np.uint32)
    # Words and extended words in order, with their share of the sample.
    first, share = np.unique(keys >> np.uint32(16), return_counts=True)
    fair = max(1, len(keys) // groups)
    heavy = np.isin(keys >> np.uint32(16), first[share > fair])
    nodes, weight = np.unique(np.where(heavy, keys, keys >> np.uint32(16) << np.uint32(16)), return_counts=True)
    cut = np.flatnonzero(np.diff((np.cumsum(weight) - weight) // fair, prepend=-1))
    starts = nodes[cut].astype(np.uint32)
    starts[0] = 0
    return starts


# What travels of a suffix: doc_id, checksum of the text, word position, hash of the window.
KINDS = (np.int64, np.uint32, np.uint32, np.uint64)


def _planes(column: np.ndarray) -> np.ndarray:
    """High bytes first apart from low ones: they repeat, so the shuffle's compression takes them out."""
    return column.view(np.uint8).reshape(len(column), column.itemsize).T


def _packed(part: np.ndarray, doc: np.ndarray, tag: np.ndarray, at: np.ndarray, *more: np.ndarray) -> Iterator[tuple]:
    """(part, bytes) for rows in the order of their part, of one document after the other.

    Each document once with its number of rows, positions as steps.
    """
    if not len(doc):
        return
    edge, new = np.ones(len(doc), bool), np.ones(len(doc), bool)
    edge[1:] = part[1:] != part[:-1]
    new[1:] = edge[1:] | (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1])
    first, begin = np.flatnonzero(new), np.flatnonzero(edge)
    size = np.diff(np.append(first, len(doc))).astype(np.uint32)
    step = np.diff(at, prepend=np.uint32(0))
    step[first] = at[first]
    runs = np.concatenate([_planes(c) for c in (doc[first], tag[first], size)])
    rows = np.concatenate([_planes(c) for c in (step, *more)])
    ends = np.append(begin[1:], len(doc))
    of_runs = np.searchsorted(first, np.append(begin, len(doc)))
    heads = np.stack([ends - begin, np.diff(of_runs)], axis=1).astype(np.int64)
    edges = zip(begin.tolist(), ends.tolist(), of_runs[:-1].tolist(), of_runs[1:].tolist())
    for name, head, (a, b, c, d) in zip(part[begin].tolist(), heads, edges):
        yield name, b"".join((head.tobytes(), runs[:, c:d].tobytes(), rows[:, a:b].tobytes()))


def _unpacked(packed: list[bytes], columns: int) -> list[np.ndarray]:
    """The rows of all of ``packed``, one after the other."""
    heads, tails = [], []
    bytes_of = [np.dtype(k).itemsize for k in KINDS[2:columns]]
    for data in packed:
        n, runs = np.frombuffer(data, np.int64, 2).tolist()
        heads.append(np.frombuffer(data, np.uint8, 16 * runs, 16).reshape(16, runs))
        tails.append(np.frombuffer(data, np.uint8, sum(bytes_of) * n, 16 + 16 * runs).reshape(-1, n))
    head, tail = (np.concatenate(p, axis=1) if len(p) > 1 else p[0] for p in (heads, tails))

    def column(planes: np.ndarray, kind: type) -> np.ndarray:
        return np.ascontiguousarray(planes.T).view(kind).ravel()

    doc, tag, size = column(head[:8], np.int64), column(head[8:12], np.uint32), column(head[12:], np.uint32)
    step = column(tail[:4], np.uint32)
    first = np.cumsum(size, dtype=np.int64) - size
    total = np.cumsum(step, dtype=np.uint32)
    at_row = total - np.repeat(total[first] - step[first], size)
    more = [column(tail[4 + 8 * i : 12 + 8 * i], kind) for i, kind in enumerate(KINDS[3:columns])]
    return [np.repeat(doc, size), np.repeat(tag, size), at_row, *more]


def _parcels(buckets: int):
    """Text side: a batch's texts as one compressed Arrow stream for each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        for batch in batches:
            bucket = _bucket(array(batch["doc_id"], int(LAST)), buckets)
            for b in np.unique(bucket).tolist():
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, batch.schema, options=options) as writer:
                    writer.write_batch(batch.take(pa.array(np.flatnonzero(bucket == b))))
                yield _rows([(b, 1, sink.getvalue().to_pybytes())])

    return run


def _bucket(doc: np.ndarray, buckets: int) -> np.ndarray:
    return (doc ^ (doc >> 17)) % buckets


def _rows(parts: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*parts), _TABLE)], schema=_TABLE)


def _send(groups: Groups, limit: int):
    """Task side: the suffixes of its texts, one row per group and round."""
    window = groups.window

    def flush(held: list) -> Iterator[pa.RecordBatch]:
        doc, tag, at, key, group = (np.concatenate(c) for c in zip(*held))
        # Copies that meet here: only the first of a window goes on, the others are marked already.
        behind, firsts, alike = copies(doc, tag, at, key, group)
        on = np.ones(len(key), bool)
        on[alike] = False
        on[firsts] = True
        yield from emit(group, (doc, tag, at, key), np.flatnonzero(on), 0)
        yield from emit(group, (doc, tag, at), np.sort(behind), 1)

    def emit(group: np.ndarray, columns: tuple, rows: np.ndarray, rank: int) -> Iterator[pa.RecordBatch]:
        by = rows[_order(group[rows].astype(_U64) << _U64(33))]
        parts = [(g, rank, data) for g, data in _packed(group[by], *(c[by] for c in columns))]
        for i in range(0, len(parts), 64):
            yield _rows(parts[i : i + 64])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n_held = [], 0
        for batch in batches:
            names = array(batch["doc_id"], int(LAST))
            for row, data, offsets, words, count in _chunks(batch):
                own, at = _suffixes(count, window)
                if not len(at):
                    continue
                prefixes = [p[at] for p in groups.prefixes(words, len(words) - window + 1)]
                some = np.flatnonzero(own)
                edges = zip(offsets[some].tolist(), offsets[some + 1].tolist())
                tags = np.fromiter((xxhash.xxh32_intdigest(data[a:b]) for a, b in edges), np.uint32, len(some))
                first = np.cumsum(count) - count
                held.append(
                    (
                        np.repeat(names[row + some], own[some]),
                        np.repeat(tags, own[some]),
                        (at - np.repeat(first, own)).astype(np.uint32),
                        prefixes[-1],
                        groups.grouped(prefixes),
                    )
                )
                n_held += len(at)
                if n_held >= limit:
                    yield from flush(held)
                    held, n_held = [], 0
        if held:
            yield from flush(held)

    return run


def copies(doc, tag, at, key, group) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffixes that share group and hash with another: those that are not the first of their hash, the firsts, and all.

    The same place in a repeated row is no earlier place: its suffixes are neither behind the first nor firsts.
    """
    order = _order(key)
    # The upper bits are compared first; what agrees in them is compared whole.
    low = _U64((1 << max(1, len(key).bit_length())) - 1)
    upper = key[order] & ~low
    near = upper[1:] == upper[:-1]
    same = np.zeros(len(key), bool)
    same[1:] |= near
    same[:-1] |= near
    order = order[same]
    if not len(order):
        return order, order, order
    new = np.ones(len(order), bool)

    def differ() -> np.ndarray:
        return (key[order[1:]] != key[order[:-1]]) | (group[order[1:]] != group[order[:-1]])

    new[1:] = differ()
    if (new[1:] & (upper[same][1:] == upper[same][:-1])).any():
        order = order[np.lexsort((group[order], key[order]))]
        new[1:] = differ()
    run = np.flatnonzero(new)
    size = np.diff(np.append(run, len(order)))
    if (size == 1).any():
        kept = np.repeat(size > 1, size)
        order, size = order[kept], size[size > 1]
        run = np.cumsum(size) - size
    if not len(order):
        return order, order, order
    lead = np.ones(len(order), bool)
    for column in (doc, tag, at):
        own = column[order]
        least = np.where(lead, own, np.iinfo(own.dtype).max)
        lead &= own == np.repeat(np.minimum.reduceat(least, run), size)
    found = np.flatnonzero(lead)
    of_run = np.repeat(np.arange(len(run)), size)[found]
    firsts = found[np.append(True, of_run[1:] != of_run[:-1])]
    return order[~lead], order[firsts], order


def _repeats(buckets: int):
    """Group side: order a group's suffixes by hash and mark every one but the first of equal hashes."""

    def subtree(suffixes: list[bytes]) -> tuple[np.ndarray, ...]:
        doc, tag, at, key = _unpacked(suffixes, 4)
        marked = np.sort(copies(doc, tag, at, key, np.zeros(len(key), np.int8))[0])
        return doc[marked], tag[marked], at[marked]

    def back(held: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        doc, tag, at = (np.concatenate(c) for c in zip(*held))
        bucket = _bucket(doc, buckets)
        # Of a bucket one document after the other, by a hash.
        bits = _U64(buckets.bit_length())
        mixed = (doc.view(_U64) ^ tag.astype(_U64)) * _U64(0x9E3779B97F4A7C15)
        order = _order(bucket.astype(_U64) << (_U64(64) - bits) | mixed >> bits)
        parts = [(b, 0, data) for b, data in _packed(bucket[order], doc[order], tag[order], at[order])]
        for i in range(0, len(parts), 64):
            yield _rows(parts[i : i + 64])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, suffixes, marks, n_marks = None, [], [], 0
        for batch in batches:
            for part, rank, data in zip(*(batch[c].to_pylist() for c in ("part", "rank", "data"))):
                if part != group:
                    if suffixes:
                        marks.append(subtree(suffixes))
                        n_marks += len(marks[-1][0])
                    group, suffixes = part, []
                if rank:
                    marks.append(tuple(_unpacked([data], 3)))
                    n_marks += len(marks[-1][0])
                else:
                    suffixes.append(data)
                if n_marks >= HELD_MARKS:
                    yield from back(marks)
                    marks, n_marks = [], 0
        if suffixes:
            marks.append(subtree(suffixes))
        if marks:
            yield from back(marks)

    return run


RESULT = "doc_id long, n_words long, n_removed long, kept binary, spans array<struct<start:int,length:int>>"
_RESULT_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("n_removed", pa.int64()),
        ("kept", pa.binary()),
        ("spans", pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32())]))),
    ]
)


def _apply(window: int, digest: bool):
    """Text side: a bucket's marks come first, then its texts."""
    schema = DIGEST_ARROW if digest else _RESULT_ARROW

    def table(marks: list[bytes]) -> tuple[np.ndarray, ...]:
        if not marks:
            return np.zeros(0, np.int64), np.zeros(0, np.uint32), np.zeros(0, np.uint32)
        doc, tag, at = _unpacked(marks, 3)
        order = np.argsort(doc, kind="stable")
        return doc[order], tag[order], at[order]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, marks, ready = None, [], None
        for batch in batches:
            for part, rank, data in zip(*(batch[c].to_pylist() for c in ("part", "rank", "data"))):
                if part != bucket:
                    bucket, marks, ready = part, [], None
                if rank == 0:
                    marks.append(data)
                    continue
                if ready is None:
                    ready, marks = table(marks), []
                for texts in pa.ipc.open_stream(data):
                    rows = (one(ready, n, t) for n, t in zip(texts["doc_id"].to_pylist(), texts["text"].to_pylist()))
                    yield from in_batches(rows, schema, 1_000)

    def one(ready: tuple[np.ndarray, ...], name: int | None, text: bytes) -> tuple:
        words = text.split()
        doc, tag, at = ready
        value = LAST if name is None else name
        a, b = np.searchsorted(doc, value, "left"), np.searchsorted(doc, value, "right")
        own = at[a:b][tag[a:b] == xxhash.xxh32_intdigest(text)] if b > a else at[:0]
        if not len(own):
            gone, spans = 0, []
            kept = b" ".join(words)
        else:
            step = np.zeros(len(words) + 1, np.int64)
            np.add.at(step, own, 1)
            np.add.at(step, own.astype(np.int64) + window, -1)
            covered = np.cumsum(step[:-1]) > 0
            gone = int(covered.sum())
            edge = np.flatnonzero(np.diff(np.concatenate([[False], covered, [False]])))
            spans = [{"start": s, "length": e - s} for s, e in edge.reshape(-1, 2).tolist()]
            kept = b" ".join([w for w, c in zip(words, covered.tolist()) if not c])
        if digest:
            return name, len(words), gone, hashlib.sha256(kept).hexdigest()
        return name, len(words), gone, kept, spans

    return run


DIGEST = "doc_id long, n_words long, n_removed long, kept_sha256 string"
DIGEST_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())]
)


def remove_repeats(
    docs: DataFrame,
    window: int = WINDOW,
    group: int = GROUP,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept (text), spans (removed runs of words).

    A word is removed when a window of ``window`` words that covers it also starts earlier: in a smaller doc_id, or
    earlier in the same document. Null texts have no words. Null ids come after all others. Rows that repeat
    an id with another text are documents of their own, in the order of a checksum; a row repeated as a whole
    is not its own copy, both stay. Texts shorter than the window are kept. An empty table gives no rows.
    """
    return _remove(docs, window, group, doc_id, text, RESULT, digest=False)


def repeats_digest(docs: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """As :func:`remove_repeats`, with the SHA-256 of the kept words joined by one space in place of the text."""
    return _remove(docs, window, GROUP, doc_id, text, DIGEST, digest=True)


def _remove(
    docs: DataFrame, window: int, group: int, doc_id: str, text: str, schema: str, digest: bool
) -> DataFrame:
    n = width(docs.sparkSession)
    buckets = 2 * n
    source = doc_rows(docs, doc_id, text)
    sent = source.mapInArrow(_send(find_groups(source, n, window, group), HELD_WORDS), PARTS)
    marks = sent.repartition(n, "part").sortWithinPartitions("part").mapInArrow(_repeats(buckets), PARTS)
    texts = source.mapInArrow(_parcels(buckets), PARTS)
    both = marks.unionByName(texts).repartition(n, "part").sortWithinPartitions("part", "rank")
    return both.mapInArrow(_apply(window, digest), schema)


def find_groups(source: DataFrame, n: int, window: int, group: int) -> Groups:
    """Groups of about ``group`` suffixes or fewer, and at least about ``2 n`` of them.

    Each pass counts, over all documents, the prefixes of one level below those that were too large, and the first one
    those of two levels. The driver gets
    only the prefixes that are too large again; each holds more than half a group, so they are few. What is as long as
    the window needs no limit: of equal windows a task sends one a round.
    """
    groups = Groups(window, [], [], [])
    size, sums, made, counted_levels = 0, None, 0, len(groups.depths()) - 1
    while len(groups.extended) < counted_levels:
        # The first pass counts two levels: the numbers of both make a short table.
        levels = 1 if groups.extended else min(2, counted_levels)
        names = [f"n{i}" for i in range(CELL)]
        cells = source.mapInArrow(_counts(groups, levels), "cell long, " + ", ".join(f"{c} long" for c in names))
        summed = cells.groupBy("cell").agg(*[F.sum(c).alias(c) for c in names])
        single = summed.select("cell", F.posexplode(F.array(*names)).alias("i", "n")).where("n > 0")
        counted = stored(single.select((F.col("cell") * CELL + F.col("i")).alias("prefix"), "n"), "prefixes")
        if not size:
            total = counted.agg(F.sum("n")).first()[0] or 0
            size, sums = max(1, min(group, -(-total // (2 * n)))), np.array([total], np.int64)
        for above in reversed(range(levels)):
            number = F.shiftright("prefix", DIGIT * above).alias("prefix")
            level = counted.groupBy(number).agg(F.sum("n").alias("n")) if above else counted
            rows = level.where(F.col("n") > size // 2).orderBy("prefix").collect()
            large = np.array([r.prefix for r in rows], np.int64)
            inside = np.array([r.n for r in rows], np.int64)
            if above + 1 < levels:
                # Numbered by the parent's place; a parent is no smaller than its prefixes.
                large = _places(groups.extended[-1], large >> DIGIT)[0] << DIGIT | large & ((1 << DIGIT) - 1)
            rest = sums.copy()
            np.subtract.at(rest, large >> DIGIT, inside)
            made = _add(groups, rest, size, made)
            groups.extended.append(large)
            sums = inside
            if not len(large):
                return groups
    if not size:
        # A window of one word: its prefixes are whole windows.
        sums, size = np.array([group * 2 * n], np.int64), group
    _add(groups, sums, size, made)
    return groups


def _add(groups: Groups, sizes: np.ndarray, size: int, made: int) -> int:
    count = np.maximum(1, -(-sizes // size))
    groups.first.append(made + np.cumsum(count) - count)
    groups.count.append(count)
    return made + int(count.sum())


def _counts(groups: Groups, levels: int = 1):
    """How often each prefix of the next levels occurs in a task's texts, ``CELL`` neighbouring prefixes to a row."""
    kind = pa.schema([("cell", pa.int64()), *[(f"n{i}", pa.int64()) for i in range(CELL)]])
    space = (len(groups.extended[-1]) if groups.extended else 1) << DIGIT * levels

    def rows(known: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
        cell, back = np.unique(known[0] // CELL, return_inverse=True)
        table = np.zeros((CELL, len(cell)), np.int64)
        table[known[0] % CELL, back] = known[1]
        return pa.record_batch([pa.array(c) for c in (cell, *table)], schema=kind)

    def folded(held: list[np.ndarray], known: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        found, n = np.unique(np.concatenate(held), return_counts=True)
        prefix, back = np.unique(np.concatenate([known[0], found]), return_inverse=True)
        total = np.zeros(len(prefix), np.int64)
        np.add.at(total, back, np.concatenate([known[1], n]))
        return prefix, total

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in batches:
            for *_, words, count in _chunks(batch):
                _, at = _suffixes(count, groups.window)
                if len(at):
                    yield groups.frontier([p[at] for p in groups.prefixes(words, len(words) - groups.window + 1)], levels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if space <= DENSE:
            total = np.zeros(space, np.int64)
            for numbers in found(batches):
                total += np.bincount(numbers, minlength=space)
            some = np.flatnonzero(total)
            if len(some):
                yield rows((some, total[some]))
            return
        nothing = np.zeros(0, np.int64), np.zeros(0, np.int64)
        held, n_held, known = [], 0, nothing
        for numbers in found(batches):
            held.append(numbers)
            n_held += len(numbers)
            if n_held >= HELD_WORDS:
                known, held, n_held = folded(held, known), [], 0
                if len(known[0]) >= HELD_COUNTS:
                    yield rows(known)
                    known = nothing
        if held:
            known = folded(held, known)
        if len(known[0]):
            yield rows(known)

    return run
