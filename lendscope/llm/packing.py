"""Packing token ids into training sequences, best fit decreasing.

Each task packs the documents of its own partition, so token ids are never shuffled: it encodes them, cuts overlong
ones into full windows, and places what is left, longest first, into the open window with the least room
that still fits. A segment tree over remaining capacities finds that window. A task closes its windows after a set
number of tokens, which bounds its memory; padding is then about half a window for each such round.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendscope.llm.common import doc_rows
from lendscope.llm.tokens import encoder

LENGTH = 4096
END = 2
ROUND_TOKENS = 1 << 24  # tokens that a task holds before it closes its windows

PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
_PIECES_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids", pa.binary()),
        ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
    ]
)


class RoomTree:
    """Open windows by remaining capacity: the leaf of a capacity counts its windows, a node sums its leaves."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.windows: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _add(self, room: int, by: int) -> None:
        node = room + self.leaves
        while node:
            self.count[node] += by
            node >>= 1

    def put(self, room: int, window: int) -> None:
        self.windows[room].append(window)
        self._add(room, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """(room, window) of the tightest window with room for ``need``, removed; None if there is none."""
        count, node = self.count, need + self.leaves
        if not count[node]:
            # Up to the first ancestor with a filled right sibling, then down its left side.
            while node > 1 and (node & 1 or not count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if count[2 * node] else 2 * node + 1
        room = node - self.leaves
        self._add(room, -1)
        return room, self.windows[room].pop()


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(window, offset) of each piece and the number of windows; longest first, ties in the given order."""
    window, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    tree, opened = RoomTree(capacity), 0
    sizes = lengths.tolist()
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = sizes[i]
        found = tree.take(need)
        if found is None:
            room, w = capacity, opened
            opened += 1
        else:
            room, w = found
        window[i], offset[i] = w, capacity - room
        if room > need:
            tree.put(room - need, w)
    return window, offset, opened


def pack(
    docs: DataFrame,
    vocabulary: str,
    length: int = LENGTH,
    end: int = END,
    round_tokens: int = ROUND_TOKENS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids, doc_tokens, sequence_id, offset.

    ``ids`` are the piece's token ids as little-endian unsigned 32-bit integers. A document is its text's ids and
    then ``end``; a null or empty text is ``end`` alone. Pieces of a document are full windows from its start
    and one rest. Sequences hold at most ``length`` tokens, pieces lie in them without gaps from 0. Null ids and
    repeated rows are packed like any other row. sequence_id is unique and the same again when a task is
    repeated. An empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, close = encoder(vocabulary), np.array([end], "<u4").tobytes()
        sequence = TaskContext.get().partitionId() << 33
        held: list[tuple[int | None, int, bytes, int]] = []
        tokens = 0

        def placed() -> Iterator[pa.RecordBatch]:
            nonlocal sequence, held, tokens
            sizes = np.array([len(p[2]) // 4 for p in held], np.int64)
            window, offset, opened = best_fit(sizes, length)
            yield from batch_of(held, sizes, sequence + window, offset)
            sequence, held, tokens = sequence + opened, [], 0

        def batch_of(pieces, sizes, sequences, offsets, limit=8_000) -> Iterator[pa.RecordBatch]:
            for at in range(0, len(pieces), limit):
                some = pieces[at : at + limit]
                ids, starts, parts, totals = zip(*some)
                columns = [ids, starts, sizes[at : at + limit], parts, totals]
                columns += [sequences[at : at + limit], offsets[at : at + limit]]
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, _PIECES_ARROW)], _PIECES_ARROW)

        for batch in batches:
            names = batch["doc_id"].to_pylist()
            texts = batch["text"].to_pylist()
            for at in range(0, len(names), 256):
                full = []
                for name, ids in zip(names[at : at + 256], coder.encode(texts[at : at + 256])):
                    ids += close
                    total = len(ids) // 4
                    whole = total - total % length
                    for start in range(0, whole, length):
                        full.append((name, start, ids[4 * start : 4 * (start + length)], total))
                    if total > whole:
                        held.append((name, whole, ids[4 * whole :], total))
                        tokens += total - whole
                if full:
                    n = len(full)
                    yield from batch_of(full, np.full(n, length), np.arange(sequence, sequence + n), np.zeros(n, np.int64))
                    sequence += n
                if tokens >= round_tokens:
                    yield from placed()
        if held:
            yield from placed()

    return doc_rows(docs, doc_id, text).mapInArrow(run, PIECES)


def sequences(pieces: DataFrame, length: int = LENGTH, pad: int = 0) -> DataFrame:
    """(sequence_id, ids, n_tokens): the pieces of each sequence one after the other, padded to ``length``."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    filled = pieces.groupBy("sequence_id").agg(ordered.alias("p"), F.sum("length").alias("n_tokens"))
    blank = F.lit(np.array([pad], "<u4").tobytes())
    joined = F.concat(
        F.aggregate("p", F.lit(b""), lambda acc, x: F.concat(acc, x["ids"])),
        F.aggregate(
            F.when(F.col("n_tokens") < length, F.sequence(F.lit(1), (length - F.col("n_tokens")).cast("int"))).otherwise(
                F.array().cast("array<int>")
            ),
            F.lit(b""),
            lambda acc, _: F.concat(acc, blank),
        ),
    )
    return filled.select("sequence_id", joined.alias("ids"), "n_tokens")
