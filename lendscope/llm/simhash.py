"""SimHash near-duplicates, compared bit-sliced.

A fingerprint has 64 bits, each the majority of that bit over the hashes of a text's word shingles. Distinct
fingerprints are cut into blocks; two within the radius agree on at least one choice of ``blocks - radius`` blocks,
so rows meet in a bucket for each choice. In a bucket the fingerprints are stored vertically, 64 to a machine word and
one word for each bit. Distances to 64 fingerprints at once are counted by carry-save adders over these planes; a word
is abandoned as soon as all its counters have passed the radius. Buckets above a set size are dealt out as pairs of
chunks, so no task holds a large bucket and no link is lost. Only a spanning forest of the links of a task
leaves it.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendscope.llm.common import doc_rows, stored, width
from lendscope.llm.components import components, salted_join

BITS = 64
CHUNK = 8_192  # fingerprints of one bucket that one comparison holds
PAIRS = 1 << 15  # (fingerprint, word) pairs that are counted together
HOT_ROWS = 1_000  # rows of one fingerprint that always stay together
HOT_SALTS = 64
_CUT = 1 << 16  # shingle hashes whose bits are counted together


def fingerprint(text: bytes, shingle: int = 4) -> int:
    """Majority bits of XXH64 (seed 42) over the word shingles of an ASCII-lowered text."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    start = (end - size).tolist()
    n = max(1, len(words) - shingle + 1)
    end = end[-n:].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], 42) for a, b in zip(start, end)), np.uint64, n)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, _CUT):
        bits = np.unpackbits(hashes[at : at + _CUT].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4) -> DataFrame:
    """(doc_id, row, fp) for each row; row is a hash of the text, fp a signed long."""
    schema = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t, shingle) for t in batch["text"].to_pylist()]
            fp = pa.array(np.array(found, np.uint64).view(np.int64))
            yield pa.record_batch([batch["doc_id"], batch["row"], fp], schema=schema)

    rows = doc_rows(docs, doc_id, text).withColumn("row", F.xxhash64("text"))
    return rows.mapInArrow(run, "doc_id long, row long, fp long")


def block_masks(blocks: int, radius: int) -> list[int]:
    """For each choice of blocks - radius blocks, the bits in them."""
    if blocks <= radius:
        raise ValueError("blocks must exceed the radius")
    edges = [round(i * BITS / blocks) for i in range(blocks + 1)]
    parts = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    return [sum(c) for c in combinations(parts, blocks - radius)]


class Planes:
    """Fingerprints stored vertically: word w of plane j has bit j of fingerprints 64 w to 64 w + 63."""

    def __init__(self, fps: np.ndarray):
        self.n = len(fps)
        self.words = (self.n + 63) // 64
        padded = np.zeros(self.words * 64, np.uint64)
        padded[: self.n] = fps
        bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        packed = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little")
        self.planes = packed.view(np.uint64).reshape(BITS, self.words)
        self.live = np.full(self.words, ~np.uint64(0))
        if self.n % 64:
            self.live[-1] = np.uint64((1 << (self.n % 64)) - 1)


def near(queries: np.ndarray, words: np.ndarray, planes: Planes, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (into ``queries``, fingerprint) within the radius; ``words[i]`` is compared with ``queries[i]``."""
    counters = max(1, radius.bit_length())
    for at in range(0, len(queries), PAIRS):
        alive = np.arange(at, min(at + PAIRS, len(queries)))
        q, w = queries[alive], words[alive]
        # over: lanes past the radius; sums: the lanes' counters, one word for each binary digit.
        over = ~planes.live[w]
        sums = [np.zeros(len(q), np.uint64) for _ in range(counters)]
        for j in range(BITS):
            carry = planes.planes[j][w] ^ (np.uint64(0) - ((q >> np.uint64(j)) & np.uint64(1)))
            for k in range(counters):
                sums[k], carry = sums[k] ^ carry, sums[k] & carry
            over |= carry
            if j >= radius and (j & 3 == 3 or j == BITS - 1):
                past = over | _above(sums, radius)
                keep = past != ~np.uint64(0)
                if not keep.all():
                    alive, q, w, over = alive[keep], q[keep], w[keep], over[keep]
                    sums = [s[keep] for s in sums]
                    if not len(q):
                        break
        if not len(q):
            continue
        hit = ~(over | _above(sums, radius))
        lanes = np.unpackbits(hit.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        row, lane = np.nonzero(lanes)
        yield alive[row], w[row] * 64 + lane


def _above(sums: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose binary counter exceeds the radius."""
    above = np.zeros_like(sums[0])
    equal = ~above
    for k in reversed(range(len(sums))):
        if radius >> k & 1:
            equal &= sums[k]
        else:
            above |= equal & sums[k]
            equal &= ~sums[k]
    return above


class Forest:
    """Union-find over positions; keeps the links that joined two trees, at most one less than positions."""

    def __init__(self, n: int):
        self.root = np.arange(n)
        self.links: list[tuple[int, int]] = []

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        """Take in the links a[i] - b[i]; those inside a tree fall away at once."""
        x, y = self.root[a], self.root[b]
        new = np.flatnonzero(x != y)
        if not len(new):
            return
        _, first = np.unique(np.minimum(x[new], y[new]) * len(self.root) + np.maximum(x[new], y[new]), return_index=True)
        parent: dict[int, int] = {}

        def top(v: int) -> int:
            while v in parent:
                v = parent[v]
            return v

        for i in new[first].tolist():
            u, v = top(int(x[i])), top(int(y[i]))
            if u != v:
                parent[max(u, v)] = min(u, v)
                self.links.append((int(a[i]), int(b[i])))
        moved = np.arange(len(self.root))
        for v in parent:
            moved[v] = top(v)
        self.root = moved[self.root]


def link_buckets(sizes: np.ndarray, fps: np.ndarray, left: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links within buckets that lie one after the other in ``fps``.

    ``left`` marks the members that are compared with all others of their bucket: all of them, or the first chunk
    of a pair of chunks.
    """
    first_word = np.zeros(len(sizes), np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    total = 0
    for b in range(len(sizes)):
        first_word[b] = total
        total += (int(sizes[b]) + 63) // 64
    lane_of = np.zeros(total * 64, np.int64) - 1
    bucket = np.repeat(np.arange(len(sizes)), sizes)
    lane_of[first_word[bucket] * 64 + np.arange(len(fps)) - starts[bucket]] = np.arange(len(fps))
    filled = np.where(lane_of >= 0, lane_of, 0)
    planes = Planes(fps[filled])
    used = np.packbits(lane_of >= 0, bitorder="little").view(np.uint64)
    planes.live = used
    forest = Forest(len(fps))
    members = np.flatnonzero(left)
    n_words = (sizes + 63) // 64
    # Each member against the words of its bucket, a bounded number of (member, word) pairs at a time.
    per = n_words[bucket[members]]
    cuts = np.searchsorted(np.cumsum(per), np.arange(PAIRS, int(per.sum()) + PAIRS, PAIRS), side="left") + 1
    begin = 0
    for stop in np.unique(np.minimum(cuts, len(members))):
        part, count = members[begin:stop], per[begin:stop]
        begin = stop
        if not len(part):
            continue
        who = np.repeat(part, count)
        step = np.arange(len(who)) - np.repeat(np.cumsum(count) - count, count)
        words = first_word[bucket[who]] + step
        for row, lane in near(fps[who], words, planes, radius):
            a, b = who[row], lane_of[lane]
            forest.add(a, b)
    return forest.links


def _compare(radius: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def flush(cells: list, fps: list, side: list) -> pa.RecordBatch:
        key, fp, left = (np.concatenate(x) for x in (cells, fps, side))
        change = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        sizes = np.diff(np.append(change, len(key)))
        fp = fp.view(np.uint64)
        links = link_buckets(sizes, fp, left, radius)
        ends = np.array(links, np.int64).reshape(-1, 2)
        signed = fp.view(np.int64)
        return pa.record_batch([pa.array(signed[ends[:, 0]]), pa.array(signed[ends[:, 1]])], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, fps, side, held = [], [], [], 0
        for batch in batches:
            key = batch["cell"].to_numpy()
            fp, left = batch["fp"].to_numpy(), batch["side"].to_numpy(zero_copy_only=False)
            if held >= 8 * CHUNK:
                # Close the buckets that are whole; the last one may go on.
                last = cells[-1][-1]
                split = int(np.searchsorted(key != last, True)) if key[-1] != last else len(key)
                if split < len(key):
                    yield flush([*cells, key[:split]], [*fps, fp[:split]], [*side, left[:split]])
                    key, fp, left = key[split:], fp[split:], left[split:]
                    cells, fps, side, held = [], [], [], 0
            cells.append(key)
            fps.append(fp)
            side.append(left)
            held += len(key)
        if held:
            yield flush(cells, fps, side)

    return run


def links(distinct: DataFrame, radius: int = 4, blocks: int = 5, chunk: int = CHUNK) -> DataFrame:
    """A spanning set of the links (a, b) between distinct fingerprints (column fp) at ``radius`` bits or fewer."""
    n = width(distinct.sparkSession)
    masks = block_masks(blocks, radius)
    keyed = distinct.select(
        "fp",
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(m - (m >> 63 << 64))).alias("part"))
                    for i, m in enumerate(masks)
                ]
            )
        ).alias("k"),
    ).select("fp", F.xxhash64("k.choice", "k.part").alias("bucket"))
    large = keyed.groupBy("bucket").count().where(F.col("count") > chunk)
    chunks = F.coalesce(F.ceil(F.col("count") / chunk), F.lit(1)).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    # A bucket of c chunks becomes cells (i, j), i <= j; a row enters the cells of its chunk.
    dealt = (
        keyed.join(large, "bucket", "left")
        .withColumn("chunks", chunks)
        .withColumn("own", own)
        .select("fp", "bucket", "own", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
        .select(
            "fp",
            F.xxhash64("bucket", F.least("own", "other"), F.greatest("own", "other")).alias("cell"),
            (F.col("own") <= F.col("other")).alias("side"),
        )
    )
    return (
        dealt.repartition(n, "cell")
        .sortWithinPartitions("cell", "fp")
        .mapInArrow(_compare(radius), "a long, b long")
    )


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = 4,
    radius: int = 4,
    blocks: int = 5,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id.

    Fingerprints at ``radius`` or fewer differing bits are linked; component_id is the smallest doc_id reachable. Null
    and blank texts have fingerprint zero and are linked like any other. Null ids never win; a component of null ids
    only has a null component_id. Repeated rows appear as often as they occur; an empty table gives no rows.
    """
    return grouped_rows(docs, doc_id, text, shingle, radius, blocks).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def grouped_rows(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4, radius: int = 4, blocks: int = 5
) -> DataFrame:
    """As :func:`near_duplicates`, with the fingerprint as a number (fp), a hash of the row's text (row) and a number
    of the component (root) that is never null."""
    found = stored(fingerprints(docs, doc_id, text, shingle), "fingerprints")
    classes = found.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("rows"))
    # A fingerprint above a thousandth of the rows is hot; there are fewer than a thousand, and they are salted.
    total = found.count()
    hot = [r.fp for r in classes.where(F.col("rows") > max(HOT_ROWS, total // 1_000)).select("fp").collect()]
    joined = components(links(classes.select("fp"), radius, blocks))
    # Only fingerprints with a neighbour need their component's smallest id; a large component is dealt out by salt.
    members = classes.join(joined.withColumnRenamed("node", "fp"), "fp")
    groups = members.groupBy("root").agg(F.min("least").alias("group_least"))
    grouped = salted_join(members, groups, "root", "fp").select("fp", "root", "group_least")
    named = classes.join(grouped, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), F.coalesce("group_least", "least").alias("component_id")
    )
    is_hot, salts = F.col("fp").isin(hot), F.sequence(F.lit(0), F.lit(HOT_SALTS - 1))
    own = F.pmod(F.xxhash64("doc_id"), F.lit(HOT_SALTS)).cast("int")
    rows = found.withColumn("salt", F.when(is_hot, own).otherwise(F.lit(0)))
    copies = named.withColumn("salt", F.explode(F.when(is_hot, salts).otherwise(F.array(F.lit(0)))))
    return rows.join(copies, ["fp", "salt"]).select("doc_id", "row", "fp", "root", "component_id")
