"""Exact deduplication through an extendible-hash index kept in shared files.

Every text is normalised (each run of white space becomes one space) and hashed. Equal texts that meet in one
record batch are folded first, so a group of copies that holds a third of the table enters as a few entries. The
directory starts with one bucket and doubles while a bucket holds more than its capacity; a bucket owns a range of
hash values. Owner tasks read their ranges in hash order, chain texts that collide, and compare bytes: two texts
are one class only when their bytes are equal.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from lendscope.llm.common import doc_rows, in_batches, stored, width
from lendscope.session import scratch_path

CAPACITY = 50_000  # entries of a bucket before it splits
STEP = 12  # hash bits that the first counting pass resolves
DEEPER = 4  # hash bits that each further pass resolves below a bucket that is too full

ENTRY = "entry long, hash long, text binary, doc_ids array<long>"
_ENTRY_ARROW = pa.schema(
    [("entry", pa.int64()), ("hash", pa.int64()), ("text", pa.binary()), ("doc_ids", pa.list_(pa.int64()))]
)
CLASSED = "entry long, hash long, chain int, text_sha256 string, doc_ids array<long>, bucket int"
_CLASSED_ARROW = pa.schema(
    [
        ("entry", pa.int64()),
        ("hash", pa.int64()),
        ("chain", pa.int32()),
        ("text_sha256", pa.string()),
        ("doc_ids", pa.list_(pa.int64())),
        ("bucket", pa.int32()),
    ]
)
_SPACE = b" \t\n\v\f\r"


def normalised(text: bytes) -> bytes:
    """Each run of space, tab, newline, vertical tab, form feed or return as one space."""
    words = text.split()
    if not words:
        return b" " if text else b""
    out = b" ".join(words)
    if text[0] in _SPACE:
        out = b" " + out
    return out + b" " if text[-1] in _SPACE else out


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One entry for each distinct text of a batch."""
    number = TaskContext.get().partitionId() << 33
    for batch in batches:
        groups: dict[bytes, list] = {}
        for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
            groups.setdefault(normalised(text), []).append(doc_id)
        texts = list(groups)
        hashes = np.fromiter((xxhash.xxh64_intdigest(t) for t in texts), np.uint64, len(texts)).view(np.int64)
        for at in range(0, len(texts), 2_000):
            part = texts[at : at + 2_000]
            yield pa.record_batch(
                [
                    pa.array(np.arange(number + at, number + at + len(part), dtype=np.int64)),
                    pa.array(hashes[at : at + 2_000]),
                    pa.array(part, pa.binary()),
                    pa.array([groups[t] for t in part], pa.list_(pa.int64())),
                ],
                schema=_ENTRY_ARROW,
            )
        number += len(texts)


def directory(entries: DataFrame, capacity: int = CAPACITY) -> list[int]:
    """First hash value (unsigned) of each bucket, ascending.

    A bucket is a hash prefix and its depth. The first counting pass sees ``STEP`` bits, the others ``DEEPER``
    more bits at a time, and only below buckets that are still too full; the driver holds counts of those prefixes, at
    most 2 ** DEEPER for each bucket that is too full. A bucket whose entries share one hash
    cannot split and stays as a chain.
    """
    key = F.col("hash")
    starts, full = [], [(0, 0)]
    depth = 0
    while full and depth < 60:
        step = DEEPER if depth else STEP
        deeper = depth + step
        prefix = F.shiftrightunsigned(key, 64 - deeper)
        rows = entries.select(prefix.alias("p"), "hash")
        if depth:
            parents = entries.sparkSession.createDataFrame([(p,) for p, _ in full], "parent long")
            rows = rows.withColumn("parent", F.shiftright("p", step)).join(parents, "parent")
        counted = rows.groupBy("p").agg(F.count("*").alias("n"), (F.min("hash") == F.max("hash")).alias("same"))
        counts = {r.p: (r.n, r.same) for r in counted.collect()}
        ready = full
        full = []
        for parent, _ in ready:
            # Directory doubling below this bucket: halves until each half fits or the counted bits are used up.
            stack = [(parent << step, deeper, step)]
            while stack:
                first, at, left = stack.pop()
                inside = [counts[p] for p in range(first, first + (1 << left)) if p in counts]
                n = sum(c for c, _ in inside)
                if n <= capacity or (left == 0 and inside and inside[0][1]):
                    starts.append(first << (64 - at))
                elif left == 0:
                    full.append((first, at))
                else:
                    half = 1 << (left - 1)
                    stack += [(first + half, at, left - 1), (first, at, left - 1)]
        depth = deeper
    starts += [first << (64 - at) for first, at in full]
    return sorted(starts)


def _owner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries in hash order: chain the distinct texts of one hash, compare bytes."""

    def rows() -> Iterator[tuple]:
        last, chain = None, []
        for batch in batches:
            columns = [batch[c].to_pylist() for c in ("entry", "hash", "text", "doc_ids", "bucket")]
            for entry, key, text, doc_ids, bucket in zip(*columns):
                if key != last:
                    last, chain = key, []
                at = next((i for i, (known, _) in enumerate(chain) if known == text), -1)
                if at < 0:
                    at = len(chain)
                    chain.append((text, hashlib.sha256(text).hexdigest()))
                yield entry, key, at, chain[at][1], doc_ids, bucket

    return in_batches(rows(), _CLASSED_ARROW, 2_000)


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> str:
    """Write the index of ``docs`` and return its path: one row per folded entry, with bucket, hash and chain link."""
    spark = docs.sparkSession
    entries = stored(doc_rows(docs, doc_id, text).mapInArrow(_fold, ENTRY), "entries")
    starts = spark.sparkContext.broadcast(np.array(directory(entries, capacity), dtype=np.uint64))

    @pandas_udf("int")
    def owner(key):
        import pandas as pd

        return pd.Series(np.searchsorted(starts.value, key.to_numpy().view(np.uint64), side="right") - 1)

    path = scratch_path(spark, "hash-index")
    (
        entries.withColumn("bucket", owner("hash"))
        .repartition(width(spark), "bucket")
        .sortWithinPartitions("bucket", "hash")
        .mapInArrow(_owner, CLASSED)
        .write.parquet(path)
    )
    return path


def exact_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Null texts count as empty; empty texts equal each other. Of equal texts the smallest doc_id stays; null ids come
    last, so a group of null ids only has a null keep_id. When the smallest id occurs more than once in a group, one
    of these rows is ``kept``. An empty table gives no rows. Other columns are not read.
    """
    index = docs.sparkSession.read.parquet(build_index(docs, doc_id, text, capacity))
    # Entry level first: each entry is a bounded list of ids, so a class of any size is a map-side sum.
    smallest = F.array_min("doc_ids")
    classes = index.groupBy("hash", "chain").agg(
        F.min(F.struct(smallest.isNull(), smallest.alias("doc_id"), "entry")).alias("first"),
        F.sum(F.size("doc_ids")).cast("long").alias("group_size"),
    )
    keep = F.col("first.doc_id")
    at = F.when(keep.isNull(), F.lit(1)).otherwise(F.array_position("doc_ids", keep))
    rows = index.join(classes, ["hash", "chain"]).select(
        keep.alias("keep_id"),
        "group_size",
        "text_sha256",
        F.when(F.col("first.entry") == F.col("entry"), at).otherwise(F.lit(0)).alias("at"),
        F.posexplode("doc_ids").alias("pos", "doc_id"),
    )
    return rows.select(
        "doc_id", "keep_id", "group_size", (F.col("pos") + 1 == F.col("at")).alias("kept"), "text_sha256"
    )
