"""Token ids as Arrow files of equal-length sequences.

Documents are dealt to shards by ranges of doc_id, so shards follow each other in ascending order. Every task writes
its range as two Arrow stream files: sequences (fixed-size lists of ids and of masks, one record batch per
set number of rows) and documents (where each one starts in the shard's stream of ids). Fixed-size lists lie
in one buffer per batch, so row r of batch b is found by arithmetic and read without copying; a small list of batch
positions makes any row reachable. A file is written under another name first and moved when it is whole, so a
repeated task leaves one file.
"""

from __future__ import annotations

import uuid
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendscope.llm.common import doc_rows, in_batches, width
from lendscope.llm.tokens import encoder
from lendscope.session import scratch_path

SEQUENCE = 2048
ROWS = 512  # sequences of one record batch
END = 2

SHARD = "shard int, n_docs long, n_tokens long"
READ = "doc_id long, start long, n_tokens long, ids binary"
_READ_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())]
)
_DOCS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


def open_path(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path, as Spark names it."""
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    scheme, _, rest = path.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    if scheme in ("s3a", "s3n"):
        path = "s3:" + rest
    return fs.FileSystem.from_uri(path)


class ShardWriter:
    """Appends documents' ids to the two files of one shard."""

    def __init__(self, folder: str, shard: int, length: int, kind: np.dtype, rows: int):
        self.files, root = open_path(folder)
        self.files.create_dir(root, recursive=True)
        self.final = [f"{root}/{shard:06d}.{n}.arrow" for n in ("sequences", "documents")]
        self.parts = [f"{p}.{uuid.uuid4().hex}" for p in self.final]
        self.length, self.rows, self.kind = length, rows, kind
        ids = pa.list_(pa.from_numpy_dtype(kind), length)
        self.schema = pa.schema([("ids", ids), ("mask", pa.list_(pa.bool_(), length))])
        self.sinks = [self.files.open_output_stream(p) for p in self.parts]
        self.sequences = pa.ipc.new_stream(self.sinks[0], self.schema)
        self.documents = pa.ipc.new_stream(self.sinks[1], _DOCS)
        self.held: list[np.ndarray] = []
        self.n_held = self.n_docs = self.n_tokens = 0

    def add(self, names: list, ids: list[bytes]) -> None:
        sizes = np.array([len(i) // 4 for i in ids], np.int64)
        starts = self.n_tokens + np.cumsum(sizes) - sizes
        self.documents.write_batch(pa.record_batch([pa.array(names, pa.int64()), starts, sizes], schema=_DOCS))
        self.held.append(np.frombuffer(b"".join(ids), "<u4").astype(self.kind))
        self.n_docs, self.n_tokens, self.n_held = self.n_docs + len(ids), self.n_tokens + sizes.sum(), self.n_held + sizes.sum()
        block = self.length * self.rows
        if self.n_held >= block:
            stream = np.concatenate(self.held)
            whole = len(stream) // block * block
            for at in range(0, whole, block):
                self._batch(stream[at : at + block], block)
            self.held, self.n_held = [stream[whole:]], len(stream) - whole

    def _batch(self, ids: np.ndarray, real: int) -> None:
        mask = np.zeros(len(ids), bool)
        mask[:real] = True
        columns = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (ids, mask)]
        self.sequences.write_batch(pa.record_batch(columns, schema=self.schema))

    def close(self) -> tuple[int, int]:
        rest = np.concatenate(self.held) if self.held else np.zeros(0, self.kind)
        if len(rest):
            padded = np.zeros(-len(rest) % self.length + len(rest), self.kind)
            padded[: len(rest)] = rest
            self._batch(padded, len(rest))
        for writer, sink in zip((self.sequences, self.documents), self.sinks):
            writer.close()
            sink.close()
        for part, final in zip(self.parts, self.final):
            self.files.move(part, final)
        return self.n_docs, int(self.n_tokens)


class ShardReader:
    """Random access to one shard's sequences and documents."""

    def __init__(self, folder: str, shard: int):
        files, root = open_path(folder)
        paths = [f"{root}/{shard:06d}.{n}.arrow" for n in ("sequences", "documents")]
        if isinstance(files, fs.LocalFileSystem):
            sources = [pa.memory_map(p) for p in paths]
        else:
            sources = [files.open_input_file(p) for p in paths]
        # Batches of a mapped file are views of it; a file elsewhere is read as its batches are touched.
        self.batches = [b for b in pa.ipc.open_stream(sources[0])]
        self.documents = pa.ipc.open_stream(sources[1])
        self.first = np.cumsum([0, *(len(b) for b in self.batches)]).tolist()
        self.length = self.batches[0].schema.field("ids").type.list_size if self.batches else 1

    def sequence(self, row: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, mask) of a row; ids without copying."""
        b = bisect_right(self.first, row) - 1
        at = (row - self.first[b]) * self.length
        ids, mask = (self.batches[b][c].flatten().slice(at, self.length) for c in ("ids", "mask"))
        return ids.to_numpy(), mask.to_numpy(zero_copy_only=False)

    def tokens(self, start: int, n: int) -> np.ndarray:
        """``n`` ids of the shard's stream from ``start``; a copy only where they cross batches."""
        parts = []
        while n > 0:
            b = bisect_right(self.first, start // self.length) - 1
            flat = self.batches[b]["ids"].flatten()
            at = start - self.first[b] * self.length
            part = flat.slice(at, min(n, len(flat) - at)).to_numpy()
            parts.append(part)
            start, n = start + len(part), n - len(part)
        return parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.zeros(0, np.uint32)


def write_shards(
    docs: DataFrame,
    folder: str,
    vocabulary: str,
    length: int = SEQUENCE,
    end: int = END,
    rows: int = ROWS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> list[tuple[int, int, int]]:
    """Write ``docs`` below ``folder``; (shard, documents, tokens) of each shard in order.

    Documents are in ascending doc_id order, null ids first, rows with one id by text; a document is its text's ids
    and ``end``, null and empty texts ``end`` alone. The driver gets three numbers for each shard. An empty table
    writes no shard.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, close = encoder(vocabulary), np.array([end], "<u4").tobytes()
        kind = np.dtype(np.uint16 if coder.largest < 1 << 16 else np.uint32)
        shard, writer = TaskContext.get().partitionId(), None
        for batch in batches:
            names, texts = batch["doc_id"].to_pylist(), batch["text"].to_pylist()
            for at in range(0, len(names), 256):
                writer = writer or ShardWriter(folder, shard, length, kind, rows)
                writer.add(names[at : at + 256], [ids + close for ids in coder.encode(texts[at : at + 256])])
        if writer:
            yield pa.record_batch([[shard], *([x] for x in writer.close())], schema=kinds)

    kinds = pa.schema([("shard", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())])
    source = doc_rows(docs, doc_id, text)
    # The text's hash only splits a doc_id that many rows share.
    dealt = source.repartitionByRange(width(docs.sparkSession), "doc_id", F.xxhash64("text"))
    ordered = dealt.sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    return sorted(tuple(r) for r in ordered.mapInArrow(run, SHARD).collect())


def read_shards(spark: SparkSession, folder: str, shards: list[tuple[int, int, int]]) -> DataFrame:
    """One row per document: doc_id, start (ids of all documents before it), n_tokens, ids (unsigned 32-bit)."""
    if not shards:
        return spark.createDataFrame([], READ)
    before = np.cumsum([0, *(s[2] for s in shards)]).tolist()
    numbers = [s[0] for s in shards]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for i in batch["id"].to_pylist():
                    reader = ShardReader(folder, numbers[i])
                    for docs in reader.documents:
                        for name, start, n in zip(*(docs[c].to_pylist() for c in docs.schema.names)):
                            ids = reader.tokens(start, n).astype("<u4").tobytes()
                            yield name, before[i] + start, n, ids

        return in_batches(rows(), _READ_ARROW, 2_000)

    return spark.range(0, len(shards), 1, len(shards)).mapInArrow(run, READ)


def token_shards(docs: DataFrame, vocabulary: str, folder: str | None = None, **options) -> DataFrame:
    """Write the shards and read every document back from them."""
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "token-shards")
    return read_shards(spark, folder, write_shards(docs, folder, vocabulary, **options))


