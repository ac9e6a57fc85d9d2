"""Small helpers the operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendscope.session import scratch_path


def width(spark: SparkSession) -> int:
    """How many partitions a shuffle makes; named explicitly where a Python stage follows, so that AQE keeps them."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below the shared folder and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def text_bytes(text: str) -> Column:
    """A text column as UTF-8 bytes; null counts as empty."""
    return F.coalesce(F.col(text).cast("string").cast("binary"), F.lit(b""))


def doc_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Only ``doc_id`` (long) and ``text`` (bytes, null as empty), whatever else the table carries."""
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_bytes(text).alias("text"))


def array(column: pa.Array | pa.ChunkedArray, null: int = 0) -> np.ndarray:
    """An integer or float Arrow column as numpy, nulls replaced."""
    if column.null_count:
        column = column.fill_null(null)
    return column.to_numpy(zero_copy_only=False)


def list_binary(parts: list[bytes]) -> pa.Array:
    return pa.array(parts, pa.binary())


def in_batches(rows: Iterator[tuple], schema: pa.Schema, limit: int = 5_000) -> Iterator[pa.RecordBatch]:
    """Tuples as record batches of bounded length."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= limit:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows)
    return pa.record_batch([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)


def bucket_of(*columns: str, n: int) -> Column:
    """A bucket from 0 to n - 1 by hash."""
    return F.pmod(F.xxhash64(*[F.col(c) for c in columns]), F.lit(n)).cast("int")


def remainder(doc_id: str, n: int) -> Column:
    """crc32 of the id as text, modulo n; null for a null id."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(n))
