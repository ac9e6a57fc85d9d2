"""The payment feed as a stream of landed files."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lendscope.sources.files import latest_partition, path_exists

_BATCH, _MONTH = "_batch", "_event_month"


def read_landed(spark: SparkSession, landing: str, schema: T.StructType, files_per_batch: int | None = None) -> DataFrame:
    """Landed Parquet files as a stream; every file is seen once."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(landing)


def _batch_name(spark: SparkSession, checkpoint: str, batch_id: int) -> str:
    """The stream's own id, which its checkpoint keeps, and the batch number.

    Two streams never share a name, and a stream whose checkpoint was reset is another stream.
    """
    stream = json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]
    return f"{stream}-{batch_id}"


def _swap(rows: DataFrame, path: str, by: str) -> None:
    """Write a batch into folders of its own below each value of ``by``; a repeated batch replaces them."""
    (
        rows.hint("rebalance", F.col(by))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(by, _BATCH)
        .parquet(path)
    )


def ingest_stream(landed: DataFrame, bronze: str, checkpoint: str, load_date: str = "load_date") -> StreamingQuery:
    """New files to stamped bronze below ``_load_date``, then stop.

    Each micro-batch owns a folder below each day it holds and overwrites that alone, so a batch that runs again after
    a failure leaves no second copy and streams can share a table. After a reset checkpoint all landed files are
    read again beside what is stored; the key's dedupe in silver drops the copies.
    """
    stamped = landed.select(
        *[c for c in landed.columns if c != load_date],
        F.col("_metadata.file_name").alias("_source_file"),
        F.col(load_date).cast("date").alias("_load_date"),
        F.current_timestamp().alias("_loaded_at"),
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        name = _batch_name(batch.sparkSession, checkpoint, batch_id)
        _swap(batch.withColumn(_BATCH, F.lit(name)), bronze, "_load_date")

    return _available_now(stamped, write, checkpoint)


def dedupe_stream(
    landed: DataFrame, path: str, checkpoint: str, key: str, event_time: str, delay: str
) -> StreamingQuery:
    """Append the first row of each key within the watermark to ``path``, then stop.

    A batch is folded to one row per key, the earliest, before any shuffle, so a hot key costs a row per task. What is
    left meets only the keys stored in the watermark's range of months, which partition pruning keeps as small
    as ``delay``. Rows older than the watermark are not compared with the evicted keys: they go to ``<path>_late``.
    Rows without a key cannot be copies and all pass.
    """
    timed = landed.withColumn(event_time, F.col(event_time).cast("timestamp"))
    columns = [event_time, *[c for c in timed.columns if c != event_time]]

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        name = _batch_name(spark, checkpoint, batch_id)
        stored = _stored(spark, path, batch.schema, name)
        seen = None if stored is None else _newest(spark, path, stored, event_time)
        horizon = F.lit(seen) - F.expr(f"interval {delay}") if seen else None
        moment = F.col(event_time)
        late = F.coalesce(moment < horizon, F.lit(False)) if seen else F.lit(False)
        fresh = batch.filter(~late)
        once = (
            fresh.filter(F.col(key).isNotNull())
            .groupBy(key)
            .agg(F.min(F.struct(*columns)).alias("row"))
            .select("row.*")
        )
        if seen:
            known = stored.filter(F.col(_MONTH) >= F.trunc(horizon, "MM")).select(key)
            once = once.join(known, key, "left_anti")
        unnamed = fresh.filter(F.col(key).isNull()).select(*columns)
        month = F.coalesce(F.trunc(moment, "MM"), F.lit("1970-01-01").cast("date"))
        stamp = {_MONTH: month, _BATCH: F.lit(name)}
        _swap(once.select(*columns).unionByName(unnamed).withColumns(stamp), path, _MONTH)
        if seen:
            _swap(batch.filter(late).withColumns(stamp), f"{path}_late", _MONTH)

    return _available_now(timed, write, checkpoint)


def _stored(spark: SparkSession, path: str, schema: T.StructType, batch: str) -> DataFrame | None:
    """What earlier batches stored; a first try of this batch does not count."""
    if not path_exists(spark, path):
        return None
    parts = [T.StructField(_MONTH, T.DateType()), T.StructField(_BATCH, T.StringType())]
    return spark.read.schema(T.StructType([*schema.fields, *parts])).parquet(path).filter(F.col(_BATCH) != batch)


def _newest(spark: SparkSession, path: str, stored: DataFrame, event_time: str):
    """The latest event time stored, from the last month that holds another batch's rows."""
    last = latest_partition(spark, path, _MONTH)
    if last is None:
        return None
    row = stored.filter(F.col(_MONTH) == F.lit(last).cast("date")).agg(F.max(event_time)).first()
    return row[0] or stored.agg(F.max(event_time)).first()[0]


def _available_now(stream: DataFrame, write, checkpoint: str) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
