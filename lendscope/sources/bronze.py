"""Bronze tables: append-only, re-runnable by partition."""

from __future__ import annotations

import os
import re
from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendscope.schemas import SOURCES, require_columns
from lendscope.sources.files import (
    find_loan_tape,
    latest_partition,
    read_clients,
    read_feed,
    read_partition,
    read_loan_tape,
    stamp_load_metadata,
)


def land_feed(df: DataFrame, base: str, key: str = "load_date") -> None:
    """Write feed rows below ``key=`` folders, made on demand.

    The rebalance hint sizes the write tasks from the real row counts: a day
    that holds a third of the feed is spread over many tasks, small days share
    one, and no day ends up as thousands of tiny files.
    """
    df.hint("rebalance", F.col(key)).write.mode("append").partitionBy(key).parquet(base)


def replace_partition(df: DataFrame, path: str, key: str = "_load_date", **partition: str) -> int | None:
    """Swap partitions and keep all others; re-running a load leaves the same table behind.

    With ``partition``, a value of ``key``, that partition becomes exactly the rows of ``df``, also when there are
    none; a row of another partition is an error. Returns their number and lists this folder only. Without it, every partition that ``df`` holds is swapped.
    """
    if partition:
        (column, value), *others = partition.items()
        if column != key or others:
            raise ValueError(f"{path} is partitioned by {key}")
        folder = partition_folder(df.sparkSession, path, key, value)
        own = F.col(key).cast("string").eqNullSafe(F.lit(str(value)))
        other = F.raise_error(F.concat(F.lit(f"a row outside {key}={value}: "), F.col(key).cast("string")))
        rows = df.filter(F.when(own, F.lit(True)).otherwise(other.cast("boolean"))).drop(key)
        rows.hint("rebalance").write.mode("overwrite").parquet(folder)
        return df.sparkSession.read.schema(rows.schema).parquet(folder).count()
    (
        df.hint("rebalance", F.col(key))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(key)
        .parquet(path)
    )
    return None


def partition_folder(spark: SparkSession, path: str, key: str, value: str) -> str:
    """The folder of one partition, its name escaped as Spark's writers do."""
    escape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    return f"{path}/{key}={escape(str(value))}"


def write_clustered(df: DataFrame, path: str, partition_by: str, cluster_by: Sequence[str]) -> None:
    """Partition folders whose files are sorted by ``cluster_by``; replaces the whole table.

    Readers skip partitions by folder and row groups by their min and max.
    """
    (
        df.hint("rebalance", F.col(partition_by))
        .sortWithinPartitions(partition_by, *cluster_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(partition_by)
        .parquet(path)
    )


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def load_source(
    spark: SparkSession,
    name: str,
    landing: str,
    bronze: str,
    loaded_at: datetime | None = None,
    extra_folders: tuple[str, ...] = (),
    schema: T.StructType | None = None,
) -> int | None:
    """Land → bronze for one source; None when nothing has landed.

    ``schema`` declares the columns of a tape, which has none of its own.
    """
    spec = SOURCES[name]
    target = f"{bronze}/{spec.table}"
    if name == "loan_tape":
        paths = find_loan_tape(spark, (landing, *extra_folders))
        return load_tape(spark, paths, target, loaded_at, schema) if paths else None

    load_date = latest_partition(spark, landing)
    return None if load_date is None else load_day(spark, name, landing, bronze, load_date, loaded_at)


def load_day(
    spark: SparkSession, name: str, landing: str, bronze: str, load_date: str, loaded_at: datetime | None = None
) -> int:
    """One landed day of a source to its bronze partition; its rows."""
    spec = SOURCES[name]
    if name == "clients":
        rows = read_clients(spark, f"{landing}/load_date={load_date}", spec.schema)
    else:
        rows = require_columns(read_feed(read_partition(spark, landing, load_date)), spec.schema)
    stamped = stamp_load_metadata(rows, load_date, loaded_at=loaded_at)
    return replace_partition(stamped, f"{bronze}/{spec.table}", _load_date=load_date)


def load_tape(
    spark: SparkSession,
    paths: str | Sequence[str],
    target: str,
    loaded_at: datetime | None = None,
    schema: T.StructType | None = None,
) -> int:
    """One tape, a folder or all its part files, to its own bronze partition.

    A tape has no load date; the partition is where it was delivered, without the scheme. Each row keeps the
    name of its file.
    """
    folder = paths.rstrip("/") if isinstance(paths, str) else os.path.commonpath([p.rpartition("/")[0] for p in paths])
    delivery = re.sub("^[a-z0-9]+:/*", "/", folder)
    rows = read_loan_tape(spark, paths, schema)
    stamped = stamp_load_metadata(rows, "1970-01-01", loaded_at=loaded_at).withColumn("_delivery", F.lit(delivery))
    return replace_partition(stamped, target, "_delivery", _delivery=delivery)


def load_sources(spark: SparkSession, names: tuple[str, ...], landing: str, bronze: str) -> dict[str, int | None]:
    """Load the chosen sources; an absent one is skipped."""
    return {n: load_source(spark, n, f"{landing}/{n}", bronze) for n in names}


def table_inventory(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) of each table, by name."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
        for n, df in sorted(tables.items())
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result.orderBy("table_name")


def catalog_inventory(spark: SparkSession, database: str) -> DataFrame:
    """The inventory of every table a catalog database holds."""
    names = [t.name for t in spark.catalog.listTables(database) if not t.isTemporary]
    if not names:
        return empty_table(
            spark, T.StructType([T.StructField("table_name", T.StringType()), T.StructField("row_count", T.LongType())])
        )
    return table_inventory({n: spark.table(f"{database}.{n}") for n in names})
