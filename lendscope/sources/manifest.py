"""Provenance of landed files."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from datetime import datetime
from urllib.parse import quote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendscope.schemas import SchemaDrift

_CHUNK = 1 << 20

# Schemes that Spark knows under another name than the reader of the tasks.
_SCHEMES = {"s3a": "s3", "s3n": "s3", "gs": "gs", "hdfs": "hdfs", "file": "file", "s3": "s3"}


class UnknownStore(ValueError):
    """A path whose files the tasks cannot open."""


def store_uri(path: str) -> str:
    """The path as the tasks' reader names it; an unknown store is refused."""
    scheme, mark, rest = path.partition("://")
    if not mark:
        scheme, mark, rest = "file", "://", "/" + path.removeprefix("file:").lstrip("/")
    if scheme not in _SCHEMES:
        raise UnknownStore(f"{path}: cannot hash files of {scheme}://")
    return f"{_SCHEMES[scheme]}://{rest}"


def _hasher(chunk: int = _CHUNK):
    """The function a task runs; nested, so it ships by value to the executors."""

    named = store_uri

    def digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        for batch in batches:
            found = []
            for path in batch["path"]:
                store, inner = fs.FileSystem.from_uri(quote(named(path), safe=":/"))
                digest = hashlib.sha256()
                with store.open_input_stream(inner) as stream:
                    while data := stream.read(chunk):
                        digest.update(data)
                found.append(digest.hexdigest())
            yield batch.assign(sha256=found)

    return digests


def hashed_files(files: DataFrame) -> DataFrame:
    """``files`` (path, byte_size, modified) with ``sha256``, read in 1 MB chunks where the task runs."""
    return files.select("path", "byte_size", "modified").mapInPandas(
        _hasher(), "path string, byte_size long, modified timestamp, sha256 string"
    )


def file_manifest(
    spark: SparkSession,
    source: str,
    path: str,
    origin: str,
    rows: DataFrame | None = None,
    loaded_at: datetime | None = None,
) -> DataFrame:
    """One row per file: source, name, origin, rows, bytes, sha256, time.

    Files are listed without their content and hashed in 1 MB chunks where the
    task runs, so a file larger than memory is no problem. ``rows`` is the
    scan of the same files; without it the row count is NULL.
    """
    store_uri(path)
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select(
            F.regexp_replace("path", "^file:/+", "file:///").alias("path"), F.col("length").alias("byte_size")
        )
    )
    hashed = listed.mapInPandas(_hasher(), "path string, byte_size long, sha256 string")
    if rows is None:
        counted = hashed.withColumn("row_count", F.lit(None).cast("long"))
    else:
        per_file = rows.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(
            F.count(F.lit(1)).alias("row_count")
        )
        # The scan reports its paths percent-encoded.
        plain = F.url_decode(F.replace("file_path", F.lit("+"), F.lit("%2B")))
        per_file = per_file.select(F.regexp_replace(plain, "^file:/+", "file:///").alias("path"), "row_count")
        counted = hashed.join(per_file, "path", "left")
    moment = F.lit(loaded_at.isoformat(sep=" ")) if loaded_at else F.current_timestamp()
    return counted.select(
        F.lit(source).alias("source"),
        F.element_at(F.split("path", "/"), -1).alias("data_file"),
        F.lit(origin).alias("origin"),
        "row_count",
        "byte_size",
        "sha256",
        moment.cast("timestamp_ntz").alias("loaded_at"),
    )


FOOTERS = "path string, column_name string, actual_type string, n_rows long"


def _footers():
    """The function a task runs; nested, so it ships by value to the executors."""
    named = store_uri

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs, parquet
        from pyspark.sql.pandas.types import from_arrow_type

        for batch in batches:
            found = []
            for path in batch["path"]:
                store, inner = fs.FileSystem.from_uri(quote(named(path), safe=":/"))
                with store.open_input_file(inner) as source:
                    footer = parquet.ParquetFile(source)
                    n = footer.metadata.num_rows
                    columns = list(footer.schema_arrow)
                    for column in columns:
                        try:
                            kind = from_arrow_type(column.type, prefer_timestamp_ntz=True).simpleString()
                        except Exception:  # a type Spark has no name for
                            kind = str(column.type)
                        found.append((path, column.name, kind, n))
                    if not columns:
                        found.append((path, None, None, n))
            yield pd.DataFrame(found, columns=["path", "column_name", "actual_type", "n_rows"])

    return read


def parquet_columns(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(path, column_name, actual_type, n_rows): one row per Parquet file and column, from the files' footers alone.

    Footers are read where the task runs; no data page is. A file without columns has one row without a name.
    """
    for folder in [path] if isinstance(path, str) else path:
        store_uri(folder)
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    files = listed.select(F.regexp_replace("path", "^file:/+", "file:///").alias("path"))
    name = F.element_at(F.split("path", "/"), -1)
    files = files.filter(name.endswith(".parquet") & ~name.rlike("^[._]"))
    return files.mapInPandas(_footers(), FOOTERS)


def drifted_files(spark: SparkSession, path: str | Sequence[str], declared: T.StructType) -> DataFrame:
    """(path, column_name, declared_type, actual_type, status) of each file's columns that are not as declared.

    ``status`` is ``missing``, ``unexpected`` or ``type_changed``, so one odd part file among many is named before
    anything is loaded. Columns are compared by name, whatever their order.
    """
    found = parquet_columns(spark, path)
    wanted = [(f.name, f.dataType.simpleString()) for f in declared.fields]
    files = found.groupBy("path").agg(F.collect_list(F.struct("column_name", "actual_type")).alias("columns"))
    per_file = files.select("path", F.map_from_entries(F.filter("columns", lambda c: c["column_name"].isNotNull())).alias("has"))
    listed = [F.struct(F.lit(n).alias("column_name"), F.lit(k).alias("declared_type")) for n, k in wanted]
    named = per_file.withColumn("declared", F.array(*listed))
    rows = named.select("path", "has", F.explode("declared").alias("d")).select(
        "path", "d.column_name", "d.declared_type", F.col("has")[F.col("d.column_name")].alias("actual_type")
    )
    names = F.array(*[F.lit(n) for n, _ in wanted])
    others = per_file.select("path", F.explode("has").alias("column_name", "actual_type")).filter(
        ~F.array_contains(names, F.col("column_name"))
    )
    status = F.when(F.col("actual_type").isNull(), "missing").when(
        F.col("actual_type") != F.col("declared_type"), "type_changed"
    )
    known = rows.withColumn("status", status).filter("status IS NOT NULL")
    return known.unionByName(
        others.select("path", "column_name", F.lit(None).cast("string").alias("declared_type"), "actual_type", F.lit("unexpected").alias("status"))
    )


def require_files(spark: SparkSession, path: str, declared: T.StructType) -> None:
    """SchemaDrift that names the files below a folder which lack a declared column or hold an unknown one."""
    wrong = drifted_files(spark, path, declared).filter(F.col("status") != "type_changed").limit(20).collect()
    if wrong:
        raise SchemaDrift("; ".join(f"{r.path.rsplit('/', 1)[-1]}: {r.column_name} {r.status}" for r in wrong))
