"""Reading landed files."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendscope.schemas import SchemaDrift, require_columns


def _children(spark: SparkSession, path: str, recursive: bool = False) -> list[str]:
    """Paths below a folder from the cluster's own file system; [] if absent."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    if not recursive:
        return [s.getPath().toString() for s in fs.listStatus(folder) if s.isDirectory()]
    found, files = [], fs.listFiles(folder, True)
    while files.hasNext():
        found.append(files.next().getPath().toString())
    return found


def path_exists(spark: SparkSession, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def latest_partition(spark: SparkSession, base: str, key: str = "load_date") -> str | None:
    """The last ``key=`` folder by name, or None. Lists one folder, opens no file."""
    return max(partitions(spark, base, key), default=None)


# The folder of rows without a value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def partitions(spark: SparkSession, base: str, key: str = "load_date") -> list[str]:
    """The values of the ``key=`` folders, in order; rows without a value have none."""
    marker = f"{key}="
    names = [p.rsplit("/", 1)[1] for p in _children(spark, base)]
    found = [n.removeprefix(marker) for n in names if n.startswith(marker)]
    return sorted(v for v in found if v != NO_VALUE)


def read_partition(spark: SparkSession, base: str, value: str, key: str = "load_date") -> DataFrame:
    """The rows of one landed partition, without the partition column."""
    return spark.read.parquet(f"{base}/{key}={value}")


def _formats(paths: Sequence[str]) -> set[str]:
    """The suffixes of data files; hidden and marker files do not count."""
    names = [p.rsplit("/", 1)[-1] for p in paths]
    return {s for s in ("csv", "parquet") for n in names if n.endswith(f".{s}") and n[0] not in "._"}


def file_format(spark: SparkSession, path: str) -> str:
    """``csv`` or ``parquet``, by the names of the files below a folder; both at once are refused."""
    found = _formats([path, *_children(spark, path, recursive=True)])
    if len(found) > 1:
        raise SchemaDrift(f"{path} holds CSV and Parquet files")
    return found.pop() if found else "parquet"


def read_clients(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The client file, Parquet or CSV, with the declared columns in their order.

    The CSV export of the sheet begins with the column names, or with a banner line and the column names; nothing else
    is dropped. A second line that names other columns, a line with too few or too many cells, a row without a whole
    number as its key, also an empty one, and a cell that is no number are errors of the job that reads them.
    """
    if file_format(spark, path) == "parquet":
        found = require_columns(spark.read.parquet(path), schema)
        return found.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    raw = spark.read.schema(text).csv(path, header=False, mode="FAILFAST")
    cells = F.array(*[F.coalesce(F.trim(F.col(f"`{n}`")), F.lit("")) for n in schema.names])
    names = F.array(*[F.lit(n) for n in schema.names])
    heading = cells == names
    for banner in _banners(spark, path, schema.names):
        heading = heading | (cells == F.array(*[F.lit(c) for c in banner]))
    drifted = ~heading & F.arrays_overlap(cells, names)
    rows = raw.filter(
        F.when(drifted, F.raise_error(F.concat(F.lit("client columns are "), F.concat_ws(",", cells))).cast("boolean"))
        .otherwise(~heading)
    )
    key = schema.fields[0].name
    number = F.trim(F.col(f"`{key}`"))
    checked = F.when(F.coalesce(number.rlike(r"^-?\d+$"), F.lit(False)), number).otherwise(
        F.raise_error(F.concat(F.lit(f"client row without a number as {key}: "), F.concat_ws(",", cells)))
    )
    columns = [checked.cast(schema.fields[0].dataType).alias(key)]
    columns += [F.trim(F.col(f"`{f.name}`")).cast(f.dataType).alias(f.name) for f in schema.fields[1:]]
    return rows.select(*columns)


def _first_lines(spark: SparkSession, path: str, n: int = 2) -> list[str]:
    """The first lines of one file, from the cluster's own file system."""
    jvm = spark.sparkContext._jvm
    file = jvm.org.apache.hadoop.fs.Path(path)
    stream = file.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(file)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        lines = [reader.readLine() for _ in range(n)]
    finally:
        stream.close()
    return [line for line in lines if line is not None]


def _banners(spark: SparkSession, path: str, names: Sequence[str]) -> list[list[str]]:
    """The distinct first lines of a sheet's files that the line of column names follows, as cells."""
    found: dict[tuple, None] = {}
    for file in [path, *_children(spark, path, recursive=True)]:
        if _formats([file]):
            lines = [[c.strip() for c in row] for row in csv.reader(_first_lines(spark, file))]
            if len(lines) == 2 and lines[1] == list(names) and len(lines[0]) == len(names):
                found[tuple(lines[0])] = None
    return [list(cells) for cells in found]


def read_feed(df: DataFrame, column: str = "txn_ts") -> DataFrame:
    """The feed with its event time as a timestamp.

    Nanosecond files arrive as a long (see ``session.SETTINGS``); microseconds
    are kept, as everywhere in Spark.
    """
    if isinstance(df.schema[column].dataType, T.LongType):
        return df.withColumn(column, F.timestamp_micros(F.expr(f"`{column}` div 1000")))
    return df


def find_loan_tape(spark: SparkSession, folders: Sequence[str]) -> list[str]:
    """Every part file of the tape: the first folder that holds any, Parquet before CSV, by name."""
    for folder in folders:
        paths = _children(spark, folder, recursive=True)
        for suffix in ("parquet", "csv"):
            found = sorted(p for p in paths if _formats([p]) == {suffix})
            if found:
                return found
    return []


def read_loan_tape(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | None = None) -> DataFrame:
    """The rows of a tape: its part files, or a folder of them.

    Without a declared schema a CSV is read twice, once for its types.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    found = {file_format(spark, paths[0])} if len(paths) == 1 else _formats(paths)
    if found == {"parquet"}:
        return spark.read.parquet(*paths) if schema is None else spark.read.schema(schema).parquet(*paths)
    if len(found) > 1:
        raise SchemaDrift("a tape of CSV and Parquet files")
    if schema is not None:
        return spark.read.schema(schema).csv(paths, header=True, enforceSchema=False)
    return spark.read.csv(paths, header=True, inferSchema=True)


def stamp_load_metadata(
    df: DataFrame, load_date: str, source_file: str | None = None, loaded_at: datetime | None = None
) -> DataFrame:
    """Adds file name, load date and load time to every row.

    Without ``source_file`` each row carries the name of the file it was read
    from; without ``loaded_at`` the time of the query.
    """
    name = F.lit(source_file) if source_file else F.col("_metadata.file_name")
    moment = F.lit(loaded_at.isoformat(sep=" ")) if loaded_at else F.current_timestamp()
    return df.select(
        "*",
        name.alias("_source_file"),
        F.lit(load_date).cast("date").alias("_load_date"),
        moment.cast("timestamp_ntz").alias("_loaded_at"),
    )
