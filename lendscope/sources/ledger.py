"""Which landed files were loaded, so that each is loaded once, whatever day it lands.

The ledger has a row for each loaded file: where it lies, its day, size, time, digest and rows. A run compares it with
what lies in the landing folder now. Files of known place, size and time are not opened; the others are hashed in the
tasks, and one whose content is known does not load its day again. A day is loaded whole: its bronze partition becomes
exactly the rows of its files.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from py4j.protocol import Py4JJavaError
from pyspark import inheritable_thread_target
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendscope.schemas import SOURCES, SchemaDrift
from lendscope.sources import bronze
from lendscope.sources.bronze import replace_partition
from lendscope.sources.files import file_format, partitions, path_exists
from lendscope.sources.manifest import drifted_files, hashed_files, require_files

LEDGER = (
    "source string, load_date string, data_file string, path string, byte_size long, modified timestamp, "
    "sha256 string, row_count long, loaded_at timestamp_ntz, again boolean, run string"
)


DAYS = 8  # days that are loaded at the same time


def read_ledger(spark: SparkSession, root: str) -> DataFrame:
    """All rows ever written; a file that was delivered again has one for each delivery."""
    path = f"{root}/meta/ledger"
    return spark.read.schema(LEDGER).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], LEDGER)


def _loaded(spark: SparkSession, source: str, root: str) -> DataFrame:
    """The newest ledger row of each file of a source."""
    own = read_ledger(spark, root).filter(F.col("source") == source)
    newest = own.groupBy("path").agg(F.max_by(F.struct(*own.columns), F.struct("loaded_at", "run")).alias("r"))
    return newest.select("r.*")


def pending_files(spark: SparkSession, source: str, landing: str, root: str) -> DataFrame:
    """(path, data_file, load_date, byte_size, modified, sha256, known): landed files the ledger does not hold as they are.

    ``known``: the place is in the ledger, with other content.
    """
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(landing)
        .select(
            F.regexp_replace("path", "^file:/+", "file:///").alias("path"),
            F.col("length").alias("byte_size"),
            F.col("modificationTime").alias("modified"),
        )
    )
    name = F.element_at(F.split("path", "/"), -1)
    files = files.filter(~name.rlike("^[._]"))
    loaded = _loaded(spark, source, root).select("path", "byte_size", "modified", "sha256")
    unseen = files.join(loaded, ["path", "byte_size", "modified"], "left_anti")
    before = loaded.select("path", F.col("sha256").alias("loaded_sha256"))
    hashed = hashed_files(unseen).join(before, "path", "left")
    changed = hashed.filter(~F.col("sha256").eqNullSafe(F.col("loaded_sha256")))
    day = F.regexp_extract("path", "/load_date=([^/]+)/", 1)
    return changed.select(
        "path", name.alias("data_file"), day.alias("load_date"), "byte_size", "modified", "sha256",
        F.col("loaded_sha256").isNotNull().alias("known"),
    )


def load_pending(
    spark: SparkSession, source: str, landing: str, root: str, run: str, loaded_at: datetime
) -> dict[str, int]:
    """Load every day of a source that holds a file the ledger lacks; rows by day.

    The days and files of a run are few: what landed since the last one. The footers of all are read by one job, and
    ``DAYS`` days are loaded at a time, since one alone seldom has work for every core. Each day is entered in the ledger once its bronze partition stands,
    oldest first and none after a day that fails; a run that breaks off in between loads the days that are not
    entered again, to the same partitions.
    """
    if not partitions(spark, landing):
        return {}
    listed = pending_files(spark, source, landing, root).collect()
    stamped = {r.load_date for r in _loaded(spark, source, root).select("load_date").distinct().collect()}
    days = sorted({r.load_date for r in listed if r.load_date})
    folders = {day: f"{landing}/load_date={day}" for day in days}
    as_declared = _as_declared(spark, source, list(folders.values()))

    def load(day: str) -> tuple[int, dict[str, int]]:
        """The day's rows, also by file."""
        if not as_declared and file_format(spark, folders[day]) == "parquet":
            require_files(spark, folders[day], SOURCES[source].schema)
        rows = bronze.load_day(spark, source, landing, f"{root}/bronze", day, loaded_at)
        place = bronze.partition_folder(spark, f"{root}/bronze/{SOURCES[source].table}", "_load_date", day)
        stored = spark.read.schema("_source_file string").parquet(place)
        return rows, {r[0]: r[1] for r in stored.groupBy("_source_file").count().collect()}

    def enter(ready: list[tuple[str, dict[str, int]]]) -> None:
        rows = [
            (source, day, f.data_file, f.path, f.byte_size, f.modified, f.sha256, per_file.get(f.data_file, 0), loaded_at, day in stamped, run, f"{run}-{source}-{day}")
            for day, per_file in ready
            for f in listed
            if f.load_date == day
        ]
        table = spark.createDataFrame(rows, f"{LEDGER}, entry string").coalesce(1)
        replace_partition(table, f"{root}/meta/ledger", "entry")

    done: dict[str, int] = {}
    ready: list[tuple[str, dict[str, int]]] = []
    pool = ThreadPoolExecutor(DAYS)
    try:
        loads = [pool.submit(inheritable_thread_target(spark)(load), day) for day in days]
        for day, one in zip(days, loads):
            # Days that stand are entered together while the next one is loaded.
            if ready and not one.done():
                enter(ready)
                ready = []
            done[day], per_file = one.result()
            ready.append((day, per_file))
    finally:
        pool.shutdown(wait=False, cancel_futures=True)
        if ready:
            enter(ready)
        pool.shutdown()
    return done


def _as_declared(spark: SparkSession, source: str, folders: list[str]) -> bool:
    """Whether the footers of all these folders' files hold the declared columns, by one job.

    If not, or if one cannot be read, each day is looked at by itself, so that it alone is refused.
    """
    try:
        if not folders or {file_format(spark, f) for f in folders} != {"parquet"}:
            return False
        return drifted_files(spark, folders, SOURCES[source].schema).filter("status <> 'type_changed'").isEmpty()
    except (PySparkException, Py4JJavaError, SchemaDrift):
        return False
