"""A table with one row per key that grows by merging: only what new rows change is written.

The rows lie in buckets by a hash of their key, each in folders that are never changed. A version of the table is a
list of folders. Merging new rows reads keys and order columns of the buckets they fall into: rows with new keys are
added to a bucket as one more folder, a bucket in which a newer row takes a stored one's place is written anew, all
others keep their folders. Readers of an older version go on reading it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendscope.operators.dedupe import dedupe_latest
from lendscope.session import scratch_path
from lendscope.sources.files import NO_VALUE, _children, path_exists

BUCKETS = 64
FOLDERS = 8  # a bucket of more folders is written anew when it grows
VERSION = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("folder", T.StringType())])


def versions(spark: SparkSession, root: str) -> list[str]:
    """The names of the stored versions, oldest first."""
    found = [p.rstrip("/").rsplit("/", 1)[1] for p in _children(spark, f"{root}/versions")]
    return sorted(n for n in found if path_exists(spark, f"{root}/versions/{n}/_SUCCESS"))


def newest_version(spark: SparkSession, root: str) -> str | None:
    return max(versions(spark, root), default=None)


def folders_of(spark: SparkSession, root: str, version: str) -> list[tuple[int, str]]:
    """(bucket, folder) of a version, one row per folder."""
    rows = spark.read.schema(VERSION).json(f"{root}/versions/{version}").collect()
    return sorted((r.bucket, r.folder) for r in rows)


def read_version(spark: SparkSession, root: str, version: str | None = None) -> DataFrame:
    """The rows of a version, by default the newest."""
    version = version or newest_version(spark, root)
    if version is None:
        raise LookupError(f"{root} holds no version")
    return _read(spark, root, [f"{root}/{folder}" for _, folder in folders_of(spark, root, version)])


def _read(spark: SparkSession, root: str, folders: list[str]) -> DataFrame:
    schema = spark.read.parquet(f"{root}/schema").schema
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def merge_latest(
    new: DataFrame,
    root: str,
    keys: Sequence[str],
    newest_first: Sequence[str],
    label: str = "",
    buckets: int = BUCKETS,
    withdrawn: Column | None = None,
    history: DataFrame | None = None,
) -> str:
    """Merge ``new`` into the newest version and store the outcome as the next one: the newest row of each key.

    Returns the version's name, a number and ``label``. ``newest_first`` are columns of the table, in order of weight, that tell rows of one key apart; a new row takes
    the stored one's place if it comes before it. Null keys are equal. The same rows merged again change nothing, so a
    merge that broke off is repeated.

    Rows that were delivered before and no longer hold are named by ``withdrawn``, a condition on stored rows; then
    ``history`` has all rows that hold, new ones included, and the buckets of withdrawn rows are made from it.
    """
    spark = new.sparkSession
    base = newest_version(spark, root)
    # What a merge that broke off left under this number is written over; no version lists it.
    version = f"{int(base[:8]) + 1 if base else 1:08d}{label and '-' + label}"
    if base is None:
        new.limit(0).write.mode("overwrite").parquet(f"{root}/schema")
    by_bucket: dict[int, list[str]] = {}
    for bucket, folder in folders_of(spark, root, base) if base else ():
        by_bucket.setdefault(bucket, []).append(folder)
    known = [f"{root}/{f}" for own in by_bucket.values() for f in own]
    bucket = bucket_of(keys, buckets)

    redone: list[int] = []
    if withdrawn is not None and known:
        if history is None:
            raise ValueError("withdrawn rows need the rows that hold")
        held = _read(spark, root, known).filter(F.coalesce(withdrawn, F.lit(False)))
        redone = [r.b for r in held.select(bucket.alias("b")).distinct().collect()]
    fresh_path = scratch_path(spark, "fresh")
    fresh = dedupe_latest(new, keys, newest_first).withColumn("_bucket", bucket)
    marked = _marked(spark, fresh.filter(~F.col("_bucket").isin(redone)), root, by_bucket, keys, newest_first)
    marked.write.parquet(fresh_path)
    marked = spark.read.schema(marked.schema).parquet(fresh_path)

    counts = marked.groupBy("_bucket").agg(F.count_if("_replaces").alias("replaced"), F.count_if(~F.col("_replaces")).alias("added"))
    replaced, added = [], []
    for row in counts.collect():
        if row.replaced or (row.added and len(by_bucket.get(row["_bucket"], ())) >= FOLDERS):
            replaced.append(row["_bucket"])
        elif row.added:
            added.append(row["_bucket"])

    columns = new.columns
    made: dict[int, list[str]] = dict(by_bucket)
    if added:
        rows = marked.filter(F.col("_bucket").isin(added)).select(*columns, "_bucket")
        for b, folder in _write(rows, root, f"data/{version}/added").items():
            made[b] = [*made.get(b, ()), folder]
    if replaced:
        old = _read(spark, root, [f"{root}/{f}" for b in replaced for f in by_bucket.get(b, ())])
        gone = marked.filter("_replaces").select(*[F.col(k).alias(f"_new_{k}") for k in keys])
        kept = old.join(gone, _same_key(keys), "left_anti").withColumn("_bucket", bucket)
        rows = kept.unionByName(marked.filter(F.col("_bucket").isin(replaced)).select(*columns, "_bucket"))
        made |= {b: [f] for b, f in _write(rows, root, f"data/{version}/merged").items()}
    if redone:
        rows = dedupe_latest(history.withColumn("_bucket", bucket).filter(F.col("_bucket").isin(redone)), keys, newest_first)
        written = _write(rows.select(*columns, "_bucket"), root, f"data/{version}/redone")
        for b in redone:
            made[b] = [written[b]] if b in written else []
    listed = [(b, f) for b, folders in made.items() for f in folders]
    spark.createDataFrame(listed, VERSION).coalesce(1).write.mode("overwrite").json(f"{root}/versions/{version}")
    return version


def _marked(
    spark: SparkSession, fresh: DataFrame, root: str, by_bucket: dict[int, list[str]], keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """The new rows that change the table, with ``_replaces``: whether one takes a stored row's place."""
    touched = [r[0] for r in fresh.select("_bucket").distinct().collect()] if by_bucket else []
    folders = [f"{root}/{f}" for b in touched for f in by_bucket.get(b, ())]
    if not folders:
        return fresh.withColumn("_replaces", F.lit(False))
    # Parquet hands out these columns alone.
    held = _read(spark, root, folders).select(
        *[F.col(k).alias(f"_new_{k}") for k in keys], F.struct(*order).alias("_order"), F.lit(True).alias("_held")
    )
    joined = fresh.join(held, _same_key(keys), "left")
    # Null is least in a struct, as it comes last among the newest.
    newer = F.struct(*order) > F.col("_order")
    replaces = F.coalesce("_held", F.lit(False))
    return joined.filter(~replaces | newer).select(*fresh.columns, replaces.alias("_replaces"))


def _same_key(keys: Sequence[str]) -> Column:
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_new_{k}"))
    return same


def _write(rows: DataFrame, root: str, place: str) -> dict[int, str]:
    """Write rows below ``place`` by bucket; the folder of each bucket."""
    spark = rows.sparkSession
    rows.hint("rebalance", F.col("_bucket")).write.mode("overwrite").option(
        "partitionOverwriteMode", "static"
    ).partitionBy("_bucket").parquet(f"{root}/{place}")
    names = [p.rstrip("/").rsplit("/", 1)[1] for p in _children(spark, f"{root}/{place}")]
    values = {n.removeprefix("_bucket="): n for n in names if n.startswith("_bucket=")}
    return {int(v): f"{place}/{n}" for v, n in values.items() if v != NO_VALUE}
