"""Tracked history of a table's rows and partition-wise growth of facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendscope.sources.bronze import partition_folder, replace_partition
from lendscope.sources.files import latest_partition, path_exists

VALIDITY = ("valid_from", "valid_to", "is_current")


def _moment(as_of: str) -> Column:
    return F.lit(as_of).cast("timestamp_ntz")


def scd2_start(snapshot: DataFrame, key: str, attributes: Sequence[str], as_of: str) -> DataFrame:
    """The history a first snapshot opens: every row current."""
    return snapshot.select(
        key,
        *attributes,
        _moment(as_of).alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )


def scd2_merge(
    history: DataFrame, snapshot: DataFrame, key: str, attributes: Sequence[str], as_of: str
) -> DataFrame:
    """History after one more snapshot (one row per key).

    A changed row is closed and reopened, an unchanged or missing one stays
    open, a new one is opened. Only current rows, at most one per key, meet the
    snapshot in the join; closed rows pass by untouched.
    """
    columns = [key, *attributes]
    old = history.filter("is_current").select(F.col(key).alias("_key"), F.struct(*columns, *VALIDITY).alias("old"))
    new = snapshot.select(F.col(key).alias("_key"), F.struct(*columns).alias("new"))
    both = old.join(new, "_key", "full_outer")

    def version(source: str, start: Column, end: Column, current: bool) -> Column:
        return F.struct(
            *[F.col(f"{source}.{c}").alias(c) for c in columns],
            start.alias("valid_from"),
            end.alias("valid_to"),
            F.lit(current).alias("is_current"),
        )

    open_end = F.lit(None).cast("timestamp_ntz")
    kept = version("old", F.col("old.valid_from"), open_end, True)
    closed = version("old", F.col("old.valid_from"), _moment(as_of), False)
    opened = version("new", _moment(as_of), open_end, True)
    same = F.lit(True)
    for c in attributes:
        same = same & F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}"))
    versions = (
        F.when(F.col("new").isNull(), F.array(kept))
        .when(F.col("old").isNull(), F.array(opened))
        .when(same, F.array(kept))
        .otherwise(F.array(closed, opened))
    )
    current = both.select(F.inline(versions))
    return current.unionByName(history.filter(~F.col("is_current")).select(*columns, *VALIDITY))


def scd2_observe(
    history: DataFrame | None, snapshot: DataFrame, key: str, attributes: Sequence[str], as_of: str
) -> DataFrame:
    """History after a snapshot (one row per key) that may be older than snapshots it already holds.

    Beside its validity a version carries ``seen``, the times of the snapshots that showed it, so that the snapshots
    give one history in whatever order they come: a late value splits the version it falls into where that was seen
    next, joins an equal version that follows, or opens the history earlier. A key that a snapshot lacks was not seen
    and stays as it is; a time that a key was seen at before changes nothing. Versions that ended by ``as_of`` pass
    by untouched, so an on-time snapshot meets current rows only.
    """
    columns = [key, *attributes]
    at = _moment(as_of)
    if history is None:
        return scd2_start(snapshot, key, attributes, as_of).withColumn("seen", F.array(at))
    version = F.struct("valid_from", "valid_to", "seen", F.struct(*attributes).alias("own"))
    ended = F.coalesce(F.col("valid_to") <= at, F.lit(False))
    old = history.filter(~ended).groupBy(F.col(key).alias("_key")).agg(F.array_sort(F.collect_list(version)).alias("old"))
    new = snapshot.select(F.col(key).alias("_new_key"), F.struct(*attributes).alias("new"), F.lit(True).alias("shown"))
    both = old.join(new, F.col("_key").eqNullSafe(F.col("_new_key")), "full_outer")

    # The version that holds ``as_of``, if any, and the ones behind it.
    holds = F.get(F.filter("old", lambda v: v["valid_from"] <= at), F.lit(0))
    behind = F.filter("old", lambda v: v["valid_from"] > at)
    ready = both.select(
        F.coalesce("_key", "_new_key").alias(key), "old", "new", "shown", holds.alias("v"), behind.alias("behind")
    )
    ready = ready.withColumn("next", F.get("behind", F.lit(0))).withColumn("later", F.filter("v.seen", lambda s: s > at))

    def made(start: Column, end: Column, seen: Column, own: Column) -> Column:
        return F.struct(start.alias("valid_from"), end.alias("valid_to"), seen.alias("seen"), own.alias("own"))

    def equal(one: Column, other: Column) -> Column:
        return F.coalesce(one.eqNullSafe(other), F.lit(False))

    v, follows, own = F.col("v"), F.col("next"), F.col("new")
    confirmed = made(v["valid_from"], v["valid_to"], F.array_sort(F.array_union(v["seen"], F.array(at))), v["own"])
    before = made(v["valid_from"], at, F.filter(v["seen"], lambda s: s < at), v["own"])
    seen_next = F.array_min("later")
    after = made(seen_next, v["valid_to"], F.col("later"), v["own"])
    joined = made(at, follows["valid_to"], F.concat(F.array(at), follows["seen"]), own)
    tail = F.slice("behind", 2, F.greatest(F.size("behind"), F.lit(1)))
    # Behind the new value: what the split version showed later, else the version that follows.
    meets = F.when(follows.isNotNull() & equal(follows["own"], own), F.concat(F.array(joined), tail)).otherwise(
        F.concat(F.array(made(at, follows["valid_from"], F.array(at), own)), F.col("behind"))
    )
    split = F.when(F.size("later") > 0, F.concat(F.array(made(at, seen_next, F.array(at), own), after), F.col("behind")))
    versions = (
        F.when(F.col("shown").isNull(), F.col("old"))
        .when(F.col("old").isNull(), F.array(made(at, F.lit(None).cast("timestamp_ntz"), F.array(at), own)))
        .when(v.isNotNull() & F.array_contains(v["seen"], at), F.col("old"))
        .when(v.isNotNull() & equal(v["own"], own), F.concat(F.array(confirmed), F.col("behind")))
        .when(v.isNotNull(), F.concat(F.array(before), F.coalesce(split, meets)))
        .otherwise(meets)
    )
    rows = ready.select(key, F.explode(versions).alias("_v")).select(
        key, "_v.own.*", "_v.valid_from", "_v.valid_to", F.col("_v.valid_to").isNull().alias("is_current"), "_v.seen"
    )
    return rows.unionByName(history.filter(ended).select(*columns, *VALIDITY, "seen"))


# Days without a date.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def day_digests(fact: DataFrame, key: str) -> DataFrame:
    """(day, n_rows, digest_a, digest_b): per day the row count and two sums of row hashes, which no order changes."""
    columns = [F.col(f"`{c}`") for c in sorted(fact.columns) if c != key]
    hashes = [F.xxhash64(F.lit(seed), *columns).cast("decimal(38,0)") for seed in (1, 2)]
    return fact.groupBy(F.col(key).alias("day")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(hashes[0]).alias("digest_a"), F.sum(hashes[1]).alias("digest_b")
    )


def fact_changes(fact: DataFrame, path: str, key: str) -> DataFrame:
    """(day, change, n_rows, before): the days of ``fact`` that differ from what was stored below ``path``.

    ``change`` is ``new``, ``changed`` (other rows, also of equal number) or ``vanished``; rows without a day are a
    day of their own. Only the digests stored beside the table are read, not its rows; a table without digests is
    read once.
    """
    spark = fact.sparkSession
    now = day_digests(fact, key)
    before = _stored_digests(spark, fact, path, key)
    joined = now.alias("a").join(before.alias("b"), F.col("a.day").eqNullSafe(F.col("b.day")), "full_outer")
    same = F.lit(True)
    for c in ("n_rows", "digest_a", "digest_b"):
        same = same & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    change = F.when(F.col("b.n_rows").isNull(), "new").when(F.col("a.n_rows").isNull(), "vanished").otherwise("changed")
    return joined.filter(~same).select(
        F.coalesce("a.day", "b.day").alias("day"), change.alias("change"), F.col("a.n_rows"), F.col("b.n_rows").alias("before")
    )


def _stored_digests(spark: SparkSession, fact: DataFrame, path: str, key: str) -> DataFrame:
    if path_exists(spark, f"{path}_digests"):
        return spark.read.parquet(f"{path}_digests")
    if path_exists(spark, path):
        return day_digests(spark.read.schema(fact.schema).parquet(path), key)
    return day_digests(fact.limit(0), key)


def incremental_fact(
    fact: DataFrame, path: str, key: str, drop_vanished: bool = False, rewrite_newest: bool = True
) -> int:
    """Write only the days whose rows are new or other than those stored, and the newest stored day; rows written.

    Days are compared by digests of their content, so a late or a changed row of an old day is found and that day
    alone written again; rows without a day are one. With ``drop_vanished`` a stored day that the fact no longer holds
    is emptied, else it stays; without ``rewrite_newest`` the newest day is one like any other. The digests are written after the rows: a run that breaks off in between is repeated.
    """
    spark = fact.sparkSession
    changes = fact_changes(fact, path, key).collect()
    written = {r.day: r.n_rows for r in changes if r.change != "vanished"}
    newest = latest_partition(spark, path, key) if rewrite_newest else None
    if newest is not None:
        last = F.lit(newest).cast(fact.schema[key].dataType)
        written |= {r[0]: r[1] for r in fact.filter(F.col(key) == last).groupBy(key).count().collect()}
    if written:
        days = [d for d in written if d is not None]
        chosen = F.col(key).isin(days) if days else F.lit(False)
        if None in written:
            chosen = chosen | F.col(key).isNull()
        replace_partition(fact.filter(F.coalesce(chosen, F.lit(False))), path, key)
    gone = [r for r in changes if r.change == "vanished"]
    if drop_vanished:
        for row in gone:
            name = NO_DAY if row.day is None else str(row.day)
            fact.limit(0).drop(key).write.mode("overwrite").parquet(partition_folder(spark, path, key, name))
    if written or (gone and drop_vanished) or not path_exists(spark, f"{path}_digests"):
        now = day_digests(fact, key)
        if gone and not drop_vanished:
            held = now.select(F.col("day").alias("_day"))
            before = _stored_digests(spark, fact, path, key)
            now = now.unionByName(before.join(held, F.col("day").eqNullSafe(F.col("_day")), "left_anti"))
        # One row a day, taken along since the folder is replaced.
        spark.createDataFrame(now.collect(), now.schema).coalesce(1).write.mode("overwrite").parquet(f"{path}_digests")
    return sum(written.values())
