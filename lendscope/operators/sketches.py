"""Quantile sketches that can be stored and merged, and drift between any two windows of them.

A sketch of a day's values is a few tens of kilobytes whatever the day holds. Sketches of many days merge to the sketch
of all their rows, so drift against any past window reads the new day once and no old row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIZE = 4096  # the sketch's parameter; up to about so many values are kept as they are
RANK_ERROR = 0.0013  # of a rank, as a share of the rows, at this size


def value_sketches(df: DataFrame, by: Sequence[str], columns: Sequence[str], size: int = SIZE) -> DataFrame:
    """(by, column_name, n, sketch) per group and numeric column, from one pass; null and NaN are left out.

    A group without values of a column has no row for it.
    """
    values = {c: F.col(c).cast("double") for c in columns}
    kept = df.select(*by, *[F.when(~F.isnan(v), v).alias(c) for c, v in values.items()])
    sketched = kept.groupBy(*by).agg(
        *[F.count(c).alias(f"n_{c}") for c in columns],
        *[F.kll_sketch_agg_double(c, F.lit(size)).alias(f"sketch_{c}") for c in columns],
    )
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(f"n_{c}").alias("n"), F.col(f"sketch_{c}").alias("sketch")) for c in columns]
    return sketched.select(*by, F.inline(F.array(*rows))).filter("n > 0")


def merged_sketches(sketches: DataFrame, by: Sequence[str] = (), size: int = SIZE) -> DataFrame:
    """(by, column_name, n, sketch): the sketches of each group as one."""
    return sketches.groupBy(*by, "column_name").agg(
        F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", F.lit(size)).alias("sketch")
    )


def sketch_drift(baseline: DataFrame, current: DataFrame, bins: int = 10, size: int = SIZE) -> DataFrame:
    """(column_name, bin, upto, share_baseline, share_current, psi) between two windows of sketches.

    Bins end at the baseline's quantiles; the last has no end. Shares lie within twice ``RANK_ERROR`` of the exact
    ones. An empty bin counts as half a row, so its term stays finite. A column that one side lacks has no rows.
    """
    sides = [
        merged_sketches(s, size=size).select("column_name", F.col("n").alias(f"n_{name}"), F.col("sketch").alias(f"s_{name}"))
        for name, s in (("baseline", baseline), ("current", current))
    ]
    steps = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    both = sides[0].join(sides[1], "column_name")
    # Ranks are asked for numbers the plan knows: bins - 1 of them per column.
    found = both.select("column_name", F.kll_sketch_get_quantile_double("s_baseline", steps).alias("ends")).collect()
    rows = both.select("column_name", *[F.lit(None).cast(k).alias(c) for c, k in DRIFT.items()]).limit(0)
    for r in sorted(found, key=lambda r: r.column_name):
        rows = rows.unionByName(_bins(both.filter(F.col("column_name") == r.column_name), sorted(set(r.ends))))
    move = F.col("share_current") - F.col("share_baseline")
    return rows.withColumn("psi", move * F.log(F.col("share_current") / F.col("share_baseline")))


DRIFT = {"bin": "int", "upto": "double", "share_baseline": "double", "share_current": "double"}


def _bins(both: DataFrame, ends: list[float]) -> DataFrame:
    """One row per bin of one column."""
    numbers = F.array(*[F.lit(e) for e in ends])

    def shares(name: str) -> Column:
        ranks = F.kll_sketch_get_rank_double(f"s_{name}", numbers)
        upto = F.concat(F.array(F.lit(0.0)), ranks, F.array(F.lit(1.0)))
        return F.transform(
            F.sequence(F.lit(1), F.lit(len(ends) + 1)),
            lambda i: F.greatest(F.get(upto, i) - F.get(upto, i - 1), F.lit(0.5) / F.col(f"n_{name}")),
        )

    open_end = F.concat(numbers, F.array(F.lit(None).cast("double")))
    zipped = F.arrays_zip(open_end.alias("upto"), shares("baseline").alias("share_baseline"), shares("current").alias("share_current"))
    return both.select("column_name", F.posexplode(zipped).alias("bin", "b")).select("column_name", "bin", "b.*")
