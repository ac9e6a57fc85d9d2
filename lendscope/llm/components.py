"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendscope.llm.common import stored


SALTS = 16


def salted_join(rows: DataFrame, single: DataFrame, key: str, by: str, salts: int = SALTS) -> DataFrame:
    """``rows`` with the columns of ``single``, which has one row per ``key``; a hot key is dealt out by ``by``."""
    salt = F.pmod(F.xxhash64(by), F.lit(salts)).cast("int")
    copies = single.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return rows.withColumn("_salt", salt).join(copies, [key, "_salt"]).drop("_salt")


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b), root the smallest node of its component.

    Alternating star contraction: each round links a node's larger neighbours, then its smaller ones, to the smallest
    of them. Edges never grow in number, a hub is folded before the shuffle, and the table is written once a
    round. A table without edges gives no rows.
    """
    edges = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    for _ in range(rounds):
        # Large star: every neighbour above u now hangs on the smallest neighbour (or u itself).
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = salted_join(both.where("v > u"), least, "u", "v").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: u and its smaller neighbours hang on the smallest of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            salted_join(large, low, "u", "v")
            .select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("e"))
            .select(F.col("e.u").alias("u"), F.col("e.m").alias("v"))
            .where("u <> v")
            .distinct()
        )
        done = stored(small, "edges")
        # Finished when every edge leads to a root: no target is itself the upper end of an edge, no node has two.
        state = done.agg(F.count("*").alias("n"), F.count_distinct("u").alias("nodes")).first()
        hanging = done.select("v").distinct().join(done.select(F.col("u").alias("v")), "v", "left_semi").limit(1).count()
        edges = done
        if state.n == state.nodes and not hanging:
            roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(roots)
    raise RuntimeError(f"components not settled after {rounds} rounds")
