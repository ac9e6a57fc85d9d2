"""The corpus pipeline: from ``documents`` to packed sequences, one operator of ``lendscope.llm`` per stage."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendscope.llm import exact, mixing, packing, quality, queries, simhash
from lendscope.llm.common import stored, text_bytes


def free_name(docs: DataFrame, wanted: str) -> str:
    """A column name that ``docs`` does not use."""
    used = {c.lower() for c in docs.columns}
    while wanted.lower() in used:
        wanted += "_"
    return wanted


def row_name(doc_id: str = "doc_id", row: Column | None = None) -> Column:
    """What names a row: its id and a hash of its text. Nulls are equal inside it."""
    text = F.xxhash64(text_bytes("text")) if row is None else row
    return F.struct(F.col(doc_id).cast("long").alias("doc_id"), text.alias("row"))


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts.

    The model is fitted on the labelled rows among ``docs``. Decisions are joined by id and text, so rows that share
    an id, or have none, are judged by their own text.
    """
    model = quality.train(docs, queries.table(spark, sf_dir, "labels"))
    name = free_name(docs, "__row")
    rejected = quality.score(docs, model).where("predicted = 0")
    rejected = rejected.select(row_name(row=F.col("row")).alias(name)).distinct()
    return docs.withColumn(name, row_name()).join(rejected, name, "left_anti").select(_all(docs))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts: the one with the smallest doc_id, and one of rows that repeat it."""
    text = F.sha2(F.regexp_replace(F.coalesce(F.col("text"), F.lit("")), "[\\x20\\x09-\\x0D]+", " "), 256)
    name = free_name(docs, "__row")
    kept = exact.exact_groups(docs).where("kept").select(row_name(row=F.col("text_sha256")).alias(name))
    named = docs.withColumn(name, row_name(row=text))
    return named.join(kept, name, "left_semi").dropDuplicates([name]).select(_all(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash component: the one with the smallest doc_id, null ids after all others.

    Rows are named by doc_id and a hash of the text, so an id with two texts loses only the one that is a copy.
    """
    found = simhash.grouped_rows(docs, shingle=4, radius=4)
    first = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("r"))
    name = free_name(docs, "__row")
    kept = first.select(F.struct("r.doc_id", "r.row").alias(name))
    return docs.withColumn(name, row_name()).join(kept, name, "left_semi").dropDuplicates([name]).select(_all(docs))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its fitted rate says: the shares of good, low and toxic text meet the targets.

    Good documents are never thinned; the token total grows instead. Rates are joined by id and text.
    """
    labelled = queries.table(spark, sf_dir, "labels").withColumn("domain", mixing.domain_of())
    rated = mixing.mixture(docs, labelled, queries.WEIGHTS, keep=("good",))
    name, times, copy = (free_name(docs, n) for n in ("__row", "__copies", "__copy"))
    copies = rated.groupBy(row_name(row=F.col("row")).alias(name)).agg(F.max("copies").alias(times))
    joined = docs.withColumn(name, row_name()).join(copies, name)
    return joined.withColumn(copy, F.explode(F.array_repeat(F.lit(1), F.col(times)))).select(_all(docs))


def _all(docs: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in docs.columns]


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 4096 tokens, with their ids."""
    return packing.pack(docs, public_tokenizers.path(queries.WORD_VOCABULARY))


STAGES = [
    ("quality", keep_good),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mix", mix),
    ("pack", pack),
]

# No SQL expresses the classifier, the fingerprints or the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table, each written below the shared folder before the next."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
