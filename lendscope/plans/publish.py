"""Write, audit, publish: consumers only ever see gold that passed the gate."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendscope.operators.checks import Check
from lendscope.plans import contracts
from lendscope.plans.gold import (
    dim_borrower,
    fct_payment_history,
    feature_default_prediction,
    labelled_borrowers,
    mart_portfolio_risk,
)
from lendscope.plans.governance import governed_views
from lendscope.plans.quality import (
    CLIENT_ROWS,
    dq_gate,
    dq_results,
    dq_suite,
    gold_suites,
    mart_data_quality,
    run_id_of,
)
from lendscope.schemas import GOLD_CONTRACTS, gold_contract, require_schema
from lendscope.session import side_by_side
from lendscope.sources import keyed
from lendscope.sources.bronze import replace_partition

PUBLISHED = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("published_at", T.TimestampType()),
    ]
)


def build_gold(clients: DataFrame) -> dict[str, DataFrame]:
    """Every gold table as a plan over client silver."""
    return {
        "dim_borrower": dim_borrower(clients),
        "fct_payment_history": fct_payment_history(clients),
        "mart_portfolio_risk": mart_portfolio_risk(labelled_borrowers(clients)),
        "feature_default_prediction": feature_default_prediction(clients),
    }


def write_versions(tables: Mapping[str, DataFrame], root: str, run_id: str) -> dict[str, str]:
    """Write each table to a new folder; nobody reads it yet.

    A table that breaks its column contract is not written at all. Tables are written side by side. The folder's name is new each time, so a repeated
    run never touches what is published.
    """
    version = f"{run_id}-{uuid.uuid4().hex[:8]}"
    for name, df in tables.items():
        if name in GOLD_CONTRACTS:
            require_schema(df, gold_contract(name))
    paths = {name: f"{root}/marts/{name}/version={version}" for name in tables}
    writes = [lambda df=df, path=paths[name]: df.write.parquet(path) for name, df in tables.items()]
    if tables:
        side_by_side(next(iter(tables.values())).sparkSession, writes)
    return paths


def publish_dq_results(results: DataFrame, path: str) -> int:
    """Store a run's check rows; a repeated run replaces its own rows only."""
    rows = results.count()
    if rows:
        replace_partition(results, path, "run_id")
    return rows


def publish_gold(
    spark: SparkSession,
    clients: DataFrame,
    root: str,
    run_at: datetime,
    suites: Mapping[str, list[Check]] | None = None,
    client_rows: tuple[int, int] = CLIENT_ROWS,
    enforce: bool = True,
    payments: DataFrame | None = None,
    stored: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Build gold beside the published version, check it, then point to it.

    Silver is stored once, so its dedupe runs once for all tables; with ``payments`` their silver and the role-scoped
    views are published too. ``stored`` has the places (see ``keyed_place``) of silver that is stored by key already
    and is not written again. When a blocking check or a column test fails the pointer is not moved and the last good
    version stays in place; the check rows are kept either way.
    """
    run_id = run_id_of(run_at)
    stored = dict(stored or {})
    silver = {"stg_clients": clients} | ({} if payments is None else {"stg_payments": payments})
    paths = stored | write_versions({n: df for n, df in silver.items() if n not in stored}, root, run_id)
    paths |= write_versions(build_gold(read_place(spark, paths["stg_clients"])), root, run_id)
    if payments is not None:
        read = {n: read_place(spark, paths[n]) for n in ("dim_borrower", "stg_payments")}
        paths |= write_versions(governed_views(read["dim_borrower"], read["stg_payments"]), root, run_id)
    written = {name: read_place(spark, path) for name, path in paths.items()}
    results = dq_results(dq_suite(written, suites or gold_suites(client_rows)), run_at)
    publish_dq_results(results, f"{root}/meta/dq_results")
    stored = spark.read.parquet(f"{root}/meta/dq_results").filter(F.col("run_id") == run_id)
    dq_gate(stored, enforce)
    if enforce:
        contracts.require_column_tests(written)
    point_to(spark, paths, root, run_id)
    return paths


def point_to(spark: SparkSession, paths: Mapping[str, str], root: str, run_id: str) -> None:
    """From now on readers get these versions."""
    moment = datetime.now(timezone.utc)
    pointer = [(name, path, run_id, moment) for name, path in paths.items()]
    spark.createDataFrame(pointer, PUBLISHED).coalesce(1).write.mode("append").json(f"{root}/meta/published")


def read_published(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The newest version of a table that passed its gate."""
    return read_place(spark, published_path(spark, root, name))


def keyed_place(root: str, version: str) -> str:
    """How a pointer names a version of a table stored by key."""
    return f"{root}@{version}"


def read_place(spark: SparkSession, place: str) -> DataFrame:
    """The rows a pointer names: a folder, or a version of a table stored by key, without its helper columns."""
    root, mark, version = place.rpartition("@")
    if not mark or "/" in version:
        return spark.read.parquet(place)
    rows = keyed.read_version(spark, root, version)
    return rows.select(*[c for c in rows.columns if not c.startswith("_")])


def published_path(spark: SparkSession, root: str, name: str) -> str:
    """The folder of that version."""
    pointers = spark.read.schema(PUBLISHED).json(f"{root}/meta/published")
    newest = pointers.filter(F.col("table_name") == name).agg(F.max_by("path", F.struct("run_id", "published_at")).alias("path")).first()
    if newest.path is None:
        raise LookupError(f"{name} was never published")
    return newest.path


def publish_views(spark: SparkSession, root: str, database: str, names: Sequence[str]) -> None:
    """Point one catalog view per table at its newest published version."""
    spark.sql(f"create database if not exists {database}")
    for name in names:
        path = published_path(spark, root, name)
        if "@" in path.rsplit("/", 1)[-1]:
            raise ValueError(f"{name} is stored by key and has no one folder; read it with read_published")
        spark.sql(f"create or replace view {database}.{name} as select * from parquet.`{path}`")


def write_table(df: DataFrame, table: str) -> None:
    """Full replace of a catalog table."""
    df.write.mode("overwrite").saveAsTable(table)


def create_view(df: DataFrame, name: str) -> None:
    """Create or replace a view over a plan."""
    df.createOrReplaceTempView(name)


def read_dq_summary(spark: SparkSession, root: str) -> DataFrame:
    return mart_data_quality(spark.read.parquet(f"{root}/meta/dq_results"))


def write_metrics(metrics: DataFrame, champion: DataFrame, path: str) -> None:
    """Champion and per-model metrics as one JSON record."""
    per_model = metrics.agg(
        F.map_from_entries(F.collect_list(F.struct("model", F.struct("auc", "ks", "brier")))).alias("models")
    )
    record = per_model.select(
        champion.select("model").scalar().alias("champion"), "models"
    )
    record.coalesce(1).write.mode("overwrite").json(path)
