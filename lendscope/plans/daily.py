"""One day's run: land to bronze, silver, checked gold, governed views, scores, their evaluation and monitoring."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendscope.operators import metrics, sketches
from lendscope.plans import model, monitoring, portfolio, publish, quality, silver
from lendscope.schemas import SOURCES
from lendscope.sources import bronze, files, keyed, ledger, manifest

# Rows of one key and one load time are told apart by their file and, at last, by a digest of the whole row.
TIES = ("_source_file", "_digest")

# The feed's newest day may differ so much from the days before, of which there must be so many.
VOLUME_TOLERANCE, VOLUME_DAYS = 0.15, 7
# Shares and population stability above these are reported.
NULL_LIMIT, DRIFT_LIMIT = 0.05, 0.2


def run_daily(
    spark: SparkSession,
    landing: str,
    root: str,
    run_at: datetime,
    client_rows: tuple[int, int] = quality.CLIENT_ROWS,
    rounds: int = 300,
    sources: tuple[str, ...] = tuple(SOURCES),
    volume_tolerance: float | None = VOLUME_TOLERANCE,
    tape: Tape | None = None,
) -> dict[str, int | None]:
    """Run every step in order; a failing check or test stops before anything is served.

    Every landed day that the ledger lacks is loaded, whenever it landed, and only those days are merged into silver.
    Each step reads what the step before stored, so a lost executor costs its own tasks only, and a run can be
    repeated from the start. Returns the rows loaded by source; None where nothing new has landed.
    """
    run_id = quality.run_id_of(run_at)
    loaded = load_landed(spark, landing, root, run_at, sources, tape)
    record_files(spark, [n for n in sources if loaded[n] is not None], landing, root, run_at, tape)
    places = {"stg_clients": merge_silver(spark, "clients", root, run_id)}
    payments = None
    if "transactions" in sources:
        require_fresh_feed(spark, root, run_at)
        if volume_tolerance is not None:
            require_volume(spark, root, run_at, volume_tolerance)
        places["stg_payments"] = merge_silver(spark, "transactions", root, run_id)
        payments = publish.read_place(spark, places["stg_payments"])
    clients = publish.read_place(spark, places["stg_clients"])
    publish.publish_gold(spark, clients, root, run_at, client_rows=client_rows, payments=payments, stored=places)
    if loaded.get("loan_tape") is not None and tape is not None:
        publish_tape(spark, root, run_id, tape)
    train_and_score(spark, root, run_at, rounds)
    monitor(spark, root, run_id)
    return loaded


def load_landed(
    spark: SparkSession, landing: str, root: str, run_at: datetime, sources: tuple[str, ...], tape: Tape | None = None
) -> dict[str, int | None]:
    """Land to bronze: all days of the dated sources that the ledger lacks, and the tape as it lies there."""
    loaded: dict[str, int | None] = {}
    for source in sources:
        path = f"{landing}/{source}"
        if source == "loan_tape":
            schema = tape.raw_schema() if tape else None
            loaded[source] = bronze.load_source(spark, source, path, f"{root}/bronze", run_at, schema=schema)
        else:
            days = ledger.load_pending(spark, source, path, root, quality.run_id_of(run_at), run_at)
            loaded[source] = sum(days.values()) if days else None
    return loaded


# Silver by source: its table, key and typed rows.
SILVER = {
    "clients": ("stg_clients", "client_id", silver.typed_clients),
    "transactions": ("stg_payments", "txn_id", silver.typed_payments),
}


def merge_silver(spark: SparkSession, source: str, root: str, run_id: str) -> str:
    """Merge the days of the ledger that silver lacks into its newest version; the place of the new version.

    Only these days are read from bronze. A day that was delivered again may lack rows it had; then the buckets that
    held its rows are made from all of bronze. Entries are noted once their version stands.
    """
    name, key, typed = SILVER[source]
    store = f"{root}/silver/{name}"
    entries = ledger.read_ledger(spark, root).filter(F.col("source") == source)
    entries = entries.groupBy("load_date", "run").agg(F.max("again").alias("again"))
    noted = f"{store}/merged"
    if files.path_exists(spark, noted):
        entries = entries.join(spark.read.schema(MERGED).json(noted), ["load_date", "run"], "left_anti")
    todo = entries.collect()  # a row for each day since the last run
    newest = keyed.newest_version(spark, store)
    if not todo:
        if newest is None:
            raise LookupError(f"no {source} were ever loaded")
        return publish.keyed_place(store, newest)
    rows = typed(_bronze(spark, root, source), TIES)
    days = sorted({r.load_date for r in todo})
    again = sorted({r.load_date for r in todo if r.again})
    version = keyed.merge_latest(
        rows.filter(F.col("load_date").isin(*[_day(d) for d in days])),
        store,
        [key],
        ["loaded_at", *TIES],
        run_id,
        withdrawn=F.col("load_date").isin(*[_day(d) for d in again]) if again else None,
        history=rows if again else None,
    )
    done = spark.createDataFrame([(r.load_date, r.run) for r in todo], MERGED)
    done.coalesce(1).write.mode("append").json(noted)
    return publish.keyed_place(store, version)


MERGED = "load_date string, run string"


def _day(value: str) -> date:
    return date.fromisoformat(value)


def _bronze(spark: SparkSession, root: str, source: str) -> DataFrame:
    raw = spark.read.parquet(f"{root}/bronze/{SOURCES[source].table}")
    return raw.withColumn("_digest", F.xxhash64(*[F.col(f"`{c}`") for c in raw.columns]))


def require_volume(spark: SparkSession, root: str, run_at: datetime, tolerance: float) -> None:
    """The feed's newest day against the days before, by the ledger's counts; no feed row is read.

    The first ``VOLUME_DAYS`` days of a feed have too little behind them and pass.
    """
    own = ledger.read_ledger(spark, root).filter(F.col("source") == "transactions")
    newest = own.groupBy("path").agg(F.max_by(F.struct("load_date", "row_count"), F.struct("loaded_at", "run")).alias("r"))
    volume = newest.groupBy(F.lit("transactions").alias("source"), F.col("r.load_date").cast("date").alias("day")).agg(
        F.sum("r.row_count").alias("row_count")
    )
    bands = monitoring.volume_band(volume, tolerance)
    bands = bands.withColumn("n_before", F.row_number().over(Window.partitionBy("source").orderBy("day")) - 1)
    last = bands.orderBy(F.desc("day")).first()
    if last is not None and last.n_before >= VOLUME_DAYS and not last.within_band:
        raise quality.GateFailed(
            f"volume of transactions on {last.day}: {last.row_count} rows, {last.trailing_avg} on the days before"
        )


@dataclass(frozen=True)
class Tape:
    """The declared loan tape: its cleaned columns, key, and the columns that tell rows of one loan apart.

    ``extra`` names columns of the files that cleaning drops; files are read as text, so types never depend on a
    delivery's values.
    """

    schema: T.StructType
    key: tuple[str, ...] = ("loan_id",)
    newest_first: tuple[str, ...] = ("_loaded_at", "_delivery")
    extra: tuple[str, ...] = ()

    def raw_schema(self) -> T.StructType:
        return T.StructType([T.StructField(n, T.StringType()) for n in (*self.schema.names, *self.extra)])


def publish_tape(spark: SparkSession, root: str, run_id: str, tape: Tape) -> None:
    """The tape cleaned, its loans as facts and the overview of the portfolio."""
    raw = spark.read.parquet(f"{root}/bronze/{SOURCES['loan_tape'].table}")
    cleaned = portfolio.clean_loan_tape(raw, tape.schema, tape.key, tape.newest_first)
    paths = publish.write_versions({"stg_loans": cleaned}, root, run_id)
    loans = spark.read.parquet(paths["stg_loans"])
    paths |= publish.write_versions(
        {"fct_loan": portfolio.fct_loan(loans), "mart_portfolio": portfolio.portfolio_overview(loans)}, root, run_id
    )
    publish.point_to(spark, paths, root, run_id)


def monitor(spark: SparkSession, root: str, run_id: str) -> None:
    """Null rates of the features and drift of the scores against the run before, one partition per run.

    Scores of earlier runs are not read: a run leaves sketches of its own. These checks warn; nothing is held back.
    """
    nulls = monitoring.null_rate(publish.read_published(spark, root, "feature_default_prediction"), NULL_LIMIT)
    rows = nulls.select(
        F.lit("null_rate").alias("check"), F.col("column_name").alias("name"), F.col("null_rate").cast("double").alias("value"), "success"
    )
    path = f"{root}/meta/score_sketches"
    before = max((r for r in files.partitions(spark, path, "run") if r < run_id), default=None)
    scores = publish.read_published(spark, root, "model_scores").withColumn("run", F.lit(run_id))
    own = sketches.value_sketches(scores, ["run"], [column for _, column in model.MODELS])
    bronze.replace_partition(own, path, "run", run=run_id)
    if before is not None:
        stored = [spark.read.parquet(bronze.partition_folder(spark, path, "run", r)) for r in (before, run_id)]
        drift = sketches.sketch_drift(*stored).groupBy(F.col("column_name").alias("name")).agg(F.sum("psi").alias("value"))
        rows = rows.unionByName(drift.select(F.lit("score_drift").alias("check"), "name", "value", (F.col("value") < DRIFT_LIMIT).alias("success")))
    bronze.replace_partition(rows.withColumn("run", F.lit(run_id)), f"{root}/meta/monitoring", "run", run=run_id)


def require_fresh_feed(spark: SparkSession, root: str, run_at: datetime) -> str:
    """Status of the payment feed by its newest event, whether or not anything landed today.

    Only the newest day's partition is read. A feed that was never loaded is an error.
    """
    spec = SOURCES["transactions"]
    path = f"{root}/bronze/{spec.table}"
    newest = files.latest_partition(spark, path, spec.partition_by)
    if newest is None:
        raise quality.StaleSource("the feed was never loaded")
    events = spark.read.parquet(path).filter(F.col(spec.partition_by) == F.lit(newest).cast("date"))
    age = quality.source_freshness(events, run_at, spec.warn_after, spec.error_after, loaded_at="txn_ts")
    return quality.require_fresh(age)


def record_files(
    spark: SparkSession, sources: list[str], landing: str, root: str, run_at: datetime, tape: Tape | None = None
) -> None:
    """Name, rows, size, digest and load time of every file the run loaded, one partition per run and source."""
    run_id = quality.run_id_of(run_at)
    for source in sources:
        if source == "loan_tape":
            paths = files.find_loan_tape(spark, [f"{landing}/{source}"])
            scan = files.read_loan_tape(spark, paths, tape.raw_schema() if tape else None)
            rows = manifest.file_manifest(spark, source, f"{landing}/{source}", landing, scan, run_at)
        else:
            own = ledger.read_ledger(spark, root).filter((F.col("source") == source) & (F.col("run") == run_id))
            rows = own.select(
                "source", "data_file", F.lit(landing).alias("origin"), "row_count", "byte_size", "sha256", "loaded_at"
            )
        stamped = rows.withColumn("run", F.lit(f"{run_id}-{source}"))
        bronze.replace_partition(stamped, f"{root}/meta/manifest", "run", run=f"{run_id}-{source}")


def train_and_score(spark: SparkSession, root: str, run_at: datetime, rounds: int = 300) -> None:
    """Fit on the published features; publish scores and evaluation once every borrower has a valid score."""
    run_id = quality.run_id_of(run_at)
    parted = model.split(publish.read_published(spark, root, "feature_default_prediction"))
    fitted = model.fit_models(parted.filter(~F.col("is_test")), rounds)
    model.save_models(fitted, f"{root}/models")
    paths = publish.write_versions({"model_scores": model.model_scores(parted, fitted)}, root, run_id)
    scores = spark.read.parquet(paths["model_scores"])
    model.require_valid_scores(scores)
    table = metrics.model_metrics(metrics.long_scores(scores.filter("is_test"), model.MODELS))
    champion = metrics.champion_model(table, [name for name, _ in model.MODELS])
    bands = publish.read_published(spark, root, "dim_borrower").select("client_id", "credit_limit_band")
    paths |= publish.write_versions(evaluation(scores, bands, dict(model.MODELS)[champion.first().model]), root, run_id)
    publish.point_to(spark, paths, root, run_id)
    publish.write_metrics(table, champion, f"{root}/meta/metrics")


def evaluation(scores: DataFrame, bands: DataFrame, champion: str) -> dict[str, DataFrame]:
    """Calibration by decile, default rate by segment, and both sides of the split."""
    test = scores.filter("is_test")
    curves = [
        metrics.calibration_deciles(test, column).withColumn("model", F.lit(name)) for name, column in model.MODELS
    ]
    calibration = curves[0]
    for curve in curves[1:]:
        calibration = calibration.unionByName(curve)
    return {
        "model_calibration": calibration,
        "model_segments": metrics.segment_pd_report(test.join(bands, "client_id"), champion),
        "model_split": metrics.split_report(scores, model.MODELS),
    }
