"""The whole day on landed files."""

import json
import random
from datetime import date, datetime, timedelta

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lendscope.plans import daily, monitoring, publish, quality
from lendscope.sources import bronze, manifest
from test_sources import feed_rows

RUN = datetime.now().replace(microsecond=0)
DAY = RUN.date()


def land_clients(folder, n, age=30):
    rng = random.Random(4)
    part = folder / "clients" / f"load_date={DAY}"
    part.mkdir(parents=True, exist_ok=True)
    lines = []
    for k in range(n):
        late = rng.randint(-2, 3)
        bills = [round(rng.random() * 1e4, 2) for _ in range(12)]
        flag = int(rng.random() < (0.7 if late > 1 else 0.1))
        row = [k, rng.randint(1, 40) * 10_000, 1 + k % 2, 1 + k % 4, 1 + k % 3, age + k % 40, *[late] * 6, *bills, flag]
        lines.append(",".join(map(str, row)))
    (part / "sheet.csv").write_text("\n".join(lines))


def test_a_day_from_files_to_scores(spark, tmp_path):
    landing, root = tmp_path / "landing", str(tmp_path / "lake")
    land_clients(landing, 300)
    bronze.land_feed(feed_rows(spark, DAY, ["a", "b"]), str(landing / "transactions"))
    loaded = daily.run_daily(spark, str(landing), root, RUN, client_rows=(100, 400), rounds=3)
    assert loaded == {"clients": 300, "transactions": 2, "loan_tape": None}
    assert publish.read_published(spark, root, "mart_portfolio_risk").count() > 6
    scores = publish.read_published(spark, root, "model_scores")
    assert publish.read_published(spark, root, "stg_payments").count() == 2
    assert publish.read_published(spark, root, "gov_payments_analyst").count() == 2
    assert publish.read_published(spark, root, "model_split").count() == 4
    assert {r.source for r in spark.read.parquet(f"{root}/meta/manifest").collect()} == {"clients", "transactions"}
    assert scores.count() == 300 and scores.filter("is_test").count() == 75
    record = json.loads(spark.read.text(f"{root}/meta/metrics").first()[0])
    assert record["champion"] in record["models"]

    publish.publish_views(spark, root, "marts_day", ["dim_borrower"])
    assert spark.table("marts_day.dim_borrower").count() == 300

    # The next day's file is broken: nothing served changes.
    land_clients(landing, 320, age=150)
    with pytest.raises(quality.GateFailed):
        daily.run_daily(spark, str(landing), root, RUN + timedelta(minutes=1), client_rows=(100, 400), rounds=3)
    publish.publish_views(spark, root, "marts_day", ["dim_borrower"])
    assert spark.table("marts_day.dim_borrower").agg(F.max("age")).first()[0] < 100
    assert publish.read_published(spark, root, "model_scores").count() == 300

    with pytest.raises(quality.StaleSource):
        daily.run_daily(spark, str(landing), root, RUN + timedelta(days=30), sources=("clients", "transactions"))

    # Monitored again, the run finds the drift of its scores from the run before in the stored sketches.
    daily.monitor(spark, root, "99999999T000000")
    found = spark.read.parquet(f"{root}/meta/monitoring").filter("check = 'score_drift'").collect()
    assert {r.name for r in found} == {"pd_logreg", "pd_xgboost"}
    assert all(r.success and abs(r.value) < 1e-9 for r in found)


def test_clustered_files_are_sorted(spark, tmp_path):
    path = str(tmp_path / "clustered")
    df = spark.range(1000).selectExpr("id % 2 as part", "(id * 7919) % 1000 as x")
    bronze.write_clustered(df, path, "part", ["x"])
    stored = spark.read.parquet(path)
    assert stored.count() == 1000
    written = list((tmp_path / "clustered").rglob("*.parquet"))
    assert {f.parent.name for f in written} == {"part=0", "part=1"}
    for file in written:
        x = pq.ParquetFile(file).read().column("x").to_pylist()
        assert x == sorted(x)


def test_an_old_feed_is_stale_whatever_landed(spark, tmp_path):
    landing, root = str(tmp_path / "landing"), str(tmp_path / "lake")
    with pytest.raises(quality.StaleSource, match="never loaded"):
        daily.require_fresh_feed(spark, root, RUN)
    bronze.land_feed(feed_rows(spark, date(2020, 1, 1), ["a"]), landing)
    bronze.load_source(spark, "transactions", landing, f"{root}/bronze")
    with pytest.raises(quality.StaleSource):
        daily.require_fresh_feed(spark, root, RUN)


def test_a_column_test_stops_the_run(spark, tmp_path):
    landing, root = tmp_path / "landing", str(tmp_path / "lake")
    land_clients(landing, 300)
    bronze.land_feed(feed_rows(spark, DAY, ["a"]).withColumn("borrower_id", F.lit(9999)), str(landing / "transactions"))
    with pytest.raises(quality.GateFailed, match="relationships stg_payments.client_id"):
        daily.run_daily(spark, str(landing), root, RUN, client_rows=(100, 400), rounds=3)


def test_days_without_rows_count(spark):
    days = [(1, 10), (2, 10), (6, 10)]
    rows = spark.createDataFrame([("s", date(2024, 3, d), n) for d, n in days], "source string, day date, row_count long")
    found = {r.day.day: r for r in monitoring.volume_band(rows, 0.5, until=date(2024, 3, 7)).collect()}
    assert sorted(found) == [1, 2, 3, 4, 5, 6, 7]
    assert [found[d].row_count for d in (3, 7)] == [0, 0]
    assert not found[3].within_band and not found[6].within_band


def test_paths_of_other_stores():
    assert manifest.store_uri("s3a://bucket/x") == "s3://bucket/x"
    assert manifest.store_uri("/a/b c") == "file:///a/b c"
    with pytest.raises(manifest.UnknownStore):
        manifest.store_uri("abc://x/y")
