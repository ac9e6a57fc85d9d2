from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lendscope.operators import checks
from lendscope.operators.checks import Check
from lendscope.plans import contracts, publish, quality
from test_models import clients, raw_client

RUN = datetime(2024, 1, 31, 2)


def outcome(df, *declared):
    found = checks.run_checks(df, declared).orderBy("position").collect()
    return [(r.success, r.observed_value, r.unexpected_count) for r in found]


@pytest.fixture
def sample(spark):
    rows = [(1, 10), (2, 20), (2, 20), (3, None), (3, 5), (3, 21), (None, 10), (None, 10)]
    return spark.createDataFrame(rows, "k int, v int")


def test_checks_count_what_is_wrong(sample):
    assert outcome(
        sample,
        Check(checks.ROW_COUNT, low=8, high=8),
        Check(checks.ROW_COUNT, low=9),
        Check(checks.NOT_NULL, "k"),
        Check(checks.UNIQUE, "k"),
        Check(checks.IN_SET, "v", values=(10, 20)),
        Check(checks.BETWEEN, "v", low=10, high=20),
        Check(checks.BETWEEN, "v", low=5),
        Check(checks.BETWEEN, "v", high=20),
    ) == [
        (True, "8", None),
        (False, "8", None),
        (False, None, 2),
        (False, None, 5),
        (False, None, 2),
        (False, None, 2),
        (True, None, 0),
        (False, None, 1),
    ]


def test_mean_check_of_nothing_fails(spark, sample):
    assert outcome(sample, Check(checks.MEAN_BETWEEN, "v", low=13, high=14)) == [(True, "13.714285714285714", None)]
    assert outcome(sample.limit(0), Check(checks.MEAN_BETWEEN, "v", low=0, high=1)) == [(False, None, None)]
    assert outcome(sample.limit(0), Check(checks.UNIQUE, "k"), Check(checks.IN_SET, "v", values=(1,))) == [
        (True, None, 0),
        (True, None, 0),
    ]


def test_one_pass_for_all_but_uniqueness(spark, sample, tmp_path):
    path = str(tmp_path / "t")
    sample.write.parquet(path)
    declared = [Check(checks.NOT_NULL, "k"), Check(checks.BETWEEN, "v", low=0), Check(checks.ROW_COUNT, low=1), Check(checks.UNIQUE, "k")]
    plan = checks.run_checks(spark.read.parquet(path), declared)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2


def test_the_suites_hold_the_declared_checks():
    suites = quality.gold_suites()
    flat = [c for declared in suites.values() for c in declared]
    assert [len(s) for s in suites.values()] == [10, 4, 4]
    assert sum(c.severity == checks.BLOCKING for c in flat) == 15
    assert sum(len(c) for c in contracts.NOT_NULL_COLUMNS.values()) == 22
    assert len(contracts.UNIQUE_COLUMNS) == 9
    assert len(contracts.ACCEPTED_VALUES) == 8
    assert len(contracts.RELATIONSHIPS) == 3


def test_column_tests_find_planted_rows(spark, sample, rows):
    assert rows(checks.not_null_failures(sample, ["k", "v"])) == [("k", 2), ("v", 1)]
    assert rows(checks.unique_failures(sample, "k")) == [("k", 2)]
    assert rows(checks.accepted_values_failures(sample, "v", [10, 20])) == [("v", "21", 1), ("v", "5", 1)]
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    assert rows(checks.fk_orphans(sample, "k", parent, "id")) == [(3, 3)]


def test_negative_amounts(spark, rows):
    df = spark.createDataFrame([("a", -0.01), ("b", 0.0), ("c", None)], "txn_id string, amount double")
    assert rows(contracts.negative_amounts(df)) == [("a", -0.01)]


@pytest.mark.parametrize(
    "hours, status", [(0, "pass"), (26, "pass"), (26.01, "warn"), (52, "warn"), (52.01, "error")]
)
def test_freshness(spark, hours, status):
    df = spark.createDataFrame([(datetime(2024, 1, 1),), (datetime(2023, 1, 1),)], "_loaded_at timestamp_ntz")
    found = quality.source_freshness(
        df, datetime(2024, 1, 1) + timedelta(hours=hours), timedelta(hours=26), timedelta(hours=52)
    )
    assert found.first().status == status


def test_freshness_of_an_empty_source_is_an_error(spark):
    df = spark.createDataFrame([], "_loaded_at timestamp_ntz")
    assert quality.source_freshness(df, RUN, timedelta(hours=26), timedelta(hours=52)).first().status == "error"


def make_results(spark, run_at, outcomes):
    rows = [("s", "marts.t", i, "e", "c", severity, ok, None, None) for i, (severity, ok) in enumerate(outcomes)]
    schema = (
        "suite_name string, target_table string, position int, expectation_type string, column_name string, "
        "severity string, success boolean, observed_value string, unexpected_count long"
    )
    return quality.dq_results(spark.createDataFrame(rows, schema), run_at)


def test_gate_stops_on_blocking_only(spark):
    warned = make_results(spark, RUN, [("blocking", True), ("warning", False)])
    assert quality.dq_gate(warned) == []
    failed = make_results(spark, RUN, [("blocking", False), ("warning", False)])
    with pytest.raises(quality.GateFailed, match="marts.t :: e"):
        quality.dq_gate(failed)
    assert len(quality.dq_gate(failed, enforce=False)) == 1


def test_summary_marks_the_newest_run(spark, rows):
    first = make_results(spark, RUN, [("blocking", True), ("blocking", True), ("blocking", False), ("warning", False)])
    second = make_results(spark, RUN + timedelta(days=1), [("blocking", True)])
    both = first.unionByName(second)
    summary = quality.mart_data_quality(both)
    assert rows(summary.select("severity", "checks", "passed", "failed", "pass_rate", "is_latest")) == [
        ("blocking", 1, 1, 0, 1.0, True),
        ("blocking", 3, 2, 1, 0.6667, False),
        ("warning", 1, 0, 1, 0.0, False),
    ]
    assert quality.dq_latest_detail(both).count() == 1
    assert tuple(quality.dq_latest_kpis(summary).first()) == ("20240201T020000Z", 1, 1, 1.0)
    assert tuple(quality.dq_latest_kpis(summary.limit(0)).first()) == (None, 0, 0, 0.0)


def test_publishing_a_run_twice_stores_it_once(spark, tmp_path):
    path = str(tmp_path / "dq")
    first = make_results(spark, RUN, [("blocking", True), ("warning", True)])
    second = make_results(spark, RUN + timedelta(days=1), [("blocking", False)])
    assert publish.publish_dq_results(first, path) == 2
    publish.publish_dq_results(second, path)
    publish.publish_dq_results(make_results(spark, RUN, [("blocking", False)]), path)
    assert publish.publish_dq_results(first.limit(0), path) == 0
    stored = spark.read.parquet(path)
    assert sorted((r.run_id, r.success) for r in stored.collect()) == [
        ("20240131T020000Z", False),
        ("20240201T020000Z", False),
    ]


def test_a_failed_gate_leaves_the_last_good_gold(spark, tmp_path):
    root = str(tmp_path / "lake")
    good = clients(spark, *[raw_client(i) for i in range(5)])
    publish.publish_gold(spark, good, root, RUN, client_rows=(1, 10))
    assert publish.read_published(spark, root, "dim_borrower").count() == 5

    bad = clients(spark, *[raw_client(i, age=200) for i in range(7)])
    with pytest.raises(quality.GateFailed, match="age"):
        publish.publish_gold(spark, bad, root, RUN + timedelta(days=1), client_rows=(1, 10))
    assert publish.read_published(spark, root, "dim_borrower").count() == 5
    summary = publish.read_dq_summary(spark, root)
    assert summary.filter("is_latest").agg(F.sum("failed")).first()[0] >= 1

    publish.publish_gold(spark, good.limit(4), root, RUN + timedelta(days=2), client_rows=(1, 10))
    assert publish.read_published(spark, root, "dim_borrower").count() == 4
    with pytest.raises(LookupError):
        publish.read_published(spark, root, "unknown")


def test_tables_and_views(spark):
    df = spark.range(3)
    publish.create_view(df, "three_rows")
    assert spark.sql("select count(*) from three_rows").first()[0] == 3
    from lendscope.sources import bronze

    spark.sql("create database if not exists checks_db")
    assert not bronze.table_exists(spark, "checks_db.numbers")
    assert bronze.catalog_inventory(spark, "checks_db").filter("table_name = 'numbers'").count() == 0
    publish.write_table(df, "checks_db.numbers")
    publish.write_table(spark.range(5), "checks_db.numbers")
    assert bronze.table_exists(spark, "checks_db.numbers")
    assert bronze.catalog_inventory(spark, "checks_db").filter("table_name = 'numbers'").first().row_count == 5
