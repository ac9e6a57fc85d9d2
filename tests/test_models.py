"""Silver, gold and governance on hand-written clients."""

import hashlib
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from lendscope.plans import gold, governance, silver
from lendscope.schemas import RAW_CLIENTS, class_of

STAMPS = "_source_file string, _load_date date, _loaded_at timestamp_ntz"


def raw_client(key, limit=100_000, age=35, codes=(1, 2, 3), status=(0,) * 6, bills=(600.0,) * 6, paid=(60.0,) * 6, flag=0, hour=1):
    return (key, limit, *codes, age, *status, *bills, *paid, flag, "f", date(2024, 1, 1), datetime(2024, 1, 1, hour))


def clients(spark, *rows):
    names = [f"`{f.name}` {f.dataType.simpleString()}" for f in RAW_CLIENTS.fields]
    return silver.stg_clients(spark.createDataFrame(list(rows), ", ".join([*names, STAMPS])))


def payments(spark, *rows):
    schema = (
        "txn_id string, borrower_id int, txn_ts timestamp_ntz, amount double, channel string, txn_type string, "
        "status string, borrower_email string, borrower_ip string, " + STAMPS + ", tie int"
    )
    return silver.stg_payments(spark.createDataFrame(list(rows), schema), ["tie"])


def payment(key, amount=1.0, mail="a@b.c", ip="10.0.0.1", hour=1, tie=0):
    at = datetime(2024, 1, 1, hour)
    return (key, 1, at, amount, "ACH", "PAYMENT", "POSTED", mail, ip, "f", date(2024, 1, 1), at, tie)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df):
    return plan_of(df).count("FileScan parquet")


def test_newest_load_wins(spark):
    found = clients(spark, raw_client(1, limit=10, hour=1), raw_client(1, limit=20, hour=3), raw_client(1, limit=30, hour=2))
    assert [r.credit_limit for r in found.collect()] == [20]


def test_tie_breakers_decide_inside_a_load(spark):
    found = payments(spark, payment("a", 1.0, tie=1), payment("a", 2.0, tie=2), payment("b", 3.0))
    assert sorted((r.txn_id, r.amount) for r in found.collect()) == [("a", 2.0), ("b", 3.0)]
    assert "tie" not in found.columns


def test_dedupe_keeps_one_row_per_key_and_task_before_the_shuffle(spark, tmp_path):
    path = str(tmp_path / "raw")
    spark.range(1000).selectExpr("case when id % 3 = 0 then 0 else id end as k", "id as v").write.parquet(path)
    from lendscope.operators.dedupe import dedupe_latest

    found = dedupe_latest(spark.read.parquet(path), ["k"], ["v"])
    plan = plan_of(found)
    assert plan.index("Partial", plan.index("Exchange")) > 0
    assert found.filter("k = 0").first().v == 999
    assert found.count() == 667


def test_region_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "clients")
    spark.range(40).selectExpr("id as ID", "id as LIMIT_BAL").write.parquet(path)
    raw = spark.read.parquet(path)
    typed = raw.select(F.col("ID").cast("int").alias("client_id"), F.col("LIMIT_BAL").alias("loaded_at"))
    from lendscope.operators.dedupe import dedupe_latest

    plan = plan_of(dedupe_latest(typed, ["client_id"], ["loaded_at"]).filter("client_id % 4 = 3"))
    assert plan.index("Window") < plan.rindex("Filter")


def test_classes_follow_the_columns(spark):
    found = clients(spark, raw_client(1))
    classes = {f.name: class_of(f) for f in gold.dim_borrower(found).schema.fields}
    assert classes["age"] == "PII" and classes["credit_limit"] == "CONFIDENTIAL" and classes["region"] == "PUBLIC"


def test_gold_keeps_its_contracts(spark):
    from lendscope.plans.publish import build_gold
    from lendscope.schemas import GOLD_CONTRACTS, SchemaDrift, gold_contract, require_schema

    tables = build_gold(clients(spark, raw_client(1)))
    assert set(tables) == set(GOLD_CONTRACTS)
    for name, df in tables.items():
        require_schema(df, gold_contract(name))
    with pytest.raises(SchemaDrift, match="age"):
        require_schema(tables["dim_borrower"].withColumn("age", F.col("age").cast("string")), gold_contract("dim_borrower"))


def test_history_unpivots_in_one_scan(spark, tmp_path):
    found = clients(
        spark, raw_client(7, limit=0), raw_client(8, status=(1, -1, 0, 2, None, -2), bills=(1.0, 2.0, 3.0, 4.0, 5.0, None))
    )
    fact = gold.fct_payment_history(found)
    assert fact.count() == 12
    assert fact.filter("client_id = 7 and utilization is not null").count() == 0
    flags = {r.month_index: r.is_delinquent for r in fact.filter("client_id = 8").collect()}
    assert flags == {1: True, 2: False, 3: False, 4: True, 5: None, 6: False}
    key = fact.filter("client_id = 8 and month_index = 3").first().payment_history_id
    assert key == hashlib.md5(b"8-3").hexdigest()

    path = str(tmp_path / "silver")
    found.write.parquet(path)
    stored = spark.read.parquet(path)
    assert scans(gold.fct_payment_history(stored)) == 1
    assert scans(gold.mart_portfolio_risk(gold.labelled_borrowers(stored))) == 1
    features = gold.feature_default_prediction(stored)
    assert scans(features) == 1 and "Exchange" not in plan_of(features)


def test_features_handle_missing_and_non_positive_values(spark):
    found = gold.feature_default_prediction(
        clients(
            spark,
            raw_client(1, limit=0),
            raw_client(2, bills=(0.0,) * 6),
            raw_client(3, bills=(-1.0,) * 6),
            raw_client(4, status=(1, None, 0, 0, 0, 3)),
            raw_client(5, age=None, limit=None),
            raw_client(6, bills=(1.0, None, 1.0, 1.0, 1.0, 1.0)),
        )
    )
    by_id = {r.client_id: r for r in found.collect()}
    assert by_id[1].avg_utilization is None and by_id[1].pay_to_bill_ratio == 0.1
    assert by_id[2].pay_to_bill_ratio is None and by_id[3].pay_to_bill_ratio is None
    assert by_id[3].avg_utilization == -0.0
    assert by_id[4].avg_repay_status is None and by_id[4].max_repay_status == 3 and by_id[4].months_delinquent is None
    assert (by_id[5].age_band, by_id[5].credit_limit_band) == ("60+", "300k+")
    assert by_id[6].total_bill_amt is None and by_id[6].avg_utilization is None


def test_mart_means_skip_missing_values(spark):
    found = clients(spark, raw_client(4, limit=100, flag=1), raw_client(8, limit=None, flag=None), raw_client(12, limit=201, flag=0))
    mart = gold.mart_portfolio_risk(gold.labelled_borrowers(found))
    north = mart.filter("segment_dimension = 'region' and segment_value = 'north'").first()
    assert (north.n_clients, north.n_default, north.default_rate) == (3, 1, 0.5)
    assert (north.avg_credit_limit, north.total_credit_limit_exposure) == (150.5, 301)
    assert {r.segment_dimension for r in mart.collect()} == set(gold.SEGMENT_DIMENSIONS)


def test_analyst_sees_no_exact_values(spark):
    dim = gold.dim_borrower(clients(spark, raw_client(3), raw_client(4)))
    analyst = governance.gov_borrower_analyst(dim)
    view = governance.gov_payments_analyst(payments(spark, payment("a"), payment("b", mail=None, ip=None)))
    assert governance.pii_leaks(analyst, view).count() == 0
    assert analyst.select("age", "credit_limit").distinct().collect() == [(None, None)]
    leaks = governance.pii_leaks(dim, payments(spark, payment("a"), payment("b", mail=None, ip=None)))
    assert sorted((r.violation, r.id) for r in leaks.collect()) == [
        ("age_not_masked", "3"), ("age_not_masked", "4"), ("credit_limit_not_masked", "3"),
        ("credit_limit_not_masked", "4"), ("email_not_masked", "a"), ("ip_not_masked", "a"),
    ]


def test_row_access(spark):
    dim = gold.dim_borrower(clients(spark, *[raw_client(i) for i in range(8)]))
    rights = spark.createDataFrame(
        [("R", "north"), ("R", "east"), ("R", "east"), ("R", "atlantis"), ("S", "south")], "role_name string, region string"
    )
    assert governance.row_access_entitled(dim, "ADMIN", rights).count() == 8
    assert {r.region for r in governance.row_access_entitled(dim, "R", rights).collect()} == {"north", "east"}
    assert governance.row_access_entitled(dim, "R", rights).count() == 4
    assert governance.row_access_entitled(dim, "nobody", rights).count() == 0
    west = governance.gov_borrower_regional(governance.gov_borrower_analyst(dim))
    assert sorted(r.client_id for r in west.collect()) == [3, 7]
    assert governance.row_access_leaks(west).count() == 0
    assert governance.row_access_leaks(west, "north").count() == 2


@pytest.mark.parametrize("role, clear", [("RISK_ANALYST", True), ("ADMIN", True), ("ANALYST", False)])
def test_policy_by_role(spark, role, clear):
    dim = gold.dim_borrower(clients(spark, raw_client(1, age=44)))
    assert (governance.apply_masking_policy(dim, role, governance.BORROWER_POLICY).first().age == 44) is clear
