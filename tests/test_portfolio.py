from datetime import date, timedelta

import pytest
from pyspark.sql import types as T

from lendscope import schemas
from lendscope.plans import gold, monitoring, portfolio, serving
from test_models import clients, raw_client

TAPE = T.StructType(
    [
        T.StructField("loan_id", T.IntegerType()),
        T.StructField("grade", T.StringType()),
        T.StructField("rate", T.DoubleType()),
    ]
)


def test_tape_is_typed_trimmed_and_unique(spark, rows):
    raw = spark.createDataFrame(
        [("1", "  A \t One ", "5.5", 1), ("1", "B", "6", 2), ("2", None, None, 1)],
        "loan_id string, grade string, rate string, delivery int",
    )
    assert rows(portfolio.clean_loan_tape(raw, TAPE, ["loan_id"], ["delivery"])) == [(1, "b", 6.0), (2, None, None)]
    assert rows(portfolio.clean_loan_tape(raw.limit(1), TAPE, ["loan_id"], ["delivery"])) == [(1, "a one", 5.5)]


def test_calendar_covers_the_span(spark):
    df = spark.createDataFrame([(date(2024, 2, 27),), (date(2024, 3, 3),)], "d date")
    found = [tuple(r) for r in portfolio.dim_date(df, "d").orderBy("date_key").collect()]
    assert len(found) == 6
    assert found[2] == (20240229, date(2024, 2, 29), 2024, 1, 2, 29, 4, False)
    assert found[-1][-2:] == (7, True)


def test_vintage_curve_accumulates(spark, rows):
    d = date
    loans = [
        (d(2024, 1, 5), d(2024, 3, 1)),
        (d(2024, 2, 5), d(2024, 4, 30)),
        (d(2024, 3, 5), None),
        (d(2024, 3, 5), d(2024, 3, 9)),
        (d(2024, 4, 1), None),
    ]
    df = spark.createDataFrame(loans, "issue_date date, default_date date")
    assert rows(portfolio.vintage_curves(df)) == [("2024-Q1", 0, 4, 1, 1, 0.25), ("2024-Q1", 2, 4, 2, 3, 0.75)]


def test_roll_rates_follow_the_older_month(spark, rows):
    # m1 is the newest month, so the path is 0 -> 1 -> 2 -> 2 -> 0 -> 0.
    found = rows(portfolio.roll_rate(clients(spark, raw_client(1, status=(0, 0, 2, 2, 1, 0)))))
    assert found == [(0, 0, 1, 0.5), (0, 1, 1, 0.5), (1, 2, 1, 1.0), (2, 0, 1, 0.5), (2, 2, 1, 0.5)]


def test_overview_and_expected_loss(spark, rows):
    loans = spark.createDataFrame(
        [("current", 100.0, 5.0), ("current", 300.0, 9.0), ("late", 50.0, 1.0), ("empty", 0.0, 1.0)],
        "loan_status string, principal double, int_rate double",
    )
    assert rows(portfolio.portfolio_overview(loans)) == [
        ("current", 2, 400.0, 8.0, 0.5), ("empty", 1, 0.0, None, 0.25), ("late", 1, 50.0, 1.0, 0.25),
    ]
    scores = spark.createDataFrame([(1, 0.1), (2, 0.5), (9, 0.9)], "client_id int, pd_xgboost double")
    dim = spark.createDataFrame([(1, "x", 1000), (2, "y", 600)], "client_id int, credit_limit_band string, credit_limit int")
    assert rows(portfolio.expected_loss_share(scores, dim)) == [("x", 100.0, 0.25), ("y", 300.0, 0.75)]


def test_volume_outside_the_band(spark):
    start = date(2024, 1, 1)
    counts = [100, 100, 114, 200]
    df = spark.createDataFrame([("feed", start + timedelta(days=i), n) for i, n in enumerate(counts)], "source string, day date, row_count long")
    found = monitoring.volume_band(df, 0.15).orderBy("day").collect()
    assert [r.within_band for r in found] == [True, True, True, False]
    assert [r.row_delta for r in found] == [None, 0, 14, 86]
    raw = spark.createDataFrame([(start, "a"), (start, "a"), (start, "b")], "d date, s string")
    from pyspark.sql import functions as F

    assert monitoring.daily_volume(raw, F.col("d"), F.col("s")).count() == 2


def test_null_rates(spark, rows):
    df = spark.createDataFrame([(1, None), (2, 1), (3, 1), (4, 1)], "a int, b int")
    assert rows(monitoring.null_rate(df, 0.2)) == [("a", 0, 4, 0.0, True), ("b", 1, 4, 0.25, False)]


def test_schema_drift(spark, rows):
    df = spark.createDataFrame([("1", "x"), ("oops", "y"), (None, "z")], "loan_id string, extra string")
    assert rows(monitoring.schema_check(df, TAPE)) == [
        ("extra", None, "string", "unexpected", 3, 0),
        ("grade", "string", None, "missing", 0, 0),
        ("loan_id", "int", "string", "type_changed", 2, 1),
        ("rate", "double", None, "missing", 0, 0),
    ]
    with pytest.raises(schemas.SchemaDrift, match="rate"):
        schemas.require_schema(df, TAPE)
    assert schemas.require_schema(df, df.schema) is df


def test_anomaly_needs_a_spread(spark):
    start = date(2024, 1, 1)
    values = [10.0, 10.0, 11.0, 9.0, 10.0, 30.0]
    df = spark.createDataFrame([("m", start + timedelta(days=i), v) for i, v in enumerate(values)], "metric string, day date, value double")
    found = monitoring.dq_anomaly(df).orderBy("day").collect()
    assert [r.is_anomaly for r in found] == [False] * 5 + [True]
    assert found[1].z_score is None


def test_dashboard_queries(spark, rows):
    found = clients(
        spark,
        raw_client(0, limit=10_000, flag=1, status=(1, 0, 0, 0, 0, 0)),
        raw_client(1, limit=400_000),
        raw_client(2, limit=0),
    )
    dim, features = gold.dim_borrower(found), gold.feature_default_prediction(found)
    assert tuple(serving.portfolio_kpis(features).first()) == (3, 410_000, 410_000 / 3, 1 / 3)
    assert [tuple(r) for r in serving.borrowers_by_limit_band(dim).collect()] == [("<50k", 2), ("300k+", 1)]
    assert [tuple(r) for r in serving.borrowers_by_region(dim).collect()] == [("east", 1), ("north", 1), ("south", 1)]
    trend = [tuple(r) for r in serving.delinquency_trend(gold.fct_payment_history(found)).collect()]
    assert [t[0] for t in trend] == ["m1", "m2", "m3", "m4", "m5", "m6"]
    assert trend[0][1] == pytest.approx(1 / 3) and trend[0][2] == pytest.approx((0.06 + 0.0015) / 2)
    mart = gold.mart_portfolio_risk(gold.labelled_borrowers(found))
    assert [r[0] for r in serving.segment_dimensions(mart).collect()] == sorted(gold.SEGMENT_DIMENSIONS)
    assert [r.segment_value for r in serving.segment_detail(mart).collect()] == ["<50k", "300k+"]


def test_score_buckets_round_half_to_even(spark):
    df = spark.createDataFrame([(s,) for s in (0.0, 0.04, 0.25, 0.35, 0.95, 1.0)], "pd_xgboost double")
    # 2.5 and 3.5 go to 2 and 4, 9.5 to 10.
    assert [tuple(r) for r in serving.pd_histogram(df).collect()] == [(0.0, 2), (0.2, 1), (0.4, 1), (1.0, 2)]


def test_top_risk_breaks_ties_by_client(spark):
    scores = spark.createDataFrame([(i, 0.5, 0) for i in range(40, 0, -1)], "client_id int, pd_xgboost double, is_default int")
    dim = spark.createDataFrame([(i, "b", "a", "r") for i in range(2, 41)], "client_id int, credit_limit_band string, age_band string, region string")
    assert [r.client_id for r in serving.top_risk_borrowers(scores, dim).collect()] == list(range(2, 17))


def test_survival_with_censoring(spark, rows):
    """The textbook product over loans that default, close or stay open."""
    day = lambda m, d=10: date(2024, m, d)
    loans = [
        (1, day(1), day(2), None), (2, day(1), None, None), (3, day(2), day(5), None), (4, day(2), None, day(4)),
        (5, day(3), day(11), None), (6, day(3), day(3), day(9)), (7, day(9), None, None), (8, None, None, None),
        (9, day(1), day(4), day(3)),
    ]
    df = spark.createDataFrame(loans, "loan_id int, issue_date date, default_date date, closed date")
    found = {(r.cohort, r.months_on_book): r for r in portfolio.survival_curves(df, "2024-08-01", closed="closed").collect()}
    # Ages: 1 defaults at 1, 2 open at 7, 3 defaults at 3, 4 closed at 2, 5 open at 5, 6 defaults at 0, 9 closed at 2.
    exits = [(1, True), (7, False), (3, True), (2, False), (5, False), (0, True), (2, False)]
    left = 1.0
    for m in sorted({m for m, _ in exits}):
        risk, lost = sum(a >= m for a, _ in exits), sum(a == m and e for a, e in exits)
        left *= 1 - lost / risk
        got = found["2024-Q1", m]
        assert (got.at_risk, got.defaults, got.censored) == (risk, lost, sum(a == m and not e for a, e in exits))
        assert (got.hazard, got.survival) == (round(lost / risk, 6), round(left, 6))
    assert {c for c, _ in found} == {"2024-Q1"}
    everyone = portfolio.survival_curves(df.filter("loan_id = 1"), "2024-08-01").collect()
    assert [(r.hazard, r.survival) for r in everyone] == [(1.0, 0.0)]
    assert portfolio.survival_curves(df.limit(0), "2024-08-01").count() == 0


def test_default_by_horizon_is_the_chains_power(spark):
    counts = {(0, 0): 70, (0, 1): 25, (0, 3): 5, (1, 0): 30, (1, 2): 20, (2, 4): 10, (2, 1): 10, (4, 0): 50, (5, None): 3}
    rolls = spark.createDataFrame([(a, b, n) for (a, b), n in counts.items()], "from_status int, to_status int, n_moves long")
    found = {(r.from_status, r.months): r.default_probability for r in portfolio.default_horizon(rolls, 6, 3).collect()}

    def chance(state, months):
        if state >= 3:
            return 1.0
        if not months:
            return 0.0
        ways = [(b, n) for (a, b), n in counts.items() if a == state and b is not None]
        return sum(n * chance(b, months - 1) for b, n in ways) / sum(n for _, n in ways)

    assert set(found) == {(s, m) for s in (0, 1, 2) for m in range(1, 7)}
    assert all(p == pytest.approx(chance(s, m)) for (s, m), p in found.items())
    none = portfolio.default_horizon(rolls.limit(0), 3, 3)
    assert none.count() == 0
