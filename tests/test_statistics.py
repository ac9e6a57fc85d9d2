"""Order statistics, metrics and models against plain numpy."""

import hashlib
import json
import math
from collections import Counter

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from lendscope.operators import metrics, preprocess, ranking
from lendscope.plans import model, publish

QUIET = {"max_examples": 10, "deadline": None, "suppress_health_check": [HealthCheck.function_scoped_fixture]}


def numbers(spark, values, name="x"):
    return spark.createDataFrame([(v,) for v in values], f"{name} double")


@settings(**QUIET)
@given(st.lists(st.one_of(st.none(), st.integers(-3, 3), st.floats(-100, 100)), min_size=1, max_size=80))
def test_quantiles_match_numpy(spark, values):
    values = [None if v is None else float(v) for v in values]
    known = [v for v in values if v is not None]
    probabilities = [0.0, 0.1, 0.5, 0.73, 1.0]
    found = ranking.exact_quantiles(numbers(spark, values), ["x"], probabilities)["x"]
    if known:
        assert found == pytest.approx(list(np.quantile(known, probabilities)), rel=1e-12, abs=1e-12)
    else:
        assert found == [None] * 5


def test_quantiles_with_one_dominant_value(spark):
    rng = np.random.default_rng(3)
    values = np.concatenate([np.zeros(20_000), rng.normal(size=40_001)])
    df = numbers(spark, values.tolist()).withColumn("y", -F.col("x"))
    found = ranking.exact_quantiles(df, ["x", "y"], [0.25, 0.5, 0.9])
    assert found["x"] == pytest.approx(list(np.quantile(values, [0.25, 0.5, 0.9])), abs=1e-15)
    assert found["y"] == pytest.approx(list(np.quantile(-values, [0.25, 0.5, 0.9])), abs=1e-15)


def test_running_totals_across_many_slices(spark):
    rng = np.random.default_rng(5)
    scores = np.where(rng.random(5_000) < 0.33, 0.5, rng.random(5_000).round(3))
    data = [("ab"[i % 2], float(s), 1) for i, s in enumerate(scores)]
    df = spark.createDataFrame(data, "g string, s double, one long")
    found = ranking.running_totals(df, "s", ["one"], by=["g"], slices=64).collect()
    for group in "ab":
        counts = Counter(s for g, s, _ in data if g == group)
        upto, expected = 0, {}
        for s in sorted(counts, reverse=True):
            upto += counts[s]
            expected[s] = (counts[s], upto)
        assert {r.s: (r.one, r.cum_one) for r in found if r.g == group} == expected


def test_split_is_exact_and_repeatable(spark):
    labels = {i: int(i % 7 == 0) for i in range(1003)}
    df = spark.createDataFrame(list(labels.items()), "k int, y int")
    found = {r.k: r.is_test for r in ranking.stratified_split(df, "k", "y").collect()}
    again = {r.k: r.is_test for r in ranking.stratified_split(df.repartition(7), "k", "y").collect()}
    assert found == again
    assert sum(found.values()) == math.ceil(1003 / 4)

    def number(k):
        return int(hashlib.md5(f"42-{k}".encode()).hexdigest()[:15], 16)

    for label in (0, 1):
        members = sorted((k for k in labels if labels[k] == label), key=lambda k: (number(k), k))
        size = sum(found[k] for k in members)
        assert abs(size - len(members) / 4) <= 1
        assert {k for k in members if found[k]} == set(members[:size])


def test_split_of_small_and_empty_frames(spark):
    one = spark.createDataFrame([(1, 0)], "k int, y int")
    assert ranking.stratified_split(one, "k", "y").first().is_test is True
    assert ranking.stratified_split(one.limit(0), "k", "y").count() == 0
    missing = spark.createDataFrame([(i, None if i % 2 else 1) for i in range(8)], "k int, y int")
    found = ranking.stratified_split(missing, "k", "y").collect()
    assert sum(r.is_test for r in found) == 2 and {r.y for r in found if r.is_test} == {None, 1}


def long_frame(spark, scores, labels):
    rows = [("m", float(s), int(y)) for s, y in zip(scores, labels)]
    return spark.createDataFrame(rows, "model string, score double, label int")


@settings(**QUIET)
@given(st.lists(st.tuples(st.integers(0, 6), st.integers(0, 1)), min_size=2, max_size=60))
def test_rank_metrics_match_brute_force(spark, pairs):
    scores, labels = [s / 6 for s, _ in pairs], [y for _, y in pairs]
    found = metrics.rank_metrics(metrics.roc_points(long_frame(spark, scores, labels))).first()
    good = [s for s, y in zip(scores, labels) if y]
    bad = [s for s, y in zip(scores, labels) if not y]
    if not good or not bad:
        assert found.auc is None
        return
    wins = sum((g > b) + 0.5 * (g == b) for g in good for b in bad)
    gaps = [np.mean(np.array(good) >= t) - np.mean(np.array(bad) >= t) for t in scores]
    assert found.auc == pytest.approx(wins / len(good) / len(bad))
    assert found.ks == pytest.approx(max(0.0, *gaps))


def test_auc_equals_the_built_in_evaluator(spark):
    rng = np.random.default_rng(8)
    labels = rng.integers(0, 2, 3000)
    scores = (rng.random(3000) + 0.3 * labels).round(2)
    df = long_frame(spark, scores, labels)
    built_in = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0)
    mine = metrics.rank_metrics(metrics.roc_points(df)).first().auc
    assert mine == pytest.approx(built_in.evaluate(df), abs=1e-12)


def test_equal_scores_separate_nothing(spark):
    found = metrics.rank_metrics(metrics.roc_points(long_frame(spark, [0.4] * 6, [0, 1, 0, 1, 1, 0]))).first()
    assert (found.auc, found.ks) == (0.5, 0.0)


def test_calibration_matches_numpy(spark):
    rng = np.random.default_rng(11)
    p = np.where(rng.random(997) < 0.4, 0.2, rng.random(997).round(3))
    y = (rng.random(997) < p).astype(int)
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(p, y)], "pd double, is_default int")
    slot = np.searchsorted(np.percentile(p, np.arange(10, 100, 10)), p)
    expected = [
        (i + 1, round(float(p[slot == s].mean()), 4), round(float(y[slot == s].mean()), 4))
        for i, s in enumerate(np.unique(slot))
    ]
    found = [tuple(r) for r in metrics.calibration_deciles(df, "pd").orderBy("bin").collect()]
    assert len(expected) < 10
    assert [f[0] for f in found] == [e[0] for e in expected]
    assert np.allclose([f[1:] for f in found], [e[1:] for e in expected], atol=1.01e-4)


def test_champion_tie_goes_to_the_first_listed(spark):
    tied = spark.createDataFrame([("xgboost", 0.7), ("logreg", 0.7)], "model string, auc double")
    assert metrics.champion_model(tied, ["logreg", "xgboost"]).first().model == "logreg"
    clear = spark.createDataFrame([("xgboost", 0.71), ("logreg", 0.7)], "model string, auc double")
    assert metrics.champion_model(clear, ["logreg", "xgboost"]).first().model == "xgboost"


def test_median_averages_the_middle_and_fills(spark):
    df = numbers(spark, [1.0, 2.0, 3.0, 10.0, None, float("nan")])
    medians = preprocess.fit_medians(df, ["x"])
    assert medians == {"x": 2.5}
    assert preprocess.median_impute(df, medians).filter("x = 2.5").count() == 2
    assert preprocess.fit_medians(df, ["x"], exact=False)["x"] in (2.0, 3.0)


def test_scaling_uses_the_population_deviation(spark):
    df = numbers(spark, [1.0, 2.0, 3.0, 10.0]).withColumn("c", F.lit(5.0))
    scaling = preprocess.fit_scaling(df, ["x", "c"])
    assert scaling["x"] == pytest.approx((4.0, np.std([1, 2, 3, 10])))
    assert scaling["c"] == (5.0, 1.0)
    assert {r.c for r in preprocess.standard_scale(df, scaling).collect()} == {0.0}


def test_one_hot_of_unseen_and_missing_is_all_zeros(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    seen = spark.createDataFrame([("a",), ("b",), ("c",)], "x string")
    fitted = Pipeline(stages=preprocess.one_hot_stages(["x"])).fit(seen)
    new = spark.createDataFrame([("b",), ("z",), (None,)], "x string")
    found = fitted.transform(new).select("x", vector_to_array("x_onehot").alias("v")).collect()
    assert {r.x: list(r.v) for r in found} == {"b": [0, 1, 0], "z": [0, 0, 0], None: [0, 0, 0]}


@pytest.fixture(scope="module")
def features(spark):
    rng = np.random.default_rng(17)
    rows = []
    for i in range(600):
        late = int(rng.integers(-2, 4))
        ratio = None if i % 50 == 0 else float(rng.random())
        rows.append(
            (i, int(rng.integers(1, 9)) * 10_000, int(rng.integers(20, 70)), 1 + i % 2, 1 + i % 4, 1 + i % 3,
             late / 2, late, max(late, 0), float(rng.random() * 1e5), float(rng.random() * 1e4), float(rng.random()),
             "<30", "<50k", int(rng.random() < (0.8 if late > 1 else 0.1)), ratio)
        )
    return spark.createDataFrame(
        rows,
        "client_id int, credit_limit int, age int, sex_code int, education_code int, marriage_code int, "
        "avg_repay_status double, max_repay_status int, months_delinquent int, total_bill_amt double, "
        "total_pay_amt double, avg_utilization double, age_band string, credit_limit_band string, is_default int, "
        "pay_to_bill_ratio double",
    )


def test_models_score_everyone_and_survive_saving(spark, features, tmp_path):
    parted = model.split(features)
    fitted = model.fit_models(parted.filter("not is_test"), rounds=5)
    scores = model.model_scores(parted, fitted)
    assert scores.columns == ["client_id", "pd_logreg", "pd_xgboost", "is_default", "is_test"]
    assert scores.filter("pd_logreg between 0 and 1 and pd_xgboost between 0 and 1").count() == 600

    root = str(tmp_path / "models")
    with pytest.raises(Exception):
        model.load_models(root)
    model.save_models(fitted, root)
    again = model.model_scores(parted, model.load_models(root))
    first = {r.client_id: (r.pd_logreg, r.pd_xgboost) for r in scores.collect()}
    assert {r.client_id: (r.pd_logreg, r.pd_xgboost) for r in again.collect()} == first

    long = metrics.long_scores(scores.filter("is_test"), model.MODELS)
    table = metrics.model_metrics(long)
    assert all(r.auc > 0.7 and 0 < r.brier < 0.25 for r in table.collect())
    target = str(tmp_path / "metrics")
    publish.write_metrics(table, metrics.champion_model(table, ["logreg", "xgboost"]), target)
    record = json.loads(spark.read.text(target).first()[0])
    assert set(record) == {"champion", "models"} and set(record["models"]) == {"logreg", "xgboost"}


def test_penalty_is_one_over_the_training_rows():
    assert model.logistic_regression(400).getRegParam() == 1 / 400
    trees = model.boosted_trees()
    assert (trees.rounds, trees.depth, trees.rate, trees.rows, trees.columns) == (300, 4, 0.05, 0.9, 0.9)


def test_segment_report_and_drift(spark):
    rows = [("a", 0.2, 0), ("a", 0.4, 1), ("b", 0.9, 1)]
    df = spark.createDataFrame(rows, "credit_limit_band string, pd double, is_default int")
    assert [tuple(r) for r in metrics.segment_pd_report(df, "pd").collect()] == [("b", 1, 0.9, 1.0), ("a", 2, 0.3, 0.5)]
    base = numbers(spark, [i / 100 for i in range(100)], "pd")
    assert metrics.score_drift(base, base, "pd").agg(F.sum("psi")).first()[0] == pytest.approx(0)
    moved = base.withColumn("pd", F.col("pd") / 2 + 0.5)
    assert metrics.score_drift(base, moved, "pd").agg(F.sum("psi")).first()[0] > 0.5
