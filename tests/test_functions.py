import math

import duckdb
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lendscope import functions as fn

TIES = [0.00015, 1.005, 0.12345, 2.5, -2.5, 0.5, -0.5, 0.0, 0.49999999999999994, 1e-9, 123456.78905]


def column(spark, values, kind="double"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")


def values(df):
    return [r.v for r in df.orderBy("i").collect()]


def duckdb_round(numbers, digits):
    con = duckdb.connect()
    con.register("given", pd.DataFrame({"x": numbers}))
    return [r[0] for r in con.execute(f"select round(x, {digits}) from given").fetchall()]


@pytest.mark.parametrize("digits", [0, 2, 4])
def test_round_matches_duckdb_on_ties(spark, digits):
    mine = values(column(spark, TIES).select("i", fn.round_half_away(F.col("x"), digits).alias("v")))
    assert mine == duckdb_round(TIES, digits)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e9, 1e9), min_size=1, max_size=200))
def test_round_matches_duckdb(spark, numbers):
    mine = values(column(spark, numbers).select("i", fn.round_half_away(F.col("x"), 4).alias("v")))
    assert mine == duckdb_round(numbers, 4)


def test_round_passes_what_cannot_be_rounded(spark):
    odd = [float("inf"), float("-inf"), 1e300, float("nan"), None]
    got = values(column(spark, odd).select("i", fn.round_half_away(F.col("x"), 4).alias("v")))
    assert got[:3] == odd[:3] and math.isnan(got[3]) and got[4] is None


def test_int_and_metric_rounding_take_the_even_neighbour(spark):
    got = values(column(spark, [2.5, 3.5, 2.7, -2.5]).select("i", fn.to_int_half_even(F.col("x")).alias("v")))
    assert got == [2, 4, 3, -2]
    got = values(column(spark, [0.03125, 0.09375]).select("i", fn.round_half_even(F.col("x"), 4).alias("v")))
    assert got == [0.0312, 0.0938]


def test_guarded_ratio(spark):
    df = spark.createDataFrame([(0, 1.0, 3), (1, 1.0, 0), (2, 1.0, -5), (3, None, 4), (4, 1.0, None)], "i int, a double, b int")
    got = values(df.select("i", fn.guarded_ratio(F.col("a"), F.col("b")).alias("v")))
    assert got == [0.3333, None, None, None, None]


def test_bands_at_their_edges(spark):
    ages = [29, 30, 39, 40, 49, 50, 59, 60, None]
    got = values(column(spark, ages, "int").select("i", fn.age_band(F.col("x")).alias("v")))
    assert got == ["<30", "30-39", "30-39", "40-49", "40-49", "50-59", "50-59", "60+", "60+"]
    limits = [-1, 0, 49_999, 50_000, 149_999, 150_000, 299_999, 300_000, None]
    got = values(column(spark, limits, "int").select("i", fn.credit_limit_band(F.col("x")).alias("v")))
    assert got == ["<50k"] * 3 + ["50k-150k"] * 2 + ["150k-300k"] * 2 + ["300k+"] * 2


def test_labels_and_regions(spark):
    codes = [0, 1, 2, 3, 4, None]
    df = column(spark, codes, "int")
    assert values(df.select("i", fn.sex(F.col("x")).alias("v"))) == [
        "unknown", "male", "female", "unknown", "unknown", "unknown",
    ]
    assert values(df.select("i", fn.education_level(F.col("x")).alias("v"))) == [
        "other_unknown", "graduate_school", "university", "high_school", "other_unknown", "other_unknown",
    ]
    assert values(df.select("i", fn.marital_status(F.col("x")).alias("v"))) == [
        "unknown", "married", "single", "other", "unknown", "unknown",
    ]
    ids = column(spark, [-1, 0, 1, 2, 3, 4, None], "int")
    assert values(ids.select("i", fn.region(F.col("x")).alias("v"))) == [
        "west", "north", "south", "east", "west", "north", "west",
    ]


def test_masks(spark):
    mails = ["jane@x.com", "", "nobody", "a@b@c", None]
    df = column(spark, mails, "string")
    assert values(df.select("i", fn.mask(F.col("x"), "email").alias("v"))) == [
        "****@x.com", "****", "****", "****@b@c", None,
    ]
    assert set(values(df.select("i", fn.mask(F.col("x"), "ip").alias("v")))) == {"***.***.***.***"}
    assert set(values(df.select("i", fn.mask(F.col("x")).alias("v")))) == {"***MASKED***"}
    nothing = df.select(fn.mask(F.col("x"), "null").alias("a"), fn.mask(F.col("x"), "null_int").alias("b"))
    assert nothing.dtypes == [("a", "string"), ("b", "int")]
    assert {tuple(r) for r in nothing.collect()} == {(None, None)}
