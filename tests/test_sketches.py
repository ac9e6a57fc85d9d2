"""Drift from stored sketches against the exact one."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendscope.operators import sketches


def days(spark, n=12_000, seed=2):
    rng = np.random.default_rng(seed)
    x = np.concatenate([rng.normal(size=n // 2), rng.normal(0.6, 1.5, n // 2)]).round(4)
    rows = [(i * 8 // n, float(v), float(v) ** 2 if i % 3 else None) for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "day int, x double, y double"), rows


def exact_psi(old, new, bins=10):
    edges = np.unique(np.quantile(old, np.arange(1, bins) / bins, method="inverted_cdf"))
    shares = [np.bincount(np.searchsorted(edges, v, side="left"), minlength=len(edges) + 1) / len(v) for v in (old, new)]
    b, c = (np.maximum(s, 0.5 / len(v)) for s, v in zip(shares, (old, new)))
    return float(((c - b) * np.log(c / b)).sum())


@pytest.mark.parametrize("size", [256, sketches.SIZE])
def test_merged_days_give_the_drift_of_their_rows(spark, size):
    df, rows = days(spark)
    stored = sketches.value_sketches(df, ["day"], ["x", "y"], size)
    assert stored.count() == 16
    found = sketches.sketch_drift(stored.filter("day < 4"), stored.filter("day >= 4"), size=size).collect()
    for name, column in (("x", 1), ("y", 2)):
        old, new = (np.array([r[column] for r in rows if (r[0] < 4) == side and r[column] is not None]) for side in (True, False))
        own = sorted((r for r in found if r.column_name == name), key=lambda r: r.bin)
        assert [r.bin for r in own] == list(range(10)) and own[-1].upto is None
        error = 2 * sketches.RANK_ERROR * (sketches.SIZE / size) ** 0.9 + 1e-3
        for r in own[:-1]:
            for share, v in ((r.share_baseline, old), (r.share_current, new)):
                before = own[r.bin - 1].upto if r.bin else -np.inf
                assert abs(share - ((v > before) & (v <= r.upto)).mean()) <= error
        psi = sum(r.psi for r in own)
        assert psi == pytest.approx(exact_psi(old, new), abs=0.02 if size == sketches.SIZE else 0.1)
    merged = sketches.merged_sketches(stored).collect()
    assert {r.column_name: r.n for r in merged} == {"x": len(rows), "y": sum(r[2] is not None for r in rows)}


def test_few_and_missing_values(spark):
    rows = [(1, 1.0), (1, 2.0), (1, None), (1, float("nan")), (2, 2.0), (2, 2.0), (3, None)]
    df = spark.createDataFrame(rows, "day int, x double")
    stored = sketches.value_sketches(df, ["day"], ["x"])
    assert {(r.day, r.n) for r in stored.collect()} == {(1, 2), (2, 2)}
    found = sketches.sketch_drift(stored.filter("day = 1"), stored.filter("day = 2")).collect()
    shares = {r.upto: (r.share_baseline, r.share_current) for r in found}
    assert shares[1.0] == (0.5, 0.25) and shares[2.0][1] == 1.0 and all(np.isfinite(r.psi) for r in found)
    assert sketches.sketch_drift(stored.filter("day = 1"), stored.filter("day = 3")).count() == 0
    same = sketches.sketch_drift(stored, stored).agg(F.sum("psi")).first()[0]
    assert same == pytest.approx(0)
