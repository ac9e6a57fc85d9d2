"""Boosted trees on Spark against a plain fit, one node and one candidate at a time."""

import math
import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendscope.operators import boosting
from lendscope.operators.boosting import Settings
from lendscope.plans import model


def table(n=240, seed=5):
    rng = np.random.default_rng(seed)
    x = np.stack([rng.normal(size=n), rng.integers(0, 4, n), rng.random(n) ** 3, np.full(n, 7.0), rng.integers(0, 2, n)], axis=1)
    y = (rng.random(n) < 1 / (1 + np.exp(-(x[:, 0] + (x[:, 1] == 2) * 2 - x[:, 4])))).astype(float)
    return np.round(x, 6), y


def frame(spark, x, y, parts):
    rows = [(i, float(label), [float(v) for v in row]) for i, (row, label) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "key long, label double, features array<double>").repartition(parts)


def keys(spark, n, seed):
    found = spark.range(n).select("id", F.xxhash64(F.lit(seed), "id").alias("h")).collect()
    return np.array([r.h for r in sorted(found)], np.int64).view(np.uint64)


def plain_fit(x, y, key, s):
    """Every candidate of every node tried in turn; probabilities of all rows."""
    d = x.shape[1]
    edges = []
    for column in x.T:
        values = sorted(set(column))
        if len(values) > s.bins:
            values = sorted({sorted(column)[math.floor(q * (len(column) - 1))] for q in np.linspace(0, 1, s.bins + 1)[1:-1]})
        edges.append([v for v in values if v < max(column)])
    share = y.mean()
    margin = [math.log(share / (1 - share))] * len(y)
    for t in range(s.rounds):
        drawn = boosting._drawn(key, t, s.rows)
        columns = sorted(np.random.default_rng([s.seed, t]).permutation(d)[: max(1, round(d * s.columns))])
        p = [1 / (1 + np.exp(-m)) for m in margin]
        g = [round(float(q - v) * 2**24) for q, v in zip(p, y)]
        h = [round(float(q * (1 - q)) * 2**24) for q in p]

        def worth(rows):
            a, b = sum(g[i] for i in rows) / 2**24, sum(h[i] for i in rows) / 2**24
            return a * a / (b + s.ridge), b, -s.rate * a / (b + s.ridge)

        def grow(seen, everyone, depth):
            best = (1e-6, None, None)
            for f in columns if depth < s.depth else ():
                for edge in edges[f]:
                    left = [i for i in seen if x[i, f] <= edge]
                    right = [i for i in seen if x[i, f] > edge]
                    a, b = worth(left), worth(right)
                    gain = a[0] + b[0] - worth(seen)[0]
                    if min(a[1], b[1]) >= s.least and gain > best[0] + 1e-12:
                        best = (gain, f, edge)
            if best[1] is None:
                value = worth(seen)[2]
                for i in everyone:
                    margin[i] += value
                return
            for side in (True, False):
                keep = [[i for i in rows if (x[i, best[1]] <= best[2]) == side] for rows in (seen, everyone)]
                grow(*keep, depth + 1)

        grow([i for i in range(len(y)) if drawn[i]], list(range(len(y))), 0)
    return 1 / (1 + np.exp(-np.array(margin)))


@pytest.mark.parametrize(
    ("settings", "parts"),
    [(Settings(rounds=4, depth=3, rate=0.3, bins=16), 1), (Settings(rounds=3, depth=2, rate=0.5, rows=1.0, columns=0.5, seed=3), 5)],
)
def test_fit_is_the_plain_fit(spark, settings, parts):
    x, y = table()
    want = plain_fit(x, y, keys(spark, len(y), settings.seed), settings)
    trees = boosting.fit(frame(spark, x, y, parts), settings)
    assert len(trees.value) == settings.rounds
    assert trees.probability(x) == pytest.approx(want, abs=1e-12)


def test_any_dealing_gives_one_model(spark, monkeypatch):
    x, y = table(600)
    settings = Settings(rounds=7, depth=4, rate=0.2)
    fits = [boosting.fit(frame(spark, x, y, 2), settings)]
    monkeypatch.setattr(boosting, "BLOCK", 50)
    for keep, few, parts in ((3, 64, 1), (100, 2, 7)):
        monkeypatch.setattr(boosting, "KEEP", keep)
        monkeypatch.setattr(boosting, "_FEW", few)
        fits.append(boosting.fit(frame(spark, x, y, parts).orderBy(F.rand(1)), settings))
    for other in fits[1:]:
        for c in ("feature", "threshold", "value"):
            assert (getattr(fits[0], c) == getattr(other, c)).all()


def test_scores_and_saved_trees(spark, tmp_path):
    x, y = table(400)
    x[::50, 0] = np.nan
    df = frame(spark, x, y, 3)
    trees = boosting.fit(df, Settings(rounds=20, rate=0.3))
    p = trees.probability(x)
    order = np.argsort(p)
    assert y[order[-100:]].mean() > y[order[:100]].mean() + 0.4
    trees.save(spark, str(tmp_path / "t"))
    again = boosting.Trees.load(spark, str(tmp_path / "t"))
    found = {r.key: r.p for r in df.select("key", again.score("features").alias("p")).collect()}
    assert [found[i] for i in range(len(y))] == p.tolist()


def test_hard_tables(spark):
    schema = "key long, label double, features array<double>"
    none = boosting.fit(spark.createDataFrame([], schema), Settings(rounds=2))
    assert none.base == 0 and len(none.value) == 0
    same = [(i, 1.0, [float(i)]) for i in range(5)] + [(None, 0.0, [1.0]), (9, None, [1.0])]
    # Rows without a label are left out; a null key is a key like any other.
    mixed = boosting.fit(spark.createDataFrame(same, schema), Settings(rounds=2, rows=1.0, least=0.0))
    assert mixed.base == pytest.approx(math.log(5))
    ones = boosting.fit(spark.createDataFrame(same[:5], schema), Settings(rounds=2))
    assert ones.probability(np.array([[1.0]]))[0] > 0.99 and len(ones.value) == 0
    constant = boosting.fit(spark.createDataFrame([(i, float(i % 2), [3.0]) for i in range(10)], schema), Settings(rounds=2, rows=1.0))
    assert constant.probability(np.array([[3.0]]))[0] == pytest.approx(0.5)


def test_gradient_sums_are_exact_at_any_size():
    key = np.arange(100_000, dtype=np.uint64)
    block = boosting.Block(np.zeros((100_000, 1), np.int32), np.zeros(100_000), key, np.full(100_000, 3.0))
    tree = boosting._Tree(np.zeros(1, np.int64), np.full(1, 2), np.zeros(2))
    settings = Settings(depth=1, rows=1.0)
    whole = boosting.histograms(block, [], tree, 0, 2, 0, settings)
    p = 1 / (1 + np.exp(-3.0))
    assert whole[0, 0].tolist() == [100_000 * round(p * 2**24), 100_000 * round(p * (1 - p) * 2**24)]


def test_features_of_few_bins_are_counted_together(spark, monkeypatch):
    """Twenty flags and one number in 40 partitions: four groups of cells, as many tasks as there are cores."""
    rng = np.random.default_rng(9)
    x = np.concatenate([rng.integers(0, 2, (900, 20)), rng.normal(size=(900, 1))], axis=1).round(4)
    y = (rng.random(900) < 1 / (1 + np.exp(-(x[:, 0] + x[:, 20])))).astype(float)
    settings, seen = Settings(rounds=5, depth=3, rate=0.3), []
    alone = boosting.fit(frame(spark, x, y, 2), settings)
    together = boosting._together
    monkeypatch.setattr(boosting, "BLOCK", 100)
    monkeypatch.setattr(boosting, "_together", lambda blocks, *a: seen.append(blocks) or together(blocks, *a))
    spread = boosting.fit(frame(spark, x, y, 40), settings)
    assert seen[0].getNumPartitions() == spark.sparkContext.defaultParallelism
    assert seen[0].map(lambda b: b.bins.shape[1]).distinct().collect() == [4]
    for c in ("feature", "threshold", "value"):
        assert (getattr(alone, c) == getattr(spread, c)).all()


def test_sums_by_cell_are_sums_by_bin():
    rng = np.random.default_rng(2)
    sizes = np.array([2, 1, 300, 2, 5, 40])
    bins = np.stack([rng.integers(0, n, 500) for n in sizes], axis=1)
    layout = boosting.Layout(np.concatenate([[0], np.cumsum(sizes)]))
    settings, n = Settings(depth=2, rows=1.0), len(bins)
    label = rng.integers(0, 2, n).astype(float)
    block = boosting.Block(layout.cells_of(bins), label, rng.integers(0, 99, n).astype(np.uint64), rng.normal(size=n))
    tree = layout.tree(3)
    layout.split(tree, 0, 4, int(layout.starts[4]) + 1)
    found = layout.by_bin(boosting.histograms(block, [], tree, 1, layout.cells, 0, settings))
    p = 1 / (1 + np.exp(-block.margin))
    for node in range(2):
        own = (bins[:, 4] > 1) == bool(node)
        for f, size in enumerate(sizes):
            for b in range(size):
                rows = own & (bins[:, f] == b)
                want = [np.rint(w[rows] * 2**24).sum() for w in (p - label, p * (1 - p))]
                assert found[node, layout.starts[f] + b].tolist() == want
    # A skipped node's sums are what its parent has more than its sibling.
    parent = boosting.histograms(block, [], tree, 0, layout.cells, 0, settings)
    one = boosting.histograms(block, [], tree, 1, layout.cells, 0, settings, np.array([False, True]))
    assert (one[1] == 0).all() and (layout.by_bin(parent - one[:1])[0] == found[1]).all()


def test_one_task_fits_up_to_its_cells(spark, monkeypatch):
    """60,000 rows of two features need no job for each level; a table of more cells has one, with the same model."""
    rows = spark.range(60_000).selectExpr(
        "id as key", "cast(id * 7919 % 100 < id % 50 as double) as label", "array(id % 50, id * 7919 % 37) as features"
    )
    settings, seen = Settings(rounds=3, depth=3, rate=0.3), []
    together = boosting._together
    monkeypatch.setattr(boosting, "_together", lambda *a: seen.append(1) or together(*a))
    alone = boosting.fit(rows, settings)
    assert not seen
    monkeypatch.setattr(boosting, "ALONE", 119_999)
    spread = boosting.fit(rows, settings)
    assert seen
    for c in ("feature", "threshold", "value"):
        assert (getattr(alone, c) == getattr(spread, c)).all()


def test_both_models_are_fitted_side_by_side(spark, monkeypatch):
    rows = spark.range(200).selectExpr(
        "id as client_id", "cast(id % 3 = 0 as int) as is_default",
        *[f"cast(id * 7919 % {i + 5} as double) as {c}" for i, c in enumerate(model.NUMERIC_FEATURES)],
        *[f"cast(id % 3 as string) as {c}" for c in model.CATEGORICAL_FEATURES],
    )
    apart = {name: model.fit_models(rows, 2, only=(name,))[name] for name, _ in model.MODELS}
    both = threading.Barrier(2, timeout=60)

    def meeting(fit):
        def met(*a):
            both.wait()  # broken unless the other model is fitted at the same time
            return fit(*a)

        return met

    monkeypatch.setattr(model, "logistic_regression", meeting(model.logistic_regression))
    monkeypatch.setattr(model.boosting, "fit", meeting(model.boosting.fit))
    found = model.fit_models(rows, 2)
    assert list(found) == ["logreg", "xgboost"]
    assert (found["xgboost"].trees.value == apart["xgboost"].trees.value).all()
    assert found["logreg"].stages[-1].intercept == pytest.approx(apart["logreg"].stages[-1].intercept)
