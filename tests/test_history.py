"""Facts compared by content, and histories of snapshots that come late."""

import random
from datetime import date, datetime, timedelta
from itertools import permutations

import pytest

from lendscope.plans import history
from lendscope.sources.files import latest_partition

FACT = "k long, amount double, day date"


def fact(spark, rows):
    return spark.createDataFrame([(k, float(a), None if d is None else date(2024, 1, d)) for k, a, d in rows], FACT)


def stored(spark, path):
    rows = spark.read.schema(FACT).parquet(path).collect()
    return sorted(((r.k, r.amount, r.day and r.day.day) for r in rows), key=repr)


def as_rows(rows):
    return sorted(((k, float(a), d) for k, a, d in rows), key=repr)


def test_days_are_compared_by_content(spark, tmp_path):
    path = str(tmp_path / "fact")
    first = [(1, 10, 1), (2, 20, 1), (3, 30, 2), (4, 40, 3), (5, 50, None)]
    assert history.incremental_fact(fact(spark, first), path, "day") == 5
    assert stored(spark, path) == as_rows(first)
    files = {f: f.stat().st_mtime_ns for f in (tmp_path / "fact").rglob("*.parquet")}
    assert history.incremental_fact(fact(spark, list(reversed(first))), path, "day", rewrite_newest=False) == 0

    # A changed row in a day of equal count, one without a day, a new day, and a day that is gone.
    second = [(1, 10, 1), (2, 21, 1), (3, 30, 2), (5, 51, None), (6, 60, None), (7, 70, 9)]
    changes = history.fact_changes(fact(spark, second), path, "day").collect()
    assert {(r.day and r.day.day, r.change, r.n_rows, r.before) for r in changes} == {
        (1, "changed", 2, 2), (None, "changed", 2, 1), (9, "new", 1, None), (3, "vanished", None, 1),
    }
    assert history.incremental_fact(fact(spark, second), path, "day", rewrite_newest=False) == 5
    assert stored(spark, path) == as_rows([*second, (4, 40, 3)])
    kept = [f for f in files if f.exists() and f.parent.name in ("day=2024-01-02", "day=2024-01-03")]
    assert len(kept) == 2 and all(f.stat().st_mtime_ns == files[f] for f in kept)
    assert latest_partition(spark, path, "day") == "2024-01-09"

    # The vanished day is still known, and dropped on request; so are rows without a day.
    third = [r for r in second if r[2] is not None]
    assert history.incremental_fact(fact(spark, third), path, "day", drop_vanished=True, rewrite_newest=False) == 0
    assert stored(spark, path) == as_rows(third)
    # The newest day is written again unless told otherwise.
    assert history.incremental_fact(fact(spark, third), path, "day") == 1
    assert history.fact_changes(fact(spark, third), path, "day").count() == 0


def test_two_equal_rows_do_not_cancel_out(spark, tmp_path):
    path = str(tmp_path / "fact")
    history.incremental_fact(fact(spark, [(1, 1, 1), (1, 1, 1), (2, 2, 1), (3, 3, 1)]), path, "day")
    swapped = fact(spark, [(1, 1, 1), (2, 2, 1), (2, 2, 1), (3, 3, 1)])
    assert [r.change for r in history.fact_changes(swapped, path, "day").collect()] == ["changed"]


def test_a_table_without_digests_is_read(spark, tmp_path):
    path = str(tmp_path / "fact")
    rows = [(1, 1, 1), (2, 2, None)]
    fact(spark, rows).write.partitionBy("day").parquet(path)
    assert history.fact_changes(fact(spark, rows), path, "day").count() == 0
    assert history.incremental_fact(fact(spark, [*rows, (3, 3, None)]), path, "day", rewrite_newest=False) == 2
    assert stored(spark, path) == as_rows([*rows, (3, 3, None)])
    assert history.incremental_fact(fact(spark, []), str(tmp_path / "none"), "day") == 0


def moment(n):
    return datetime(2024, 1, 1) + timedelta(days=n)


def plain_history(snapshots):
    """From all snapshots in order: a version for each run of equal values of a key."""
    seen = {}
    for n in sorted(snapshots):
        for k, a, b in snapshots[n]:
            seen.setdefault(k, []).append((n, (a, b)))
    rows = []
    for k, shown in seen.items():
        runs = []
        for n, own in shown:
            if runs and runs[-1][1] == own:
                runs[-1][2].append(n)
            else:
                runs.append([n, own, [n]])
        for i, (start, own, times) in enumerate(runs):
            end = runs[i + 1][0] if i + 1 < len(runs) else None
            rows.append((k, *own, moment(start), end if end is None else moment(end), end is None, [moment(t) for t in times]))
    return sorted(rows, key=repr)


def observed(spark, snapshots, order):
    found = None
    for n in order:
        df = spark.createDataFrame(snapshots[n], "k long, a string, b int")
        found = history.scd2_observe(found, df, "k", ["a", "b"], moment(n).isoformat(sep=" "))
        # Keep plans short.
        found = spark.createDataFrame(found.collect(), found.schema)
    rows = found.select("k", "a", "b", "valid_from", "valid_to", "is_current", "seen").collect()
    return sorted((tuple(r) for r in rows), key=repr)


HAND = {
    0: [(1, "x", 1), (2, "x", None)],
    2: [(1, "y", 1), (3, "z", 1), (None, "n", 1)],
    4: [(1, "x", 1), (2, "x", None), (3, "z", 1)],
    6: [(1, "x", 1), (2, None, None), (None, "m", 1)],
}


@pytest.mark.parametrize("order", list(permutations(HAND))[::5])
def test_any_order_of_snapshots_gives_one_history(spark, order):
    assert observed(spark, HAND, order) == plain_history(HAND)


def test_random_snapshots_in_random_order(spark):
    rng = random.Random(8)
    snapshots = {n: [(k, rng.choice("ab"), rng.choice([1, None])) for k in range(12) if rng.random() < 0.8] for n in range(7)}
    order = list(snapshots)
    rng.shuffle(order)
    assert observed(spark, snapshots, [*order, order[0]]) == plain_history(snapshots)
