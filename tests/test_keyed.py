"""Silver merged day by day against the dedupe of everything, and the ledger of landed files."""

import random
import threading
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lendscope.operators.dedupe import dedupe_latest
from lendscope.plans import daily
from lendscope.schemas import SchemaDrift
from lendscope.session import side_by_side
from lendscope.sources import bronze, keyed, ledger
from test_sources import feed_rows

ROWS = "k string, at long, tie string, v long, day int"
ORDER = ("at", "tie")


def frame(spark, rows):
    return spark.createDataFrame(rows, ROWS)


def drawn(rng, day, n, at=None):
    return [
        (rng.choice([None, *"abcdefghijklmnopqrstuvwxyz"]), at or rng.choice([None, day, day + 1]), f"{day}-{i:03d}", rng.randrange(99), day)
        for i in range(n)
    ]


def same(spark, root, rows):
    want = dedupe_latest(frame(spark, rows), ["k"], ORDER)
    return sorted(map(tuple, keyed.read_version(spark, root).collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_any_days_in_any_order_equal_the_full_dedupe(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keyed, "FOLDERS", 3)
    rng = random.Random(6)
    days = [drawn(rng, d, n) for d, n in enumerate((6, 14, 3, 0, 20, 5))]
    order = [2, 0, 4, 1, 3, 5, 1]
    root, seen = str(tmp_path / "t"), []
    for d in order:
        seen += days[d] if order.count(d) == 1 or days[d][0] not in seen else []
        keyed.merge_latest(frame(spark, days[d]), root, ["k"], ORDER, f"d{d}", buckets=5)
        assert same(spark, root, seen)
    assert [v[:8] for v in keyed.versions(spark, root)] == [f"{i:08d}" for i in range(1, 8)]
    # A day merged again changes no folder.
    last, before = (keyed.folders_of(spark, root, v) for v in keyed.versions(spark, root)[:-3:-1])
    assert last == before


def test_untouched_buckets_keep_their_folders(spark, tmp_path):
    root = str(tmp_path / "t")
    rows = [(f"k{i}", 1, "a", i, 1) for i in range(200)]
    first = keyed.merge_latest(frame(spark, rows), root, ["k"], ORDER, buckets=16)
    second = keyed.merge_latest(frame(spark, [("k7", 2, "b", 777, 2), ("new", 2, "b", 1, 2), ("k8", 0, "b", 888, 2)]), root, ["k"], ORDER, buckets=16)
    old, new = (set(keyed.folders_of(spark, root, v)) for v in (first, second))
    # k7 replaces a row of its bucket, the new key is added to its own, and the older k8 changes nothing.
    assert len(old - new) == 1 and 1 <= len(new - old) <= 2
    found = {r.k: r.v for r in keyed.read_version(spark, root).collect()}
    assert (found["k7"], found["new"], found["k8"], len(found)) == (777, 1, 8, 201)
    assert {r.k: r.v for r in keyed.read_version(spark, root, first).collect()}["k7"] == 7


def test_withdrawn_rows_fall_back_to_what_still_holds(spark, tmp_path):
    root = str(tmp_path / "t")
    one = [("a", 1, "x", 1, 1), ("b", 1, "x", 2, 1), ("d", 1, "x", 9, 1)]
    two = [("a", 2, "x", 3, 2), ("c", 2, "x", 4, 2)]
    keyed.merge_latest(frame(spark, one), root, ["k"], ORDER, buckets=4)
    keyed.merge_latest(frame(spark, two), root, ["k"], ORDER, buckets=4)
    again = [("b", 2, "y", 5, 2)]
    with pytest.raises(ValueError):
        keyed.merge_latest(frame(spark, again), root, ["k"], ORDER, buckets=4, withdrawn=F.col("day") == 2)
    keyed.merge_latest(
        frame(spark, again), root, ["k"], ORDER, buckets=4, withdrawn=F.col("day") == 2, history=frame(spark, one + again)
    )
    assert same(spark, root, one + again)
    # A table of nothing but withdrawn rows is empty.
    other = str(tmp_path / "o")
    keyed.merge_latest(frame(spark, two), other, ["k"], ORDER)
    keyed.merge_latest(frame(spark, []), other, ["k"], ORDER, withdrawn=F.col("day") == 2, history=frame(spark, []))
    assert keyed.read_version(spark, other).count() == 0
    with pytest.raises(LookupError):
        keyed.read_version(spark, str(tmp_path / "none"))


RUN = datetime(2024, 3, 10, 5)


def land(spark, landing, day, ids):
    path = f"{landing}/transactions/load_date={day}"
    feed_rows(spark, day, ids).drop("load_date").coalesce(1).write.mode("overwrite").parquet(path)


def load(spark, landing, root, n):
    at = RUN + timedelta(hours=n)
    done = ledger.load_pending(spark, "transactions", f"{landing}/transactions", root, f"run{n}", at)
    place = daily.merge_silver(spark, "transactions", root, f"run{n}") if done or n else None
    return done, place and daily.publish.read_place(spark, place)


def test_every_landed_day_is_loaded_once(spark, tmp_path):
    landing, root = str(tmp_path / "landing"), str(tmp_path / "lake")
    assert load(spark, landing, root, 0) == ({}, None)
    days = [date(2024, 3, d) for d in (4, 2, 6)]
    for n, day in enumerate(days):
        land(spark, landing, day, [f"t{n}", f"u{n}"])
    done, rows = load(spark, landing, root, 1)
    assert done == {"2024-03-02": 2, "2024-03-04": 2, "2024-03-06": 2}
    assert rows.count() == 6 and "_digest" not in rows.columns
    assert load(spark, landing, root, 2)[0] == {}

    # A day between the others, and one delivered again without one of its rows and with a new one.
    land(spark, landing, date(2024, 3, 3), ["late"])
    land(spark, landing, days[0], ["t0", "v0"])
    done, rows = load(spark, landing, root, 3)
    assert done == {"2024-03-03": 1, "2024-03-04": 2}
    assert sorted(r.txn_id for r in rows.collect()) == ["late", "t0", "t1", "t2", "u1", "u2", "v0"]
    table = ledger.read_ledger(spark, root)
    assert {(r.load_date, r.row_count, r.again) for r in table.filter("run = 'run3'").collect()} == {
        ("2024-03-03", 1, False), ("2024-03-04", 2, True),
    }

    # A file that only looks new is hashed, found known and not loaded.
    for file in (tmp_path / "landing").rglob("*.parquet"):
        file.touch()
    assert load(spark, landing, root, 4)[0] == {}


def test_volume_gate_reads_the_ledger(spark, tmp_path):
    landing, root = str(tmp_path / "landing"), str(tmp_path / "lake")
    for d in range(1, 10):
        land(spark, landing, date(2024, 3, d), [f"{d}-{i}" for i in range(20 if d < 9 else 5)])
    load(spark, landing, root, 1)
    with pytest.raises(daily.quality.GateFailed, match="volume of transactions on 2024-03-09"):
        daily.require_volume(spark, root, RUN, 0.15)
    daily.require_volume(spark, root, RUN, 0.9)


def test_one_odd_file_among_many_is_named(spark, tmp_path):
    landing, root = str(tmp_path / "landing"), str(tmp_path / "lake")
    for d in range(1, 5):
        land(spark, landing, date(2024, 3, d), [f"{d}"])
    odd = f"{landing}/transactions/load_date=2024-03-03"
    feed_rows(spark, date(2024, 3, 3), ["x"]).drop("load_date", "amount").coalesce(1).write.mode("append").parquet(odd)
    with pytest.raises(SchemaDrift, match="part-.*parquet: amount missing"):
        load(spark, landing, root, 1)
    # The days before it were loaded, nothing of its day was.
    assert {r.load_date for r in ledger.read_ledger(spark, root).collect()} == {"2024-03-01", "2024-03-02"}


def test_days_are_loaded_side_by_side_and_entered_in_order(spark, tmp_path, monkeypatch):
    top, root = str(tmp_path / "landing"), str(tmp_path / "lake")
    landing = f"{top}/transactions"
    for day in (1, 2, 3):
        land(spark, top, date(2024, 1, day), [day])
    both, load_day = threading.Barrier(2, timeout=60), bronze.load_day

    def meeting(spark, name, landing, target, day, loaded_at=None):
        if day < "2024-01-03":
            both.wait()  # broken unless another day is loaded at the same time
        else:
            raise ValueError(day)
        return load_day(spark, name, landing, target, day, loaded_at)

    at = datetime(2024, 1, 5)
    monkeypatch.setattr(bronze, "load_day", meeting)
    with pytest.raises(ValueError, match="2024-01-03"):
        ledger.load_pending(spark, "transactions", landing, root, "run1", at)
    assert {r.load_date for r in ledger.read_ledger(spark, root).collect()} == {"2024-01-01", "2024-01-02"}
    monkeypatch.setattr(bronze, "load_day", load_day)
    assert ledger.load_pending(spark, "transactions", landing, root, "run2", at) == {"2024-01-03": 1}


def test_footers_of_all_days_are_read_by_one_job(spark, tmp_path, monkeypatch):
    landing, root = str(tmp_path / "landing"), str(tmp_path / "lake")
    for d in range(1, 6):
        land(spark, landing, date(2024, 3, d), [f"{d}.{i}" for i in range(d)])
    looked, entered = [], []
    require_files, replace = ledger.require_files, ledger.replace_partition
    monkeypatch.setattr(ledger, "require_files", lambda *a: looked.append(a) or require_files(*a))
    monkeypatch.setattr(ledger, "replace_partition", lambda df, *a, **k: entered.append(df.count()) or replace(df, *a, **k))
    assert load(spark, landing, root, 1)
    assert not looked
    assert sum(entered) == 5
    found = ledger.read_ledger(spark, root).groupBy("load_date").agg({"row_count": "sum"}).collect()
    assert {r[0]: r[1] for r in found} == {f"2024-03-0{d}": d for d in range(1, 6)}
    # A file without a footer is an error of its own day: the days before it are loaded and entered.
    for d in (6, 7, 8):
        land(spark, landing, date(2024, 3, d), [f"{d}"])
    (tmp_path / "landing/transactions/load_date=2024-03-07/odd.parquet").write_bytes(b"no footer")
    with pytest.raises(Exception):
        load(spark, landing, root, 2)
    assert {r.load_date for r in ledger.read_ledger(spark, root).collect()} == {f"2024-03-0{d}" for d in range(1, 7)}


def test_side_by_side(spark):
    both = threading.Barrier(2, timeout=60)

    def meeting(i):
        both.wait()  # broken unless another call runs at the same time
        return i

    assert side_by_side(spark, [lambda i=i: meeting(i) for i in range(4)], most=2) == [0, 1, 2, 3]
    with pytest.raises(ZeroDivisionError):
        side_by_side(spark, [lambda: 1, lambda: 1 // 0, lambda: spark.range(3).count()])
    assert side_by_side(spark, []) == []
