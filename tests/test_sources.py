"""Landing, bronze, streams and history on small files."""

import hashlib
from datetime import date, datetime

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lendscope.plans import history
from lendscope.schemas import RAW_CLIENTS, SOURCES, SchemaDrift
from lendscope.session import scratch_path, shared_dir
from lendscope.sources import bronze, files, manifest
from lendscope.streaming import feed

AT = datetime(2024, 3, 1, 5)


def feed_rows(spark, day, keys, amount=1.0):
    return spark.createDataFrame(
        [(k, 1, datetime.combine(day, AT.time()), amount, "ACH", "PAYMENT", "POSTED", "a@b", "1.1.1.1", day) for k in keys],
        "txn_id string, borrower_id int, txn_ts timestamp, amount double, channel string, txn_type string, "
        "status string, borrower_email string, borrower_ip string, load_date date",
    )


def test_the_newest_folder_is_the_last_by_name(spark, tmp_path):
    assert files.latest_partition(spark, str(tmp_path / "nothing")) is None
    for name in ("load_date=2024-01-09", "load_date=2024-01-10", "other=2025-01-01"):
        (tmp_path / name).mkdir()
    (tmp_path / "load_date=2030-01-01").write_text("a file, not a folder")
    assert files.latest_partition(spark, str(tmp_path)) == "2024-01-10"


def test_a_load_can_be_repeated(spark, tmp_path):
    landing, raw = str(tmp_path / "landing"), str(tmp_path / "raw")
    assert bronze.load_source(spark, "transactions", landing, raw) is None
    bronze.land_feed(feed_rows(spark, date(2024, 3, 1), ["a", "b"]), landing)
    assert bronze.load_source(spark, "transactions", landing, raw, AT) == 2
    bronze.land_feed(feed_rows(spark, date(2024, 3, 2), ["c", "d", "e"]), landing)
    assert bronze.load_source(spark, "transactions", landing, raw, AT) == 3
    assert bronze.load_source(spark, "transactions", landing, raw, AT) == 3
    stored = spark.read.parquet(f"{raw}/{SOURCES['transactions'].table}")
    assert sorted(r.txn_id for r in stored.collect()) == list("abcde")
    one = stored.filter("txn_id = 'a'").first()
    assert one._load_date == date(2024, 3, 1) and one._loaded_at == AT and one._source_file.endswith(".parquet")


def test_a_feed_with_other_columns_is_refused(spark, tmp_path):
    landing = str(tmp_path / "landing")
    bronze.land_feed(feed_rows(spark, date(2024, 3, 1), ["a"]).drop("amount"), landing)
    with pytest.raises(SchemaDrift, match="amount: missing"):
        bronze.load_source(spark, "transactions", landing, str(tmp_path / "raw"), AT)


def test_replacing_keeps_other_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(6).selectExpr("id", "concat('p', id % 3) as part")
    bronze.replace_partition(rows, path, "part")
    assert bronze.replace_partition(rows.filter("id = 4"), path, "part", part="p1") == 1
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [0, 2, 3, 4, 5]
    assert bronze.replace_partition(rows.filter("id < 0"), path, "part", part="p1") == 0
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [0, 2, 3, 5]
    assert bronze.replace_partition(rows.filter("id = 1"), path, "part", part="p1") == 1
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [0, 1, 2, 3, 5]
    with pytest.raises(Exception, match="a row outside part=p1"):
        bronze.replace_partition(rows, path, "part", part="p1")


def test_an_empty_reload_empties_its_day(spark, tmp_path):
    landing, raw = str(tmp_path / "landing"), str(tmp_path / "raw")
    day = feed_rows(spark, date(2024, 3, 1), ["a", "b"])
    bronze.land_feed(day, landing)
    assert bronze.load_source(spark, "transactions", landing, raw, AT) == 2
    day.limit(0).drop("load_date").write.mode("overwrite").parquet(f"{landing}/load_date=2024-03-01")
    assert bronze.load_source(spark, "transactions", landing, raw, AT) == 0
    assert spark.read.parquet(f"{raw}/{SOURCES['transactions'].table}").count() == 0


def test_a_clustered_rewrite_leaves_nothing_behind(spark, tmp_path):
    path = str(tmp_path / "t")
    loans = spark.range(4).selectExpr("id", "if(id = 1, 'late', 'current') as status")
    bronze.write_clustered(loans, path, "status", ["id"])
    bronze.write_clustered(loans.selectExpr("id", "'current' as status"), path, "status", ["id"])
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [0, 1, 2, 3]


def test_a_hot_partition_is_written_by_many_tasks(spark, tmp_path):
    df = spark.range(10).selectExpr("id", "'one' as part").hint("rebalance", F.col("part"))
    assert "REBALANCE_PARTITIONS_BY_COL" in df._jdf.queryExecution().executedPlan().toString()


def test_nanosecond_feed(spark, tmp_path):
    path = str(tmp_path / "nanos.parquet")
    stamp = pd.Timestamp("2024-03-01 05:06:07.123456789", tz="UTC")
    pq.write_table(pa.table({"txn_ts": pa.array([stamp], pa.timestamp("ns", tz="UTC"))}), path, version="2.6")
    found = files.read_feed(spark.read.parquet(path))
    assert found.first().txn_ts == datetime(2024, 3, 1, 5, 6, 7, 123456)


def test_client_sheet_with_two_header_lines(spark, tmp_path):
    part = tmp_path / "clients" / "load_date=2024-03-01"
    part.mkdir(parents=True)
    banner = "," + ",".join(f"X{i}" for i in range(1, 24)) + ",Y"
    lines = [banner, ",".join(RAW_CLIENTS.names)]
    lines += [f"{k}, 20000,2,2,1,24,2,2,-1,-1,-2,-2," + ",".join(["3913.5"] * 6 + ["0"] * 6) + ",1" for k in (1, 2)]
    (part / "sheet.csv").write_text("\n".join(lines))
    raw = str(tmp_path / "raw")
    counts = bronze.load_sources(spark, ("clients", "transactions"), str(tmp_path), raw)
    assert counts == {"clients": 2, "transactions": None}
    found = spark.read.parquet(f"{raw}/raw.uci_credit_default").orderBy("ID").first()
    assert (found.ID, found.LIMIT_BAL, found.PAY_6, found.BILL_AMT1) == (1, 20000, -2, 3913.5)
    assert found["default payment next month"] == 1 and found._source_file == "sheet.csv"


def test_client_file_as_parquet(spark, tmp_path):
    path = str(tmp_path / "clients")
    row = (1, 20000, 2, 2, 1, 24, *(0,) * 6, *(1.0,) * 12, 0)
    spark.createDataFrame([row], RAW_CLIENTS).write.parquet(path)
    assert tuple(files.read_clients(spark, path, RAW_CLIENTS).first()) == row


def sheet(tmp_path, *lines):
    part = tmp_path / "clients" / "load_date=2024-03-01"
    part.mkdir(parents=True, exist_ok=True)
    (part / "sheet.csv").write_text("\n".join(lines))
    return str(part)


def client_line(key):
    return f"{key},20000,2,2,1,24,2,2,-1,-1,-2,-2," + ",".join(["3913.5"] * 6 + ["0"] * 6) + ",1"


@pytest.mark.parametrize("key", ["2a", "", "x"])
def test_a_malformed_client_row_is_an_error(spark, tmp_path, key):
    path = sheet(tmp_path, ",".join(RAW_CLIENTS.names), client_line(1), client_line(key), client_line(3))
    with pytest.raises(Exception, match="client row without a number as ID"):
        files.read_clients(spark, path, RAW_CLIENTS).collect()


@pytest.mark.parametrize("row", ["A17" + "," * 24, "," * 24, ",".join("x" * 25)])
def test_client_rows_without_numbers_are_not_dropped(spark, tmp_path, row):
    path = sheet(tmp_path, ",".join(RAW_CLIENTS.names), client_line(1), row, client_line(2))
    with pytest.raises(Exception, match="client row without a number as ID"):
        files.read_clients(spark, path, RAW_CLIENTS).collect()


def test_a_banner_stands_before_the_names_only(spark, tmp_path):
    banner = "Title of the sheet" + "," * 24
    path = sheet(tmp_path, banner, ",".join(RAW_CLIENTS.names), client_line(1))
    assert files.read_clients(spark, path, RAW_CLIENTS).count() == 1
    path = sheet(tmp_path, client_line(1), banner, client_line(2))
    with pytest.raises(Exception, match="client row without a number as ID"):
        files.read_clients(spark, path, RAW_CLIENTS).collect()


def test_reordered_or_missing_client_columns_are_refused(spark, tmp_path):
    names = list(RAW_CLIENTS.names)
    names[1], names[2] = names[2], names[1]
    path = sheet(tmp_path, ",".join(names), client_line(1))
    with pytest.raises(Exception, match="client columns are"):
        files.read_clients(spark, path, RAW_CLIENTS).collect()
    path = sheet(tmp_path, client_line(1), client_line(2).rpartition(",")[0])
    with pytest.raises(Exception, match="(?i)malformed"):
        files.read_clients(spark, path, RAW_CLIENTS).collect()
    only = str(tmp_path / "only")
    spark.createDataFrame([(1,)], "ID long").write.parquet(only)
    with pytest.raises(SchemaDrift, match="LIMIT_BAL: missing"):
        files.read_clients(spark, only, RAW_CLIENTS)
    (tmp_path / "only" / "more.csv").write_text("1")
    with pytest.raises(SchemaDrift, match="CSV and Parquet"):
        files.read_clients(spark, only, RAW_CLIENTS)


def test_a_whole_tape_is_loaded(spark, tmp_path):
    first, second = tmp_path / "a", tmp_path / "b"
    raw = str(tmp_path / "raw")
    assert bronze.load_source(spark, "loan_tape", str(first), raw, extra_folders=(str(second),)) is None
    second.mkdir()
    (second / "z.csv").write_text("loan_id,amount\n1,2.5\n2,3.5\n")
    (second / "a.csv").write_text("loan_id,amount\n9,9.5\n")
    assert [p[-5:] for p in files.find_loan_tape(spark, [str(first), str(second)])] == ["a.csv", "z.csv"]
    assert bronze.load_source(spark, "loan_tape", str(first), raw, extra_folders=(str(second),)) == 3
    assert bronze.load_source(spark, "loan_tape", str(first), raw, extra_folders=(str(second),)) == 3
    stored = spark.read.parquet(f"{raw}/raw.lending_club_loans")
    assert sorted((r.loan_id, r._source_file) for r in stored.collect()) == [(1, "z.csv"), (2, "z.csv"), (9, "a.csv")]
    assert {r._delivery for r in stored.collect()} == {str(second)}
    third = tmp_path / "c" / "b"
    third.mkdir(parents=True)
    (third / "a.csv").write_text("loan_id,amount\n5,1.5\n")
    assert bronze.load_source(spark, "loan_tape", str(third), raw) == 1
    assert spark.read.parquet(f"{raw}/raw.lending_club_loans").count() == 4
    pq.write_table(pa.table({"loan_id": [5, 6, 7]}), second / "y.parquet")
    assert files.find_loan_tape(spark, [str(first), str(second)])[0].endswith("y.parquet")
    folder = tmp_path / "delivery"
    spark.range(40).repartition(4).write.csv(str(folder), header=True)
    assert bronze.load_tape(spark, str(folder), str(tmp_path / "tapes"), AT) == 40


def test_manifest_hashes_what_is_there(spark, tmp_path):
    folder = tmp_path / "landed"
    folder.mkdir()
    pq.write_table(pa.table({"x": [1, 2, 3]}), folder / "one.parquet")
    pq.write_table(pa.table({"x": list(range(400_000))}), folder / "two words.parquet")
    rows = spark.read.parquet(str(folder))
    found = {r.data_file: r for r in manifest.file_manifest(spark, "s", str(folder), "test", rows, AT).collect()}
    for path in folder.glob("*.parquet"):
        name = path.name
        assert found[name].sha256 == hashlib.sha256(path.read_bytes()).hexdigest()
        assert found[name].byte_size == path.stat().st_size
        assert found[name].row_count == pq.read_metadata(path).num_rows
    blind = manifest.file_manifest(spark, "s", str(folder), "test", loaded_at=AT).first()
    assert blind.row_count is None and blind.loaded_at == AT


def test_inventory(spark, rows):
    found = bronze.table_inventory({"b": spark.range(2), "a": spark.range(3)})
    assert [tuple(r) for r in found.collect()] == [("a", 3), ("b", 2)]
    assert bronze.empty_table(spark, RAW_CLIENTS).count() == 0


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(shared_dir(spark) + "/x-")


def test_every_landed_file_is_ingested_once(spark, tmp_path):
    landing, target, state = (str(tmp_path / n) for n in ("landing", "bronze", "state"))
    bronze.land_feed(feed_rows(spark, date(2024, 3, 1), ["a", "b"]), landing)
    schema = spark.read.parquet(landing).schema
    for keys in ([], ["c"], []):
        if keys:
            bronze.land_feed(feed_rows(spark, date(2024, 3, 2), keys), landing)
        feed.ingest_stream(feed.read_landed(spark, landing, schema), target, state).awaitTermination()
    found = spark.read.parquet(target)
    assert sorted((r.txn_id, r._load_date) for r in found.collect()) == [
        ("a", date(2024, 3, 1)),
        ("b", date(2024, 3, 1)),
        ("c", date(2024, 3, 2)),
    ]
    assert (tmp_path / "bronze" / "_load_date=2024-03-02").is_dir()


def test_streams_share_a_table(spark, tmp_path):
    target = str(tmp_path / "bronze")
    for name, keys in (("a", ["a1", "a2", "a3"]), ("b", ["b1", "b2"])):
        landing = str(tmp_path / name / "landing")
        bronze.land_feed(feed_rows(spark, date(2024, 3, 1), keys), landing)
        schema = spark.read.parquet(landing).schema
        feed.ingest_stream(feed.read_landed(spark, landing, schema), target, str(tmp_path / name / "state")).awaitTermination()
    # A reset checkpoint reads everything again and overwrites nothing.
    feed.ingest_stream(feed.read_landed(spark, landing, schema), target, str(tmp_path / "b" / "again")).awaitTermination()
    found = [r.txn_id for r in spark.read.parquet(target).collect()]
    assert sorted(found) == ["a1", "a2", "a3", "b1", "b1", "b2", "b2"]


def dedupe(spark, landing, schema, target, state, delay="1 day"):
    landed = feed.read_landed(spark, landing, schema)
    feed.dedupe_stream(landed, target, state, "txn_id", "txn_ts", delay).awaitTermination()


def test_stream_keeps_one_row_per_key_across_batches(spark, tmp_path):
    landing, target, state = (str(tmp_path / n) for n in ("landing", "out", "state"))
    day = date(2024, 3, 1)
    bronze.land_feed(feed_rows(spark, day, ["hot"] * 50 + ["a", None, None], 1.0), landing)
    schema = spark.read.parquet(landing).schema
    for keys in ([], ["hot", "a", "b", None]):
        if keys:
            bronze.land_feed(feed_rows(spark, day, keys, 2.0), landing)
        dedupe(spark, landing, schema, target, state)
    found = spark.read.parquet(target)
    assert sorted((str(r.txn_id), r.amount) for r in found.collect()) == [
        ("None", 1.0), ("None", 1.0), ("None", 2.0), ("a", 1.0), ("b", 2.0), ("hot", 1.0)
    ]


def test_the_watermark_evicts_keys_and_sets_late_rows_aside(spark, tmp_path):
    landing, target, state = (str(tmp_path / n) for n in ("landing", "out", "state"))
    steps = [(1, ["old"]), (9, ["mid"]), (10, ["new", "mid"]), (2, ["old", "other"])]
    for day, keys in steps:
        bronze.land_feed(feed_rows(spark, date(2024, 3, day), keys), landing)
        schema = spark.read.parquet(landing).schema
        dedupe(spark, landing, schema, target, state, "3 days")
    assert sorted(r.txn_id for r in spark.read.parquet(target).collect()) == ["mid", "new", "old"]
    assert sorted(r.txn_id for r in spark.read.parquet(target + "_late").collect()) == ["old", "other"]


def snapshot(spark, *rows):
    return spark.createDataFrame(list(rows), "id int, v string, w int")


def test_history_opens_closes_and_keeps(spark):
    first, second, third = "2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-03 00:00:00"
    h = history.scd2_start(snapshot(spark, (1, "a", 1), (2, "b", None), (3, "c", 3)), "id", ["v", "w"], first)
    h = history.scd2_merge(h, snapshot(spark, (1, "A", 1), (2, "b", None), (4, "d", 4)), "id", ["v", "w"], second)
    h = history.scd2_merge(h, snapshot(spark, (1, "A", 1), (2, "b", 5), (3, "c", 3), (4, "d", 4)), "id", ["v", "w"], third)
    found = {(r.id, r.v, r.w, r.valid_from.day, r.valid_to and r.valid_to.day, r.is_current) for r in h.collect()}
    assert h.count() == 6
    assert found == (
        {
            (1, "a", 1, 1, 2, False),
            (1, "A", 1, 2, None, True),
            (2, "b", None, 1, 3, False),
            (2, "b", 5, 3, None, True),
            (3, "c", 3, 1, None, True),
            (4, "d", 4, 2, None, True),
        }
    )


def test_increments_write_new_and_late_days(spark, tmp_path):
    path = str(tmp_path / "fact")
    days = spark.range(5).selectExpr("id", "date_add(date'2024-01-01', cast(id as int)) as day")
    assert history.incremental_fact(days.filter("id < 3"), path, "day") == 3
    assert history.incremental_fact(days, path, "day") == 3
    assert history.incremental_fact(days, path, "day") == 1
    assert spark.read.parquet(path).count() == 5
    late = days.unionByName(spark.sql("select 77L as id, date'2024-01-02' as day"))
    assert history.incremental_fact(late, path, "day") == 3
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [0, 1, 2, 3, 4, 77]


def test_stamp_uses_the_file_of_each_row(spark, tmp_path):
    for name in ("x", "y"):
        pq.write_table(pa.table({"v": [name]}), tmp_path / f"{name}.parquet")
    found = files.stamp_load_metadata(spark.read.parquet(str(tmp_path)), "2024-03-01")
    assert {(r.v, r._source_file) for r in found.collect()} == {("x", "x.parquet"), ("y", "y.parquet")}
    assert found.schema["_loaded_at"].dataType.simpleString() == "timestamp_ntz"


def test_missing_shared_folder_on_a_cluster_is_an_error():
    class Context:
        master = "yarn"

    class Conf:
        def get(self, key, default):
            return default

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session())
