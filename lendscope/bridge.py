"""The given TPC-H-like tables in the shapes the pipeline ingests.

One SQL text per shape, run by Spark here and by the oracle there, so both
sides start from the same rows. ``{names}`` are tables, ``{ts}`` is the
zone-less timestamp type and ``{flag}`` the quoted label column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lendscope.schemas import MONTHS, RAW_DEFAULT_FLAG, RAW_STATUS_COLUMNS

TABLES = ("customer", "orders", "lineitem", "events")
GIVEN = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)

CLIENT_LOAD_DATE = "2024-01-31"
CLIENT_LOADED_AT = "2024-01-31 01:00:00"
OLDER_LOADED_AT = "2024-01-30 01:00:00"


def _slot_sums() -> str:
    lines = []
    for m in MONTHS:
        lines.append(f"sum(case when slot = {m} then cents else 0 end) as bill_{m}")
        lines.append(f"sum(case when slot = {m} and o_orderstatus = 'P' then cents else 0 end) as paid_{m}")
        lines.append(f"sum(case when slot = {m} and o_orderstatus = 'F' then 1 else 0 end) as late_{m}")
    return ",\n        ".join(lines)


def _slot_columns() -> str:
    lines = []
    for m, raw in zip(MONTHS, RAW_STATUS_COLUMNS):
        # Some clients have no status in one month.
        lines.append(f"case when c.c_custkey % 83 <> {m} then least(coalesce(a.late_{m}, 0) - 2, 9) end as {raw}")
    lines += [f"coalesce(a.bill_{m}, 0) / cast(100 as double) as BILL_AMT{m}" for m in MONTHS]
    lines += [f"coalesce(a.paid_{m}, 0) / cast(100 as double) as PAY_AMT{m}" for m in MONTHS]
    return ",\n    ".join(lines)


RAW_CLIENTS_SQL = f"""
select
    c.c_custkey as ID,
    case when c.c_custkey % 89 <> 3 then cast(floor(abs(c.c_acctbal)) as int) * 50 end as LIMIT_BAL,
    c.c_nationkey % 3 as SEX,
    c.c_nationkey % 5 as EDUCATION,
    c.c_nationkey % 4 as MARRIAGE,
    case when c.c_custkey % 97 <> 5 then cast(20 + c.c_custkey % 60 as int) end as AGE,
    {_slot_columns()},
    case when coalesce(a.urgent, 0) >= 4 then 1 else 0 end as {{flag}},
    'customer.parquet' as _source_file,
    date '{CLIENT_LOAD_DATE}' as _load_date,
    {{ts}} '{CLIENT_LOADED_AT}' as _loaded_at
from {{customer}} c
left join (
    select
        o_custkey,
        {_slot_sums()},
        sum(case when o_orderpriority = '1-URGENT' then 1 else 0 end) as urgent
    from (
        select
            o_custkey,
            o_orderstatus,
            o_orderpriority,
            month(o_orderdate) % 6 + 1 as slot,
            cast(round(o_totalprice * 100) as bigint) as cents
        from {{orders}}
    ) o
    group by o_custkey
) a on a.o_custkey = c.c_custkey
"""

# Every second client also has a row of an earlier load, most with another limit.
RAW_CLIENTS_TWO_LOADS_SQL = """
select * from {raw_clients}
union all
select
    r.ID, r.LIMIT_BAL + 1000 * (r.ID %% 3), r.SEX, r.EDUCATION, r.MARRIAGE, r.AGE, {columns},
    'customer.parquet', date '2024-01-30', {ts} '%s'
from {raw_clients} r
where r.ID %% 2 = 0
""" % OLDER_LOADED_AT

RAW_TRANSACTIONS_SQL = """
select
    cast(l.l_orderkey as string) || '-' || cast(l.l_linenumber as string) as txn_id,
    o.o_custkey as borrower_id,
    l.l_shipdate as txn_ts,
    l.l_extendedprice as amount,
    case l.l_orderkey % 4 when 0 then 'ACH' when 1 then 'CARD' when 2 then 'WIRE' else 'CHECK' end as channel,
    case l.l_returnflag when 'N' then 'PAYMENT' when 'A' then 'FEE' else 'ADJUSTMENT' end as txn_type,
    case o.o_orderstatus when 'F' then 'FAILED' when 'P' then 'PENDING' else 'POSTED' end as status,
    'user' || cast(o.o_custkey as string) || '@mail' || cast(o.o_custkey % 7 as string) || '.example' as borrower_email,
    '10.' || cast(o.o_custkey % 256 as string) || '.' || cast(l.l_suppkey % 256 as string)
        || '.' || cast(l.l_linenumber as string) as borrower_ip,
    'lineitem.parquet' as _source_file,
    cast(l.l_shipdate as date) as _load_date,
    l.l_shipdate as _loaded_at,
    l.l_partkey as _part,
    l.l_suppkey as _supplier
from {lineitem} l
join {orders} o on o.o_orderkey = l.l_orderkey
"""

# Columns that decide between payment rows of one key and load.
PAYMENT_TIES = ("_part", "_supplier")

# Scores by a closed formula of the key: many ties, one model with signal.
MODEL_SCORES_SQL = """
select
    k as client_id,
    (k * 7919 % 100) / cast(100 as double) as pd_logreg,
    (k * 7919 % 60 + 30 * is_default) / cast(100 as double) as pd_xgboost,
    is_default,
    k % 4 = 0 as is_test
from (
    select c_custkey as k, case when c_custkey * 31 % 100 < 22 then 1 else 0 end as is_default
    from {customer}
) c
"""

# The loan tape as it lands: untrimmed text, a rate in percent, some loans twice.
LOAN_TAPE_SQL = """
select
    o_orderkey as loan_id,
    o_custkey as client_id,
    o_totalprice as principal,
    cast(5 + o_orderkey % 20 as double) as int_rate,
    '  ' || upper(o_orderpriority) || ' ' as grade,
    case o_orderstatus when 'F' then ' Charged Off' when 'P' then 'LATE ' else 'Current' end as loan_status,
    cast(o_orderdate as date) as issue_date,
    copy as delivery
from {orders}, {copies}
where copy = 1 or o_orderkey % 5 = 0
"""


# The events table as the daily feed.
FEED_SQL = """
select
    cast(event_id as string) as txn_id,
    user_id as borrower_id,
    ts as txn_ts,
    value as amount,
    upper(event_type) as channel,
    'PAYMENT' as txn_type,
    'POSTED' as status,
    'user' || cast(user_id as string) || '@mail.example' as borrower_email,
    '10.0.0.' || cast(user_id % 256 as string) as borrower_ip,
    cast(ts as date) as load_date
from {events}
"""

# Loans that failed, dated by their first returned line after the issue date.
# One row per loan and day goes into the join, however many lines a loan has.
LOAN_DEFAULTS_SQL = """
select
    o.o_orderkey as loan_id,
    cast(o.o_orderdate as date) as issue_date,
    cast(case when o.o_orderstatus = 'F' then r.returned end as date) as default_date
from {orders} o
left join (
    select x.o_orderkey as returned_key, min(l.l_shipdate) as returned
    from (
        select l_orderkey, l_shipdate from {lineitem} where l_returnflag = 'R' group by l_orderkey, l_shipdate
    ) l
    join {orders} x on x.o_orderkey = l.l_orderkey
    where l.l_shipdate >= x.o_orderdate
    group by x.o_orderkey
) r on r.returned_key = o.o_orderkey
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _run(spark: SparkSession, sf_dir: str, sql: str, names: tuple[str, ...], **texts: str) -> DataFrame:
    frames = {n: table(spark, sf_dir, n) for n in names}
    for key, text in texts.items():
        sql = sql.replace("{" + key + "}", text)
    return spark.sql(sql, **frames)


def raw_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(
        spark, sf_dir, RAW_CLIENTS_SQL, ("customer", "orders"), ts="timestamp_ntz", flag=f"`{RAW_DEFAULT_FLAG}`"
    )


def raw_clients_two_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ", ".join(f"r.{c}" for c in _measure_columns()) + f", r.`{RAW_DEFAULT_FLAG}`"
    sql = RAW_CLIENTS_TWO_LOADS_SQL.replace("{columns}", columns).replace("{ts}", "timestamp_ntz")
    return spark.sql(sql, raw_clients=raw_clients(spark, sf_dir))


def _measure_columns() -> list[str]:
    return [
        *RAW_STATUS_COLUMNS,
        *[f"BILL_AMT{m}" for m in MONTHS],
        *[f"PAY_AMT{m}" for m in MONTHS],
    ]


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, RAW_TRANSACTIONS_SQL, ("lineitem", "orders"))


def model_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, MODEL_SCORES_SQL, ("customer",))


def loan_tape(spark: SparkSession, sf_dir: str) -> DataFrame:
    sql = LOAN_TAPE_SQL.replace(", {copies}", " lateral view explode(array(1, 2)) t as copy")
    return _run(spark, sf_dir, sql, ("orders",))


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, FEED_SQL, ("events",))


def loan_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, LOAN_DEFAULTS_SQL, ("orders", "lineitem"))
