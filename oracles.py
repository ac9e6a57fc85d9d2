"""DuckDB SQL giving the result of each registered query on the given tables.

Written against the table definitions, not against the Spark plans: joins to
small label lists, UNPIVOT, QUALIFY, quantile_cont and rank formulas stand where
the engine uses other means. Only the input mapping text is shared.
"""

from __future__ import annotations

from lendscope import bridge

M = range(1, 7)
# Where the given tables lie when results are compared; file sizes and digests are read there.
GIVEN_DIR = "/root/testdata/sf0.01"

STREAM_CUT, STREAM_DELAY = "1996-01-01", "120 days"
TIME = "timestamp '2024-01-31 01:00:00'"


def _fill(sql: str, **more: str) -> str:
    texts = {t: t for t in bridge.TABLES} | {"ts": "timestamp", "flag": '"default payment next month"'} | more
    for key, text in texts.items():
        sql = sql.replace("{" + key + "}", text)
    return sql


def _list(pattern: str) -> str:
    return ", ".join(pattern.format(m=m) for m in M)


RAW_CLIENTS = _fill(bridge.RAW_CLIENTS_SQL)
MEASURES = ", ".join(f"r.{c}" for c in bridge._measure_columns()) + ', r."default payment next month"'
TWO_LOADS = _fill(bridge.RAW_CLIENTS_TWO_LOADS_SQL, raw_clients="raw_one", columns=MEASURES)
RAW_PAYMENTS = _fill(bridge.RAW_TRANSACTIONS_SQL)
SCORES = _fill(bridge.MODEL_SCORES_SQL)
TAPE = _fill(bridge.LOAN_TAPE_SQL, copies="(select unnest([1, 2]) as copy) c")
FEED = _fill(bridge.FEED_SQL)
DEFAULTS = _fill(bridge.LOAN_DEFAULTS_SQL)

CLIENT_COLUMNS = f"""
    ID::bigint as client_id, LIMIT_BAL::int as credit_limit, SEX::int as sex_code,
    EDUCATION::int as education_code, MARRIAGE::int as marriage_code, AGE::int as age,
    {", ".join(f"PAY_{0 if m == 1 else m}::int as repay_status_m{m}" for m in M)},
    {_list("BILL_AMT{m}::double as bill_amt_m{m}")}, {_list("PAY_AMT{m}::double as pay_amt_m{m}")},
    "default payment next month"::int as is_default, _load_date as load_date, _loaded_at as loaded_at
"""

# Named building blocks; each may use the ones above it.
CTES = {
    "raw_one": RAW_CLIENTS,
    "raw_two": TWO_LOADS,
    "stg": f"""
        select {CLIENT_COLUMNS} from raw_one
        qualify row_number() over (partition by ID order by _loaded_at desc) = 1""",
    "pay": """
        select txn_id::varchar as txn_id, borrower_id::bigint as client_id, txn_ts::timestamp as txn_ts,
            amount::double as amount, channel, txn_type, status, borrower_email, borrower_ip,
            _load_date as load_date, _loaded_at as loaded_at
        from raw_pay
        qualify row_number() over (partition by txn_id order by _loaded_at desc, _part desc, _supplier desc) = 1""",
    "raw_pay": RAW_PAYMENTS,
    "dim": """
        select s.client_id, s.credit_limit, s.sex_code, coalesce(x.label, 'unknown') as sex,
            s.education_code, coalesce(e.label, 'other_unknown') as education_level,
            s.marriage_code, coalesce(w.label, 'unknown') as marital_status,
            s.age,
            case when age < 30 then '<30' when age < 40 then '30-39' when age < 50 then '40-49'
                when age < 60 then '50-59' else '60+' end as age_band,
            case when credit_limit < 50000 then '<50k' when credit_limit < 150000 then '50k-150k'
                when credit_limit < 300000 then '150k-300k' else '300k+' end as credit_limit_band,
            (['north', 'south', 'east', 'west'])[1 + client_id % 4] as region
        from stg s
        left join (values (1, 'male'), (2, 'female')) x(code, label) on x.code = s.sex_code
        left join (values (1, 'graduate_school'), (2, 'university'), (3, 'high_school')) e(code, label)
            on e.code = s.education_code
        left join (values (1, 'married'), (2, 'single'), (3, 'other')) w(code, label) on w.code = s.marriage_code""",
    "lab": "select d.*, s.is_default from dim d join stg s using (client_id)",
    "fact": f"""
        select md5(concat(client_id, '-', month_index)) as payment_history_id, client_id, month_index, repay_status,
            repay_status > 0 as is_delinquent, bill_amt, pay_amt,
            if(credit_limit > 0, round(bill_amt / credit_limit, 4), null) as utilization
        from (
            select client_id, credit_limit, unnest([1, 2, 3, 4, 5, 6]) as month_index,
                unnest([{_list("repay_status_m{m}")}]) as repay_status,
                unnest([{_list("bill_amt_m{m}")}]) as bill_amt,
                unnest([{_list("pay_amt_m{m}")}]) as pay_amt
            from stg
        )""",
    "feat": f"""
        select client_id, credit_limit, age, sex_code, education_code, marriage_code,
            total_status / 6.0::double as avg_repay_status, max_repay_status, months_delinquent,
            total_bill_amt, total_pay_amt,
            if(credit_limit > 0, round(total_bill_amt / 6.0::double / credit_limit, 4), null) as avg_utilization,
            age_band, credit_limit_band, is_default,
            if(total_bill_amt > 0, round(total_pay_amt / total_bill_amt, 4), null) as pay_to_bill_ratio
        from (
            select stg.*, age_band, credit_limit_band,
                {" + ".join(f"repay_status_m{m}" for m in M)} as total_status,
                list_max([{_list("repay_status_m{m}")}]) as max_repay_status,
                {" + ".join(f"(repay_status_m{m} > 0)::int" for m in M)} as months_delinquent,
                {" + ".join(f"bill_amt_m{m}" for m in M)} as total_bill_amt,
                {" + ".join(f"pay_amt_m{m}" for m in M)} as total_pay_amt
            from stg join dim using (client_id)
        )""",
    "mart": """
        select segment_dimension, segment_value, count(*) as n_clients, sum(is_default)::bigint as n_default,
            round(avg(is_default), 4) as default_rate, round(avg(credit_limit), 2) as avg_credit_limit,
            sum(credit_limit)::bigint as total_credit_limit_exposure
        from (
            unpivot (select is_default, credit_limit, age_band, credit_limit_band, education_level, sex,
                marital_status, region from lab)
            on age_band, credit_limit_band, education_level, sex, marital_status, region
            into name segment_dimension value segment_value
        )
        group by all""",
    "ana": "select * replace (null::int as age, null::int as credit_limit) from dim",
    "payview": """
        select * exclude (load_date, loaded_at) replace (
            '****' || substr(borrower_email, instr(borrower_email, '@')) as borrower_email,
            '***.***.***.***' as borrower_ip)
        from pay""",
    "scores": SCORES,
    "test_scores": """
        select 'logreg' as model, pd_logreg as score, is_default as label from scores where is_test
        union all
        select 'xgboost', pd_xgboost, is_default from scores where is_test""",
    "tape": """
        select loan_id, client_id::bigint as client_id, principal, int_rate, lower(trim(grade)) as grade,
            lower(trim(loan_status)) as loan_status, issue_date
        from raw_tape
        qualify row_number() over (partition by loan_id order by delivery desc) = 1""",
    "raw_tape": TAPE,
    "feed": FEED,
    "loan_defaults": DEFAULTS,
}
ORDER = (
    "raw_one", "raw_two", "stg", "raw_pay", "pay", "dim", "lab", "fact", "feat", "mart", "ana", "payview",
    "scores", "test_scores", "raw_tape", "tape", "feed", "loan_defaults",
)
NEEDS = {
    "raw_two": ("raw_one",),
    "stg": ("raw_one",),
    "pay": ("raw_pay",),
    "dim": ("stg",),
    "lab": ("dim", "stg"),
    "fact": ("stg",),
    "feat": ("stg", "dim"),
    "mart": ("lab",),
    "ana": ("dim",),
    "payview": ("pay",),
    "test_scores": ("scores",),
    "tape": ("raw_tape",),
}


def _with(names: str, body: str) -> str:
    wanted: set[str] = set()

    def add(name: str) -> None:
        if name not in wanted:
            wanted.add(name)
            for need in NEEDS.get(name, ()):
                add(need)

    for name in names.split():
        add(name)
    blocks = ",\n".join(f"{n} as ({CTES[n]})" for n in ORDER if n in wanted)
    joiner = ",\n" if body.lstrip().lower().startswith("with ") else "\n"
    text = body.lstrip()[5:] if joiner.startswith(",") else body
    return f"with {blocks}{joiner}{text}"


# Check rows. ``bad`` counts offending rows; ``seen`` is an observed number.


def _check(table, name, position, kind, column, severity, bad=None, seen=None, low=None, high=None) -> str:
    if bad is not None:
        success, observed, unexpected = f"({bad}) = 0", "null::varchar", f"({bad})::bigint"
    else:
        success, observed, unexpected = f"({seen}) between {low} and {high}", f"({seen})::varchar", "null::bigint"
    column_sql = f"'{column}'" if column else "null::varchar"
    return f"""select '{name}' as suite_name, 'marts.{name}' as target_table, {position}::int as position,
        '{kind}' as expectation_type, {column_sql} as column_name, '{severity}' as severity,
        {success} as success, {observed} as observed_value, {unexpected} as unexpected_count from {table}"""


ROWS = "expect_table_row_count_to_be_between"
NULLS = "expect_column_values_to_not_be_null"
UNIQ = "expect_column_values_to_be_unique"
INSET = "expect_column_values_to_be_in_set"
RANGE = "expect_column_values_to_be_between"
MEAN = "expect_column_mean_to_be_between"
F_, D_, R_ = ("feat", "feature_default_prediction"), ("dim", "dim_borrower"), ("mart", "mart_portfolio_risk")
B, W = "blocking", "warning"


def _bad(rule: str) -> str:
    return f"count(*) filter (where {rule})"


def _repeats(column: str) -> str:
    return f"count({column}) - (select count(*) from (select {column} from {{t}} group by 1 having count(*) = 1 and {column} is not null))"


def _suite(low: int, high: int) -> list[str]:
    def unique(at, position):
        return _check(*at, position, UNIQ, "client_id", B, bad=_repeats("client_id").replace("{t}", at[0]))

    return [
        _check(*F_, 0, ROWS, None, B, seen="count(*)", low=low, high=high),
        _check(*F_, 1, NULLS, "client_id", B, bad=_bad("client_id is null")),
        unique(F_, 2),
        _check(*F_, 3, NULLS, "is_default", B, bad=_bad("is_default is null")),
        _check(*F_, 4, INSET, "is_default", B, bad=_bad("is_default not in (0, 1)")),
        _check(*F_, 5, RANGE, "credit_limit", B, bad=_bad("credit_limit not between 0 and 2000000")),
        _check(*F_, 6, RANGE, "age", B, bad=_bad("age not between 18 and 100")),
        _check(*F_, 7, RANGE, "months_delinquent", B, bad=_bad("months_delinquent not between 0 and 6")),
        _check(*F_, 8, MEAN, "is_default", W, seen="avg(is_default)", low=0.15, high=0.30),
        _check(*F_, 9, RANGE, "max_repay_status", W, bad=_bad("max_repay_status not between -2 and 9")),
        _check(*D_, 0, ROWS, None, B, seen="count(*)", low=low, high=high),
        _check(*D_, 1, NULLS, "client_id", B, bad=_bad("client_id is null")),
        unique(D_, 2),
        _check(*D_, 3, INSET, "sex", B, bad=_bad("sex not in ('male', 'female', 'unknown')")),
        _check(*R_, 0, ROWS, None, B, seen="count(*)", low=1, high=100),
        _check(*R_, 1, RANGE, "default_rate", B, bad=_bad("default_rate not between 0 and 1")),
        _check(*R_, 2, RANGE, "n_clients", B, bad=_bad("n_clients < 1")),
        _check(
            *R_, 3, INSET, "segment_dimension", W,
            bad=_bad("segment_dimension not in ('age_band', 'credit_limit_band', 'education_level', 'sex', "
                     "'marital_status', 'region')"),
        ),
    ]


WIDE = (1, 1_000_000_000)
NARROW = (25_000, 35_000)


def _union(parts) -> str:
    return "\nunion all\n".join(parts)


def _results() -> str:
    def run(run_id: str, run_at: str, rows: tuple[int, int]) -> str:
        return f"""select '{run_id}' as run_id, timestamp '{run_at}' as run_at, * exclude (position)
            from ({_union(_suite(*rows))})"""

    return _union(
        [
            run("20240131T020000Z", "2024-01-31 02:00:00", WIDE),
            run("20240201T020000Z", "2024-02-01 02:00:00", NARROW),
        ]
    )


def _checks(names: str, parts: list[str]) -> str:
    return _with(names, _union(parts))


SUMMARY = """
    select run_id, run_at, target_table, severity, count(*) as checks,
        count(*) filter (where success) as passed, count(*) filter (where not success) as failed,
        round(count(*) filter (where success) / count(*), 4) as pass_rate,
        run_id = max(max(run_id)) over () as is_latest
    from results group by run_id, run_at, target_table, severity"""


def _not_null() -> str:
    declared = {
        ("stg", "stg_clients"): "client_id is_default age credit_limit",
        ("pay", "stg_payments"): "txn_id client_id",
        ("dim", "dim_borrower"): "client_id age_band credit_limit_band region",
        ("fact", "fct_payment_history"): "payment_history_id client_id month_index",
        ("mart", "mart_portfolio_risk"): "segment_dimension segment_value default_rate",
        ("feat", "feature_default_prediction"): "client_id is_default",
        ("dim", "gov_borrower_risk_analyst"): "client_id",
        ("ana", "gov_borrower_analyst"): "client_id",
        ("payview", "gov_payments_analyst"): "txn_id",
        ("(select * from ana where region = 'west')", "gov_borrower_regional"): "client_id",
    }
    return _union(
        f"select '{model}' as model, '{c}' as column_name, count(*) - count({c}) as failures from {table}"
        for (table, model), columns in declared.items()
        for c in columns.split()
    )


def _unique() -> str:
    declared = {
        ("stg", "stg_clients"): "client_id",
        ("pay", "stg_payments"): "txn_id",
        ("dim", "dim_borrower"): "client_id",
        ("fact", "fct_payment_history"): "payment_history_id",
        ("feat", "feature_default_prediction"): "client_id",
        ("dim", "gov_borrower_risk_analyst"): "client_id",
        ("ana", "gov_borrower_analyst"): "client_id",
        ("payview", "gov_payments_analyst"): "txn_id",
        ("(select * from ana where region = 'west')", "gov_borrower_regional"): "client_id",
    }
    return _union(
        f"""select '{model}' as model, '{c}' as column_name, count(*) as failures
            from (select {c} from {table} where {c} is not null group by 1 having count(*) > 1)"""
        for (table, model), c in declared.items()
    )


def _accepted() -> str:
    declared = {
        ("stg", "stg_clients", "is_default"): "(0, 1)",
        ("stg", "stg_clients", "sex_code"): "(1, 2)",
        ("pay", "stg_payments", "status"): "('POSTED', 'PENDING', 'FAILED')",
        ("dim", "dim_borrower", "sex"): "('male', 'female', 'unknown')",
        ("dim", "dim_borrower", "region"): "('north', 'south', 'east', 'west')",
        ("fact", "fct_payment_history", "month_index"): "(1, 2, 3, 4, 5, 6)",
        ("feat", "feature_default_prediction", "is_default"): "(0, 1)",
        ("payview", "gov_payments_analyst", "borrower_ip"): "('***.***.***.***')",
    }
    return _union(
        f"""select '{model}' as model, '{c}' as column_name, {c}::varchar as value, count(*) as n_records
            from {table} where {c} not in {accepted} group by {c}"""
        for (table, model, c), accepted in declared.items()
    )


def _relationships() -> str:
    declared = {
        ("pay", "stg_payments"): "stg",
        ("fact", "fct_payment_history"): "dim",
        ("feat", "feature_default_prediction"): "dim",
    }
    return _union(
        f"""select '{model}' as model, 'client_id' as column_name, c.client_id as orphan, count(*) as n_rows
            from {child} c
            left join (select client_id from {parent} where client_id % 50 <> 0) p on p.client_id = c.client_id
            where c.client_id is not null and p.client_id is null group by c.client_id"""
        for (child, model), parent in declared.items()
    )


NUMERIC = (
    "credit_limit age avg_repay_status max_repay_status months_delinquent total_bill_amt total_pay_amt "
    "avg_utilization pay_to_bill_ratio"
).split()
CATEGORICAL = "sex_code education_code marriage_code age_band credit_limit_band".split()

IMPUTED = f"""
    select client_id, {", ".join(f"coalesce({c}::double, (select median({c}::double) from feat)) as {c}" for c in NUMERIC)}
    from feat"""

RANK_AUC = """
    select model, (sum(if(label = 1, rank_avg, 0)) - p * (p + 1) / 2) / (p * n) as auc
    from (
        select model, label,
            rank() over (partition by model order by score)
                + (count(*) over (partition by model, score) - 1) / 2 as rank_avg,
            (sum(label) over (partition by model))::double as p,
            (sum(1 - label) over (partition by model))::double as n
        from test_scores
    ) group by model, p, n"""
KS = """
    select model, greatest(0, max(tpr - fpr)) as ks
    from (
        select model,
            sum(label) over w / sum(label) over (partition by model) as tpr,
            sum(1 - label) over w / sum(1 - label) over (partition by model) as fpr
        from test_scores window w as (partition by model order by score desc range unbounded preceding)
    ) group by model"""
METRICS = f"""
    select model, round_even(auc, 4) as auc, round_even(ks, 4) as ks, round_even(brier, 4) as brier,
        n_scored, n_unscored
    from ({RANK_AUC}) join ({KS}) using (model)
    join (
        select model, avg((score - label) ** 2) as brier, count(score) as n_scored,
            count(*) - count(score) as n_unscored
        from test_scores group by model
    ) using (model)"""


def _calibration(model: str, column: str) -> str:
    return f"""
        select '{model}' as model, row_number() over (order by slot)::int as bin,
            round_even(avg(p), 4) as predicted_pd, round_even(avg(is_default), 4) as observed_default_rate
        from (
            select s.{column} as p, s.is_default, len(list_filter(q.edges, lambda e: e < s.{column})) as slot
            from scores s, (
                select quantile_cont({column}, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) as edges
                from scores where is_test
            ) q where s.is_test
        ) group by slot"""


def _class_rows(table: str, cte: str, columns: dict[str, tuple[str, str | None]]) -> str:
    return _union(
        f"""select '{table}' as table_name, '{c}' as column_name, '{kind}' as classification,
            {f"'{method}'" if method else "null::varchar"} as masking, count({c}) as n_values from {cte}"""
        for c, (kind, method) in columns.items()
    )


CLIENT_CLASSES = {
    "client_id": ("PUBLIC", None),
    "credit_limit": ("CONFIDENTIAL", "null_int"),
    "sex_code": ("PII", None),
    "education_code": ("PII", None),
    "marriage_code": ("PII", None),
    "age": ("PII", "null_int"),
    **{f"{p}_m{m}": ("PUBLIC", None) for p in ("repay_status", "bill_amt", "pay_amt") for m in M},
    "is_default": ("PUBLIC", None),
    "load_date": ("PUBLIC", None),
    "loaded_at": ("PUBLIC", None),
}
PAYMENT_CLASSES = {
    **{c: ("PUBLIC", None) for c in "txn_id client_id txn_ts amount channel txn_type status".split()},
    "borrower_email": ("PII", "email"),
    "borrower_ip": ("PII", "ip"),
    "load_date": ("PUBLIC", None),
    "loaded_at": ("PUBLIC", None),
}


def _freshness(moment: str) -> str:
    return f"""select max(ts) as max_loaded_at, age as age_seconds, '{moment}' as as_of,
        case when age > 52 * 3600 then 'error' when age > 26 * 3600 then 'warn' else 'pass' end as status
        from (select ts, date_diff('microsecond', max(ts) over (), timestamp '{moment}') // 1000000 as age from events)
        group by age"""


def _null_rates() -> str:
    columns = (
        "client_id credit_limit age sex_code education_code marriage_code avg_repay_status max_repay_status "
        "months_delinquent total_bill_amt total_pay_amt avg_utilization age_band credit_limit_band is_default "
        "pay_to_bill_ratio late"
    ).split()
    return _union(
        f"""select '{c}' as column_name, count(*) - count({c}) as n_null, count(*) as n_rows,
            round(1 - count({c}) / count(*), 4) as null_rate, 1 - count({c}) / count(*) <= 0.01 as success
            from (select *, if(max_repay_status > 0, 1, null) as late from feat)"""
        for c in columns
    )


def _schema_rows() -> str:
    declared = {
        "txn_id": ("string", "string", "ok"),
        "borrower_id": ("bigint", "bigint", "ok"),
        "txn_ts": ("timestamp", "timestamp_ntz", "type_changed"),
        "amount": ("double", "double", "ok"),
        "channel": ("string", "string", "ok"),
        "txn_type": ("string", "string", "ok"),
        "status": ("string", "string", "ok"),
        "borrower_email": ("string", "string", "ok"),
        "borrower_ip": ("string", "string", "ok"),
        "_source_file": (None, "string", "unexpected"),
        "_load_date": (None, "date", "unexpected"),
        "_loaded_at": (None, "timestamp_ntz", "unexpected"),
        "_part": (None, "bigint", "unexpected"),
        "_supplier": (None, "bigint", "unexpected"),
    }
    return _union(
        f"""select '{c}' as column_name, {f"'{want}'" if want else "null::varchar"} as declared_type,
            '{have}' as actual_type, '{status}' as status, count({c}) as n_values, 0::bigint as n_unreadable
            from raw_pay"""
        for c, (want, have, status) in declared.items()
    )


SCD2 = "credit_limit, sex_code, education_code, marriage_code, age"


def _volume_band(events: str) -> str:
    return f"""
            with counted as (select event_type as source, ts::date as day, count(*) as n from {events} e group by 1, 2),
            spine as (
                select source, unnest(generate_series(min(day)::timestamp, (select max(day) from counted)::timestamp,
                    interval 1 day))::date as day
                from counted group by source
            ),
            daily as (
                select source, day, coalesce(n, 0)::bigint as row_count from spine left join counted using (source, day)
            ),
            usual as (
                select *, avg(row_count) over (partition by source order by day rows between 7 preceding and 1 preceding)
                        as mean_before,
                    row_count - lag(row_count) over (partition by source order by day) as row_delta
                from daily
            )
            select source, day, row_count, round(mean_before, 4) as trailing_avg, row_delta,
                coalesce(abs(row_count - mean_before) <= mean_before * 0.15::double, true) as within_band
            from usual"""


DAILY_RUN = """
    with n as (select count(*) as clients from customer), e as (select count(*) as payments from events)
    select * from (
        select unnest([
            {'table_name': 'stg_clients', 'row_count': clients}, {'table_name': 'dim_borrower', 'row_count': clients},
            {'table_name': 'stg_payments', 'row_count': payments}, {'table_name': 'gov_payments_analyst', 'row_count': payments},
            {'table_name': 'fct_payment_history', 'row_count': 6 * clients},
            {'table_name': 'feature_default_prediction', 'row_count': clients},
            {'table_name': 'gov_borrower_analyst', 'row_count': clients},
            {'table_name': 'gov_borrower_risk_analyst', 'row_count': clients},
            {'table_name': 'gov_borrower_regional', 'row_count': west},
            {'table_name': 'model_scores', 'row_count': clients}, {'table_name': 'scores_in_range', 'row_count': clients},
            {'table_name': 'test_rows', 'row_count': ceil(clients * 0.25)::bigint},
            {'table_name': 'model_calibration', 'row_count': 20}, {'table_name': 'model_segments', 'row_count': bands},
            {'table_name': 'model_split', 'row_count': 4}, {'table_name': 'useful_models', 'row_count': 2},
            {'table_name': 'dq_results', 'row_count': 18}, {'table_name': 'manifest_sources', 'row_count': 3},
            {'table_name': 'stg_loans', 'row_count': loans}, {'table_name': 'fct_loan', 'row_count': loans},
            {'table_name': 'manifest_rows', 'row_count': clients + payments + loans + twice},
            {'table_name': 'monitored', 'row_count': 16}
        ], recursive := true)
        from n, e, (select count(*) as loans, count(*) filter (o_orderkey % 5 = 0) as twice from orders),
            (select count(*) as west from customer where c_custkey % 4 = 3),
            (select count(distinct case when c_custkey % 89 = 3 or floor(abs(c_acctbal))::int * 50 < 50000 then 1
                when floor(abs(c_acctbal))::int * 50 < 150000 then 2
                when floor(abs(c_acctbal))::int * 50 < 300000 then 3 else 4 end) as bands from customer)
    )
"""


def oracle_sql() -> dict[str, str]:
    stamps = f"date '2024-01-31' as _load_date, {TIME} as _loaded_at"
    raw_columns = ", ".join(
        ["ID"]
        + [f"{c}::int as {c}" for c in "LIMIT_BAL SEX EDUCATION MARRIAGE AGE PAY_0 PAY_2 PAY_3 PAY_4 PAY_5 PAY_6".split()]
        + [f"BILL_AMT{m}" for m in M]
        + [f"PAY_AMT{m}" for m in M]
        + ['"default payment next month"::int as "default payment next month"']
    )
    results = _results()
    found = _oracles(stamps, raw_columns, results)
    split = found["stratified_split"]
    valid = f"select client_id, is_default, is_test, true as is_probability, true as separates from ({split})"
    found |= {"score_logreg": valid, "score_gbt": valid}
    found["model_scores"] = f"select client_id, is_default, is_test, true as same_after_reload from ({split})"
    codes = "sex_code education_code marriage_code age_band credit_limit_band".split()
    known = " + ".join(f"(select count(distinct {c}) from train)" for c in codes)
    found["logreg_optimality"] = _with(
        "feat",
        f"""with train as (select * from feat where client_id in (select client_id from ({split}) where not is_test))
        select unnest(generate_series(-1, (8 + {known})::int))::int as position, true as is_zero""",
    )
    return found


def _oracles(stamps: str, raw_columns: str, results) -> dict[str, str]:
    return {
        "load_clients": _with("raw_one", f"select {raw_columns}, {stamps} from raw_one"),
        "load_transactions": _with(
            "feed",
            f"""select * exclude (load_date), load_date as _load_date, {TIME} as _loaded_at from feed
            where load_date = (select max(load_date) from feed)""",
        ),
        "load_loan_tape": _with(
            "raw_tape",
            f"select *, date '1970-01-01' as _load_date, {TIME} as _loaded_at from raw_tape",
        ),
        "latest_partition": """
            select max(ts)::date::varchar as load_date,
                count(*) filter (where ts::date = (select max(ts)::date from events)) as row_count
            from events""",
        "stamp_load_metadata": f"select *, 'orders.parquet' as _source_file, {stamps} from orders",
        "replace_partition": """
            select event_id::varchar as txn_id, value * if(ts >= timestamp '2024-01-26', 2, 1) as amount,
                ts::date as _load_date from events""",
        "table_inventory": _union(
            f"select '{t}' as table_name, count(*) as row_count from {t}" for t in bridge.GIVEN
        ),
        "publish_dq_results": _with("feat dim mart", results),
        "stg_clients": _with(
            "raw_two",
            f"""select {CLIENT_COLUMNS} from raw_two
            qualify row_number() over (partition by ID order by _loaded_at desc) = 1""",
        ),
        "stg_payments": _with("pay", "select * from pay"),
        "dedupe_latest": """
            select * from lineitem qualify row_number() over (
                partition by l_orderkey, l_linenumber order by l_shipdate desc, l_partkey desc, l_suppkey desc) = 1""",
        "dim_borrower": _with("dim", "select * from dim"),
        "labelled_borrowers": _with("lab", "select * from lab"),
        "fct_payment_history": _with("fact", "select * from fact"),
        "feature_default_prediction": _with("feat", "select * from feat"),
        "mart_portfolio_risk": _with("mart", "select * from mart"),
        "mask_methods": _with(
            "pay",
            """select txn_id, '****' || substr(borrower_email, instr(borrower_email, '@')) as email,
            '***.***.***.***' as ip, null::varchar as nothing, null::int as no_number, '***MASKED***' as hidden
            from pay""",
        ),
        "apply_masking_policy": _with(
            "pay payview",
            """select txn_id, borrower_email, borrower_ip, 'RISK_ANALYST' as role from pay
            union all select txn_id, borrower_email, borrower_ip, 'ANALYST' from payview""",
        ),
        "gov_borrower_analyst": _with("ana", "select * from ana"),
        "gov_borrower_risk_analyst": _with("dim", "select * from dim"),
        "gov_payments_analyst": _with("payview", "select * from payview"),
        "gov_borrower_regional": _with("ana", "select * from ana where region = 'west'"),
        "row_access_entitled": _with(
            "dim",
            """select role, client_id, region from dim, (select unnest(['ADMIN', 'REGIONAL_ANALYST', 'ANALYST']) as role)
            where role = 'ADMIN' or exists (
                select 1 from (values ('REGIONAL_ANALYST', 'north'), ('REGIONAL_ANALYST', 'east')) e(who, place)
                where who = role and place = region)""",
        ),
        "pii_leaks": _with(
            "ana payview dim pay",
            _union(
                f"select '{v}' as violation, {i}::varchar as id, '{view}' as view from {t} where {rule}"
                for view, borrowers, payments in (("analyst", "ana", "payview"), ("clear", "dim", "pay"))
                for v, i, t, rule in (
                    ("age_not_masked", "client_id", borrowers, "age is not null"),
                    ("credit_limit_not_masked", "client_id", borrowers, "credit_limit is not null"),
                    ("email_not_masked", "txn_id", payments, "not starts_with(borrower_email, '****@')"),
                    ("ip_not_masked", "txn_id", payments, "borrower_ip <> '***.***.***.***'"),
                )
            ),
        ),
        "row_access_leaks": _with("dim", "select client_id, 'whole' as view from dim where region <> 'west'"),
        "classification_report": _with(
            "stg pay",
            _class_rows("stg_clients", "stg", CLIENT_CLASSES)
            + "\nunion all\n"
            + _class_rows("stg_payments", "pay", PAYMENT_CLASSES),
        ),
        "expect_row_count": _checks(
            "feat dim mart",
            [
                _check(*F_, 0, ROWS, None, B, seen="count(*)", low=WIDE[0], high=WIDE[1]),
                _check(*F_, 1, ROWS, None, B, seen="count(*)", low=1, high=10),
                _check(*D_, 0, ROWS, None, B, seen="count(*)", low=WIDE[0], high=WIDE[1]),
                _check(*R_, 0, ROWS, None, B, seen="count(*)", low=1, high=100),
            ],
        ),
        "expect_not_null": _checks(
            "feat dim",
            [
                _check(*F_, 0, NULLS, "client_id", B, bad=_bad("client_id is null")),
                _check(*F_, 1, NULLS, "is_default", B, bad=_bad("is_default is null")),
                _check(*F_, 2, NULLS, "avg_utilization", B, bad=_bad("avg_utilization is null")),
                _check(*D_, 0, NULLS, "client_id", B, bad=_bad("client_id is null")),
            ],
        ),
        "expect_unique": _with(
            "raw_pay",
            "select * exclude (suite_name, target_table) from ("
            + _union(
                _check("raw_pay", "x", i, UNIQ, c, B, bad=_repeats(c).replace("{t}", "raw_pay"))
                for i, c in enumerate(("txn_id", "channel"))
            )
            + ")",
        ),
        "expect_in_set": _checks(
            "feat dim mart",
            [
                _check(*F_, 0, INSET, "is_default", B, bad=_bad("is_default not in (0, 1)")),
                _check(*F_, 1, INSET, "sex_code", B, bad=_bad("sex_code not in (1, 2)")),
                _check(*D_, 0, INSET, "sex", B, bad=_bad("sex not in ('male', 'female', 'unknown')")),
                _suite(*WIDE)[17].replace("3::int as position", "0::int as position"),
            ],
        ),
        "expect_between": _checks(
            "feat mart",
            [
                _check(*F_, 0, RANGE, "credit_limit", B, bad=_bad("credit_limit not between 0 and 2000000")),
                _check(*F_, 1, RANGE, "age", B, bad=_bad("age not between 18 and 100")),
                _check(*F_, 2, RANGE, "months_delinquent", B, bad=_bad("months_delinquent not between 0 and 6")),
                _check(*F_, 3, RANGE, "max_repay_status", W, bad=_bad("max_repay_status not between -2 and 9")),
                _check(*F_, 4, RANGE, "age", B, bad=_bad("age not between 30 and 60")),
                _check(*F_, 5, RANGE, "max_repay_status", B, bad=_bad("max_repay_status > 0")),
                _check(*R_, 0, RANGE, "default_rate", B, bad=_bad("default_rate not between 0 and 1")),
                _check(*R_, 1, RANGE, "n_clients", B, bad=_bad("n_clients < 1")),
            ],
        ),
        "expect_mean_between": _checks(
            "feat",
            [
                _check(*F_, 0, MEAN, "is_default", W, seen="avg(is_default)", low=0.15, high=0.30),
                _check(*F_, 1, MEAN, "age", B, seen="avg(age)", low=18, high=100),
            ],
        ),
        "dq_suite": _with("feat dim mart", _union(_suite(*WIDE))),
        "dq_results": _with("feat dim mart", results),
        "dq_gate": _with(
            "feat dim mart", f"select * from ({results}) where not success and severity = 'blocking'"
        ),
        "test_not_null": _with("stg pay dim fact mart feat ana payview", _not_null()),
        "test_unique": _with("stg pay dim fact feat ana payview", _unique()),
        "test_accepted_values": _with("stg pay dim fact feat payview", _accepted()),
        "test_relationships": _with("stg pay dim fact feat", _relationships()),
        "test_non_negative_amount": _with(
            "pay", "select txn_id, amount - 50000::double as amount from pay where amount < 50000"
        ),
        "fk_orphans": _with(
            "pay dim",
            """select client_id as orphan, count(*) as n_rows, 'regional' as parent from pay
            where client_id not in (select client_id from dim where region = 'west') group by 1""",
        ),
        "source_freshness": _union(
            _freshness(m) for m in ("2024-01-31 12:00:00", "2024-02-01 06:00:00", "2024-02-03 00:00:00")
        ),
        "mart_data_quality": _with("feat dim mart", f"with results as ({results}) {SUMMARY}"),
        "dq_latest_detail": _with(
            "feat dim mart",
            f"""with results as ({results})
            select target_table, expectation_type, column_name, severity, success, observed_value
            from results where run_id = (select max(run_id) from results)""",
        ),
        "dq_latest_kpis": _with(
            "feat dim mart",
            f"""with results as ({results})
            select max(run_id) as run_id, count(*) as checks, count(*) filter (where success) as passed,
                count(*) filter (where success) / count(*) as pass_rate
            from results where run_id = (select max(run_id) from results)""",
        ),
        "portfolio_kpis": _with(
            "feat",
            """select count(*) as borrowers, sum(credit_limit)::bigint as total_exposure,
            avg(credit_limit) as avg_limit, avg(is_default) as default_rate from feat""",
        ),
        "borrowers_by_limit_band": _with(
            "dim", "select credit_limit_band as band, count(*) as borrowers from dim group by 1"
        ),
        "borrowers_by_region": _with("dim", "select region, count(*) as borrowers from dim group by 1"),
        "segment_dimensions": _with("mart", "select distinct segment_dimension from mart"),
        "segment_detail": _with(
            "mart",
            """select segment_value, n_clients, n_default, default_rate, total_credit_limit_exposure
            from mart where segment_dimension = 'credit_limit_band'""",
        ),
        "delinquency_trend": _with(
            "fact",
            """select concat('m', month_index) as statement_month, avg(is_delinquent::int) as delinquency_rate,
            round(avg(utilization), 9) as avg_utilization from fact group by month_index""",
        ),
        "pd_histogram": _with(
            "scores",
            "select (pd_xgboost * 10)::int / 10 as pd_bucket, count(*) as borrowers from scores group by 1",
        ),
        "pd_vs_actual_by_band": _with(
            "scores dim",
            """select d.credit_limit_band as band, round(avg(s.pd_xgboost), 9) as predicted_pd,
            avg(s.is_default) as actual_rate from scores s join dim d using (client_id) group by 1""",
        ),
        "top_risk_borrowers": _with(
            "scores dim",
            """select s.client_id, round(s.pd_xgboost, 4) as pd, s.is_default, d.credit_limit_band, d.age_band, d.region
            from scores s join dim d using (client_id) order by s.pd_xgboost desc, s.client_id limit 15""",
        ),
        "stratified_split": _with(
            "feat",
            """with hashed as (
                select client_id, is_default,
                    ('0x' || substr(md5('42-' || client_id::varchar), 1, 15))::bigint as h from feat
            ), sizes as (
                select is_default, n, ceil(0.25 * sum(n) over ())::bigint as wanted, sum(n) over () as total
                from (select is_default, count(*) as n from hashed group by 1)
            ), shares as (
                select is_default, wanted, (wanted * n // total)::bigint as whole,
                    row_number() over (order by wanted * n % total desc, is_default) as place,
                    sum(wanted * n // total) over () as given
                from sizes
            )
            select client_id, is_default,
                row_number() over (partition by is_default order by h, client_id)
                    <= whole + if(place <= wanted - given, 1, 0) as is_test
            from hashed join shares using (is_default)""",
        ),
        "median_impute": _with("feat", IMPUTED),
        "standard_scale": _with(
            "feat",
            f"""with filled as ({IMPUTED})
            select client_id, {", ".join(
                f"round(({c} - (select avg({c}) from filled)) / (select stddev_pop({c}) from filled), 6) as {c}"
                for c in NUMERIC)}
            from filled""",
        ),
        "one_hot": _with(
            "feat",
            _union(
                f"""select '{c}' as feature, (row_number() over (order by {c}::varchar) - 1)::int as position,
                count(*) as n_rows from feat group by {c}"""
                for c in CATEGORICAL
            ),
        ),
        "score_test_flag": _with("scores", "select client_id, is_default, client_id % 4 = 0 as is_test from scores"),
        "roc_points": _with(
            "test_scores",
            """with per_score as (
                select model, score, sum(label)::bigint as positives, sum(1 - label)::bigint as negatives
                from test_scores group by model, score
            )
            select model, score, positives, negatives,
                (sum(positives) over w)::bigint as cum_positives, (sum(negatives) over w)::bigint as cum_negatives,
                (sum(positives) over w)::bigint / (sum(positives) over (partition by model))::bigint as tpr,
                (sum(negatives) over w)::bigint / (sum(negatives) over (partition by model))::bigint as fpr
            from per_score window w as (partition by model order by score desc)""",
        ),
        "auc": _with("test_scores", f"select model, round_even(auc, 9) as auc from ({RANK_AUC})"),
        "ks": _with("test_scores", f"select model, round_even(ks, 9) as ks from ({KS})"),
        "brier": _with(
            "test_scores",
            "select model, round_even(avg((score - label) ** 2), 9) as brier from test_scores group by model",
        ),
        "calibration_deciles": _with(
            "scores",
            _calibration("logreg", "pd_logreg")
            + "\nunion all\n"
            + _calibration("xgboost", "pd_xgboost"),
        ),
        "model_metrics": _with("test_scores", METRICS),
        "published_metrics": _with(
            "test_scores",
            f"""with m as ({METRICS}) select model, auc, ks, brier,
                row_number() over (order by auc desc, model) = 1 as is_champion from m""",
        ),
        "split_report": _with(
            "scores",
            """with long as (
                select 'logreg' as model, pd_logreg as score, is_default as label, is_test from scores
                union all select 'xgboost', pd_xgboost, is_default, is_test from scores
            ), ranked as (
                select *, rank() over (partition by model, is_test order by score)
                    + (count(*) over (partition by model, is_test, score) - 1) / 2 as place from long
            )
            select model, if(is_test, 'test', 'train') as side, count(*) as n, round_even(avg(label), 4) as mean_label,
                round_even((sum(if(label = 1, place, 0)) - sum(label) * (sum(label) + 1) / 2)
                    / (sum(label)::double * sum(1 - label)), 4) as auc
            from ranked group by model, is_test""",
        ),
        "catalog_roundtrip": _with(
            "dim",
            """select client_id, region, false as before, true as after, (select count(*) from dim) as rows from dim""",
        ),
        "load_chosen_sources": """
            select 'clients' as source, null::bigint as row_count
            union all select 'transactions', count(*) from events where ts::date = (select max(ts::date) from events)""",
        "file_manifest": _union(
            f"""select '{t}' as source, '{t}.parquet' as data_file, 'given' as origin,
                (select count(*) from {t}) as row_count, size as byte_size, sha256(content) as sha256,
                {TIME} as loaded_at from read_blob('{GIVEN_DIR}/{t}.parquet')"""
            for t in bridge.GIVEN
        ),
        "champion_model": _with(
            "test_scores", f"select model, auc from ({METRICS}) order by auc desc, model limit 1"
        ),
        "segment_pd_report": _with(
            "scores dim",
            """select credit_limit_band, count(*) as n, round_even(avg(pd_xgboost), 4) as predicted_pd,
            round_even(avg(is_default), 4) as actual_default_rate
            from scores join dim using (client_id) where is_test group by 1""",
        ),
        "ingest_events_stream": _with(
            "feed", "select txn_id, borrower_id, txn_ts, amount, load_date as _load_date from feed"
        ),
        "ingest_two_streams": _with(
            "feed", "select txn_id, borrower_id, txn_ts, amount, load_date as _load_date from feed"
        ),
        "reload_empty_day": _with(
            "feed",
            """select load_date as _load_date, count(*) as row_count from feed
            where load_date = (select max(load_date) from feed where load_date < (select max(load_date) from feed))
            group by 1""",
        ),
        "refused_client_files": """
            select * from (values ('whole', false), ('bad_key', true), ('empty_key', true), ('no_numbers', true),
                ('blank_row', true), ('short_rows', true), ('one_column', true)) t(file, refused)
            where (select count(*) from customer) > 0""",
        # The first batch is what lies before the cut; its newest event, less the delay, is the watermark.
        "dedupe_events_stream": _with(
            "raw_pay",
            f"""with rows as (
                select txn_id, borrower_id, txn_ts, amount, txn_ts < date '{STREAM_CUT}' as early,
                    split_part(txn_id, '-', 1)::bigint % 5 = 0 as repeated
                from raw_pay
            ), one as (
                select txn_id, borrower_id, txn_ts, amount from rows where early
                qualify row_number() over (partition by txn_id order by txn_ts, borrower_id, amount) = 1
            ), mark as (select max(txn_ts) - interval {STREAM_DELAY} as horizon from one),
            two as (
                select txn_id, borrower_id, txn_ts, amount from rows, mark
                where (not early or repeated) and txn_ts >= horizon
                    and txn_id not in (select txn_id from one, mark where txn_ts >= date_trunc('month', horizon))
                qualify row_number() over (partition by txn_id order by txn_ts, borrower_id, amount) = 1
            )
            select *, false as is_late from one
            union all select *, false from two
            union all select txn_id, borrower_id, txn_ts, amount, true from rows, mark
                where repeated and early and txn_ts < horizon""",
        ),
        "clean_loan_tape": _with("tape", "select * from tape"),
        "clustered_layout": _with("tape", "select * from tape"),
        "scd2_snapshot": _with(
            "raw_two",
            f"""with old as (select {CLIENT_COLUMNS} from raw_two where _load_date = date '2024-01-30'),
            new as (select {CLIENT_COLUMNS} from raw_two where _load_date = date '2024-01-31'),
            changed as (
                select client_id from old join new using (client_id)
                where (old.credit_limit, old.sex_code, old.education_code, old.marriage_code, old.age)
                    is distinct from (new.credit_limit, new.sex_code, new.education_code, new.marriage_code, new.age)
            )
            select client_id, {SCD2}, timestamp '{bridge.OLDER_LOADED_AT}' as valid_from,
                if(client_id in (from changed), {TIME}, null) as valid_to,
                client_id not in (from changed) as is_current
            from old
            union all
            select client_id, {SCD2}, {TIME}, null, true from new
            where client_id in (from changed) or client_id not in (select client_id from old)""",
        ),
        "mart_delinquency_trend": _with(
            "fact",
            """select month_index, count(*) as n_accounts, count(*) filter (where is_delinquent) as n_delinquent,
            round(avg(is_delinquent::int), 4) as delinquency_rate, round(avg(utilization), 4) as avg_utilization
            from fact group by 1""",
        ),
        "vintage_curves": _with(
            "loan_defaults",
            """with aged as (
                select strftime(issue_date, '%Y') || '-Q' || quarter(issue_date) as cohort,
                    date_diff('month', date_trunc('month', issue_date), date_trunc('month', default_date)) as months_on_book
                from loan_defaults
            ), book as (select cohort, count(*) as cohort_loans from aged group by 1)
            select cohort, months_on_book::int as months_on_book, cohort_loans, count(*) as defaults,
                (sum(count(*)) over (partition by cohort order by months_on_book))::bigint as cum_defaults,
                round((sum(count(*)) over (partition by cohort order by months_on_book))::bigint / cohort_loans, 4)
                    as cum_default_rate
            from aged join book using (cohort) where months_on_book is not null
            group by cohort, months_on_book, cohort_loans""",
        ),
        "drifted_files": _with(
            "feed",
            """with days as (select distinct load_date from feed where day(load_date) = 17)
            select load_date::varchar as load_date, t.* from days, (values
                ('channel', 'string', null, 'missing'), ('amount', 'double', 'string', 'type_changed'),
                ('remark', null, 'string', 'unexpected')) t(column_name, declared_type, actual_type, status)""",
        ),
        "survival_curves": _with(
            "loan_defaults",
            """with seen as (
                select strftime(issue_date, '%Y') || '-Q' || quarter(issue_date) as cohort,
                    coalesce(default_date <= date '1996-07-15', false) as defaulted,
                    date_diff('month', date_trunc('month', issue_date), date_trunc('month',
                        case when default_date <= date '1996-07-15' then default_date else date '1996-07-15' end))::int as m
                from loan_defaults where issue_date <= date '1996-07-15'
            ), by_age as (
                select cohort, m, count(*) filter (defaulted) as defaults, count(*) filter (not defaulted) as censored,
                    (select count(*) from seen o where o.cohort = s.cohort and o.m >= s.m) as at_risk
                from seen s group by cohort, m
            )
            select cohort, m as months_on_book, at_risk, defaults, censored, round(defaults / at_risk, 6) as hazard,
                round(product(1 - defaults / at_risk) over (partition by cohort order by m), 6) as survival
            from by_age""",
        ),
        "expected_defaults": "with recursive" + _with(
            "fact stg",
            """with moves as (
                select lag(repay_status) over (partition by client_id order by month_index desc) as a, repay_status as b,
                    month_index from fact
            ), p as (
                select a, b, count(*) / (sum(count(*)) over (partition by a)) as rate
                from moves where month_index < 6 and a is not null and b is not null and a < 3 group by a, b
            ), walk as (
                select a as start, b as state, rate as chance, 1 as months from p
                union all
                select start, state, sum(chance), months from (
                    select w.start, coalesce(p.b, w.state) as state, w.chance * coalesce(p.rate, 1) as chance,
                        w.months + 1 as months
                    from walk w left join p on p.a = w.state where w.months < 12
                ) group by start, state, months
            ), chance as (
                select start, months, coalesce(sum(chance) filter (state >= 3), 0) as chance from walk group by start, months
            )
            select months, count(*) as n_clients, round(sum(chance), 4) as expected_defaults
            from stg join chance on repay_status_m1 = start group by months""",
        ).removeprefix("with"),
        "roll_rate": _with(
            "fact",
            """with moves as (
                select lag(repay_status) over (partition by client_id order by month_index desc) as from_status,
                    repay_status as to_status, month_index
                from fact
            )
            select from_status, to_status, count(*) as n_moves,
                round(count(*) / (sum(count(*)) over (partition by from_status))::bigint, 4) as roll_rate
            from moves where month_index < 6 group by 1, 2""",
        ),
        "dim_date": """
            select strftime(d, '%Y%m%d')::int as date_key, d::date as date_day, year(d)::int as year,
                quarter(d)::int as quarter, month(d)::int as month, day(d)::int as day,
                isodow(d)::int as iso_weekday, isodow(d) > 5 as is_weekend
            from (
                select unnest(generate_series(min(o_orderdate)::date, max(o_orderdate)::date, interval 1 day)) as d
                from orders
            )""",
        "fct_loan": _with(
            "tape",
            """select loan_id, client_id, strftime(issue_date, '%Y%m%d')::int as issue_date_key, principal, int_rate,
            grade, loan_status, loan_status in ('charged off', 'default') as is_defaulted from tape""",
        ),
        "fct_payment": _with(
            "pay",
            """select txn_id, client_id, strftime(txn_ts, '%Y%m%d')::int as txn_date_key, amount, channel, txn_type,
            status, status = 'POSTED' as is_posted from pay""",
        ),
        "incremental_fact": _with("feed", "select txn_id, borrower_id, amount, load_date from feed"),
        "boosted_stump": _with(
            "feat",
            """with v as (
                select name, coalesce(value::double, -100) as x, is_default as y, avg(is_default) over (partition by name) as p
                from (select is_default, max_repay_status, months_delinquent, age from feat)
                unpivot include nulls (value for name in (max_repay_status, months_delinquent, age))
            ), b as (select name, x, sum(p - y) as g, sum(p * (1 - p)) as h from v group by name, x),
            s as (
                select name, x, sum(g) over w as lg, sum(h) over w as lh, sum(g) over (partition by name) as g,
                    sum(h) over (partition by name) as h
                from b window w as (partition by name order by x)
            ), best as (
                select *, g - lg as rg, h - lh as rh from s where lh >= 1 and h - lh >= 1
                order by lg * lg / (lh + 1) + (g - lg) * (g - lg) / (h - lh + 1) desc limit 1
            )
            select name as feature, x as threshold, 'left' as side, round(-lg / (lh + 1), 4) as value from best
            union all select name, x, 'right', round(-rg / (rh + 1), 4) from best""",
        ),
        "incremental_fact_content": _with(
            "feed",
            """with early as (
                select txn_id, borrower_id, amount, case when txn_id::bigint % 11 <> 0 then load_date end as load_date from feed
            ), late as (
                select txn_id, borrower_id, load_date,
                    case when day(load_date) = 5 and borrower_id % 2 = 0 then amount + 1 else amount end as amount
                from early where coalesce(day(load_date), 0) <> 9 and (load_date is not null or borrower_id % 3 > 0)
            ), b as (select load_date as day, count(*) as before from early group by 1),
            a as (
                select load_date as day, count(*) as n_rows, sum(amount::decimal(18,2))::double as amount,
                    coalesce(bool_or(day(load_date) = 5 and borrower_id % 2 = 0), false) as touched
                from late group by 1
            )
            select coalesce(a.day, b.day) as day,
                case when a.n_rows is null then 'vanished' when a.n_rows <> before or touched then 'changed' end as change,
                case when a.n_rows <> before or touched then a.n_rows end as n_rows,
                case when a.n_rows is null or a.n_rows <> before or touched then before end as before,
                a.n_rows as n_stored, a.amount
            from a full join b on a.day is not distinct from b.day""",
        ),
        "late_snapshots": _with(
            "stg",
            """with shown as (
                select client_id, n, age,
                    case when client_id % 5 < n then credit_limit + 1000 * (client_id % 3 + n // 3) else credit_limit end::int
                        as credit_limit
                from stg, range(1, 5) t(n) where client_id % 7 <> n
            ), marked as (
                select *, coalesce(credit_limit is not distinct from lag(credit_limit) over w
                    and age is not distinct from lag(age) over w and row_number() over w > 1, false) as same
                from shown window w as (partition by client_id order by n)
            ), runs as (
                select *, sum(case when same then 0 else 1 end) over (partition by client_id order by n) as run from marked
            ), versions as (
                select client_id, run, any_value(credit_limit) as credit_limit, any_value(age) as age, min(n) as n,
                    count(*)::int as n_seen
                from runs group by client_id, run
            )
            select client_id, credit_limit, age, make_timestamp(2024, n, 1, 0, 0, 0) as valid_from,
                make_timestamp(2024, lead(n) over v, 1, 0, 0, 0) as valid_to, lead(n) over v is null as is_current, n_seen
            from versions window v as (partition by client_id order by n)""",
        ),
        "volume_band": _volume_band("events"),
        "volume_band_gap": _volume_band(
            "(select * from events where event_type = 'error' or day(ts) not in (10, 11, 12))"
        ),
        "late_days": _with(
            "feed",
            """with first as (select txn_id, borrower_id, amount, load_date, 0 as load from feed
                where day(load_date) in (2, 6, 8)),
            second as (select txn_id, borrower_id, amount, load_date, 1 from feed where day(load_date) = 5 or day(load_date) > 8),
            anew as (
                select txn_id, borrower_id, amount + 1, load_date, 2 from feed where day(load_date) = 4 and borrower_id % 3 > 0
                union all
                select txn_id, borrower_id, amount + 2, date '2024-01-04', 2 from feed
                where day(load_date) = 6 and borrower_id % 4 = 0
            )
            select txn_id, borrower_id::bigint as client_id, amount, load_date
            from (select * from first union all select * from second union all select * from anew)
            qualify row_number() over (partition by txn_id order by load desc) = 1""",
        ),
        "stale_feed": """select * from (values (1, 'pass'), (40, 'warn'), (720, 'refused')) t(hours, status)
            where (select count(*) from events) > 0""",
        "repeated_publish": _with("dim", "select client_id, coalesce(age, 40) as age, true as refused from dim"),
        "daily_run": DAILY_RUN,
        "schema_check": _with("raw_pay", _schema_rows()),
        "null_rate": _with("feat", _null_rates()),
        "portfolio_overview": _with(
            "tape",
            """select loan_status, count(*) as n_loans, sum(principal::decimal(18, 2))::double as balance,
            round(sum(principal::decimal(18, 2)::double * int_rate) / sum(principal::decimal(18, 2))::double, 4) as avg_rate,
            round(count(*) / (sum(count(*)) over ())::bigint, 4) as share from tape group by 1""",
        ),
        "expected_loss_share": _with(
            "scores dim",
            """with losses as (
                select credit_limit_band, sum((pd_xgboost * 100)::int::bigint * credit_limit)::bigint as cents
                from scores join dim using (client_id) group by 1
            )
            select credit_limit_band, round(cents / 100, 2) as expected_loss,
                round(cents / (sum(cents) over ())::bigint, 4) as loss_share from losses""",
        ),
        "dq_anomaly": """
            with daily as (
                select ts::date as day, count(*)::double as row_count,
                    count(*) filter (where event_type = 'error') / count(*) as error_share
                from events group by 1
            ), long as (unpivot daily on row_count, error_share into name metric value value),
            scored as (
                select *, stddev_pop(value) over w as spread, avg(value) over w as mean
                from long window w as (partition by metric order by day rows between 7 preceding and 1 preceding)
            )
            select metric, day, value, round(if(spread > 1e-9, (value - mean) / spread, null), 4) as z_score,
                coalesce(spread > 1e-9 and abs((value - mean) / spread) > 2, false) as is_anomaly
            from scored""",
        "sketch_drift": _with(
            "feed",
            """select bin::int as bin, true as within_error, true as stable, count(amount) as n_rows
            from feed, range(10) t(bin) group by bin""",
        ),
        "score_drift": _with(
            "scores",
            """with edges as (
                select quantile_cont(pd_xgboost, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) as e
                from scores where not is_test
            ), binned as (
                select len(list_filter(e, lambda x: x < pd_xgboost))::int as bin, is_test from scores, edges
            ), counted as (
                select bin, count(*) filter (where not is_test) as n_baseline, count(*) filter (where is_test) as n_current
                from binned group by 1
            ), shares as (
                select *, greatest(n_baseline::double, 0.5) / (sum(n_baseline) over ())::bigint as b,
                    greatest(n_current::double, 0.5) / (sum(n_current) over ())::bigint as c from counted
            )
            select bin, n_baseline, n_current, round((c - b) * ln(c / b), 6) as psi from shares""",
        ),
    }
