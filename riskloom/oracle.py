"""Independent SQL for the registered queries: plain windows, cross joins and one scan per column, nothing shared with
the Spark operators except the stand-in views."""

from __future__ import annotations

from typing import NamedTuple

from riskloom.sources.standins import CTES

# Fixed values, written out here a second time, so that a wrong column, holiday or check of the library shows.
FACT_COLUMNS = (
    "transaction_id transaction_date source_split transaction_hour transaction_amt product_cd card1 card2 card3 "
    "card4 card5 card6 addr1 addr2 dist1 dist2 purchaser_email_domain recipient_email_domain device_type "
    "device_info device_os device_browser has_identity is_fraud ingested_at "
).split()
REPORTED_FEATURES = "C13 C14 V70 V294 C11 C1 D2 D3 C5 V258".split()
LIFT_FEATURES = "product_cd card4 card6 purchaser_email_domain C13 D2".split()
CARD_KEYS = "card1 card2 card3 card5 addr1".split()
MOVING_COLUMNS = "C1 C13 D2 D3".split()
NULLABLE = "C13 D2 D3 addr1 card2 dist1 dist2 isFraud is_fraud".split()
WEIGHTS = {'transaction_amt': 0.01, 'C13': 0.3, 'C1': -0.02, 'D2': -0.2, 'D3': 0.01, 'V70': 0.5, 'V294': 0.15, 'card1': 0.002, 'C5': 0.0}
# Month, day, direction of the orders.
FIXED_HOLIDAYS = ((12, 24, -1), (12, 25, -1), (12, 26, -1), (1, 1, -1), (7, 4, -1))
# kind, table, column; "in" values, "from" and "to" the ends of a range, "of" the compared table and its column.
CONTRACT = """
unique transactions TransactionID
not_null transactions TransactionID
not_null transactions transaction_date
accepted_values transactions source_split in train,test
unique predictions transaction_id
not_null predictions transaction_id
not_null predictions score
not_null predictions model
unique identity TransactionID
not_null identity TransactionID
relationships identity TransactionID of transactions TransactionID
equal_rowcount fct_transactions - of stg_transactions
unique fct_transactions transaction_id
not_null fct_transactions transaction_id
not_null fct_transactions transaction_date
accepted_range fct_transactions transaction_hour from 0 to 23
not_null fct_transactions transaction_amt
accepted_range fct_transactions transaction_amt from 0
accepted_values fct_transactions source_split in train,test
not_null fct_transactions has_identity
total_equals_rows agg_transactions_daily tx_count of fct_transactions
not_null agg_transactions_daily transaction_date
not_null agg_transactions_daily tx_count
accepted_range agg_transactions_daily tx_count from 1
accepted_range agg_transactions_daily fraud_rate from 0 to 1
not_null agg_pipeline_daily transaction_date
not_null agg_pipeline_daily tx_count
accepted_range agg_pipeline_daily identity_rate from 0 to 1
unique dim_split transaction_date
not_null dim_split transaction_date
not_null dim_split ml_split
accepted_values dim_split ml_split in train,valid,test
train_before_valid dim_split transaction_date
not_null agg_predictions_daily transaction_date
not_null agg_predictions_daily model
not_null agg_predictions_daily scored_count
not_null agg_predictions_daily blocked_rate
accepted_range agg_predictions_daily blocked_rate from 0 to 1
accepted_range agg_predictions_daily score_p99 from 0 to 1
not_null agg_score_amount transaction_date
not_null agg_score_amount score_band
accepted_values agg_score_amount score_band in high,low
not_null agg_score_amount amount_band
accepted_values agg_score_amount amount_band in high,low
not_null agg_score_amount tx_count
not_null agg_score_amount amount_total
not_null agg_feature_buckets feature
not_null agg_feature_buckets bucket
not_null agg_feature_buckets fraud_rate
accepted_range agg_feature_buckets fraud_rate from 0 to 1
not_null agg_feature_buckets tx_count
not_null agg_feature_values feature
not_null agg_feature_values value
not_null agg_feature_values fraud_rate
accepted_range agg_feature_values fraud_rate from 0 to 1
"""


class Rule(NamedTuple):
    kind: str
    table: str
    column: str = ""
    values: tuple[str, ...] = ()
    low: float | None = None
    high: float | None = None
    other: str = ""
    other_column: str = ""


def contract() -> list[Rule]:
    out = []
    for line in CONTRACT.strip().splitlines():
        kind, table, column, *rest = line.split()
        given = dict(zip(("values", "low", "high", "other", "other_column"), ((), None, None, "", "")))
        while rest:
            word = rest.pop(0)
            if word == "in":
                given["values"] = tuple(rest.pop(0).split(","))
            elif word in ("from", "to"):
                given["low" if word == "from" else "high"] = int(rest.pop(0))
            else:
                given["other"], given["other_column"] = rest.pop(0), rest.pop(0) if rest else ""
        out.append(Rule(kind, table, column.strip("-"), **given))
    return out

RAW = {
    "transaction_id": '"TransactionID"',
    "transaction_dt": '"TransactionDT"',
    "transaction_amt": '"TransactionAmt"',
    "product_cd": '"ProductCD"',
    "is_fraud": '"isFraud"',
    "purchaser_email_domain": '"P_emaildomain"',
    "recipient_email_domain": '"R_emaildomain"',
    "device_type": '"DeviceType"',
    "device_info": '"DeviceInfo"',
}
TX_COLUMNS = (
    "transaction_id transaction_dt transaction_amt product_cd is_fraud purchaser_email_domain recipient_email_domain "
    "card1 card2 card3 card4 card5 card6 addr1 addr2 dist1 dist2 C13 C14 C11 C1 C5 D2 D3 M4 V70 V294 V258 "
    "transaction_date source_split ingested_at"
).split()
TX_TYPES = {
    "transaction_id": "bigint", "transaction_dt": "int", "transaction_amt": "double", "product_cd": "string",
    "is_fraud": "int", "purchaser_email_domain": "string", "recipient_email_domain": "string", "card1": "bigint",
    "card2": "bigint", "card3": "bigint", "card4": "string", "card5": "bigint", "card6": "string", "addr1": "bigint",
    "addr2": "bigint", "dist1": "bigint", "dist2": "bigint", "C13": "int", "C14": "int", "C11": "bigint", "C1": "int",
    "C5": "int", "D2": "bigint", "D3": "bigint", "M4": "string", "V70": "int", "V294": "int", "V258": "double",
    "transaction_date": "date", "source_split": "string", "ingested_at": "timestamp_ntz",
}
TIME = "strftime({}, '%Y-%m-%d %H:%M:%S.%f')"


def text(column: str) -> str:
    """A staged column in portable form."""
    if column in ("transaction_date", "day", "origin", "first_day", "last_day", "train_end", "valid_start"):
        return f"cast({column} as varchar) as {column}"
    if column in ("ingested_at", "last_ingested_at"):
        return f"{TIME.format(column)} as {column}"
    if column in ("transaction_amt", "V258"):
        return f"{r(column)} as {column}"
    if column in NULLABLE:
        return f"{d(column)} as {column}"
    return column


def raw_text(column: str) -> str:
    return text(column) if column not in RAW else f"{text(column).rsplit(' as ', 1)[0]} as {RAW[column]}"


def r(expression: str) -> str:
    """Rounded like the Spark side."""
    return f"round({expression} + 1e-9, 6)"


def d(expression: str) -> str:
    return f"cast({expression} as double)"


def q(body: str) -> str:
    return f"with {CTES}{body}"


# Mart bodies, also used by the check suite.

FCT_SELECT = {
    "transaction_hour": "(t.transaction_dt // 3600) % 24",
    "device_type": "i.device_type",
    "device_info": "i.device_info",
    "device_os": "i.id_30",
    "device_browser": "i.id_31",
    "has_identity": "i.transaction_id is not null",
}
FCT = (
    "select "
    + ", ".join(f"{FCT_SELECT.get(c, 't.' + c)} as {c}" for c in FACT_COLUMNS)
    + " from tx t left join identity i on t.transaction_id = i.transaction_id"
)
DIM = """select distinct transaction_date, case when source_split = 'test' then 'test'
 when transaction_date < date '2024-01-18' then 'train' else 'valid' end as ml_split from tx"""
DAILY = f"""select transaction_date, transaction_hour, source_split, product_cd,
 coalesce(device_type, 'unknown') as device_type, count(*) as tx_count,
 count(is_fraud) as labeled_count, count(*) filter (where is_fraud = 1) as fraud_count,
 {r("avg(is_fraud)")} as fraud_rate, {r("sum(transaction_amt)")} as amt_sum, {r("avg(transaction_amt)")} as amt_avg,
 {r("coalesce(sum(transaction_amt) filter (where is_fraud = 1), 0.0)")} as fraud_amt,
 count(*) filter (where has_identity) as with_identity_count
 from fct group by 1, 2, 3, 4, 5"""
PIPELINE = f"""select *, {r("tx_count / avg(tx_count) over (partition by source_split order by transaction_date rows between 7 preceding and 1 preceding)")}
 as tx_count_vs_baseline from (
 select transaction_date, source_split, count(*) as tx_count, count(is_fraud) as labeled_count,
 {r("1.0 - count(purchaser_email_domain) / count(*)")} as email_null_rate,
 {r("1.0 - count(addr1) / count(*)")} as addr_null_rate, {r("1.0 - count(card2) / count(*)")} as card2_null_rate,
 {r("count(*) filter (where has_identity) / count(*)")} as identity_rate, max(ingested_at) as last_ingested_at
 from fct group by 1, 2)"""
PREDICTIONS = f"""select transaction_date, model, scored_count, blocked_count, {r("rate")} as blocked_rate, score_avg, score_p50, score_p90, score_p99,
 {r("rate / nullif(avg(rate) over (partition by model order by transaction_date rows between 7 preceding and 1 preceding), 0)")}
 as blocked_rate_vs_baseline from (
 select transaction_date, model, count(*) as scored_count, count(*) filter (where score >= 0.43) as blocked_count,
 count(*) filter (where score >= 0.43) / count(*) as rate, {r("avg(score)")} as score_avg,
 {r("quantile_disc(score, 0.5)")} as score_p50, {r("quantile_disc(score, 0.9)")} as score_p90,
 {r("quantile_disc(score, 0.99)")} as score_p99 from predictions group by 1, 2)"""
SCORE_AMOUNT = f"""select p.transaction_date, t.product_cd,
 case when p.score >= 0.43 then 'high' else 'low' end as score_band,
 case when t.transaction_amt >= 115 then 'high' else 'low' end as amount_band,
 count(*) as tx_count, {r("sum(t.transaction_amt)")} as amount_total, {r("avg(t.transaction_amt)")} as amount_avg,
 {r("min(p.score)")} as score_min, {r("max(p.score)")} as score_max
 from predictions p join tx t using (transaction_id) group by 1, 2, 3, 4"""
LONG = " union all ".join(
    f"select '{f}' as feature, cast({f} as double) as v, transaction_id, is_fraud from tx where source_split = 'train'"
    for f in REPORTED_FEATURES
)
BUCKETS = f"""select feature, bucket, count(*) as tx_count, count(*) filter (where is_fraud = 1) as fraud_count,
 {r("avg(is_fraud)")} as fraud_rate, {r("min(v)")} as value_min, {r("max(v)")} as value_max from (
 select *, case when v is null then 'null' else 'Q' || ntile(5) over (partition by feature, v is null order by v, transaction_id) end as bucket
 from ({LONG})) group by 1, 2 having count(*) >= 1000"""


def values_of(features: tuple[str, ...]) -> str:
    return " union all ".join(
        f"""select '{f}' as feature, cast({f} as varchar) as value, count(*) as tx_count,
 count(*) filter (where is_fraud = 1) as fraud_count, avg(is_fraud) as rate
 from tx where source_split = 'train' and {f} is not null group by 2 having count(*) >= 1000"""
        for f in features
    )


VALUES = f"""select feature, value, tx_count, fraud_count, {r("rate")} as fraud_rate from (
 select *, row_number() over (partition by feature order by tx_count desc, value) as n from ({values_of(REPORTED_FEATURES)})) where n <= 5"""

MARTS = {
    "stg_transactions": "select * from tx",
    "fct_transactions": FCT,
    "dim_split": DIM,
    "agg_transactions_daily": DAILY,
    "agg_pipeline_daily": PIPELINE,
    "agg_predictions_daily": PREDICTIONS,
    "agg_score_amount": SCORE_AMOUNT,
    "agg_feature_buckets": BUCKETS,
    "agg_feature_values": VALUES,
}
TABLES = {"transactions": "tx", "identity": "identity", "predictions": "predictions"}


def check_row(check: Rule, table: str) -> str:
    """One check as SQL."""
    key = {"TransactionID": "transaction_id"}.get(check.column, check.column)
    other = TABLES.get(check.other, check.other)
    if check.kind == "not_null":
        v = f"select count(*) from {table} where {key} is null"
    elif check.kind == "accepted_values":
        v = f"select count(*) from {table} where {key} not in ({', '.join(repr(x) for x in check.values)})"
    elif check.kind == "accepted_range":
        ends = [f"{key} < {check.low}"] * (check.low is not None) + [f"{key} > {check.high}"] * (check.high is not None)
        v = f"select count(*) from {table} where {' or '.join(ends)}"
    elif check.kind == "unique":
        v = f"select count(*) from (select {key} from {table} where {key} is not null group by 1 having count(*) > 1)"
    elif check.kind == "relationships":
        parent = {"TransactionID": "transaction_id"}.get(check.other_column, check.other_column)
        v = f"select count(*) from {table} where {key} is not null and {key} not in (select {parent} from {other})"
    elif check.kind == "equal_rowcount":
        v = f"select abs((select count(*) from {table}) - (select count(*) from {other}))"
    elif check.kind == "total_equals_rows":
        v = f"select abs((select sum({key}) from {table}) - (select count(*) from {other}))"
    else:
        v = f"""select count(*) where (select max(transaction_date) from {table} where ml_split = 'train')
 >= (select min(transaction_date) from {table} where ml_split = 'valid')"""
    return f"""select '{check.kind}' as "check", '{check.table}' as "table", '{check.column}' as "column",
 cast(({v}) as bigint) as violations, ({v}) = 0 as passed"""


def checks_sql(checks: list[Rule], tables: dict[str, str]) -> str:
    return " union all ".join(check_row(c, tables.get(c.table, c.table)) for c in checks)


def profile_sql(table: str, columns: dict[str, str]) -> str:
    rows = []
    for c, kind in columns.items():
        number = kind in ("int", "bigint", "double")
        if number:
            advice = f"""case when count({c}) = 0 then 'drop' when bool_and({c} % 1 = 0) then
 case when min({c}) >= -2147483648 and max({c}) <= 2147483647 then 'Int32' else 'Int64' end
 when max(abs({c})) < 3.0e38 then 'float32' else 'float64' end"""
            ends = f'{r(f"cast(min({c}) as double)")} as "min", {r(f"cast(max({c}) as double)")} as "max"'
            listed = "cast(null as varchar)"
        else:
            advice = f"""case when count({c}) = 0 then 'drop' when bool_and(cast({c} as varchar) in ('T', 'F')) then 'boolean'
 when count(distinct {c}) <= 30 then 'category' else 'str' end"""
            ends = 'cast(null as double) as "min", cast(null as double) as "max"'
            listed = f"case when count(distinct {c}) <= 30 then string_agg(distinct cast({c} as varchar), '|' order by cast({c} as varchar)) end"
        rows.append(
            f"""select '{c}' as "column", '{kind}' as current_dtype, {advice} as recommended,
 round(1.0 - count({c}) / count(*), 4) as null_ratio, count(distinct {c}) as nunique, {ends}, {listed} as "values" from {table}"""
        )
    return " union all ".join(rows)


EVENTS = {"event_id": "bigint", "ts": "timestamp_ntz", "user_id": "bigint", "event_type": "string", "value": "double", "props": "string"}
CUSTOMER = {"c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_acctbal": "double", "c_mktsegment": "string"}
LINEITEM = {
    "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int", "l_quantity": "double",
    "l_extendedprice": "double", "l_discount": "double", "l_tax": "double", "l_returnflag": "string",
    "l_linestatus": "string", "l_shipdate": "timestamp_ntz",
}

INTEGRITY = """select count(*) as tx_rows, (select count(*) from {c}) as identity_rows,
 count(distinct {k}) = count(*) as tx_unique,
 (select count(distinct {k}) = count(*) from {c}) as identity_unique,
 (select count(*) from {c} where {k} in (select {k} from {p})) as matched,
 (select count(*) from {c} where {k} not in (select {k} from {p})) as orphans,
 round(100.0 * count(*) filter (where {k} in (select {k} from {c})) / count(*) + 1e-9, 6) as coverage_pct from {p}"""

# A different spelling of the alias list than the engine's: patterns instead of whole values. The stand-in views hold
# no domain that would tell them apart.
SERVICE = """case when {c} in ('gmail', 'gmail.com') then 'gmail.com' when {c} like 'yahoo.%' then 'yahoo.com'
 when {c} like 'hotmail.%' then 'hotmail.com' when {c} like 'live.%' then 'live.com'
 when {c} like 'outlook.%' then 'outlook.com' else {c} end"""
DOMAINS = ("purchaser_email_domain", "recipient_email_domain")


def kept(c: str) -> str:
    return f"select {SERVICE.format(c=c)} as domain, count(*) as n from tx where transaction_date < date '2024-01-18' and {c} is not null group by 1 having count(*) >= 1000"


def normalized(c: str) -> str:
    s = SERVICE.format(c=c)
    return f"case when {c} is null then '(missing)' when {s} in (select domain from ({kept(c)})) then {s} else 'other' end"


BAND = """case when transaction_amt < 0 or transaction_amt is null then '(missing)' when transaction_amt < 25 then '<25'
 when transaction_amt < 50 then '25-50' when transaction_amt < 100 then '50-100' when transaction_amt < 250 then '100-250'
 when transaction_amt < 500 then '250-500' else '500+' end"""


def filled(*columns: str) -> str:
    return ", ".join(f"coalesce({c}, '(missing)') as {c}" for c in columns)


JOINED = f"""select t.*, (t.transaction_dt // 3600) % 24 as transaction_hour, i.transaction_id is not null as has_identity, d.ml_split
 from tx t join ({DIM}) d using (transaction_date) left join identity i using (transaction_id)"""

GRID = "g as (select cast(x as double) / 100 as threshold from range(1, 100) t(x))"
SCORED = "s as (select p.score, t.is_fraud, t.transaction_amt from predictions p join tx t using (transaction_id) where t.is_fraud is not null)"


def outcomes(grid: str = "g") -> str:
    """Every threshold against every row: the direct definition."""
    return f"""o as (select threshold, count(*) filter (where score >= threshold and is_fraud = 1) as caught,
 count(*) filter (where score < threshold and is_fraud = 1) as missed,
 count(*) filter (where score >= threshold and is_fraud = 0) as false_alarms,
 coalesce(sum(transaction_amt) filter (where score < threshold and is_fraud = 1), 0.0) as missed_amount
 from {grid} cross join s group by 1)"""


RATES = """case when caught + missed = 0 then 0.0 else caught / (caught + missed) end as recall,
 case when caught + false_alarms = 0 then 0.0 else caught / (caught + false_alarms) end as precision"""
OUTCOME = f"threshold, caught, missed, false_alarms, {r('missed_amount')} as missed_amount, {r('recall')} as recall, {r('precision')} as precision"
CHEAPEST = "row_number() over (partition by fp_cost order by round(total_cost, 6), threshold) = 1"


def curve_q(body: str, grid: str = GRID) -> str:
    return q(f", {grid}, {SCORED}, {outcomes()} {body}")


CONTRIBUTIONS = " union all ".join(
    f"select '{c}' as feature, avg(abs(coalesce({w} * ({c} - (select avg({c}) from tx)), 0.0))) as importance from tx"
    for c, w in WEIGHTS.items()
)
IMPORTANCE = f"c as ({CONTRIBUTIONS}), k as (select *, row_number() over (order by importance desc, feature) as rank, importance / sum(importance) over () as share, sum(importance) over (order by importance desc, feature rows unbounded preceding) / sum(importance) over () as cumulative_share from c)"

SERIES = """o as (select date_diff('day', date '1995-01-01', cast(o_orderdate as date)) as day_index, count(*) as n from orders group by 1),
 t as (select *, case when count(*) over w >= 7 then median(n) over w end as trend from o window w as (order by day_index rows between 14 preceding and 13 following)),
 f as (select *, n / trend as flat from t),
 x as (select *, flat / median(flat) over (partition by day_index % 7) as resid from f),
 z as (select day_index, n, trend, resid, (resid - avg(resid) over ()) / stddev_samp(resid) over () as z from x)"""


def _holidays() -> str:
    fixed = " union all ".join(
        f"select make_date(y, {m}, {d}) as day, {way} as direction from years" for m, d, way in FIXED_HOLIDAYS
    )
    # All November Thursdays, the fourth one picked by its position.
    thursday = """select day from (select make_date(y, 11, dd) as day, row_number() over (partition by y order by dd) as nth
 from years cross join (select unnest(range(1, 31)) as dd) where isodow(make_date(y, 11, dd)) = 4) where nth = 4"""
    return f"""years as (select unnest(range(2015, 2035)) as y), th as ({thursday}),
 h as ({fixed} union all select day, -1 from th union all select cast(day + interval 1 day as date), 1 from th
 union all select cast(day + interval 4 day as date), 1 from th)"""


ORIGINS = f"""{SERIES}, {_holidays()},
 c as (select cast(unnest(generate_series(timestamp '2016-01-01', timestamp '2019-12-31', interval 1 day)) as date) as origin),
 sc as (select origin, count(*) as n_holidays, avg(z * direction) as score from c cross join z join h on h.day = c.origin + cast(z.day_index as int)
 where z.z is not null group by 1),
 v as (select *, rank() over (order by score desc) as rank, (score - avg(score) over ()) / stddev_pop(score) over () as sigma from sc where n_holidays >= 5)"""


def steps_sql(keys: tuple[str, ...]) -> str:
    card = ", ".join(keys)
    known = " and ".join(f"{k} is not null" for k in keys)
    rows = []
    for c in MOVING_COLUMNS:
        rows.append(
            f"""select '{c}' as "column", count(*) as steps, count(*) filter (where d >= 0) as not_falling,
 count(*) filter (where d = 0) as unchanged, count(*) filter (where d = days) as as_elapsed,
 {r("count(*) filter (where d >= 0) / count(*)")} as not_falling_share,
 {r("count(*) filter (where d = 0) / count(*)")} as unchanged_share,
 {r("count(*) filter (where d = days) / count(*)")} as as_elapsed_share
 from (select {c} - lag({c}) over w as d, transaction_dt // 86400 - lag(transaction_dt) over w // 86400 as days
 from tx where {known} window w as (partition by {card} order by transaction_dt, transaction_id)) where d is not null"""
        )
    return " union all ".join(rows)


def common_sql(c: str, is_number: bool) -> str:
    """What the labelled and the unlabelled rows have in common in one column."""
    v = f"cast({c} as double)" if is_number else f"cast({c} as varchar)"
    side = "(select distinct {v} as x from tx where source_split = '{s}' and {c} is not null)"
    left, right = side.format(v=v, c=c, s="train"), side.format(v=v, c=c, s="test")
    few = f"(select count(*) from {left}) < 2048 and (select count(*) from {right}) < 2048"
    both = f"(select count(*) from (select x from {left} intersect select x from {right}))"
    either = f"(select count(*) from (select x from {left} union select x from {right}))"
    rows = "(select count(*) from tx where source_split = '{}'{})"
    return f"""select '{c}' as left_column, '{c}' as right_column, {rows.format("train", "")} as left_rows, {rows.format("test", "")} as right_rows,
 {rows.format("train", f" and {c} is null")} as left_nulls, {rows.format("test", f" and {c} is null")} as right_nulls,
 case when {few} then cast((select count(*) from {left}) as double) end as left_distinct,
 case when {few} then cast((select count(*) from {right}) as double) end as right_distinct,
 case when {few} then cast({both} as double) end as common_distinct,
 case when {few} then {r(f"{both} / nullif({either}, 0)")} end as similarity"""


def oracle() -> dict[str, str]:
    nullable = ", ".join(
        f"""('{c}', '{TX_TYPES[c]}', (select {r(f"1.0 - count({c}) / count(*)")} from tx))""" for c in TX_COLUMNS
    )
    nulls = f'n as (select * from (values {nullable}) v("column", dtype, null_ratio))'
    valid_columns = "transaction_id, transaction_date, is_fraud, transaction_amt, product_cd, card4, card6, purchaser_email_domain, recipient_email_domain, transaction_hour, has_identity".split(", ")
    test_columns = [c for c in TX_COLUMNS if c not in ("transaction_id", "transaction_dt", "transaction_date", "is_fraud", "source_split", "ingested_at")]
    daily = "d as (select transaction_date as day, count(transaction_id) as tx_count, sum(is_fraud) as fraud_count, avg(is_fraud) as fraud_rate, sum(transaction_amt) as amt_sum from tx group by 1)"
    with_marts = ", fct as (" + FCT + ")"
    suite = with_marts + "".join(f", {name} as ({body})" for name, body in MARTS.items())
    spread = ", ".join(
        f"{r(f'cast({f}({c}) as double)') if f == 'median' or c != 'tx_count' else f'{f}({c})'} as {c}_{n}"
        for c in ("tx_count", "fraud_rate")
        for f, n in (("min", "min"), ("median", "median"), ("max", "max"))
    )
    lift = f"select feature, count(*) as value_count, {r('min(rate)')} as rate_min, {r('max(rate)')} as rate_max, {r('max(rate) / nullif(min(rate), 0)')} as lift from ({values_of(tuple(LIFT_FEATURES))}) group by 1"
    windows = f"""w as (select unnest([5, 7, 10, 14]) as window_days), l as (select *, date_diff('day', transaction_date, (select max(transaction_date) from tx where source_split = 'train')) as age from tx where source_split = 'train')
 select window_days, count(*) filter (where age <= window_days) as valid_rows, count(*) filter (where age > window_days) as train_rows,
 count(*) filter (where age <= window_days and is_fraud = 1) as valid_frauds, {r("avg(is_fraud) filter (where age <= window_days)")} as valid_rate from w cross join l group by 1"""
    score = f"""1 / (1 + exp(-(0.01 * transaction_amt - 0.02 * transaction_hour + case when has_identity then 0.5 else 0 end
 + case when transaction_amt < 25 then 0.3 else 0 end - case when domain = 'other' then 0.4 else 0 end - 1.0)))"""
    metrics = f""", {SCORED}, b as (select score, count(*) filter (where is_fraud = 1) as pos, count(*) filter (where is_fraud = 0) as neg from s group by 1),
 k as (select *, sum(pos) over (order by score desc) as tp, sum(pos + neg) over (order by score desc) as seen from b)
 select cast(sum(pos + neg) as bigint) as row_count, cast(sum(pos) as bigint) as fraud_count, {r("sum(pos * tp / seen) / sum(pos)")} as pr_auc,
 {r("sum(neg * (tp - pos + pos / 2)) / (sum(pos) * sum(neg))")} as roc_auc from k"""
    in_train, in_valid = "transaction_date < date '2024-01-18'", "transaction_date between date '2024-01-18' and date '2024-01-24'"
    files = {
        "TransactionID": "transaction_id", "TransactionDT": "cast(transaction_dt as bigint)", "TransactionAmt": r("transaction_amt"),
        "ProductCD": "product_cd", "card1": "card1", "card2": d("card2"), "card4": "card4", "addr1": d("addr1"), "dist1": d("dist1"),
        "P_emaildomain": "purchaser_email_domain", "C1": "cast(C1 as bigint)", "C13": d("C13"), "D2": d("D2"),
        "M1": "case M4 when 'M0' then true when 'M1' then false end", "M4": "M4",
    }
    device = """transaction_id as "TransactionID", device_type as "DeviceType", device_info as "DeviceInfo", id_30, id_31"""
    some = "(select least(1000, count(*)) from tx{})"
    refused = {
        "split without labels": "ValueError", "rows without a label": "ValueError", "no rows": "ValueError",
        "date in two splits": "ValueError", "unknown split": "ValueError", "missing column": "ContractError",
        "further column": "ContractError", "other type": "ContractError", "nothing": None,
    }
    tested = "transaction_amt product_cd card4 card6 purchaser_email_domain recipient_email_domain transaction_hour has_identity amount_band".split()
    integrity_of = """select '{c}' as child, (select count({k}) from {c}) as child_rows, (select count(distinct {k}) from {c}) as child_keys,
 (select count({p}) from {o}) as parent_rows, (select count(distinct {p}) from {o}) as parent_keys,
 (select count(distinct {k}) from {c} where {k} in (select {p} from {o})) as matched_keys,
 (select count(distinct {k}) from {c} where {k} not in (select {p} from {o})) as orphan_keys"""
    head = """'base' as model, 'all' as split, (select count(*) from s) as row_count, (select count(*) from s where is_fraud = 1) as frauds,
 round((select sum(transaction_amt) from s where is_fraud = 1), 2) as fraud_amount, '2024-01-25T00:00:00' as trained_at, 0.125 :: double as pr_auc"""
    common = [c for c in TX_COLUMNS if c != "ingested_at"]
    number = {"bigint", "int", "double"}
    pairs = " union all ".join(common_sql(c, TX_TYPES[c] in number) for c in common)
    tx_row_checks = lambda checks: q(" " + checks_sql(checks, {}))
    return {
        "bool_parse": q("select transaction_id, case M4 when 'M0' then true when 'M1' then false end as flag from tx"),
        "prepare_split": q("select " + ", ".join(raw_text(c) for c in TX_COLUMNS if c != "ingested_at") + " from tx"),
        "read_day": q("select " + ", ".join(raw_text(c) for c in TX_COLUMNS) + " from tx where transaction_date = date '2024-01-20'"),
        "replaced_day": q(f"select transaction_id, cast(transaction_date as varchar) as transaction_date, {r("score + case when transaction_date = date '2024-01-20' then 1 else 0 end")} as score, model from predictions"),
        "versioned_day": q(f"select transaction_id, cast(transaction_date as varchar) as transaction_date, {r("score + case when transaction_date = date '2024-01-20' then 1 else 0 end")} as score, model from predictions"),
        "refreshed_pipeline": q(f""", fct as (select * from ({FCT}) where transaction_date <> date '2024-01-20' or transaction_id % 2 = 0)
 select * replace (cast(transaction_date as varchar) as transaction_date, {TIME.format('last_ingested_at')} as last_ingested_at) from ({PIPELINE})"""),
        "csv_transactions": q("select " + ", ".join(f'{e} as "{c}"' for c, e in files.items()) + " from tx"),
        "csv_identity": q(f"select {device} from identity"),
        "csv_first_rows": q(f"select {some.format(" where source_split = 'train'")} as row_count, {some.format(" where source_split = 'train'")} as known_rows"),
        "profile_files": q(f", {daily} select cast(day as varchar) as day, tx_count, cast(fraud_count as double) as fraud_count, {r('fraud_rate')} as fraud_rate, {r('amt_sum')} as amt_sum from d"),
        "refusals": "select * from (values " + ", ".join(f"('{c}', {'null' if e is None else repr(e)})" for c, e in refused.items()) + ') v("case", refused_by)',
        "staged_views": q("select source_split, count(*) as row_count, count(i.transaction_id) as with_device from tx left join identity i using (transaction_id) group by 1"),
        "column_advice": f"""select "column", current_dtype, recommended, null_ratio, case when nunique <= 30 then cast(nunique as double) end as few, "min", "max", "values" from ({profile_sql("lineitem", LINEITEM)})""",
        "compare_tables": q(" " + pairs),
        "key_difference": """select (select count(*) from (select doc_id from documents except select doc_id from labels) where doc_id is not null) as left_only,
 (select count(*) from (select doc_id from labels except select doc_id from documents) where doc_id is not null) as right_only,
 (select count(*) from (select doc_id from documents intersect select doc_id from labels) where doc_id is not null) as in_both""",
        "score_drift_range": q("""select cast(e.transaction_date as varchar) as transaction_date, e.model, count(*) as scored_count, true as score_p50_holds, true as score_p90_holds, true as score_p99_holds
 from (select distinct transaction_date, model from predictions) e join predictions p on p.model = e.model
 and p.transaction_date between e.transaction_date - interval 6 day and e.transaction_date group by 1, 2"""),
        "check_unique_by_day": q("select cast(transaction_date as varchar) as transaction_date, count(transaction_id) as row_count, count(distinct transaction_id) as key_count, count(transaction_id) = count(distinct transaction_id) as is_unique from tx group by 1"),
        "bitmap_integrity": integrity_of.format(c="lineitem", k="l_orderkey", o="orders", p="o_orderkey") + " union all " + integrity_of.format(c="labels", k="doc_id", o="documents", p="doc_id"),
        "published_curve": curve_q(f", p as (select *, {RATES} from o) select {head}, threshold, caught, missed, false_alarms, round(missed_amount, 2) as missed_amount, round(recall, 4) as recall, round(precision, 4) as precision from p"),
        "model_comparison": q(f""", n as (select count(*) filter (where {in_train}) as train_rows, count(*) filter (where {in_valid}) as valid_rows, {r(f"avg(is_fraud) filter (where {in_valid})")} as rate from tx)
 select m.model, 'curated' as feature_set, cast({len(tested)} as int) as n_features, train_rows, valid_rows, true as metrics_in_range,
 case when m.model = 'dummy' then rate end as base_pr_auc, case when m.model = 'dummy' then 0.5 :: double end as base_roc_auc, m.model <> 'dummy' as beats_constant
 from n cross join (values ('dummy'), ('logistic'), ('trees')) m(model)"""),
        "logistic_optimum": q(f" select count(*) as row_count, true as at_optimum from tx where {in_train}"),
        "stored_model_day": q("select transaction_id, cast(transaction_date as varchar) as transaction_date, 'trees-curated' as model, '2024-01-25 00:00:00.000000' as model_trained_at, true as same_score, true as in_range from tx where transaction_date = date '2024-01-26'"),
        "tree_contributions": q(f"select transaction_id, cast({len(tested)} as int) as part_count, true as adds_up from tx where {in_valid}"),
        "tree_importance": "select feature, true as share_in_range from (values " + ", ".join(f"('{c}')" for c in tested) + ") v(feature)",
        "seeded_sample": q(f"select {some.format('')} as row_count, {some.format('')} as id_count, {some.format('')} as known_count"),
        "holiday_detail": f"""with {SERIES}, {_holidays()} select cast(h.day as varchar) as day, h.direction, {r('z.z')} as z, z.z * h.direction > 0 as agrees
 from h join z on h.day = date '2017-12-01' + cast(z.day_index as int) where z.z is not null""",
        "compare_schemas": """with l as (select column_name as c from (describe events)), r as (select column_name as c from (describe orders))
 select c as "column", 'left' as side, cast(null as varchar) as other from l where c not in (select c from r)
 union all select c, 'right', null from r where c not in (select c from l)""",
        "origin_rank": f"with {ORIGINS} select cast(origin as varchar) as origin, n_holidays, {r('score')} as score, cast(rank as int) as rank, {r('sigma')} as sigma from v where origin = date '2017-12-01'",
        "list_days": q("select distinct cast(transaction_date as varchar) as day from tx"),
        "load_summary": q("select count(distinct transaction_date) as day_count, count(*) as row_count from tx"),
        "load_report": q("select cast(transaction_date as varchar) as day, count(*) as row_count from tx group by 1"),
        "describe_table": q(f"select count(*) as row_count, count(distinct transaction_date) as partition_count, cast(min(transaction_date) as varchar) as first_date, cast(max(transaction_date) as varchar) as last_date, {TIME.format('max(ingested_at)')} as last_ingested from tx"),
        "gap_report": q(""", d as (select cast(unnest(generate_series(timestamp '2023-12-28', timestamp '2024-02-03', interval 1 day)) as date) as day)
 select cast(day as varchar) as day, count(i.transaction_id) as row_count, case when count(i.transaction_id) = 0 then 'skip' else 'load' end as action
 from d left join (select i.transaction_id, t.transaction_date from identity i join tx t using (transaction_id)) i on i.transaction_date = d.day group by d.day"""),
        "stg_transactions": q("select " + ", ".join(text(c) for c in TX_COLUMNS) + " from tx"),
        "stg_identity": q("select * from identity"),
        "transaction_date": q("select transaction_id, cast(transaction_date as varchar) as transaction_date from tx"),
        "amount_band": q(f"select transaction_id, {BAND} as amount_band from tx"),
        "normalize_domain": q(f"select transaction_id, {', '.join(f'{normalized(c)} as {c}' for c in DOMAINS)} from tx"),
        "categorical_fill": q(f"select transaction_id, {filled('product_cd', 'card4', 'card6', 'M4', 'purchaser_email_domain')}, {text('addr1')}, cast(transaction_date as varchar) as transaction_date from tx"),
        "feature_columns": q(f"select {', '.join(text(c) for c in test_columns)}, transaction_hour, has_identity from ({JOINED}) where ml_split = 'test'"),
        "fct_transactions": q(f"{with_marts} select {', '.join(text(c) for c in FACT_COLUMNS)} from fct"),
        "identity_dates": q("select transaction_id as \"TransactionID\", device_type as \"DeviceType\", device_info as \"DeviceInfo\", id_30, id_31, cast(t.transaction_date as varchar) as transaction_date from identity i join tx t using (transaction_id)"),
        "dataset_load": q(f"select {', '.join(text(c) for c in valid_columns)} from ({JOINED}) where ml_split = 'valid'"),
        "join_integrity": q(INTEGRITY.format(p="tx", c="identity", k="transaction_id")),
        "join_integrity_documents": INTEGRITY.format(p="documents", c="labels", k="doc_id"),
        "dim_split": q(f"select cast(transaction_date as varchar) as transaction_date, ml_split from ({DIM})"),
        "agg_transactions_daily": q(f"{with_marts} select * replace (cast(transaction_date as varchar) as transaction_date) from ({DAILY})"),
        "agg_pipeline_daily": q(f"{with_marts} select * replace (cast(transaction_date as varchar) as transaction_date, {TIME.format('last_ingested_at')} as last_ingested_at) from ({PIPELINE})"),
        "agg_predictions_daily": q(f"select * replace (cast(transaction_date as varchar) as transaction_date) from ({PREDICTIONS})"),
        "agg_score_amount": q(f"select * replace (cast(transaction_date as varchar) as transaction_date) from ({SCORE_AMOUNT})"),
        "agg_feature_buckets": q(BUCKETS),
        "agg_feature_values": q(VALUES),
        "feature_lift": q(lift),
        "split_candidates": q(f", {windows}"),
        "entity_monotonicity": q(steps_sql(("card1",))),
        "entity_monotonicity_narrow": q(steps_sql(tuple(CARD_KEYS))),
        "daily_profile": q(f", {daily} select cast(day as varchar) as day, tx_count, cast(fraud_count as double) as fraud_count, {r('fraud_rate')} as fraud_rate, {r('amt_sum')} as amt_sum from d"),
        "daily_profile_summary": q(f", {daily} select count(*) as day_count, cast(min(day) as varchar) as first_day, cast(max(day) as varchar) as last_day, cast(date_diff('day', min(day), max(day)) as int) as span_days, cast(sum(tx_count) as bigint) as tx_total, {spread} from d"),
        "null_profile": q(f", {nulls} select * from n"),
        "null_profile_summary": q(f", {nulls} select count(*) as column_count, count(*) filter (where null_ratio > 0.9) as mostly_null, count(*) filter (where null_ratio = 0) as complete from n"),
        "type_counts": q(f", {nulls} select dtype, count(*) as column_count from n group by 1"),
        "column_profile": profile_sql("events", EVENTS),
        "column_profile_customer": profile_sql("customer", CUSTOMER),
        "column_profile_lineitem": profile_sql("lineitem", LINEITEM),
        "fit_domains": q(" union all ".join(f"select '{c}' as \"column\", domain, n from ({kept(c)})" for c in DOMAINS)),
        "deseasonalize": f"with {SERIES} select day_index, n, {r('trend')} as trend, {r('resid')} as resid, {r('z')} as z from z",
        "origin_search": f"with {ORIGINS} select cast(origin as varchar) as origin, n_holidays, {r('score')} as score, cast(rank as int) as rank, {r('sigma')} as sigma from v order by v.rank, v.origin limit 10",
        "check_unique": "select l_orderkey, l_linenumber, count(*) as n from lineitem group by 1, 2 having count(*) > 1",
        "check_not_null": tx_row_checks([Rule("not_null", "tx", c) for c in TX_COLUMNS]),
        "check_accepted_values": tx_row_checks([Rule("accepted_values", "tx", c, values=v) for c, v in (("source_split", ("train", "test")), ("M4", ("M0", "M1")), ("product_cd", ("click", "view")))]),
        "check_accepted_range": tx_row_checks([Rule("accepted_range", "tx", c, low=lo, high=hi) for c, lo, hi in (("transaction_amt", 0, None), ("C13", 1, 5), ("D2", None, 7))]),
        "check_relationships": checks_sql([Rule("relationships", "lineitem", "l_orderkey", other="orders", other_column="o_orderkey"), Rule("relationships", "documents", "doc_id", other="labels", other_column="doc_id")], {}),
        "check_equal_rowcount": q(f"{with_marts} " + checks_sql([Rule("equal_rowcount", "fct_transactions", other="tx")], {"fct_transactions": "fct"})),
        "check_totals": q(f"{with_marts}, agg_transactions_daily as ({DAILY}) " + checks_sql([Rule("total_equals_rows", "agg_transactions_daily", "tx_count", other="fct")], {})),
        "check_split_order": q(f"select cast(max(transaction_date) filter (where ml_split = 'train') as varchar) as train_end, cast(min(transaction_date) filter (where ml_split = 'valid') as varchar) as valid_start from ({DIM})"),
        "check_suite": q(suite + " " + checks_sql(contract(), TABLES)),
        "features_build": q(f"select transaction_id, {text('transaction_amt')}, {BAND} as amount_band, {filled('product_cd', 'card4', 'card6', 'M4')}, {', '.join(f'{normalized(c)} as {c}' for c in DOMAINS)}, {text('C13')} from tx"),
        "dummy_scores": q(f"select transaction_id, (select {r('avg(is_fraud)')} from tx where transaction_date < date '2024-01-18') as score from tx where transaction_date between date '2024-01-18' and date '2024-01-24'"),
        "class_weights": q(f"select is_fraud as label, count(*) as n, {r('sum(count(*)) over () / (2 * count(*))')} as weight from tx where transaction_date < date '2024-01-18' group by 1"),
        "score_day": q(f", j as (select *, {normalized('purchaser_email_domain')} as domain from ({JOINED}) where transaction_date = date '2024-01-26') select transaction_id, cast(transaction_date as varchar) as transaction_date, {r(score)} as score, 'fixed' as model from j"),
        "ranking_metrics": q(metrics),
        "threshold_cost": curve_q(f", p as (select *, {RATES} from o) select {OUTCOME}, {r('missed_amount + false_alarms * 5.0')} as total_cost from p", "g as (select 0.43 :: double as threshold)"),
        "threshold_sweep": curve_q(f", p as (select *, {RATES} from o) select {OUTCOME}, {r('missed_amount + false_alarms * 5.0')} as total_cost from p"),
        "threshold_curve": curve_q(f", p as (select *, {RATES} from o) select threshold, caught, missed, false_alarms, round(missed_amount, 2) as missed_amount, round(recall, 4) as recall, round(precision, 4) as precision from p"),
        "threshold_sensitivity": curve_q(f", k as (select unnest([1.0, 5.0, 10.0, 25.0, 50.0, 100.0]) :: double as fp_cost), p as (select *, {RATES}, missed_amount + false_alarms * fp_cost as total_cost from o cross join k) select fp_cost, {OUTCOME}, {r('total_cost')} as total_cost from p qualify {CHEAPEST}"),
        "cost_view": curve_q(f", p as (select *, {RATES}, 25.0 :: double as fp_cost, missed_amount + false_alarms * 25.0 as total_cost, (select sum(transaction_amt) from s where is_fraud = 1) as loss from o) select fp_cost, {OUTCOME}, {r('total_cost')} as total_cost, {r('loss')} as no_block_loss, caught + false_alarms as blocked, {r('loss - total_cost')} as saving from p qualify {CHEAPEST}"),
        "curve_summary": q(f", {SCORED} select count(*) as row_count, count(*) filter (where is_fraud = 1) as fraud_count, round(sum(transaction_amt) filter (where is_fraud = 1), 2) as fraud_amount, {r('avg(is_fraud)')} as base_rate from s"),
        "contribution_top": q(f", {IMPORTANCE} select feature, {r('importance')} as importance, cast(rank as int) as rank, {r('share')} as share, {r('cumulative_share')} as cumulative_share from k where rank <= 5"),
        "contribution_families": q(f""", {IMPORTANCE}, f as (select case when feature ~ '^V' then 'V' when feature ~ '^C' then 'C' when feature ~ '^D' then 'D' when feature ~ '^M' then 'M' when feature like 'id\\_%' escape '\\' then 'id_' else 'named' end as family, sum(importance) as importance, count(*) as column_count from c group by 1)
 select family, {r('importance')} as importance, column_count, {r('importance / sum(importance) over ()')} as share, {r('importance / sum(importance) over () / column_count')} as share_per_column from f"""),
        "contribution_cumulative": q(f", {IMPORTANCE}, n as (select unnest([1, 2, 5, 10]) as top_n) select top_n, {r('sum(case when rank <= top_n then share else 0 end)')} as cumulative_share, count(*) filter (where importance = 0) as zero_features, count(*) as feature_count from n cross join k group by 1"),
    }
