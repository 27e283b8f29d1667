"""Card-transaction tables derived from the ``events`` table, for the registered queries and the tests.

The text is portable SQL: Spark and the SQL oracle run the same definitions, the operators differ.
"""

from __future__ import annotations

from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from riskloom.operators.staging import IDENTITY_NAMES, TRANSACTION_NAMES, stg_identity, stg_transactions
from riskloom.params import Params

# 30 days from 2024-01-01; valid from the 18th, labels end on the 24th.
STANDIN_PARAMS = Params(origin=date(2023, 12, 31), valid_start=date(2024, 1, 18), high_amount=115.0)

CTES = """
e as (select *, cast(regexp_extract(props, '([0-9]+)', 1) as int) as k from events),
tx as (
 select event_id as transaction_id,
  dayofyear(ts)*86400 + hour(ts)*3600 + minute(ts)*60 + cast(floor(second(ts)) as int) as transaction_dt,
  value as transaction_amt,
  event_type as product_cd,
  case when cast(ts as date) >= date '2024-01-25' then null when k >= 95 then 1 else 0 end as is_fraud,
  case user_id % 8 when 0 then 'gmail.com' when 1 then 'gmail' when 2 then 'yahoo.com' when 3 then 'yahoo.co.jp'
       when 4 then 'outlook.com' when 5 then 'hotmail.fr' when 6 then null else 'rare.net' end as purchaser_email_domain,
  case event_id % 5 when 0 then 'gmail.com' when 1 then 'live.com.mx' when 2 then 'aol.com' else null end as recipient_email_domain,
  user_id as card1,
  case when event_id % 50 = 0 then null else user_id*3 end as card2,
  100 + user_id % 50 as card3,
  case user_id % 3 when 0 then 'visa' when 1 then 'mastercard' else null end as card4,
  200 + user_id % 9 as card5,
  case when user_id % 4 = 0 then 'credit' else 'debit' end as card6,
  case when event_id % 10 = 0 then null else user_id % 40 end as addr1,
  user_id % 3 as addr2,
  case when event_id % 5 < 3 then null else event_id % 211 end as dist1,
  case when event_id % 16 = 0 then event_id % 301 else null end as dist2,
  case when event_id % 9 = 0 then null else k % 7 end as C13,
  k % 4 as C14,
  user_id % 17 as C11,
  cast(floor(value) as int) as C1,
  case when k >= 98 then 1 else 0 end as C5,
  case when event_id % 6 = 0 then null else user_id % 11 end as D2,
  case when event_id % 3 = 0 then null else event_id % 97 end as D3,
  case event_id % 4 when 0 then 'M0' when 1 then 'M1' when 2 then 'M2' else null end as M4,
  k % 3 as V70,
  case when k < 70 then 0 else k % 13 end as V294,
  value as V258,
  cast(ts as date) as transaction_date,
  case when cast(ts as date) >= date '2024-01-25' then 'test' else 'train' end as source_split,
  ts as ingested_at
 from e),
identity as (
 select event_id as transaction_id,
  case k % 3 when 0 then 'desktop' when 1 then 'mobile' else null end as device_type,
  concat('dev', cast(user_id % 20 as varchar(10))) as device_info,
  case user_id % 3 when 0 then 'os a' when 1 then 'os b' else null end as id_30,
  case user_id % 5 when 0 then 'browser a' else 'browser b' end as id_31
 from e where event_id % 4 = 0),
predictions as (
 select event_id as transaction_id, cast(ts as date) as transaction_date,
  cast(6*k + 4*((event_id*37) % 100) as double)/1000 as score, 'base' as model
 from e)
"""


def _inverse(names: dict[str, str]) -> dict[str, str]:
    return {staged: raw for raw, staged in names.items()}


class Standins:
    """The three raw tables and their staged views for one data directory."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark = spark
        self.directory = directory

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.directory}/{name}.parquet")

    def _derived(self, name: str) -> DataFrame:
        text = CTES.replace("from events", "from {events}")
        return self.spark.sql(f"with {text} select * from {name}", events=self.table("events"))

    @cached_property
    def raw_transactions(self) -> DataFrame:
        return self._derived("tx").withColumnsRenamed(_inverse(TRANSACTION_NAMES))

    @cached_property
    def raw_identity(self) -> DataFrame:
        return self._derived("identity").withColumnsRenamed(_inverse(IDENTITY_NAMES))

    @cached_property
    def predictions(self) -> DataFrame:
        return self._derived("predictions")

    @property
    def tx(self) -> DataFrame:
        return stg_transactions(self.raw_transactions)

    @property
    def identity(self) -> DataFrame:
        return stg_identity(self.raw_identity)
