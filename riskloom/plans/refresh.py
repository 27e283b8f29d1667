"""Daily marts that follow changed days only.

Raw tables and the base of a mart are versioned tables. The mart notes which commits of the raw tables it has seen; the
days that have changed since are read, and nothing else, and replaced in the mart in one step. What looks back over days
(trailing means) is worked out over the base, which has one row per day and source.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from riskloom.operators import marts
from riskloom.params import Params
from riskloom.sources.dated import DT
from riskloom.sources.versions import VersionedTable

BASE = "pipeline_base"
BASE_SCHEMA = T.StructType(
    [
        T.StructField("transaction_date", T.DateType()),
        T.StructField("source_split", T.StringType()),
        *[T.StructField(c, T.LongType()) for c in ("tx_count", "labeled_count")],
        *[T.StructField(f"{c}_rate", T.DoubleType()) for c in ("email_null", "addr_null", "card2_null", "identity")],
        T.StructField("last_ingested_at", T.TimestampType()),
    ]
)


def base_table(spark: SparkSession, mart_root: str, schema: T.StructType = BASE_SCHEMA) -> VersionedTable:
    return VersionedTable(spark, mart_root, BASE, schema)


def refresh_pipeline(transactions: VersionedTable, identity: VersionedTable, base: VersionedTable) -> list[date]:
    """Bring the base of the load mart up to date with staged transactions and identity rows; the days it has read."""
    seen = base.latest().notes
    sources = {"transactions": transactions, "identity": identity}
    now = {name: table.latest() for name, table in sources.items()}
    days = sorted({d for name, table in sources.items() for d in table.changed_since(seen.get(name, 0))})
    if days:
        tx, side = (sources[n].read(days, now[n]).drop(DT) for n in sources)
        daily = marts.pipeline_base(marts.fct_transactions(tx, side))
        base.write_days(daily, {name: commit.number for name, commit in now.items()}, gone=days)
    return days


def agg_pipeline_daily(base: VersionedTable, params: Params) -> DataFrame:
    """The load mart as of the last refresh."""
    return marts.with_baseline(base.read().drop(DT), params)
