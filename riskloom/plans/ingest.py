"""CSV files to dated raw tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.lineage import materialized, scope
from riskloom.params import Params
from riskloom.sources import contracts as C
from riskloom.sources import dated, raw

SPLITS = ("train", "test")
DATASETS = ("transactions", "identity")
REJECTED = "rejected_identity"


def prepared(spark: SparkSession, csv_directory: str, split: str, params: Params) -> tuple[DataFrame, DataFrame]:
    """(transactions, identity) of one split with the pipeline columns. Both keys are checked to be unique.

    A file is parsed once, into a stored table; the key check, the date join and the dated write read that. Identity rows
    are stored with their dates, so the join runs once for the kept and the rejected ones.
    """
    tx = materialized(raw.read_raw(spark, csv_directory, f"{split}_transaction"))
    raw.assert_unique(tx, C.PRIMARY_KEY)
    tx = raw.prepare_transactions(tx, split, params.origin)
    identity = materialized(raw.attach_dates(raw.read_raw(spark, csv_directory, f"{split}_identity"), tx, split))
    raw.assert_unique(identity, C.PRIMARY_KEY)
    return tx, identity


def ingest(spark: SparkSession, csv_directory: str, root: str, params: Params) -> DataFrame:
    """Write both raw tables, one job each for all days of both splits, and report (dataset, day_count, row_count).

    Identity rows without a transaction have no day; they go to a table of rejects instead of a nameless partition.
    """
    with scope(spark):
        parts = [prepared(spark, csv_directory, split, params) for split in SPLITS]
        tx = reduce(DataFrame.unionByName, [t for t, _ in parts])
        identity, rejected = raw.split_orphans(reduce(DataFrame.unionByName, [i for _, i in parts]))
        dated.write_days(tx, root, "transactions", C.table_schema("transactions"))
        dated.write_days(identity, root, "identity", C.table_schema("identity"))
        rejected.write.mode("overwrite").parquet(dated.table_path(root, REJECTED))
    reports = [
        dated.load_totals(dated.read_table(spark, root, d)).select(F.lit(d).alias("dataset"), "day_count", "row_count")
        for d in DATASETS
    ]
    return reduce(DataFrame.unionByName, reports)
