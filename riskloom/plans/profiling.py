"""Profiles of the raw files, stored as CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.columns import transaction_date
from riskloom.functions.lineage import materialized
from riskloom.operators import profile, sketches
from riskloom.params import Params
from riskloom.sources import contracts as C
from riskloom.sources import raw, sinks


def profile_files(spark: SparkSession, csv_directory: str, out: str, params: Params) -> dict[str, DataFrame]:
    """Daily volume, column advice and nulls of the labelled files, join integrity, header differences and common values
    of both splits."""
    files = {source: materialized(raw.read_raw(spark, csv_directory, source)) for source in raw.SOURCES}
    tx = files["train_transaction"].withColumn("day", transaction_date(C.OFFSET, params.origin))
    results = {"daily_profile": profile.daily_profile(tx, "day", C.PRIMARY_KEY, C.LABEL, "TransactionAmt")}
    for source in ("train_transaction", "train_identity"):
        results[f"column_profile_{source}"] = profile.column_profile(files[source])
        results[f"null_profile_{source}"] = profile.null_profile(files[source])
    for kind in ("transaction", "identity"):
        results[f"common_values_{kind}"] = sketches.compare_tables(files[f"train_{kind}"], files[f"test_{kind}"])
    for split in ("train", "test"):
        checked = profile.join_integrity(files[f"{split}_transaction"], files[f"{split}_identity"], C.PRIMARY_KEY)
        results[f"join_integrity_{split}"] = checked.select(F.lit(split).alias("split"), "*")
    for kind in ("transaction", "identity"):
        sides = [raw.read_header(spark, csv_directory, f"{split}_{kind}") for split in ("train", "test")]
        results[f"schemas_{kind}"] = profile.compare_schemas(*sides)
    for name, df in results.items():
        sinks.write_profile(df, f"{out.rstrip('/')}/{name}")
    return results
