"""Raw tables to marts, then the checks that make the marts fit for use."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskloom.operators import checks, marts
from riskloom.operators.staging import stg_identity, stg_transactions
from riskloom.params import Params
from riskloom.sources import contracts as C
from riskloom.sources import dated

MARTS = (
    "fct_transactions",
    "dim_split",
    "agg_transactions_daily",
    "agg_pipeline_daily",
    "agg_predictions_daily",
    "agg_score_amount",
    "agg_feature_buckets",
    "agg_feature_values",
)
RESULTS = "check_results"


def raw_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The raw tables; predictions that were never made are an empty table."""
    return {
        "transactions": dated.read_table(spark, root, "transactions", C.table_schema("transactions")),
        "identity": dated.read_table(spark, root, "identity", C.table_schema("identity")),
        "predictions": dated.read_table(spark, root, "predictions", C.PREDICTION_SCHEMA),
    }


def read_mart(spark: SparkSession, mart_root: str, name: str) -> DataFrame:
    return spark.read.parquet(dated.table_path(mart_root, name))


def _store(df: DataFrame, mart_root: str, name: str) -> DataFrame:
    """Replace a mart table and continue from what was written, so later marts do not repeat its joins."""
    path = dated.table_path(mart_root, name)
    if name == "fct_transactions":
        dated.write_all(df, mart_root, name)
    else:
        df.hint("rebalance").write.mode("overwrite").parquet(path)
    return read_mart(df.sparkSession, mart_root, name).drop(dated.DT)


def transform(spark: SparkSession, root: str, mart_root: str, params: Params) -> dict[str, DataFrame]:
    """Build and store every mart, run the checks on the stored tables and raise if one fails.

    The check results are stored before anything is raised.
    """
    tables = raw_tables(spark, root)
    tx, identity = stg_transactions(tables["transactions"]), stg_identity(tables["identity"])
    tx, identity = tx.drop(dated.DT), identity.drop(dated.DT)
    predictions = tables["predictions"].drop(dated.DT)

    built = {"fct_transactions": _store(marts.fct_transactions(tx, identity), mart_root, "fct_transactions")}
    fact = built["fct_transactions"]
    models = {
        "dim_split": marts.dim_split(tx, params),
        "agg_transactions_daily": marts.agg_transactions_daily(fact),
        "agg_pipeline_daily": marts.agg_pipeline_daily(fact, params),
        "agg_predictions_daily": marts.agg_predictions_daily(predictions, params),
        "agg_score_amount": marts.agg_score_amount(predictions, tx, params),
        "agg_feature_buckets": marts.agg_feature_buckets(tx, params),
        "agg_feature_values": marts.agg_feature_values(tx, params),
    }
    for name, df in models.items():
        built[name] = _store(df, mart_root, name)

    results = checks.run_checks(built | tables | {"stg_transactions": tx})
    results.write.mode("overwrite").parquet(dated.table_path(mart_root, RESULTS))
    checks.enforce(read_mart(spark, mart_root, RESULTS))
    return built
