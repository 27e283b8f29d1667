"""Fact table and aggregate marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions import columns as X
from riskloom.operators.ordered import tile_summary
from riskloom.params import Params

# The columns whose values are reported against the fraud rate.
REPORTED_FEATURES = ("C13", "C14", "V70", "V294", "C11", "C1", "D2", "D3", "C5", "V258")

# Columns of the fact table, a contract with its readers. Anonymous columns stay out.
FACT_COLUMNS = (
    "transaction_id",
    "transaction_date",
    "source_split",
    "transaction_hour",
    "transaction_amt",
    "product_cd",
    "card1",
    "card2",
    "card3",
    "card4",
    "card5",
    "card6",
    "addr1",
    "addr2",
    "dist1",
    "dist2",
    "purchaser_email_domain",
    "recipient_email_domain",
    "device_type",
    "device_info",
    "device_os",
    "device_browser",
    "has_identity",
    "is_fraud",
    "ingested_at",
)


def with_identity(tx: DataFrame, identity: DataFrame, columns: Sequence[Column] = ()) -> DataFrame:
    """Left join of the 1:1 identity side: adds ``has_identity``, ``transaction_hour`` and the given columns.

    No broadcast hint: the side grows with the data (about a quarter of the transactions), so its measured size decides.
    """
    side = identity.select("transaction_id", F.lit(True).alias("_matched"), *columns)
    return (
        tx.join(side, "transaction_id", "left")
        .withColumn("transaction_hour", X.hour_of_day("transaction_dt"))
        .withColumn("has_identity", F.col("_matched").isNotNull())
        .drop("_matched")
    )


def fct_transactions(tx: DataFrame, identity: DataFrame) -> DataFrame:
    """One row per transaction with its device, where known."""
    device = [
        F.col("device_type"),
        F.col("device_info"),
        F.col("id_30").alias("device_os"),
        F.col("id_31").alias("device_browser"),
    ]
    return with_identity(tx, identity, device).select(*FACT_COLUMNS)


def dim_split(tx: DataFrame, params: Params) -> DataFrame:
    """One row per date and source with its time split."""
    return (
        tx.select("transaction_date", "source_split")
        .distinct()
        .select("transaction_date", X.ml_split("source_split", "transaction_date", params.valid_start).alias("ml_split"))
    )


def agg_transactions_daily(fact: DataFrame) -> DataFrame:
    """Totals by date, hour, source, product and device. The rate covers labelled rows only, NULL without any."""
    fraud = F.col("is_fraud") == 1
    return fact.groupBy(
        "transaction_date",
        "transaction_hour",
        "source_split",
        "product_cd",
        F.coalesce("device_type", F.lit("unknown")).alias("device_type"),
    ).agg(
        X.row_count().alias("tx_count"),
        F.count("is_fraud").alias("labeled_count"),
        F.count_if(fraud).alias("fraud_count"),
        F.avg("is_fraud").alias("fraud_rate"),
        F.sum("transaction_amt").alias("amt_sum"),
        F.avg("transaction_amt").alias("amt_avg"),
        F.sum(F.when(fraud, F.col("transaction_amt")).otherwise(0.0)).alias("fraud_amt"),
        F.count_if("has_identity").alias("with_identity_count"),
    )


def against_trailing(daily: DataFrame, value: str, series: str, rows: int) -> Column:
    """Value over the mean of the previous rows of its series, itself excluded; NULL on the first row.

    ``daily`` must already be grouped to one row per series and day, so a window partition is as long as the calendar.
    """
    window = Window.partitionBy(series).orderBy("transaction_date").rowsBetween(-rows, -1)
    return X.ratio_or_null(value, F.avg(value).over(window))


def pipeline_base(fact: DataFrame) -> DataFrame:
    """Load health by date and source, of each day by itself: volume, null rates, freshness."""

    def share(condition: Column) -> Column:
        return F.count_if(condition) / X.row_count()

    return fact.groupBy("transaction_date", "source_split").agg(
        X.row_count().alias("tx_count"),
        F.count("is_fraud").alias("labeled_count"),
        share(F.col("purchaser_email_domain").isNull()).alias("email_null_rate"),
        share(F.col("addr1").isNull()).alias("addr_null_rate"),
        share(F.col("card2").isNull()).alias("card2_null_rate"),
        share(F.col("has_identity")).alias("identity_rate"),
        F.max("ingested_at").alias("last_ingested_at"),
    )


def with_baseline(daily: DataFrame, params: Params) -> DataFrame:
    """Volume against the trailing mean, from one row per day and source."""
    ratio = against_trailing(daily, "tx_count", "source_split", params.trailing_rows)
    return daily.withColumn("tx_count_vs_baseline", ratio)


def agg_pipeline_daily(fact: DataFrame, params: Params) -> DataFrame:
    """Load health by date and source, with the volume against the trailing mean."""
    return with_baseline(pipeline_base(fact), params)


def agg_predictions_daily(predictions: DataFrame, params: Params) -> DataFrame:
    """Score distribution by date and model, and the blocked rate against its trailing mean."""
    blocked = F.count_if(F.col("score") >= params.block_threshold)
    daily = (
        predictions.groupBy("transaction_date", "model")
        .agg(
            X.row_count().alias("scored_count"),
            blocked.alias("blocked_count"),
            (blocked / X.row_count()).alias("blocked_rate"),
            F.avg("score").alias("score_avg"),
            F.percentile_approx("score", [0.5, 0.9, 0.99], 10_000).alias("_q"),
        )
        .withColumns({f"score_p{p}": F.col("_q")[i] for i, p in enumerate((50, 90, 99))})
        .drop("_q")
    )
    ratio = against_trailing(daily, "blocked_rate", "model", params.trailing_rows)
    return daily.withColumn("blocked_rate_vs_baseline", ratio)


def agg_score_amount(predictions: DataFrame, tx: DataFrame, params: Params) -> DataFrame:
    """Score band by amount band, per date and product. Predictions without a transaction drop out."""
    amounts = tx.select("transaction_id", "transaction_amt", "product_cd")
    return (
        predictions.select("transaction_id", "transaction_date", "score")
        .join(amounts, "transaction_id")
        .groupBy(
            "transaction_date",
            "product_cd",
            X.high_low("score", params.block_threshold).alias("score_band"),
            X.high_low("transaction_amt", params.high_amount).alias("amount_band"),
        )
        .agg(
            X.row_count().alias("tx_count"),
            F.sum("transaction_amt").alias("amount_total"),
            F.avg("transaction_amt").alias("amount_avg"),
            F.min("score").alias("score_min"),
            F.max("score").alias("score_max"),
        )
    )


def labelled_rows(tx: DataFrame) -> DataFrame:
    return tx.where(F.col("source_split") == "train")


def train_rows(tx: DataFrame, dim: DataFrame) -> DataFrame:
    """Rows of the training days. What is fitted (domain lists, class weights) is fitted on these alone."""
    days = dim.where(F.col("ml_split") == "train").select("transaction_date")
    return tx.join(days, "transaction_date", "left_semi")


def long_features(tx: DataFrame, features: Sequence[str], kind: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row per record and feature from a single scan; ``kind`` is the common type of ``value``."""
    typed = tx.selectExpr(*keep, *[f"CAST({f} AS {kind}) AS {f}" for f in features])
    return typed.unpivot(list(keep), list(features), "feature", "value")


def agg_feature_buckets(tx: DataFrame, params: Params, features: Sequence[str] = REPORTED_FEATURES) -> DataFrame:
    """Fraud rate by quantile bucket of each feature, NULL apart; small buckets are not reported."""
    rows = long_features(labelled_rows(tx), features, "double", ["transaction_id", "is_fraud"])
    rows = rows.withColumn("value", F.nanvl("value", F.lit(None).cast("double")))
    tiles = tile_summary(rows, "feature", "value", "transaction_id", "is_fraud", params.tiles)
    return tiles.where(F.col("n") >= params.min_bucket_rows).select(
        "feature",
        F.when(F.col("tile") == 0, "null").otherwise(F.format_string("Q%d", "tile")).alias("bucket"),
        F.col("n").alias("tx_count"),
        F.col("positives").alias("fraud_count"),
        X.ratio_or_null("positives", "labelled").alias("fraud_rate"),
        "value_min",
        "value_max",
    )


def value_rates(tx: DataFrame, features: Sequence[str]) -> DataFrame:
    """Rows, frauds and fraud rate of every non-null value of each feature."""
    rows = long_features(labelled_rows(tx), features, "string", ["is_fraud"])
    return (
        rows.where(F.col("value").isNotNull())
        .groupBy("feature", "value")
        .agg(
            X.row_count().alias("tx_count"),
            F.count_if(F.col("is_fraud") == 1).alias("fraud_count"),
            F.avg("is_fraud").alias("fraud_rate"),
        )
    )


def agg_feature_values(tx: DataFrame, params: Params, features: Sequence[str] = REPORTED_FEATURES) -> DataFrame:
    """Fraud rate of the most frequent values of each feature, ties by value.

    The rank filter becomes a group limit: every task passes on at most ``top_values`` rows per feature.
    """
    frequent = value_rates(tx, features).where(F.col("tx_count") >= params.min_bucket_rows)
    order = Window.partitionBy("feature").orderBy(F.desc("tx_count"), "value")
    return (
        frequent.withColumn("_rank", F.row_number().over(order))
        .where(F.col("_rank") <= params.top_values)
        .drop("_rank")
    )


def feature_lift(tx: DataFrame, params: Params, features: Sequence[str]) -> DataFrame:
    """How far apart the fraud rates of a feature's values lie, over values with enough rows."""
    rates = value_rates(tx, features).where(F.col("tx_count") >= params.min_bucket_rows)
    return (
        rates.groupBy("feature")
        .agg(
            X.row_count().alias("value_count"),
            F.min("fraud_rate").alias("rate_min"),
            F.max("fraud_rate").alias("rate_max"),
        )
        .withColumn("lift", X.ratio_or_null("rate_max", "rate_min"))
    )


def split_candidates(tx: DataFrame, window_days: Sequence[int] = (21, 28, 35, 42)) -> DataFrame:
    """Size and fraud rate of the validation split for candidate lengths before the last labelled day.

    Grouped by day first; the candidates then fan out one row per calendar day, not per transaction.
    """
    daily = (
        labelled_rows(tx)
        .groupBy("transaction_date")
        .agg(X.row_count().alias("n"), F.count("is_fraud").alias("labelled"), F.count_if(F.col("is_fraud") == 1).alias("frauds"))
    )
    last_day = daily.agg(F.max("transaction_date")).scalar()
    age = F.date_diff(last_day, F.col("transaction_date"))
    return (
        daily.withColumn("window_days", F.explode(F.array(*[F.lit(d) for d in window_days])))
        .groupBy("window_days")
        .agg(
            F.sum(F.when(age <= F.col("window_days"), F.col("n")).otherwise(0)).alias("valid_rows"),
            F.sum(F.when(age > F.col("window_days"), F.col("n")).otherwise(0)).alias("train_rows"),
            F.sum(F.when(age <= F.col("window_days"), F.col("frauds")).otherwise(0)).alias("valid_frauds"),
            F.sum(F.when(age <= F.col("window_days"), F.col("labelled")).otherwise(0)).alias("_labelled"),
        )
        .withColumn("valid_rate", X.ratio_or_null("valid_frauds", "_labelled"))
        .drop("_labelled")
    )
