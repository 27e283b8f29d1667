"""Batch scoring of days into the predictions table."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.operators.dataset import feature_columns, on_same_days
from riskloom.operators.marts import with_identity
from riskloom.operators.store import ScoringModel, score
from riskloom.params import Params
from riskloom.sources import contracts as C
from riskloom.sources import dated

PREDICTIONS = "predictions"
KEYS = ("transaction_id", "transaction_date")


def scoring_input(tx: DataFrame, identity: DataFrame) -> DataFrame:
    """Keys and features, with the same exclusions as training."""
    frame = with_identity(tx, identity)
    return frame.select(*KEYS, *feature_columns(frame.columns))


def predictions(
    tx: DataFrame, identity: DataFrame, bundle: ScoringModel, name: str, params: Params, scored_at: Column | None = None
) -> DataFrame:
    """Scores of all given transactions in the shape of the predictions table."""
    scored = score(scoring_input(tx, identity), bundle, params, KEYS)
    return scored.select(
        *KEYS,
        "score",
        F.lit(name).alias("model"),
        F.lit(bundle.trained_at).cast("timestamp").alias("model_trained_at"),
        (F.current_timestamp() if scored_at is None else scored_at).alias("scored_at"),
    )


def score_day(
    tx: DataFrame, identity: DataFrame, bundle: ScoringModel, name: str, day: date, root: str, params: Params
) -> int:
    """Score one day and replace it in the predictions table; returns its rows, 0 when there is nothing to score.

    The scores are computed once, by the write. What was written is counted; a day without rows is cleared.
    """
    rows = dated.on_day(tx, day)
    scored = predictions(rows, on_same_days(identity, day, day), bundle, name, params)
    dated.replace_day(scored, root, PREDICTIONS, day, C.PREDICTION_SCHEMA)
    return dated.on_day(dated.read_table(tx.sparkSession, root, PREDICTIONS, C.PREDICTION_SCHEMA), day).count()


def score_days(
    tx: DataFrame, identity: DataFrame, bundle: ScoringModel, name: str, first: date, last: date, root: str, params: Params
) -> DataFrame:
    """Score a range of days in one job and report it; days without rows are skipped."""
    rows = dated.between_days(tx, first, last)
    scored = predictions(rows, on_same_days(identity, first, last), bundle, name, params)
    dated.write_days(scored, root, PREDICTIONS, C.PREDICTION_SCHEMA)
    return dated.gap_report(rows, first, last)
