"""Train and store the baselines, score days with a stored one, publish its threshold curve."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import UTC, date, datetime

from pyspark.sql import DataFrame, SparkSession

from riskloom.functions.lineage import materialized
from riskloom.operators import dataset, explain, models, scoring, store, thresholds
from riskloom.operators.features import FeatureSet
from riskloom.operators.ordered import ranking_metrics
from riskloom.operators.staging import stg_identity, stg_transactions
from riskloom.params import Params
from riskloom.plans.transform import raw_tables, read_mart
from riskloom.sources import sinks

KEYS = dataset.KEYS


def _staged(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Both staged tables, with the directory column that day filters prune on."""
    tables = raw_tables(spark, root)
    return stg_transactions(tables["transactions"]), stg_identity(tables["identity"])


def _split(
    spark: SparkSession, root: str, mart_root: str, split: str, feature_set: FeatureSet
) -> DataFrame:
    tx, identity = _staged(spark, root)
    dim = read_mart(spark, mart_root, "dim_split")
    return dataset.labelled_rows(tx, identity, dim, split, models.curated_or_all(feature_set))


def model_name(model: str, feature_set: FeatureSet) -> str:
    return f"{model}-{feature_set}"


def train(
    spark: SparkSession,
    root: str,
    mart_root: str,
    model_directory: str,
    params: Params,
    feature_set: FeatureSet = FeatureSet.CURATED,
    fits: Sequence[tuple[str, models.Fit]] | None = None,
    stored: Sequence[str] = ("trees",),
) -> DataFrame:
    """Fit and compare the models of a feature set, store those named in ``stored``, return the comparison."""
    parts = [_split(spark, root, mart_root, s, feature_set) for s in ("train", "valid")]
    fitted = models.compare(*parts, feature_set, params, fits)
    for t in fitted:
        if t.name in stored:
            kept = store.ScoringModel(t.model, t.inputs, t.domains, feature_set, datetime.now(UTC), t.metrics)
            store.save(kept, model_directory, model_name(t.name, feature_set))
    return models.comparison_table(spark, fitted)


def score_range(
    spark: SparkSession, root: str, model_directory: str, name: str, first: date, last: date, params: Params
) -> DataFrame:
    """Score every day of a range that has transactions and report loaded and skipped days."""
    tx, identity = _staged(spark, root)
    bundle = store.load(spark, model_directory, name)
    return scoring.score_days(tx, identity, bundle, name, first, last, root, params)


def publish_curve(
    spark: SparkSession, root: str, mart_root: str, model_directory: str, name: str, path: str, params: Params
) -> None:
    """Write the threshold curve of a stored model on the validation split as one JSON document."""
    bundle = store.load(spark, model_directory, name)
    valid = _split(spark, root, mart_root, "valid", bundle.feature_set)
    scores = materialized(store.score(valid, bundle, params, (*KEYS, "transaction_amt")))
    summary = sinks.curve_head(
        thresholds.curve_summary(scores), name, "valid", bundle.trained_at, bundle.metrics.get("pr_auc", 0.0)
    )
    sinks.write_curve(summary, thresholds.curve(scores), path)


def evaluate(
    spark: SparkSession, root: str, mart_root: str, model_directory: str, name: str, params: Params
) -> DataFrame:
    """Ranking metrics of a stored model on the validation split."""
    bundle = store.load(spark, model_directory, name)
    valid = _split(spark, root, mart_root, "valid", bundle.feature_set)
    return ranking_metrics(store.score(valid, bundle, params, KEYS))


def cost_table(
    spark: SparkSession, root: str, mart_root: str, model_directory: str, name: str, params: Params
) -> DataFrame:
    """The cheapest threshold of a stored model for each false-alarm cost, on the validation split."""
    bundle = store.load(spark, model_directory, name)
    valid = _split(spark, root, mart_root, "valid", bundle.feature_set)
    return thresholds.sensitivity(store.score(valid, bundle, params, (*KEYS, "transaction_amt")))


def explain_trees(
    spark: SparkSession, root: str, mart_root: str, model_directory: str, name: str, params: Params
) -> dict[str, DataFrame]:
    """What the features of stored trees add to their scores on the validation split: ranked, by family, cumulative."""
    bundle = store.load(spark, model_directory, name)
    valid = _split(spark, root, mart_root, "valid", bundle.feature_set)
    table = materialized(bundle.scorer.importance(store.prepare(valid, bundle, params, KEYS)))
    return {
        "top": explain.contribution_top(table),
        "families": explain.contribution_families(table),
        "cumulative": explain.contribution_cumulative(table),
    }
