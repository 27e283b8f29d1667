"""Which features move the score: contributions per row and feature, ranked and grouped."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml import Transformer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.columns import column_family
from riskloom.functions.lineage import materialized
from riskloom.functions.sampling import first_by_hash
from riskloom.operators.models import scored

# Fixed values.
CUMULATIVE_STEPS = (10, 20, 50, 100, 200)
TOP = 20
# Rows inside which one feature is exchanged at a time.
BUCKET_ROWS = 50_000


def stable_sample(df: DataFrame, row_id: str, rows: int, seed: int = 42) -> DataFrame:
    """A seeded sample of an exact size: the rows with the smallest id hashes, so the same on every run and layout."""
    return first_by_hash(df, [row_id], rows, seed=seed)


def _parts(df: DataFrame, weights: Mapping[str, float]) -> dict[str, Column]:
    """weight * (value - mean) of each feature, 0 where the value is unknown. One pass for all means, one row of them."""
    means = df.agg(*[F.avg(c) for c in weights]).first()
    return {
        c: F.coalesce(F.lit(float(w)) * (F.col(c) - F.lit(m).cast("double")), F.lit(0.0))
        for (c, w), m in zip(weights.items(), means)
    }


def linear_contributions(df: DataFrame, weights: Mapping[str, float], keys: Sequence[str]) -> DataFrame:
    """(keys, feature, contribution) of a linear score for every row and feature."""
    parts = _parts(df, weights)
    named = [p.alias(c) for c, p in parts.items()]
    return df.select(*keys, *named).unpivot(list(keys), list(parts), "feature", "contribution")


def linear_importance(df: DataFrame, weights: Mapping[str, float]) -> DataFrame:
    """(feature, importance): mean absolute contributions of a linear score, in two passes for any number of features."""
    wide = df.agg(*[F.avg(F.abs(p)).alias(c) for c, p in _parts(df, weights).items()])
    pairs = [F.struct(F.lit(c).alias("feature"), F.col(c).alias("importance")) for c in weights]
    return wide.select(F.inline(F.array(*pairs)))


def permutation_importance(
    model: Transformer, df: DataFrame, features: Sequence[str], label: str, row_id: str, seed: int = 42
) -> DataFrame:
    """Log-loss added when one feature is exchanged between rows, for models without additive contributions.

    Measured on all rows, which are stored once. They swap values inside hash buckets, whose number follows the data:
    sorted by a seeded hash, each row takes the value of the next one and the last row of a bucket keeps its own. A
    feature that misleads the model has a negative value.
    """
    stored = materialized(df)
    buckets = max(1, math.ceil(stored.count() / BUCKET_ROWS))
    base = stored.withColumn("_bucket", F.pmod(F.xxhash64(F.col(row_id), F.lit(seed)), F.lit(buckets)))

    def loss(frame: DataFrame) -> float:
        p = F.greatest(F.least(F.col("score"), F.lit(1 - 1e-15)), F.lit(1e-15))
        hit = scored(model, frame).select(
            F.avg(-F.when(F.col(label) == 1, F.log(p)).otherwise(F.log(1 - p))).alias("loss")
        )
        return hit.first()["loss"]

    before = loss(stored)
    rows = []
    for i, feature in enumerate(features):
        order = Window.partitionBy("_bucket").orderBy(F.xxhash64(F.col(row_id), F.lit(seed + 1 + i)), row_id)
        # A window's lead default must be a literal, so the last row is told apart by its rank.
        last = F.lead(F.lit(True)).over(order).isNull()
        swapped = base.withColumn(feature, F.when(last, F.col(feature)).otherwise(F.lead(feature).over(order)))
        rows.append((feature, loss(swapped.select(*df.columns)) - before))
    return df.sparkSession.createDataFrame(rows, "feature string, importance double")


# The tables below have one row per feature, so their windows do not grow with the data.


def ranked(table: DataFrame) -> DataFrame:
    """(feature, importance, rank, share, cumulative_share); equal importances by name."""
    everyone = Window.partitionBy(F.lit(0))
    order = everyone.orderBy(F.desc("importance"), "feature")
    total = F.sum("importance").over(everyone)
    upto = F.sum("importance").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return table.select(
        "feature",
        "importance",
        F.row_number().over(order).alias("rank"),
        F.try_divide(F.col("importance"), total).alias("share"),
        F.try_divide(upto, total).alias("cumulative_share"),
    )


def contribution_top(table: DataFrame, top: int = TOP) -> DataFrame:
    return ranked(table).where(F.col("rank") <= top)


def contribution_families(table: DataFrame) -> DataFrame:
    """Share of each name family, and per column of it."""
    families = table.groupBy(column_family("feature").alias("family")).agg(
        F.sum("importance").alias("importance"), F.count(F.lit(1)).alias("column_count")
    )
    share = F.try_divide(F.col("importance"), F.sum("importance").over(Window.partitionBy(F.lit(0))))
    return families.withColumn("share", share).withColumn("share_per_column", F.col("share") / F.col("column_count"))


def contribution_cumulative(table: DataFrame, steps: Sequence[int] = CUMULATIVE_STEPS) -> DataFrame:
    """Share of the first n features for each n, and how many features contribute nothing."""
    step = F.explode(F.array(*[F.lit(n) for n in steps])).alias("top_n")
    fanned = ranked(table).select("*", step)
    return fanned.groupBy("top_n").agg(
        F.sum(F.when(F.col("rank") <= F.col("top_n"), F.col("share")).otherwise(0.0)).alias("cumulative_share"),
        F.count_if(F.col("importance") == 0).alias("zero_features"),
        F.count(F.lit(1)).alias("feature_count"),
    )
