"""Cost of blocking at a threshold: a missed fraud costs its amount, a blocked honest payment a fixed sum.

All grid points come from one pass over the scores: rows are counted by the number of grid points they reach, at most
``len(grid) + 1`` rows per group, and each threshold adds up the counts on its side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.columns import ratio_or_zero
from riskloom.functions.text import numbers

# 0.01 to 0.99, each rounded on its own so that 0.29 is the double nearest to 0.29.
GRID = tuple(round(i / 100, 2) for i in range(1, 100))
FP_COSTS = (1.0, 5.0, 10.0, 25.0, 50.0, 100.0)

COUNTS = ("caught", "missed", "false_alarms", "missed_amount")
# Costs that differ by less than this are a tie: sums of doubles differ in the last bits with the order of addition.
COST_DIGITS = 6


def bucket_totals(
    scored: DataFrame, grid: Sequence[float], group: Sequence[str], score: str, label: str, amount: str
) -> DataFrame:
    """Labelled rows by the number of grid points at or below their score; a missing score reaches none."""
    edges = Bucketizer(
        splits=[float("-inf"), *grid, float("inf")], inputCol="_score", outputCol="_reached", handleInvalid="error"
    )
    rows = scored.where(F.col(label).isNotNull()).select(
        *group,
        (F.col(label) == 1).alias("_fraud"),
        F.coalesce(F.nanvl(F.col(score).cast("double"), F.lit(None).cast("double")), F.lit(float("-inf"))).alias("_score"),
        F.col(amount).alias("_amount"),
    )
    return (
        edges.transform(rows)
        .groupBy(*group, F.col("_reached").cast("int").alias("_reached"))
        .agg(
            F.count_if("_fraud").alias("_frauds"),
            F.count_if(~F.col("_fraud")).alias("_honest"),
            F.coalesce(F.sum(F.when(F.col("_fraud"), F.col("_amount"))), F.lit(0.0)).alias("_fraud_amount"),
        )
    )


def outcomes(
    scored: DataFrame,
    grid: Sequence[float] = GRID,
    group: Sequence[str] = (),
    score: str = "score",
    label: str = "is_fraud",
    amount: str = "transaction_amt",
) -> DataFrame:
    """Outcome at every grid threshold, unrounded, with the loss when nothing is blocked (the same at every threshold)."""
    totals = bucket_totals(scored, grid, group, score, label, amount)
    fanned = totals.select("*", F.posexplode(numbers(grid)).alias("_position", "threshold"))
    blocked = F.col("_reached") > F.col("_position")

    def total(condition: Column, column: str, zero) -> Column:
        return F.sum(F.when(condition, F.col(column)).otherwise(zero))

    return (
        fanned.groupBy(*group, "threshold")
        .agg(
            total(blocked, "_frauds", 0).alias("caught"),
            total(~blocked, "_frauds", 0).alias("missed"),
            total(blocked, "_honest", 0).alias("false_alarms"),
            total(~blocked, "_fraud_amount", 0.0).alias("missed_amount"),
            F.sum("_fraud_amount").alias("no_block_loss"),
        )
        .withColumn("recall", ratio_or_zero("caught", F.col("caught") + F.col("missed")))
        .withColumn("precision", ratio_or_zero("caught", F.col("caught") + F.col("false_alarms")))
    )


def points(scored: DataFrame, grid: Sequence[float] = GRID, **names) -> DataFrame:
    """Counts, missed amount, recall and precision at every grid threshold."""
    return outcomes(scored, grid, **names).drop("no_block_loss")


def total_cost(fp_cost: float | Column) -> Column:
    return F.col("missed_amount") + F.col("false_alarms") * fp_cost


def sweep(scored: DataFrame, fp_cost: float, grid: Sequence[float] = GRID, **names) -> DataFrame:
    """Outcome and cost at every grid threshold."""
    return points(scored, grid, **names).withColumn("total_cost", total_cost(fp_cost))


def cost(scored: DataFrame, threshold: float, fp_cost: float, **names) -> DataFrame:
    """Outcome and cost at one threshold."""
    return sweep(scored, fp_cost, (threshold,), **names)


def curve(scored: DataFrame, grid: Sequence[float] = GRID, **names) -> DataFrame:
    """The export form: independent of the false-alarm cost, amounts to 2 digits and rates to 4."""
    return points(scored, grid, **names).select(
        "threshold",
        "caught",
        "missed",
        "false_alarms",
        F.round("missed_amount", 2).alias("missed_amount"),
        F.round("recall", 4).alias("recall"),
        F.round("precision", 4).alias("precision"),
    )


def best(costed: DataFrame, group: Sequence[str]) -> DataFrame:
    """Cheapest threshold per group; of equal costs the lower threshold."""
    order = F.struct(F.round("total_cost", COST_DIGITS), "threshold")
    picked = F.min_by(F.struct(*[c for c in costed.columns if c not in group]), order).alias("_best")
    return costed.groupBy(*group).agg(picked).select(*group, "_best.*")


def pick(scored: DataFrame, fp_cost: float, grid: Sequence[float] = GRID, **names) -> DataFrame:
    return best(sweep(scored, fp_cost, grid, **names), ())


def sensitivity(
    scored: DataFrame, fp_costs: Sequence[float] = FP_COSTS, grid: Sequence[float] = GRID, **names
) -> DataFrame:
    """Best threshold for each false-alarm cost; the costs fan out the grid rows, not the scores."""
    costed = points(scored, grid, **names).withColumn("fp_cost", F.explode(numbers(fp_costs)))
    return best(costed.withColumn("total_cost", total_cost(F.col("fp_cost"))), ["fp_cost"])


def cost_view(seen: DataFrame, fp_cost: float) -> DataFrame:
    """What a reader of ``outcomes`` sees for one false-alarm cost: the best point and the saving over blocking nothing."""
    costed = seen.withColumn("fp_cost", F.lit(float(fp_cost))).withColumn("total_cost", total_cost(fp_cost))
    return (
        best(costed, ["fp_cost"])
        .withColumn("blocked", F.col("caught") + F.col("false_alarms"))
        .withColumn("saving", F.col("no_block_loss") - F.col("total_cost"))
    )


def curve_summary(scored: DataFrame, score: str = "score", label: str = "is_fraud", amount: str = "transaction_amt") -> DataFrame:
    """Head of the curve document: rows, frauds, loss without blocking, base rate."""
    labelled = scored.where(F.col(label).isNotNull())
    return labelled.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col(label) == 1).alias("fraud_count"),
        F.round(F.coalesce(F.sum(F.when(F.col(label) == 1, F.col(amount))), F.lit(0.0)), 2).alias("fraud_amount"),
        F.avg(label).alias("base_rate"),
    )
