"""Small outputs: the threshold curve as one JSON document, profiles as CSV."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def curve_document(summary: DataFrame, curve: DataFrame) -> DataFrame:
    """One row ``value``: ``{"summary": {...}, "rows": [...]}``.

    The curve has one row per grid threshold (99), which bounds the list.
    """
    point = F.struct(*[F.col(c) for c in curve.columns])
    points = curve.agg(F.sort_array(F.collect_list(point)).alias("points"))
    return summary.select(
        F.to_json(F.struct(F.struct(*[F.col(c) for c in summary.columns]).alias("summary"), points.scalar().alias("rows"))).alias(
            "value"
        )
    )


def curve_head(summary: DataFrame, model: str, split: str, trained_at: datetime, pr_auc: float) -> DataFrame:
    """Head of the document, from ``thresholds.curve_summary``."""
    return summary.select(
        F.lit(model).alias("model"),
        F.lit(split).alias("split"),
        F.col("row_count").alias("rows"),
        F.col("fraud_count").alias("frauds"),
        "fraud_amount",
        F.lit(trained_at.isoformat(timespec="seconds")).alias("trained_at"),
        F.lit(round(pr_auc, 4)).alias("pr_auc"),
    )


# The document.
_HEAD = "model string, split string, rows bigint, frauds bigint, fraud_amount double, trained_at string, pr_auc double"
_POINT = "threshold double, caught bigint, missed bigint, false_alarms bigint, missed_amount double, recall double, precision double"


def read_curve(spark: SparkSession, path: str) -> DataFrame:
    """The points of a stored document, each with its head."""
    document = spark.read.option("wholetext", True).text(path)
    parsed = document.select(F.from_json("value", f"summary struct<{_named(_HEAD)}>, rows array<struct<{_named(_POINT)}>>").alias("d"))
    return parsed.select("d.summary.*", F.explode("d.rows").alias("point")).select(
        "model", "split", F.col("rows").alias("row_count"), "frauds", "fraud_amount", "trained_at", "pr_auc", "point.*"
    )


def _named(columns: str) -> str:
    """Fields of a struct from columns of a table."""
    return ", ".join(":".join(c.split()) for c in columns.split(", "))


def write_curve(summary: DataFrame, curve: DataFrame, path: str) -> None:
    curve_document(summary, curve).coalesce(1).write.mode("overwrite").text(path)


def write_profile(profile: DataFrame, path: str) -> None:
    """A profile has one row per column or per day."""
    profile.write.mode("overwrite").option("header", True).csv(path)
