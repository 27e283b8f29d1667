"""Data-quality checks: (check, table, column, violations, passed) rows, and a runner that raises."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions import columns as X
from riskloom.functions import text


@dataclass(frozen=True)
class Check:
    """One promise about a table. ``kind`` names the rule, the other fields are its arguments."""

    kind: str
    table: str
    column: str = ""
    values: tuple[str, ...] = ()
    low: float | None = None
    high: float | None = None
    other: str = ""  # compared table
    other_column: str = ""


def not_null(table: str, *columns: str) -> list[Check]:
    return [Check("not_null", table, c) for c in columns]


def unique(table: str, column: str) -> Check:
    return Check("unique", table, column)


def accepted_values(table: str, column: str, *values: str) -> Check:
    return Check("accepted_values", table, column, values=values)


def accepted_range(table: str, column: str, low: float | None = None, high: float | None = None) -> Check:
    return Check("accepted_range", table, column, low=low, high=high)


# What each table promises.
CONTRACT: tuple[Check, ...] = (
    unique("transactions", "TransactionID"),
    *not_null("transactions", "TransactionID", "transaction_date"),
    accepted_values("transactions", "source_split", "train", "test"),
    unique("predictions", "transaction_id"),
    *not_null("predictions", "transaction_id", "score", "model"),
    unique("identity", "TransactionID"),
    *not_null("identity", "TransactionID"),
    Check("relationships", "identity", "TransactionID", other="transactions", other_column="TransactionID"),
    Check("equal_rowcount", "fct_transactions", other="stg_transactions"),
    unique("fct_transactions", "transaction_id"),
    *not_null("fct_transactions", "transaction_id", "transaction_date"),
    accepted_range("fct_transactions", "transaction_hour", 0, 23),
    *not_null("fct_transactions", "transaction_amt"),
    accepted_range("fct_transactions", "transaction_amt", 0),
    accepted_values("fct_transactions", "source_split", "train", "test"),
    *not_null("fct_transactions", "has_identity"),
    Check("total_equals_rows", "agg_transactions_daily", "tx_count", other="fct_transactions"),
    *not_null("agg_transactions_daily", "transaction_date", "tx_count"),
    accepted_range("agg_transactions_daily", "tx_count", 1),
    accepted_range("agg_transactions_daily", "fraud_rate", 0, 1),
    *not_null("agg_pipeline_daily", "transaction_date", "tx_count"),
    accepted_range("agg_pipeline_daily", "identity_rate", 0, 1),
    unique("dim_split", "transaction_date"),
    *not_null("dim_split", "transaction_date", "ml_split"),
    accepted_values("dim_split", "ml_split", "train", "valid", "test"),
    Check("train_before_valid", "dim_split", "transaction_date"),
    *not_null("agg_predictions_daily", "transaction_date", "model", "scored_count", "blocked_rate"),
    accepted_range("agg_predictions_daily", "blocked_rate", 0, 1),
    accepted_range("agg_predictions_daily", "score_p99", 0, 1),
    *not_null("agg_score_amount", "transaction_date", "score_band"),
    accepted_values("agg_score_amount", "score_band", "high", "low"),
    *not_null("agg_score_amount", "amount_band"),
    accepted_values("agg_score_amount", "amount_band", "high", "low"),
    *not_null("agg_score_amount", "tx_count", "amount_total"),
    *not_null("agg_feature_buckets", "feature", "bucket", "fraud_rate"),
    accepted_range("agg_feature_buckets", "fraud_rate", 0, 1),
    *not_null("agg_feature_buckets", "tx_count"),
    *not_null("agg_feature_values", "feature", "value", "fraud_rate"),
    accepted_range("agg_feature_values", "fraud_rate", 0, 1),
)

ROW_KINDS = ("not_null", "accepted_values", "accepted_range")


class CheckFailure(AssertionError):
    """At least one check has violations."""


def _violates(check: Check) -> str:
    """Condition of a violating row, for the rules that look at one row; NULL passes all but not_null."""
    c = text.name(check.column)
    if check.kind == "not_null":
        return f"{c} IS NULL"
    if check.kind == "accepted_values":
        return f"{c} NOT IN ({', '.join(text.literal(v) for v in check.values)})"
    ends = [f"{c} {sign} {text.literal(end)}" for sign, end in (("<", check.low), (">", check.high)) if end is not None]
    return " OR ".join(ends) or "false"


def row_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """All single-row rules of a table in one scan: one conditional count per rule, then one row per rule."""
    counts = df.agg(*[F.expr(f"count_if({_violates(c)}) AS v{i}") for i, c in enumerate(checks)])
    return _results(counts, {f"v{i}": c for i, c in enumerate(checks)})


def _results(counted: DataFrame, checks: Mapping[str, Check]) -> DataFrame:
    """A row of violation counts, one column per check, to one row per check."""
    row = "named_struct('check', {0}, 'table', {1}, 'column', {2}, 'violations', {3}, 'passed', {3} = 0)"
    rows = [
        row.format(*map(text.literal, (c.kind, c.table, c.column)), f"coalesce(CAST({v} AS BIGINT), 0L)")
        for v, c in checks.items()
    ]
    return counted.selectExpr(f"inline(array({', '.join(rows)}))")


def repeated_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once; NULL keys do not count."""
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return df.where(known).groupBy(*keys).agg(X.row_count().alias("n")).where(F.col("n") > 1)


def orphan_keys(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child keys without a parent, with their rows.

    The child is combined by key first, so one key with a third of the rows is a single row of the anti join.
    """
    keys = child.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("_key")).agg(X.row_count().alias("n"))
    return keys.join(parent.select(F.col(parent_column).alias("_key")), "_key", "left_anti")


def table_check(check: Check, tables: Mapping[str, DataFrame]) -> DataFrame:
    """The rules that need more than one row or more than one table."""
    df = tables[check.table]
    if check.kind == "unique":
        counted = repeated_keys(df, check.column).agg(X.row_count().alias("v"))
    elif check.kind == "relationships":
        orphans = orphan_keys(df, check.column, tables[check.other], check.other_column)
        counted = orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("v"))
    elif check.kind in ("equal_rowcount", "total_equals_rows"):
        own = F.sum(check.column) if check.kind == "total_equals_rows" else X.row_count()
        expected = tables[check.other].agg(X.row_count()).scalar()
        counted = df.agg(F.abs(F.coalesce(own, F.lit(0)) - expected).alias("v"))
    elif check.kind == "train_before_valid":
        counted = split_bounds(df).agg(F.count_if(F.col("train_end") >= F.col("valid_start")).alias("v"))
    else:
        raise KeyError(f"unknown check {check.kind!r}")
    return _results(counted, {"v": check})


def split_bounds(dim: DataFrame) -> DataFrame:
    """Last train day and first valid day."""
    day = F.col("transaction_date")
    return dim.agg(
        F.max(F.when(F.col("ml_split") == "train", day)).alias("train_end"),
        F.min(F.when(F.col("ml_split") == "valid", day)).alias("valid_start"),
    )


def run_checks(tables: Mapping[str, DataFrame], checks: Sequence[Check] = CONTRACT) -> DataFrame:
    """One result row per check whose table is given; single-row rules share one scan per table."""
    results = []
    for table in dict.fromkeys(c.table for c in checks if c.table in tables):
        own = [c for c in checks if c.table == table]
        rows = [c for c in own if c.kind in ROW_KINDS]
        if rows:
            results.append(row_checks(tables[table], rows))
        results += [
            table_check(c, tables) for c in own if c.kind not in ROW_KINDS and (not c.other or c.other in tables)
        ]
    return reduce(DataFrame.unionByName, results)


def enforce(results: DataFrame) -> None:
    """Raise when a check failed; the results have one row per check."""
    failed = results.where(~F.col("passed")).collect()
    if failed:
        raise CheckFailure("; ".join(f"{r['check']} {r['table']}.{r['column']}: {r['violations']}" for r in failed))

