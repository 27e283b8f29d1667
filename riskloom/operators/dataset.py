"""Rows of a time split or a day, as keys and features."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.checks import repeated_keys
from riskloom.operators.marts import with_identity
from riskloom.sources.dated import DT, between_days, on_day

# Whether the answer is known in a split, columns that carry time, identity or the answer and must not
# reach a model, and those that every frame carries beside its features.
HAS_LABELS = {"train": True, "valid": True, "test": False}
DROP_COLUMNS = (
    "transaction_id",
    "transaction_dt",
    "transaction_date",
    "is_fraud",
    "ml_split",
    "source_split",
    "ingested_at",
)
KEYS = ("transaction_id", "transaction_date", "is_fraud")
LABEL = "is_fraud"
# What the identity join adds.
JOINED = ("transaction_hour", "has_identity")


def feature_columns(columns: Iterable[str]) -> tuple[str, ...]:
    return tuple(c for c in columns if c not in (*DROP_COLUMNS, DT))


def _of_split(tx: DataFrame, dim: DataFrame, split: str) -> DataFrame:
    """Transactions of the days of a split. A dated table is joined on its directory column, so its days are pruned."""
    if split not in HAS_LABELS:
        raise ValueError(f"no split is called {split!r}; there are {', '.join(HAS_LABELS)}")
    if not repeated_keys(dim, "transaction_date").isEmpty():
        raise ValueError("a date belongs to two splits, its rows would be there twice")
    key = DT if DT in tx.columns else "transaction_date"
    return tx.join(dim.where(F.col("ml_split") == split).select(F.col("transaction_date").alias(key)), key, "left_semi")


def _keyed(rows: DataFrame, identity: DataFrame, features: Sequence[str] | None) -> DataFrame:
    """KEYS and features, each once; all features unless some are named."""
    wide = with_identity(rows, identity)
    named = feature_columns(wide.columns) if features is None else tuple(dict.fromkeys([*features, *JOINED]))
    return wide.select(*KEYS, *named)


def split_rows(
    tx: DataFrame, identity: DataFrame, dim: DataFrame, split: str, features: Sequence[str] | None = None
) -> DataFrame:
    """Keys and features of one time split, whether its answers are known or not."""
    return _keyed(_of_split(tx, dim, split), identity, features)


def labelled_rows(
    tx: DataFrame, identity: DataFrame, dim: DataFrame, split: str, features: Sequence[str] | None = None
) -> DataFrame:
    """As ``split_rows``, for fitting and measuring: every row has its answer, and there are rows.

    Both are counted in one job before the identity join, which is 1:1.
    """
    if not HAS_LABELS.get(split, True):
        raise ValueError(f"{split} rows have no labels; split_rows reads them for scoring")
    rows = _of_split(tx, dim, split)
    n, known = rows.agg(F.count(F.lit(1)), F.count(LABEL)).first()
    if n == 0 or known < n:
        raise ValueError(f"{split}: {n - known} rows without a label" if n else f"{split}: no rows")
    return _keyed(rows, identity, features)


def on_same_days(identity: DataFrame, first: date, last: date) -> DataFrame:
    """Identity rows of a range of days: a stored identity row carries the date of its transaction, so none is missed."""
    return between_days(identity, first, last) if "transaction_date" in identity.columns else identity


def day_rows(tx: DataFrame, identity: DataFrame, day: date) -> DataFrame:
    """Keys and features of one day."""
    return _keyed(on_day(tx, day), on_same_days(identity, day, day), None)
