"""Derived features. Training and scoring call the same functions."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from enum import StrEnum

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions import columns as X
from riskloom.functions.lineage import materialized
from riskloom.params import Params

logger = logging.getLogger(__name__)


class FeatureSet(StrEnum):
    CURATED = "curated"  # features whose meaning is known
    ALL = "all"  # the anonymous columns as well


# Fixed values.
DOMAIN_COLUMNS = ("purchaser_email_domain", "recipient_email_domain")
CURATED_COLUMNS = ("transaction_amt", "product_cd", "card4", "card6", *DOMAIN_COLUMNS)

Domains = Mapping[str, list[str] | DataFrame]


def frequent_domains(df: DataFrame, columns: Sequence[str], min_count: int) -> DataFrame:
    """(column, domain, n): services with at least ``min_count`` rows, for all domain columns in one scan."""
    return (
        df.unpivot([], [F.col(c) for c in columns], "column", "domain")
        .groupBy("column", X.canonical_domain("domain").alias("domain"))
        .agg(X.row_count().alias("n"))
        .where((F.col("n") >= min_count) & F.col("domain").isNotNull())
    )


def fit_domains(df: DataFrame, params: Params) -> dict[str, DataFrame]:
    """Kept domains per column, to be fitted on the training split only and reused afterwards.

    They are counted once and stored; every later use joins the stored table.
    """
    columns = [c for c in DOMAIN_COLUMNS if c in df.columns]
    if not columns:
        return {}
    kept = materialized(frequent_domains(df, columns, params.domain_min_count).select("column", "domain"))
    return {c: kept.where(F.col("column") == c).select("domain") for c in columns}


def normalize_domain(df: DataFrame, column: str, keep: list[str] | DataFrame) -> DataFrame:
    """Aliases to services, services outside the keep list to ``other``, NULL to ``(missing)``.

    ``keep`` is a fitted table, or a list that the caller wrote down.
    """
    service = X.canonical_domain(column)
    if not isinstance(keep, DataFrame):
        return df.withColumn(column, X.keep_or_other(service, keep))
    known = keep.select(F.col("domain").alias(column), F.lit(True).alias("_kept"))
    joined = df.withColumn(column, service).join(known, column, "left")
    final = F.when(F.col(column).isNull(), X.MISSING).when(F.col("_kept"), F.col(column)).otherwise(X.OTHER)
    return joined.withColumn(column, final).drop("_kept").select(*df.columns)


def unexpected_columns(df: DataFrame) -> dict[str, str]:
    """Columns that are neither numbers, flags nor text, with their types: as categories they lose their order."""
    ready = (T.NumericType, T.BooleanType, T.StringType)
    return {f.name: f.dataType.simpleString() for f in df.schema if not isinstance(f.dataType, ready)}


def categorical_fill(df: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Every column that is not a number or a flag becomes text with ``(missing)`` for NULL; ``keys`` stay as they are."""
    unexpected = unexpected_columns(df.drop(*keys))
    if unexpected:
        logger.warning("columns turned into categories, a derived feature may be needed: %s", unexpected)
    text = {
        f.name: F.coalesce(F.col(f.name).cast("string"), F.lit(X.MISSING))
        for f in df.schema
        if f.name not in keys and not isinstance(f.dataType, (T.NumericType, T.BooleanType))
    }
    return df.withColumns(text)


def build(df: DataFrame, params: Params, domains: Domains | None = None, keys: tuple[str, ...] = ()) -> DataFrame:
    """Amount band, normalised domains and filled categories; ``keys`` are carried along untouched.

    Without ``domains`` the keep lists come from this very data, which is right for training data only.
    """
    given = {} if domains is None else domains
    out = df
    if "transaction_amt" in df.columns:
        out = out.withColumn("amount_band", X.amount_band("transaction_amt"))
    for column in DOMAIN_COLUMNS:
        if column in df.columns:
            keep = given[column] if column in given else fit_domains(df.select(column), params)[column]
            out = normalize_domain(out, column, keep)
    return categorical_fill(out, keys)
