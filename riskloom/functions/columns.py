"""Scalar expressions shared by marts, data sets and scoring."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskloom.params import SECONDS_PER_DAY, SECONDS_PER_HOUR

# Lower edges of the amount bins, the last one open, and their labels.
AMOUNT_EDGES = (0.0, 25.0, 50.0, 100.0, 250.0, 500.0)
AMOUNT_LABELS = ("<25", "25-50", "50-100", "100-250", "250-500", "500+")

# Spellings of one mail service, matched on the whole value.
DOMAIN_ALIASES = {
    "gmail": "gmail.com",
    "yahoo.co.jp": "yahoo.com",
    "yahoo.co.uk": "yahoo.com",
    "yahoo.com.mx": "yahoo.com",
    "yahoo.de": "yahoo.com",
    "yahoo.es": "yahoo.com",
    "yahoo.fr": "yahoo.com",
    "hotmail.co.uk": "hotmail.com",
    "hotmail.de": "hotmail.com",
    "hotmail.es": "hotmail.com",
    "hotmail.fr": "hotmail.com",
    "live.com.mx": "live.com",
    "outlook.es": "outlook.com",
}

# Fixed values.
MISSING = "(missing)"
OTHER = "other"


def as_column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def row_count() -> Column:
    return F.count(F.lit(1))


def day_index(seconds: str | Column) -> Column:
    """Whole days since the origin."""
    return F.floor(as_column(seconds) / SECONDS_PER_DAY)


def transaction_date(seconds: str | Column, origin: date) -> Column:
    """Calendar date of a seconds offset."""
    return F.date_add(F.lit(origin), day_index(seconds).cast("int"))


def hour_of_day(seconds: str | Column) -> Column:
    """Hour 0..23; position inside the day does not depend on the origin."""
    return F.floor(as_column(seconds) / SECONDS_PER_HOUR) % 24


def ratio_or_null(numerator: str | Column, denominator: str | Column) -> Column:
    """Quotient, NULL where the denominator is 0 or NULL."""
    return F.try_divide(as_column(numerator), as_column(denominator))


def ratio_or_zero(numerator: str | Column, denominator: str | Column) -> Column:
    """Quotient, 0.0 where it is undefined."""
    return F.coalesce(ratio_or_null(numerator, denominator), F.lit(0.0))


def ml_split(source_split: str | Column, day: str | Column, valid_start: date) -> Column:
    """Time split; rows of the unlabelled source never become train or valid."""
    return (
        F.when(as_column(source_split) == "test", "test")
        .when(as_column(day) >= F.lit(valid_start), "valid")
        .otherwise("train")
    )


def high_low(value: str | Column, limit: float) -> Column:
    """Two bands, the limit itself is high; an unknown value is low."""
    return F.when(as_column(value) >= limit, "high").otherwise("low")


def amount_band(amount: str | Column) -> Column:
    """Six left-closed amount bins; values outside all of them, and NULL, are their own category."""
    c = as_column(amount).cast("double")
    band = F.lit(MISSING)
    # The last edge wraps all others, so the highest bin is tested first and no upper edges are needed.
    for lower, label in zip(AMOUNT_EDGES, AMOUNT_LABELS):
        band = F.when(c >= lower, label).otherwise(band)
    # Spark sorts NaN above every number, and infinity is outside the last, right-open bin.
    return F.when(F.isnan(c) | (c == float("inf")), MISSING).otherwise(band)


def canonical_domain(domain: str | Column) -> Column:
    """Replace an alias by its service name; other values are unchanged."""
    c = as_column(domain)
    by_service: dict[str, list[str]] = {}
    for alias, service in DOMAIN_ALIASES.items():
        by_service.setdefault(service, []).append(alias)
    out = c
    for service, aliases in by_service.items():
        out = F.when(c.isin(aliases), service).otherwise(out)
    return out


def keep_or_other(domain: str | Column, keep: list[str]) -> Column:
    """Values outside the keep list become ``other``; NULL becomes ``(missing)``."""
    c = as_column(domain)
    return F.when(c.isNull(), MISSING).when(c.isin(list(keep)), c).otherwise(OTHER)


def column_family(name: str | Column) -> Column:
    """Family of a feature from its name prefix."""
    c = as_column(name)
    return (
        F.when(c.startswith("V"), "V")
        .when(c.startswith("C"), "C")
        .when(c.startswith("D"), "D")
        .when(c.startswith("M"), "M")
        .when(c.startswith("id_"), "id_")
        .otherwise("named")
    )
