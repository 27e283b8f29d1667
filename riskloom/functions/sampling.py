"""Samples of an exact size that are the same on every run and layout."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_by_hash(
    df: DataFrame, keys: Sequence[str], rows: int, ties: Sequence[str] = (), seed: int | None = 42
) -> DataFrame:
    """The ``rows`` rows with the smallest hashes of ``keys``; equal hashes in the order of ``ties``.

    A count tells below which hash they lie, but for a chance of one in many millions, so that tasks pass on hardly more
    rows than are wanted, all together. Should they be too few, everything is ordered.
    """
    n = df.count()
    hashed = F.xxhash64(*[F.col(k) for k in keys], *([] if seed is None else [F.lit(seed)]))
    order = [hashed, *[F.col(t) for t in (ties or keys)]]
    if n > 2 * rows:
        # More than six standard deviations above the mean of the number below the bound.
        share = (rows + 6 * math.sqrt(rows) + 40) / n
        below = df.where(hashed < F.lit(int(-(2**63) + share * 2**64)))
        if below.count() >= rows:
            return below.orderBy(*order).limit(rows)
    return df.orderBy(*order).limit(rows)
