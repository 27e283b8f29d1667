"""Pieces of SQL text for wide projections.

Each Column operation is a call into the JVM; a table of hundreds of columns is built faster from one text per column.
"""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F


def name(column: str) -> str:
    """A column name in SQL text."""
    return "`" + column.replace("`", "``") + "`"


def literal(value: str | float) -> str:
    """A text or number in SQL text."""
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"{value!r}D" if isinstance(value, float) else str(value)


def numbers(values) -> Column:
    """A constant array of doubles."""
    return F.expr(f"array({', '.join(literal(float(v)) for v in values)})")


def lookup(mapping: dict[str, str], key: str | Column) -> Column:
    """A constant map from text to text, applied to a column."""
    table = F.from_json(F.lit(json.dumps(mapping)), "map<string,string>")
    return table[F.col(key) if isinstance(key, str) else key]
