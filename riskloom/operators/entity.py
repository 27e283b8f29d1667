"""How a column moves from one transaction of a card to the next."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.columns import day_index, ratio_or_null
from riskloom.operators.ordered import _RANGE, in_ranges


def with_predecessor(rows: DataFrame, card: str, order: str) -> DataFrame:
    """Every row with ``before``, the row of the same card that comes before it; NULL for the first one.

    One card may hold a large part of all rows, at one and the same time, so no window holds a card. Rows are dealt into
    ranges of (card, order), which are even in size whatever the cards are; inside a range the predecessor is the row
    before, and the first row of a range gets the last one of the range before it, one row a range.
    """
    row = F.struct(card, order)
    ranged = in_ranges(rows, [card], F.col(order))
    inside = Window.partitionBy(_RANGE).orderBy(card, order)
    marked = ranged.withColumn("_before", F.lag(row).over(inside))
    ends = ranged.groupBy(_RANGE).agg(F.max(row).alias("_last"))
    # At most as many rows as there are partitions.
    carried = ends.select(_RANGE, F.lag("_last").over(Window.orderBy(_RANGE)).alias("_carried"))
    met = marked.join(F.broadcast(carried), _RANGE).withColumn("_before", F.coalesce("_before", "_carried"))
    same = F.col(f"_before.{card}") == F.col(card)
    return met.select(*rows.columns, F.when(same, F.col(f"_before.{order}")).alias("before"))


def entity_monotonicity(
    tx: DataFrame, keys: Sequence[str], columns: Sequence[str], at: str = "transaction_dt", row_id: str = "transaction_id"
) -> DataFrame:
    """Per column: steps, and the shares that do not fall, stay equal, or grow by exactly the elapsed days.

    A step is a row and its predecessor on the same card, ordered by (at, row_id), with the column known on both. Rows
    without a complete card key belong to no card.
    """
    rows = tx.dropna(subset=list(keys)).select(
        F.struct(*[F.col(k) for k in keys]).alias("card"),
        F.struct(
            F.col(at).alias("at"), F.col(row_id).alias("id"), *[F.col(c).cast("double").alias(c) for c in columns]
        ).alias("c"),
    )
    steps = with_predecessor(rows, "card", "c").select("c", F.col("before").alias("p"))
    elapsed = day_index("c.at") - day_index("p.at")
    counts = []
    for c in columns:
        change = F.col(f"c.{c}") - F.col(f"p.{c}")
        tests = {"steps": change.isNotNull(), "not_falling": change >= 0, "unchanged": change == 0, "as_elapsed": change == elapsed}
        counts += [F.count_if(t).alias(f"{c} {n}") for n, t in tests.items()]
    wide = steps.agg(*counts)
    names = ("steps", "not_falling", "unchanged", "as_elapsed")
    table = wide.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), *[F.col(f"`{c} {n}`").alias(n) for n in names]) for c in columns])))
    return table.where("steps > 0").withColumns({f"{n}_share": ratio_or_null(n, "steps") for n in names[1:]})
