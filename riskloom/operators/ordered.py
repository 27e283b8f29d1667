"""Order-dependent results without a window over the whole table.

``running_totals`` gives exact prefix sums over any number of distinct values. The values are dealt into ranges that
follow the data (range partitioning, which samples them) and stored together with the number of their range, so that a
recomputed task cannot see other ranges. Sums of ranges give the offsets; a window never holds more than one range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.lineage import materialized

_RANGE = "_range"


def in_ranges(cells: DataFrame, group: Sequence[str], by: Column) -> DataFrame:
    """The rows with the number of their range, stored. Ranges are non-decreasing in (group, order) and even in size."""
    dealt = cells.repartitionByRange(*[F.col(g) for g in group], by)
    return materialized(dealt.withColumn(_RANGE, F.spark_partition_id()))


def running_totals(
    cells: DataFrame,
    order: str,
    weights: Sequence[str],
    group: Sequence[str] = (),
    descending: bool = False,
) -> DataFrame:
    """Add ``before_<w>``: the sum of ``w`` over the rows of the group that come earlier in the order.

    Order values are unique in a group, as a groupBy gives them; combining ties beforehand also removes skew. NULL and
    NaN order values are not allowed. The window over ranges sees one row for each range of a group, at most as many as
    there are partitions.
    """
    by = -F.col(order).cast("double") if descending else F.col(order)
    ranged = in_ranges(cells, group, by)
    keys = [*group, _RANGE]
    earlier = (Window.unboundedPreceding, -1)

    def prior(column: str, window) -> Column:
        return F.coalesce(F.sum(column).over(window.rowsBetween(*earlier)), F.lit(0))

    totals = ranged.groupBy(*keys).agg(*[F.sum(w).alias(f"_t_{w}") for w in weights])
    over_ranges = Window.partitionBy(*(group or [F.lit(0)])).orderBy(_RANGE)
    offsets = totals.select(*keys, *[prior(f"_t_{w}", over_ranges).alias(f"_o_{w}") for w in weights])
    # Join keys and window keys are the same, so one shuffle serves both.
    inside = Window.partitionBy(*keys).orderBy(by)
    return ranged.join(offsets, keys).select(
        *cells.columns, *[(F.col(f"_o_{w}") + prior(w, inside)).alias(f"before_{w}") for w in weights]
    )


def tile_number(rank: Column, rows: Column, tiles: int) -> Column:
    """Tile 1..tiles of a 1-based rank; the first ``rows % tiles`` tiles hold one row more."""
    size = F.floor(rows / tiles)
    larger = rows % tiles
    in_larger = larger * (size + 1)
    zero_based = rank - 1
    return (
        F.when(zero_based < in_larger, F.floor(zero_based / (size + 1)))
        .otherwise(larger + F.floor(F.try_divide(zero_based - in_larger, size)))
        .cast("int")
        + 1
    )


def tile_summary(rows: DataFrame, feature: str, value: str, row_id: str, label: str, tiles: int) -> DataFrame:
    """Exact ntile per feature, summarised: (feature, tile, n, labelled, positives, value_min, value_max).

    Rows are ordered by (value, row_id); rows with a NULL value form tile 0. ``rows`` is long: one row per feature and
    record, ``row_id`` a whole number.

    Rows are not ranked one by one. Equal values are combined first, and a value whose ranks fall into one tile is
    done. At most ``tiles - 1`` values per feature straddle a boundary; only their rows are read again and split by id.
    """
    sums = [
        F.count(F.lit(1)).alias("n"),
        F.count(label).alias("labelled"),
        F.count_if(F.col(label) == 1).alias("positives"),
    ]
    by_value = materialized(rows.groupBy(feature, value).agg(*sums))
    known = by_value.where(F.col(value).isNotNull())
    # One row per feature name.
    sizes = F.broadcast(known.groupBy(feature).agg(F.sum("n").alias("_rows")))
    # Stored, because the boundaries are looked up before the rest of the plan can be built.
    values = materialized(
        _placed(running_totals(known, value, ["n"], [feature]).join(sizes, feature), "before_n", tiles)
    )

    out = [feature, F.col("_first").alias("tile"), value, "n", "labelled", "positives"]
    nulls = by_value.where(F.col(value).isNull()).withColumn("_first", F.lit(0))
    parts = values.where(F.col("_first") == F.col("_last")).select(*out).unionByName(nulls.select(*out))

    # At most (tiles - 1) rows per feature: the tile boundaries.
    straddling = values.where(F.col("_first") != F.col("_last")).select(
        feature, value, "_rows", F.col("before_n").alias("_start")
    )
    cut_values = straddling.collect()
    if cut_values:
        local = rows.sparkSession.createDataFrame(cut_values, straddling.schema)
        tied = rows.join(F.broadcast(local), [feature, value])
        parts = parts.unionByName(_split_ties(tied, [feature, value], row_id, sums, tiles).select(*out))
    return parts.groupBy(feature, "tile").agg(
        *[F.sum(c).alias(c) for c in ("n", "labelled", "positives")],
        F.min(value).alias("value_min"),
        F.max(value).alias("value_max"),
    )


def _placed(df: DataFrame, before: str, tiles: int) -> DataFrame:
    """Tiles of the first and the last row of a cell of ``n`` rows."""
    start, rows = F.col(before), F.col("_rows")
    return df.withColumns(
        {
            "_first": tile_number(start + 1, rows, tiles),
            "_last": tile_number(start + F.col("n"), rows, tiles),
        }
    )


def _split_ties(tied: DataFrame, keys: list[str], row_id: str, sums: list[Column], tiles: int) -> DataFrame:
    """Tiles inside the values that straddle a boundary, by row id.

    Such a value may be held by a third of all rows, so its rows are ranked by prefix sums as well.
    """
    ranked = running_totals(tied.withColumn("_one", F.lit(1)), row_id, ["_one"], keys)
    rank = F.col("_start") + F.col("before__one") + 1
    return ranked.withColumn("_first", tile_number(rank, F.col("_rows"), tiles)).groupBy(*keys, "_first").agg(*sums)


def ranking_metrics(
    scored: DataFrame, score: str = "score", label: str = "is_fraud", group: Sequence[str] = ()
) -> DataFrame:
    """Average precision and ROC AUC over labelled rows; rows with equal scores count as one step.

    One row per group. Scores are combined first, so a score that many rows share is one cell. The cells are stored:
    three branches of the prefix sums read them, and what lies before them (often a join) runs once.
    """
    cells = materialized(
        scored.where(F.col(label).isNotNull())
        .groupBy(*group, score)
        .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))
    )
    steps = running_totals(cells, score, ["pos", "neg"], group, descending=True)
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    hits = F.col("before_pos") + pos
    seen = hits + F.col("before_neg") + neg
    n_pos, n_neg = F.sum("pos"), F.sum("neg")
    return steps.groupBy(*group).agg(
        (n_pos + n_neg).alias("row_count"),
        n_pos.alias("fraud_count"),
        F.try_divide(F.sum(pos * hits / seen), n_pos).alias("pr_auc"),
        F.try_divide(F.sum(neg * (F.col("before_pos") + pos / 2)), n_pos.cast("double") * n_neg).alias("roc_auc"),
    )
