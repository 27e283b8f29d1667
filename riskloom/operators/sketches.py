"""Mergeable summaries, kept per day, so that a range of days needs no row again: quantiles of scores, sets of keys, and
what two tables have in common."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions import columns as X
from riskloom.functions import text
from riskloom.sources.contracts import underscored

#: Size of a quantile sketch, and the share of rows by which the rank of its quantiles may be off (99 % of the time less
#: than half of that).
QUANTILE_SIZE, RANK_ERROR = 2000, 0.005
PROBABILITIES = (0.5, 0.9, 0.99)
#: Binary logarithm of the values that a set sketch holds; with half as many distinct values its counts are exact.
SET_SIZE_LOG2 = 12
EXACT_SET = 1 << (SET_SIZE_LOG2 - 1)


# Quantiles


def score_sketches(predictions: DataFrame) -> DataFrame:
    """(transaction_date, model, scored_count, scores): one sketch of all scores a day and model, to be stored."""
    return predictions.groupBy("transaction_date", "model").agg(
        X.row_count().alias("scored_count"), F.kll_sketch_agg_double(F.col("score"), F.lit(QUANTILE_SIZE)).alias("scores")
    )


def trailing_quantiles(sketches: DataFrame, days: int, probabilities: Sequence[float] = PROBABILITIES) -> DataFrame:
    """Quantiles over the ``days`` days that end with each day, by merging the days' sketches. No score is read."""
    ends = sketches.select(F.col("transaction_date").alias("_end"), "model")
    inside = F.col("transaction_date").between(F.date_sub("_end", days - 1), F.col("_end"))
    merged = (
        ends.join(sketches, "model")
        .where(inside)
        .groupBy(F.col("_end").alias("transaction_date"), "model")
        .agg(
            F.sum("scored_count").alias("scored_count"),
            F.kll_merge_agg_double(F.col("scores"), F.lit(QUANTILE_SIZE)).alias("_scores"),
        )
    )
    found = [F.kll_sketch_get_quantile_double("_scores", F.lit(float(p))).alias(f"score_p{round(100 * p)}") for p in probabilities]
    return merged.select("transaction_date", "model", "scored_count", *found)


def rank_bounds(quantiles: DataFrame, predictions: DataFrame, days: int, probabilities: Sequence[float] = PROBABILITIES) -> DataFrame:
    """Whether each quantile of ``trailing_quantiles`` lies where it should, from the scores themselves.

    Equal scores have a range of ranks; one of them has to be within RANK_ERROR.
    """
    named = [f"score_p{round(100 * p)}" for p in probabilities]
    ranges = quantiles.select(F.col("transaction_date").alias("_end"), "model", "scored_count", *named)
    reach = F.explode(F.sequence(F.col("transaction_date"), F.date_add("transaction_date", days - 1)))
    counts = predictions.groupBy("transaction_date", "model", "score").agg(X.row_count().alias("n"))
    rows = counts.select(reach.alias("_end"), "model", "score", "n").join(ranges, ["_end", "model"])
    inside = []
    for p, c in zip(probabilities, named):
        below = F.sum(F.when(F.col("score") < F.col(c), F.col("n")).otherwise(0)) / F.first("scored_count")
        upto = F.sum(F.when(F.col("score") <= F.col(c), F.col("n")).otherwise(0)) / F.first("scored_count")
        inside.append(((below <= p + RANK_ERROR) & (upto >= p - RANK_ERROR)).alias(f"{c}_holds"))
    return rows.groupBy(F.col("_end").alias("transaction_date"), "model").agg(F.first("scored_count").alias("scored_count"), *inside)


# Sets of whole-number keys


def key_bitmaps(df: DataFrame, key: str, by: Sequence[str] = ()) -> DataFrame:
    """(by, bucket, row_count, bits): one bit a key, 4 KB for 32,768 neighbouring keys, whatever the number of rows.

    For keys that lie close together, as running numbers do. NULL keys do not count. Rows of a task are combined before the
    shuffle, so a key with a third of the rows weighs nothing.
    """
    known = df.where(F.col(key).isNotNull()).withColumn("_key", F.col(key).cast("long"))
    return known.groupBy(*by, F.bitmap_bucket_number("_key").alias("bucket")).agg(
        X.row_count().alias("row_count"), F.bitmap_construct_agg(F.bitmap_bit_position("_key")).alias("bits")
    )


def merged_bitmaps(bitmaps: DataFrame) -> DataFrame:
    """The bitmaps of several days as one."""
    return bitmaps.groupBy("bucket").agg(F.sum("row_count").alias("row_count"), F.bitmap_or_agg("bits").alias("bits"))


def key_counts(bitmaps: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, row_count, key_count, is_unique) of bitmaps of one set, or of each of several."""
    keys = F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0))
    rows = F.coalesce(F.sum("row_count"), F.lit(0))
    return bitmaps.groupBy(*by).agg(rows.alias("row_count"), keys.alias("key_count"), (rows == keys).alias("is_unique"))


def bitmap_integrity(child: DataFrame, parent: DataFrame) -> DataFrame:
    """One row from the bitmaps of two tables: rows and keys of each, keys in both, child keys without a parent."""
    sides = [merged_bitmaps(b).withColumn("_side", F.lit(k)) for k, b in enumerate((child, parent))]
    of = lambda k, c: F.sum(F.when(F.col("_side") == k, c).otherwise(0))
    stacked = sides[0].unionByName(sides[1])
    buckets = stacked.groupBy("bucket").agg(
        *[of(k, F.col("row_count")).alias(f"_rows{k}") for k in (0, 1)],
        *[of(k, F.bitmap_count("bits")).alias(f"_keys{k}") for k in (0, 1)],
        F.when(F.count(F.lit(1)) == 2, F.bitmap_count(F.bitmap_and_agg("bits"))).otherwise(0).alias("_both"),
    )
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return buckets.agg(
        total("_rows0").alias("child_rows"),
        total("_keys0").alias("child_keys"),
        total("_rows1").alias("parent_rows"),
        total("_keys1").alias("parent_keys"),
        total("_both").alias("matched_keys"),
        (total("_keys0") - total("_both")).alias("orphan_keys"),
    )


# Content of two tables


def _comparable(column: str, kind: T.DataType) -> Column:
    """Values in a form in which equal ones of different types are equal."""
    c = F.col(text.name(column))
    if isinstance(kind, T.NumericType):
        return F.nanvl(c.cast("double"), F.lit(None).cast("double"))
    return c.cast("string")


def _summaries(df: DataFrame, columns: Sequence[str], side: str) -> DataFrame:
    """(column, rows, nulls, set) of columns in one scan, one row each."""
    kinds = {f.name: f.dataType for f in df.schema}
    values = {f"v{i}": _comparable(c, kinds[c]) for i, c in enumerate(columns)}
    prepared = df.select(*[v.alias(n) for n, v in values.items()])
    wide = prepared.agg(
        X.row_count().alias("_rows"),
        *[F.count(n).alias(f"{n}_known") for n in values],
        *[F.theta_sketch_agg(n, SET_SIZE_LOG2).alias(f"{n}_set") for n in values],
    )
    rows = [
        F.struct(
            F.lit(c).alias(f"{side}_column"), F.col("_rows").alias(f"{side}_rows"),
            (F.col("_rows") - F.col(f"{n}_known")).alias(f"{side}_nulls"), F.col(f"{n}_set").alias(f"{side}_set"),
        )
        for n, c in zip(values, columns)
    ]
    return wide.select(F.inline(F.array(*rows)))


def compare_tables(left: DataFrame, right: DataFrame) -> DataFrame:
    """For columns that both tables have, by normalised name: NULLs, distinct values, and how many values are common.

    One scan of each table. Counts of values come from set sketches: exact up to EXACT_SET distinct values, estimates above.
    """
    names = {underscored(c): c for c in right.columns}
    pairs = {c: names[underscored(c)] for c in left.columns if underscored(c) in names}
    if not pairs:
        none = "left_column string, right_column string, left_rows long, right_rows long, left_nulls long, right_nulls long"
        return left.sparkSession.createDataFrame([], f"{none}, left_distinct long, right_distinct long, common_distinct long, similarity double")
    sides = _summaries(left, list(pairs), "left").withColumn("right_column", text.lookup(pairs, "left_column"))
    both = sides.join(_summaries(right, list(pairs.values()), "right"), "right_column")
    count = F.theta_sketch_estimate
    common = count(F.theta_intersection("left_set", "right_set"))
    return both.select(
        "left_column",
        "right_column",
        "left_rows",
        "right_rows",
        "left_nulls",
        "right_nulls",
        count("left_set").alias("left_distinct"),
        count("right_set").alias("right_distinct"),
        common.alias("common_distinct"),
        F.try_divide(common.cast("double"), count(F.theta_union("left_set", "right_set"))).alias("similarity"),
    )


def key_difference(left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> DataFrame:
    """One row: distinct keys of the left side only, of the right side only, and of both. Exact, for keys of any type."""
    stacked = left.select(F.col(left_key).alias("_key"), F.lit(1).alias("_side")).unionByName(
        right.select(F.col(right_key).alias("_key"), F.lit(2).alias("_side"))
    )
    keys = stacked.where(F.col("_key").isNotNull()).groupBy("_key").agg(F.bit_or("_side").alias("_sides"))
    return keys.agg(
        F.count_if(F.col("_sides") == 1).alias("left_only"),
        F.count_if(F.col("_sides") == 2).alias("right_only"),
        F.count_if(F.col("_sides") == 3).alias("in_both"),
    )
