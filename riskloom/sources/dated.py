"""Dated Parquet tables: ``<root>/<data set>/dt=YYYY-MM-DD/*.parquet``.

The date is stored twice: as the directory ``dt``, which filters prune on, and as the ordinary key column in the file.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from riskloom.sources import contracts as C

DT = "dt"


def table_path(root: str, dataset: str) -> str:
    return f"{root.rstrip('/')}/{dataset}"


def day_path(root: str, dataset: str, day: date) -> str:
    return f"{table_path(root, dataset)}/{DT}={day:%Y-%m-%d}"


def laid_out(df: DataFrame, clustering: tuple[str, ...] = ()) -> DataFrame:
    """Add ``dt`` and arrange rows for the write.

    The rebalance hint groups rows by day and lets AQE cut a heavy day into several files of the advisory size and
    merge light ones; a plain repartition by day would put the heaviest day into one task. The sort inside a task gives
    each file the clustering order, so row-group statistics prune.
    """
    dated = df.withColumn(DT, F.col(C.PARTITION_KEY))
    keys = [c for c in clustering if c in df.columns]
    return dated.hint("rebalance", F.col(DT)).sortWithinPartitions(DT, *keys)


def write_days(df: DataFrame, root: str, dataset: str, schema: T.StructType | None = None) -> None:
    """Replace every day present in ``df``, in one job; other days stay. Rows without a date are refused."""
    checked = C.gate(df, schema) if schema is not None else df
    # The check rides on the write itself: a NULL date fails its task instead of landing in a default directory.
    guarded = checked.withColumn(
        C.PARTITION_KEY,
        F.coalesce(C.PARTITION_KEY, F.raise_error(F.lit("row without a partition date")).cast("date")),
    )
    arranged = laid_out(guarded, C.CLUSTERING.get(dataset, ()))
    writer = arranged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "snappy")
    writer.partitionBy(DT).parquet(table_path(root, dataset))


def write_all(df: DataFrame, root: str, dataset: str) -> None:
    """Replace the whole table: days that are not in ``df`` disappear."""
    writer = laid_out(df).write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer.partitionBy(DT).parquet(table_path(root, dataset))


def replace_day(df: DataFrame, root: str, dataset: str, day: date, schema: T.StructType | None = None) -> None:
    """Replace exactly one day; the same call again changes nothing. Rows of other days, or of none, are refused.

    The frame runs once: the test rides on the write and fails its task. It overwrites the day's own directory, so an
    empty frame clears the day, and a refused write leaves it as it was.
    """
    checked = C.gate(df, schema) if schema is not None else df
    key = F.col(C.PARTITION_KEY)
    refusal = F.raise_error(F.lit(f"rows of other days in the replacement of {day}")).cast("date")
    guarded = checked.withColumn(C.PARTITION_KEY, F.when(key == F.lit(day), key).otherwise(refusal))
    keys = [c for c in C.CLUSTERING.get(dataset, ()) if c in guarded.columns]
    arranged = guarded.hint("rebalance").sortWithinPartitions(*keys) if keys else guarded.hint("rebalance")
    arranged.write.mode("overwrite").option("compression", "snappy").parquet(day_path(root, dataset, day))


def read_table(spark: SparkSession, root: str, dataset: str, schema: T.StructType | None = None) -> DataFrame:
    """The whole table, with ``dt``. With a schema a table that was never written reads as empty."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(T.StructType(list(schema.fields)).add(DT, T.DateType()))
    try:
        return reader.parquet(table_path(root, dataset))
    except AnalysisException as e:
        if schema is None or e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], T.StructType(list(schema.fields)).add(DT, T.DateType()))


def on_day(table: DataFrame, day: date) -> DataFrame:
    """Rows of one day; a day without data is an empty frame. Filters the directory column where there is one."""
    column = DT if DT in table.columns else C.PARTITION_KEY
    return table.where(F.col(column) == F.lit(day)).drop(DT)


def between_days(table: DataFrame, first: date, last: date) -> DataFrame:
    """Rows of a range of days, both ends included."""
    column = DT if DT in table.columns else C.PARTITION_KEY
    return table.where(F.col(column).between(F.lit(first), F.lit(last))).drop(DT)


def present_days(table: DataFrame) -> DataFrame:
    """One row per day that holds rows."""
    column = DT if DT in table.columns else C.PARTITION_KEY
    return table.select(F.col(column).alias("day")).distinct()


def has_day(table: DataFrame, day: date) -> bool:
    return on_day(table, day).limit(1).count() > 0


def rows_per_day(table: DataFrame) -> DataFrame:
    """Rows of each day: what a load of all days reports."""
    column = DT if DT in table.columns else C.PARTITION_KEY
    return table.groupBy(F.col(column).alias("day")).agg(F.count(F.lit(1)).alias("row_count"))


def load_totals(table: DataFrame) -> DataFrame:
    """One row: days and rows; both 0 for an empty source."""
    return rows_per_day(table).agg(
        F.count(F.lit(1)).alias("day_count"), F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count")
    )


def describe(table: DataFrame) -> DataFrame:
    """One row: rows, days, first and last day, latest load.

    Grouped by day first, so the distinct count is a count over one row per day.
    """
    by_day = table.groupBy(C.PARTITION_KEY).agg(
        F.count(F.lit(1)).alias("n"), F.max(C.INGESTED_AT).alias("latest")
    )
    return by_day.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.count(C.PARTITION_KEY).alias("partition_count"),
        F.min(C.PARTITION_KEY).alias("first_date"),
        F.max(C.PARTITION_KEY).alias("last_date"),
        F.max("latest").alias("last_ingested"),
    )


def gap_report(table: DataFrame, first: date, last: date) -> DataFrame:
    """Every day of a range with its rows and whether a backfill loads or skips it."""
    spark = table.sparkSession
    days = spark.range(1).select(F.explode(F.sequence(F.lit(first), F.lit(last))).alias("day"))
    loaded = rows_per_day(table)
    return days.join(loaded, "day", "left").select(
        "day",
        F.coalesce("row_count", F.lit(0)).alias("row_count"),
        F.when(F.col("row_count").isNull(), "skip").otherwise("load").alias("action"),
    )
