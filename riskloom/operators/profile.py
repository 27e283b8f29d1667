"""Profiles of unknown data: daily volume, nulls, types worth choosing, joins and schemas."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions import columns as X
from riskloom.functions import text
from riskloom.sources.contracts import underscored

# Fixed values.
CATEGORY_MAX_VALUES = 30
FLAG_VALUES = ("F", "T")
INT32_MIN, INT32_MAX = -2_147_483_648, 2_147_483_647
FLOAT32_SAFE_MAX = 3.0e38
MOSTLY_NULL = 0.9


def daily_profile(tx: DataFrame, day: str, row_id: str, label: str, amount: str) -> DataFrame:
    """Volume, fraud and amount per day."""
    return tx.groupBy(F.col(day).alias("day")).agg(
        F.count(row_id).alias("tx_count"),
        F.sum(label).alias("fraud_count"),
        F.avg(label).alias("fraud_rate"),
        F.sum(amount).alias("amt_sum"),
    )


def daily_profile_summary(daily: DataFrame) -> DataFrame:
    """Minimum, median and maximum over the days of a daily profile, and the span they cover."""

    def spread(column: str) -> list[Column]:
        return [
            F.min(column).alias(f"{column}_min"),
            F.median(column).alias(f"{column}_median"),
            F.max(column).alias(f"{column}_max"),
        ]

    return daily.agg(
        X.row_count().alias("day_count"),
        F.min("day").alias("first_day"),
        F.max("day").alias("last_day"),
        F.date_diff(F.max("day"), F.min("day")).alias("span_days"),
        F.sum("tx_count").alias("tx_total"),
        *spread("tx_count"),
        *spread("fraud_rate"),
    )


def null_profile(df: DataFrame) -> DataFrame:
    """Null share and type of every column, all rows, in one aggregation whose only row is then turned on its side."""
    names = {c: text.name(c) for c in df.columns}
    shares = df.agg(*[F.expr(f"count_if({n} IS NULL) / count(1) AS {n}") for n in names.values()])
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    return shares.unpivot([], list(names.values()), "column", "null_ratio").select(
        "column", text.lookup(types, "column").alias("dtype"), "null_ratio"
    )


def null_summary(profile: DataFrame) -> DataFrame:
    """Columns in all, mostly empty ones and complete ones."""
    return profile.agg(
        X.row_count().alias("column_count"),
        F.count_if(F.col("null_ratio") > MOSTLY_NULL).alias("mostly_null"),
        F.count_if(F.col("null_ratio") == 0).alias("complete"),
    )


def type_counts(profile: DataFrame) -> DataFrame:
    return profile.groupBy("dtype").agg(X.row_count().alias("column_count"))


def _sql_type(kind: T.DataType) -> str:
    """The type in which values of a column are told apart."""
    if isinstance(kind, T.IntegralType):
        return "BIGINT"
    return "DOUBLE" if isinstance(kind, (T.DoubleType, T.FloatType)) else "STRING"


def _typed(column: str, kind: T.DataType) -> str:
    """A column in the type in which its values are told apart. NaN is no value; grouping folds negative zero into zero."""
    n, sql_type = text.name(column), _sql_type(kind)
    known = f"nanvl({n}, CAST(NULL AS DOUBLE))" if sql_type == "DOUBLE" else n
    return f"CAST({known} AS {sql_type})"


def _value_counts(df: DataFrame, columns: list[str], sql_type: str) -> DataFrame:
    """(column, value, n): every distinct value of columns of one type, NULL included, from one scan of them.

    A value that a third of the rows share is combined before the shuffle.
    """

    kinds = {f.name: f.dataType for f in df.schema}
    return (
        df.selectExpr(*[f"CAST({_typed(c, kinds[c])} AS {sql_type}) AS {text.name(c)}" for c in columns])
        .unpivot([], [text.name(c) for c in columns], "column", "value")
        .groupBy("column", "value")
        .agg(X.row_count().alias("n"))
    )


def _value_stats(counts: DataFrame, is_number: Column) -> DataFrame:
    """One row per column from its distinct values."""
    number = F.when(is_number, F.col("value").cast("double"))
    return counts.groupBy("column").agg(
        F.sum("n").alias("_rows"),
        F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("_nulls"),
        F.count("value").alias("nunique"),
        F.min(number).alias("min"),
        F.max(number).alias("max"),
        F.every(F.coalesce(number % 1 == 0, F.lit(True))).alias("_whole"),
        F.every(F.coalesce(F.col("value").cast("string").isin(*FLAG_VALUES), F.lit(True))).alias("_flags"),
    )


def column_profile(df: DataFrame) -> DataFrame:
    """Advised type, null share, distinct values and range of every column.

    Everything is derived from one count of the distinct values, one per kind of column (whole, fractional, other),
    instead of one distinct aggregate per column, which Spark would expand to rows times columns. The values of
    categories are listed by a second scan of just these columns, so that no list is ever built for a column with many
    values.
    """
    kinds = {f.name: f.dataType for f in df.schema}
    by_type: dict[str, list[str]] = {}
    for column, kind in kinds.items():
        by_type.setdefault(_sql_type(kind), []).append(column)
    is_number = F.col("column").isin([c for c, t in kinds.items() if isinstance(t, T.NumericType)])
    is_flag = F.col("column").isin([c for c, t in kinds.items() if isinstance(t, T.BooleanType)])
    stats = reduce(
        DataFrame.unionByName, [_value_stats(_value_counts(df, c, t), is_number) for t, c in by_type.items()]
    )
    in_int32 = (F.col("min") >= INT32_MIN) & (F.col("max") <= INT32_MAX)
    in_float32 = (F.abs("min") < FLOAT32_SAFE_MAX) & (F.abs("max") < FLOAT32_SAFE_MAX)
    advice = (
        F.when(F.col("nunique") == 0, "drop")
        .when(is_number & F.col("_whole"), F.when(in_int32, "Int32").otherwise("Int64"))
        .when(is_number, F.when(in_float32, "float32").otherwise("float64"))
        .when(is_flag | F.col("_flags"), "boolean")
        .when(F.col("nunique") <= CATEGORY_MAX_VALUES, "category")
        .otherwise("str")
    )
    # One row per column of the table.
    found = stats.withColumn("recommended", advice).drop("_whole", "_flags")
    rows = found.collect()
    profile = df.sparkSession.createDataFrame(rows, found.schema)
    few = [r["column"] for r in rows if r["recommended"] in ("boolean", "category")]
    if few:
        listed = (
            _value_counts(df, few, "STRING")
            .where(F.col("value").isNotNull())
            .groupBy("column")
            .agg(F.array_join(F.sort_array(F.collect_list("value")), "|").alias("values"))
        )
        profile = profile.join(F.broadcast(listed), "column", "left")
    else:
        profile = profile.withColumn("values", F.lit(None).cast("string"))
    return profile.select(
        "column",
        text.lookup({c: t.simpleString() for c, t in kinds.items()}, "column").alias("current_dtype"),
        "recommended",
        F.round(F.try_divide("_nulls", "_rows"), 4).alias("null_ratio"),
        "nunique",
        "min",
        "max",
        "values",
    )


def column_advice(df: DataFrame) -> DataFrame:
    """Advised type, null share, range and, for columns of few values, these values. For very wide and long tables.

    One scan sums up all columns, with a sketch for the number of distinct values, so nothing but one row leaves a task.
    Distinct values are then counted exactly for columns whose estimate is near the limit or below it, for which a
    shuffle holds a few dozen rows a column and task. Columns of more values have no count.
    """
    kinds = {f.name: f.dataType for f in df.schema}
    columns = {f"c{i}": c for i, c in enumerate(kinds)}
    typed = df.selectExpr(*[f"{_typed(c, kinds[c])} AS {n}" for n, c in columns.items()])
    numbers = {n for n, c in columns.items() if isinstance(kinds[c], T.NumericType)}
    sums = [X.row_count().alias("_rows")]
    for n in columns:
        is_number, value = n in numbers, F.col(n)
        number = value.cast("double") if is_number else F.lit(None).cast("double")
        sums += [
            F.count(n).alias(f"{n}_known"),
            F.min(number).alias(f"{n}_min"),
            F.max(number).alias(f"{n}_max"),
            (F.coalesce(F.every(value % 1 == 0), F.lit(True)) if is_number else F.lit(False)).alias(f"{n}_whole"),
            F.coalesce(F.every(value.cast("string").isin(*FLAG_VALUES)), F.lit(True)).alias(f"{n}_flags"),
            F.hll_sketch_estimate(F.hll_sketch_agg(value.cast("string"))).alias(f"{n}_distinct"),
        ]
    seen = typed.agg(*sums).first()  # one row
    near = [n for n in columns if seen[f"{n}_distinct"] <= 2 * CATEGORY_MAX_VALUES]
    listed: dict[str, list[str]] = {}
    if near:
        text_of = typed.selectExpr(*[f"CAST({n} AS STRING) AS {n}" for n in near])
        values = text_of.unpivot([], near, "column", "value").where(F.col("value").isNotNull()).distinct()
        few = values.groupBy("column").agg(F.sort_array(F.collect_list("value")).alias("values"))
        listed = {r["column"]: r["values"] for r in few.collect()}  # about sixty values a column
    rows = []
    for n, c in columns.items():
        own = listed.get(n, []) if n in near else None
        known, low, high = seen[f"{n}_known"], seen[f"{n}_min"], seen[f"{n}_max"]
        is_few = own is not None and len(own) <= CATEGORY_MAX_VALUES
        if not known:
            advice = "drop"
        elif n in numbers and seen[f"{n}_whole"]:
            advice = "Int32" if low >= INT32_MIN and high <= INT32_MAX else "Int64"
        elif n in numbers:
            advice = "float32" if max(abs(low), abs(high)) < FLOAT32_SAFE_MAX else "float64"
        elif isinstance(kinds[c], T.BooleanType) or seen[f"{n}_flags"]:
            advice = "boolean"
        else:
            advice = "category" if is_few else "str"
        nulls = round(1 - known / seen["_rows"], 4) if seen["_rows"] else None
        shown = "|".join(own) if advice in ("boolean", "category") and own is not None else None
        rows.append((c, kinds[c].simpleString(), advice, nulls, len(own) if is_few else None, low, high, shown))
    schema = "column string, current_dtype string, recommended string, null_ratio double, few int, min double, max double, `values` string"
    return df.sparkSession.createDataFrame(rows, schema)


def join_integrity(tx: DataFrame, identity: DataFrame, key: str) -> DataFrame:
    """Whether two tables join 1:1: rows, uniqueness, matches, orphans and coverage in percent.

    Both key columns are stacked and counted by key in one shuffle, pre-combined per task; no join is needed.
    """
    stacked = tx.select(key, F.lit(1).alias("_t"), F.lit(0).alias("_i")).unionByName(
        identity.select(key, F.lit(0).alias("_t"), F.lit(1).alias("_i"))
    )
    keys = stacked.groupBy(key).agg(F.sum("_t").alias("_t"), F.sum("_i").alias("_i"))
    both = F.col(key).isNotNull() & (F.col("_t") > 0) & (F.col("_i") > 0)
    return (
        keys.agg(
            F.sum("_t").alias("tx_rows"),
            F.sum("_i").alias("identity_rows"),
            (F.coalesce(F.max("_t"), F.lit(0)) <= 1).alias("tx_unique"),
            (F.coalesce(F.max("_i"), F.lit(0)) <= 1).alias("identity_unique"),
            F.sum(F.when(both, F.col("_i")).otherwise(0)).alias("matched"),
            F.sum(F.when(both, F.col("_t")).otherwise(0)).alias("_covered"),
        )
        .withColumn("orphans", F.col("identity_rows") - F.col("matched"))
        .withColumn("coverage_pct", 100 * F.try_divide("_covered", "tx_rows"))
        .drop("_covered")
    )


def compare_schemas(left: DataFrame, right: DataFrame) -> DataFrame:
    """(column, side, other): columns of one side only, and the right-hand column that equals it once normalised."""
    only_left = sorted(set(left.columns) - set(right.columns))
    only_right = sorted(set(right.columns) - set(left.columns))
    by_name: dict[str, list[str]] = {}
    for c in only_right:
        by_name.setdefault(underscored(c), []).append(c)
    rows = [(c, "left", r) for c in only_left for r in by_name.get(underscored(c), [None])]
    rows += [(c, "right", None) for c in only_right]
    return left.sparkSession.createDataFrame(rows, "column string, side string, other string")
