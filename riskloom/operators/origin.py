"""Search for the calendar day behind offset 0, by matching daily volume with holidays.

Only the holiday lookup depends on the candidate. The trend is taken over row positions, and the weekday groups are
the residues of the day index modulo 7 under every candidate, so the cleaned series is computed once.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Fixed values: (month, day, name, expected direction of the volume).
FIXED_HOLIDAYS = (
    (12, 24, "christmas eve", -1),
    (12, 25, "christmas", -1),
    (12, 26, "day after christmas", -1),
    (1, 1, "new year", -1),
    (7, 4, "independence day", -1),
)
# Days after the fourth Thursday of November.
THANKSGIVING_HOLIDAYS = ((0, "thanksgiving", -1), (1, "black friday", 1), (4, "cyber monday", 1))
FIRST_CANDIDATE, LAST_CANDIDATE = date(2016, 1, 1), date(2019, 12, 31)
TREND_ROWS, TREND_MIN = 28, 7
MIN_HOLIDAYS = 5


def daily_counts(rows: DataFrame, day: str | Column) -> DataFrame:
    """Rows per day index: (day_index, n)."""
    column = F.col(day) if isinstance(day, str) else day
    return rows.groupBy(column.cast("long").alias("day_index")).agg(F.count(F.lit(1)).alias("n"))


def deseasonalize(series: DataFrame) -> DataFrame:
    """(day_index, n, trend, resid, z): centred rolling median out, weekday median out, then a z-score.

    The series has one row per calendar day, so its window and its broadcast sides do not grow with the transactions.
    """
    half = TREND_ROWS // 2
    centred = Window.partitionBy(F.lit(0)).orderBy("day_index").rowsBetween(-half, half - 1)
    trend = F.when(F.count("n").over(centred) >= TREND_MIN, F.percentile("n", F.lit(0.5)).over(centred))
    detrended = (
        series.withColumn("trend", trend)
        .withColumn("_flat", F.try_divide("n", "trend"))
        .withColumn("_weekday", F.pmod("day_index", F.lit(7)))
    )
    weekdays = detrended.groupBy("_weekday").agg(F.percentile("_flat", F.lit(0.5)).alias("_typical"))
    resid = detrended.join(F.broadcast(weekdays), "_weekday").withColumn("resid", F.try_divide("_flat", "_typical"))
    whole = Window.partitionBy(F.lit(0))
    z = F.try_divide(F.col("resid") - F.avg("resid").over(whole), F.stddev_samp("resid").over(whole))
    return resid.select("day_index", "n", "trend", "resid", z.alias("z"))


def holidays(year: Column) -> Column:
    """Array of (day, name, direction) of one year."""
    november = F.make_date(year, F.lit(11), F.lit(1))
    # dayofweek counts Sunday as 1, so a Thursday is 5; three more weeks after the first Thursday.
    fourth = F.date_add(november, F.pmod(F.lit(5) - F.dayofweek(november), F.lit(7)) + 21)
    fixed = [(F.make_date(year, F.lit(m), F.lit(d)), name, way) for m, d, name, way in FIXED_HOLIDAYS]
    moving = [(F.date_add(fourth, after), name, way) for after, name, way in THANKSGIVING_HOLIDAYS]
    return F.array(
        *[
            F.struct(day.alias("day"), F.lit(name).alias("name"), F.lit(way).alias("direction"))
            for day, name, way in fixed + moving
        ]
    )


def covered_holidays(z: DataFrame, origins: DataFrame) -> DataFrame:
    """(origin, day, name, direction, z): the holidays inside the series, dated by each candidate origin."""
    known = z.where(F.col("z").isNotNull()).select("day_index", "z")
    lo, hi = (z.agg(f("day_index").cast("int")).scalar() for f in (F.min, F.max))
    years = F.sequence(F.year(F.date_add("origin", lo)), F.year(F.date_add("origin", hi)))
    return (
        origins.select("origin", F.explode(years).alias("_year"))
        .select("origin", F.explode(holidays(F.col("_year"))).alias("_h"))
        .select("origin", "_h.*", F.date_diff(F.col("_h.day"), F.col("origin")).cast("long").alias("day_index"))
        .join(known, "day_index")
        .drop("day_index")
    )


def candidates(spark: SparkSession, first: date = FIRST_CANDIDATE, last: date = LAST_CANDIDATE) -> DataFrame:
    return spark.range(1).select(F.explode(F.sequence(F.lit(first), F.lit(last))).alias("origin"))


def score_origins(z: DataFrame, origins: DataFrame) -> DataFrame:
    """(origin, n_holidays, score): mean of the z-scores on holidays, signed by the expected direction."""
    scored = (
        covered_holidays(z, origins)
        .groupBy("origin")
        .agg(F.count(F.lit(1)).alias("n_holidays"), F.avg(F.col("z") * F.col("direction")).alias("score"))
    )
    return origins.join(scored, "origin", "left").select(
        "origin",
        F.coalesce("n_holidays", F.lit(0)).alias("n_holidays"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def holiday_detail(z: DataFrame, origin: date) -> DataFrame:
    """(day, name, direction, z, agrees) of one candidate."""
    hits = covered_holidays(z, candidates(z.sparkSession, origin, origin))
    return hits.select("day", "name", "direction", "z", (F.col("z") * F.col("direction") > 0).alias("agrees"))


def rank_origins(scored: DataFrame) -> DataFrame:
    """Candidates with enough holidays: rank (1 + number of better ones) and distance from the mean in sigmas."""
    valid = scored.where(F.col("n_holidays") >= MIN_HOLIDAYS)
    # One row per candidate day, fixed by the searched range.
    everyone = Window.partitionBy(F.lit(0))
    sigma = F.try_divide(F.col("score") - F.avg("score").over(everyone), F.stddev_pop("score").over(everyone))
    return valid.select(
        "origin",
        "n_holidays",
        "score",
        F.rank().over(everyone.orderBy(F.desc("score"))).alias("rank"),
        sigma.alias("sigma"),
    )


def _ranked(rows: DataFrame, day: str | Column) -> DataFrame:
    z = deseasonalize(daily_counts(rows, day))
    return rank_origins(score_origins(z, candidates(rows.sparkSession)))


def origin_search(rows: DataFrame, day: str | Column, top: int = 10) -> DataFrame:
    """The best candidates for a table's day-index column."""
    return _ranked(rows, day).orderBy("rank", "origin").limit(top)


def origin_rank(rows: DataFrame, day: str | Column, origin: date) -> DataFrame:
    """Rank, score and distance of one given origin among all candidates; no row where it has too few holidays."""
    return _ranked(rows, day).where(F.col("origin") == F.lit(origin))
