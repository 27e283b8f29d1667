from datetime import date

import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from riskloom.operators import entity, explain, marts, origin, profile


def test_column_advice(spark):
    data = [
        (1, 2**40, 1.5, 2.0, 1e39, "T", "x", f"text{i}", None, True) for i in range(40)
    ] + [(None, 1, None, -0.0, 0.5, None, "y", None, None, None), (2, 1, float("nan"), 0.0, 0.5, "F", None, None, None, False)]
    df = spark.createDataFrame(
        data, "i int, big long, f double, whole double, huge double, flag string, cat string, txt string, none string, b boolean"
    )
    out = {r["column"]: r for r in profile.column_profile(df).collect()}
    assert {c: r["recommended"] for c, r in out.items()} == {
        "i": "Int32", "big": "Int64", "f": "float32", "whole": "Int32", "huge": "float64", "flag": "boolean",
        "cat": "category", "txt": "str", "none": "drop", "b": "boolean",
    }
    assert out["cat"]["values"] == "x|y" and out["txt"]["values"] is None and out["flag"]["values"] == "F|T"
    assert (out["whole"]["nunique"], out["f"]["nunique"], out["none"]["nunique"]) == (2, 1, 0)
    assert out["f"]["null_ratio"] == round(2 / 42, 4) and out["none"]["null_ratio"] == 1.0
    assert (out["big"]["min"], out["big"]["max"]) == (1.0, float(2**40))


def test_null_profile(spark):
    df = spark.createDataFrame([(1, None), (2, None), (None, None)], "a int, b string")
    out = profile.null_profile(df)
    assert rows(out.select("column", "dtype", F.round("null_ratio", 3))) == [("a", "int", 0.333), ("b", "string", 1.0)]
    assert rows(profile.null_summary(out)) == [(2, 1, 0)]


def test_schema_comparison(spark):
    left = spark.createDataFrame([(1, 2, 3)], "`id_01` int, only int, same int")
    right = spark.createDataFrame([(1, 2, 3)], "`id-01` int, extra int, same int")
    assert rows(profile.compare_schemas(left, right)) == [
        ("extra", "right", None),
        ("id-01", "right", None),
        ("id_01", "left", "id-01"),
        ("only", "left", None),
    ]


def test_join_integrity_counts_orphans_and_copies(spark):
    tx = spark.createDataFrame([(1,), (2,), (2,), (None,)], "id long")
    identity = spark.createDataFrame([(1,), (9,), (None,)], "id long")
    out = profile.join_integrity(tx, identity, "id").first().asDict()
    assert out == {
        "tx_rows": 4, "identity_rows": 3, "tx_unique": False, "identity_unique": True, "matched": 1, "orphans": 2,
        "coverage_pct": 25.0,
    }


@pytest.mark.parametrize("n", [5, 60])
def test_deseasonalise_equals_pandas(spark, n):
    values = [(i + i // 20, 10 + (i * 7919) % 13 + 5 * (i % 7 == 2)) for i in range(n)]
    got = origin.deseasonalize(spark.createDataFrame(values, "day_index long, n long")).orderBy("day_index").toPandas()
    s = pd.Series([float(v) for _, v in values], index=pd.to_datetime("2017-12-01") + pd.to_timedelta([d for d, _ in values], unit="D"))
    flat = s / s.rolling(28, center=True, min_periods=7).median()
    resid = flat / flat.groupby(flat.index.dayofweek).transform("median")
    z = (resid - resid.mean()) / resid.std()
    assert got["z"].astype(float).to_numpy() == pytest.approx(z.to_numpy(), nan_ok=True)


def test_holidays_of_a_year(spark):
    out = spark.range(1).select(F.inline(origin.holidays(F.lit(2018)))).collect()
    days = {r["name"]: (r["day"], r["direction"]) for r in out}
    assert days["thanksgiving"] == (date(2018, 11, 22), -1)
    assert days["black friday"] == (date(2018, 11, 23), 1)
    assert days["cyber monday"] == (date(2018, 11, 26), 1)
    assert days["new year"] == (date(2018, 1, 1), -1) and len(days) == 8


def test_a_planted_origin_is_found(spark):
    start, length = date(2017, 12, 1), 400
    z = spark.range(length).select(F.col("id").alias("day_index"), F.lit(0.0).alias("z"))
    planted = origin.covered_holidays(z, origin.candidates(spark, start, start)).select(
        F.date_diff("day", "origin").cast("long").alias("day_index"), F.col("direction").cast("double").alias("peak")
    )
    z = z.join(planted, "day_index", "left").select("day_index", F.coalesce("peak", "z").alias("z"))
    ranked = origin.rank_origins(origin.score_origins(z, origin.candidates(spark)))
    best = ranked.where("rank = 1").collect()
    assert [(r["origin"], r["score"]) for r in best] == [(start, 1.0)]
    assert origin.holiday_detail(z, start).where("not agrees").count() == 0


def test_steps_cross_hours_and_skip_unknown_values(spark):
    data = [
        (1, 10, "a", 1.0), (2, 20, "a", 1.0), (3, 90_000, "a", 2.0), (4, 90_001, "a", None), (5, 200_000, "a", 0.0),
        (6, 5, "b", 3.0), (7, 5, None, 9.0), (8, 6, None, 9.0),
    ]
    tx = spark.createDataFrame(data, "transaction_id long, transaction_dt long, card string, v double")
    out = entity.entity_monotonicity(tx, ["card"], ["v"]).first()
    assert (out["steps"], out["not_falling"], out["unchanged"], out["as_elapsed"]) == (2, 2, 1, 2)


@pytest.mark.parametrize("step", [1, 60, 86_400])
def test_steps_do_not_depend_on_how_coarse_times_are(spark, step):
    """Whole days put all rows of a card and day into one minute; single seconds spread them over many."""
    df = spark.range(400).selectExpr(
        "id AS transaction_id", "id % 3 AS card1", f"(id * 7919 % 400) DIV 5 * {step} AS transaction_dt",
        "CASE WHEN id % 11 = 0 THEN NULL ELSE id * 31 % 17 END AS C1",
    )
    got = entity.entity_monotonicity(df, ["card1"], ["C1"])
    order = Window.partitionBy("card1").orderBy("transaction_dt", "transaction_id")
    change = F.col("C1") - F.lag("C1").over(order)
    plain = df.select(change.alias("d")).where("d IS NOT NULL")
    assert got.first()["steps"] == plain.count() and got.first()["not_falling"] == plain.where("d >= 0").count()
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (") == 1


def test_trailing_ratio_ignores_gaps_and_itself(spark):
    days = [(date(2024, 1, d), "a", float(v)) for d, v in ((1, 10), (2, 20), (9, 30), (10, 0))]
    df = spark.createDataFrame(days, "transaction_date date, s string, v double")
    got = [r[0] for r in df.select("transaction_date", marts.against_trailing(df, "v", "s", 2).alias("x")).orderBy("transaction_date").select("x").collect()]
    assert got == [None, 2.0, 2.0, 0.0]
    zeros = df.withColumn("v", F.lit(0.0))
    assert [r[0] for r in zeros.select(marts.against_trailing(zeros, "v", "s", 7)).collect()] == [None] * 4


def test_linear_contributions(spark):
    df = spark.createDataFrame([(1, 1.0, 0), (2, 3.0, 0), (3, None, 0)], "id long, V1 double, card1 int")
    weights = {"V1": 2.0, "card1": 5.0}
    out = explain.linear_importance(df, weights)
    by_row = explain.linear_contributions(df, weights, ["id"]).groupBy("feature")
    assert rows(by_row.agg(F.avg(F.abs("contribution")))) == rows(out)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") <= 1  # the other pass made the means
    assert rows(out.select("feature", F.round("importance", 6))) == [("V1", 1.333333), ("card1", 0.0)]
    assert rows(explain.contribution_families(out).select("family", "share", "column_count")) == [("V", 1.0, 1), ("named", 0.0, 1)]
    assert rows(explain.contribution_cumulative(out, (1, 5))) == [(1, 1.0, 1, 2), (5, 1.0, 1, 2)]
    assert rows(explain.contribution_top(out, 1).select("feature", "rank")) == [("V1", 1)]


def test_sample_does_not_depend_on_the_layout(spark):
    df = spark.range(1000)
    first = rows(explain.stable_sample(df, "id", 50))
    assert first == rows(explain.stable_sample(df.repartition(7), "id", 50)) and len(first) == 50
    assert first != rows(explain.stable_sample(df, "id", 50, seed=1))
