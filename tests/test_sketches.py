"""Mergeable summaries against the rows they stand for."""

from datetime import date, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from riskloom.functions.sampling import first_by_hash
from riskloom.operators import entity, profile, sketches

DAY = date(2024, 1, 1)


def test_ranges_of_days_merge_sketches(spark):
    scores = spark.range(60_000).select(
        F.date_add(F.lit(DAY), (F.col("id") % 10).cast("int")).alias("transaction_date"),
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("model"),
        (F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / 1_000_003).alias("score"),
    )
    kept = sketches.score_sketches(scores).cache()
    got = sketches.trailing_quantiles(kept, 4)
    held = {(r["transaction_date"], r["model"]): r for r in sketches.rank_bounds(got, scores, 4).collect()}
    assert len(held) == 20 and all(r["score_p50_holds"] and r["score_p90_holds"] and r["score_p99_holds"] for r in held.values())
    last = DAY + timedelta(days=6)
    inside = scores.where(F.col("transaction_date").between(F.lit(DAY + timedelta(days=3)), F.lit(last)) & (F.col("model") == "a"))
    assert held[last, "a"]["scored_count"] == inside.count()
    # A wrong quantile is noticed.
    off = got.withColumn("score_p50", F.col("score_p50") + 0.02)
    assert not any(r["score_p50_holds"] for r in sketches.rank_bounds(off, scores, 4).collect())


def test_bitmaps_count_keys_of_any_sign(spark):
    keys = [(-40_000, 1), (-1, 1), (0, 1), (0, 2), (5, 1), (70_000, 2), (None, 1), (2**40, 2)]
    child = spark.createDataFrame(keys, "k long, day int")
    parent = spark.createDataFrame([(0,), (5,), (5,), (7,), (2**40,), (None,)], "p long")
    days = sketches.key_bitmaps(child, "k", ["day"])
    assert rows(sketches.key_counts(days, ["day"])) == [(1, 4, 4, True), (2, 3, 3, True)]
    assert rows(sketches.key_counts(sketches.merged_bitmaps(days))) == [(7, 6, False)]
    got = sketches.bitmap_integrity(days, sketches.key_bitmaps(parent, "p")).first()
    assert tuple(got) == (7, 6, 5, 4, 3, 3)
    nothing = sketches.key_bitmaps(child.where("false"), "k")
    assert tuple(sketches.bitmap_integrity(nothing, nothing).first()) == (0, 0, 0, 0, 0, 0)


def test_tables_are_compared_by_content(spark):
    left = spark.createDataFrame([(1, "a", 1.0), (2, None, 2.0), (2, "b", float("nan"))], "`id-1` int, t string, x double")
    right = spark.createDataFrame([(2, "b", 2), (3, "b", 3), (None, "c", 4)], "id_1 long, t string, x int").withColumn("more", F.lit(1))
    got = {r["left_column"]: tuple(r)[2:] for r in sketches.compare_tables(left, right).collect()}
    assert got["id-1"] == (3, 3, 0, 1, 2, 2, 1, pytest.approx(1 / 3))
    assert got["t"] == (3, 3, 1, 0, 2, 2, 1, pytest.approx(1 / 3))
    assert got["x"] == (3, 3, 1, 0, 2, 3, 1, pytest.approx(1 / 4)) and len(got) == 3
    assert sketches.compare_tables(left.select("t"), right.select("more")).count() == 0
    assert tuple(sketches.key_difference(left, "id-1", right, "id_1").first()) == (1, 1, 1)


def test_advice_needs_no_count_of_large_columns(spark):
    df = spark.range(300).select(
        F.col("id").alias("n umber"),
        (F.col("id") % 30).cast("string").alias("thirty"),
        (F.col("id") % 31).cast("string").alias("more"),
        F.when(F.col("id") % 2 == 0, "T").otherwise("F").alias("flag"),
        F.lit(None).cast("string").alias("nothing"),
        (F.col("id") / 7).alias("share"),
        (F.col("id") * 10**10).alias("large"),
        (F.col("id") > 5).alias("yes"),
    )
    got = {r["column"]: r for r in profile.column_advice(df).collect()}
    full = {r["column"]: r for r in profile.column_profile(df).collect()}
    assert {c: r["recommended"] for c, r in got.items()} == {c: r["recommended"] for c, r in full.items()}
    assert {c: r["few"] for c, r in got.items()} == {c: r["nunique"] if r["nunique"] <= 30 else None for c, r in full.items()}
    for field in ("current_dtype", "null_ratio", "min", "max", "values"):
        assert {c: r[field] for c, r in got.items()} == {c: r[field] for c, r in full.items()}
    assert got["thirty"]["recommended"] == "category" and got["more"]["recommended"] == "str"


def test_one_card_at_one_time_is_dealt_evenly(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)  # so few rows would become one partition
    df = spark.range(4000).select(
        F.when(F.col("id") < 3500, 1).otherwise(F.col("id") % 50).alias("card"), F.lit(7).alias("transaction_dt"),
        F.col("id").alias("transaction_id"), F.pmod(F.xxhash64("id"), F.lit(5)).alias("C1"),
    )
    ranged = entity.in_ranges(df, ["card"], F.struct("transaction_dt", "transaction_id"))
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [r["count"] for r in ranged.groupBy("_range").count().collect()]
    assert len(sizes) == 4 and max(sizes) < 1.5 * 1000
    got = entity.entity_monotonicity(df, ["card"], ["C1"]).first()
    last, steps, same = {}, 0, 0
    for r in df.orderBy("card", "transaction_id").collect():
        if r["card"] in last:
            steps, same = steps + 1, same + (last[r["card"]] == r["C1"])
        last[r["card"]] = r["C1"]
    assert (got["steps"], got["unchanged"]) == (steps, same)


def test_samples_take_the_smallest_hashes(spark):
    df = spark.range(50_000).repartition(5)
    want = [r["id"] for r in df.orderBy(F.xxhash64("id", F.lit(42)), "id").limit(700).collect()]
    got = first_by_hash(df, ["id"], 700)
    assert sorted(r["id"] for r in got.collect()) == sorted(want)
    assert "Filter" in got._jdf.queryExecution().optimizedPlan().toString()
    assert first_by_hash(df, ["id"], 60_000).count() == 50_000
    # One key holds nearly all rows: its hash may lie above the bound.
    hot = df.withColumn("key", F.when(F.col("id") < 49_990, 1).otherwise(F.col("id")))
    assert first_by_hash(hot, ["key"], 100, ["id"]).count() == 100
