import random

import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from riskloom.operators import ordered

def clustered(kind, n):
    """Values that a fixed grid would put into one cell, or far from all others."""
    rng = random.Random(9)
    return {
        "tiny": lambda: [rng.random() * 1e-6 for _ in range(n)],
        "epoch": lambda: [1.7e9 + i for i in range(n)],
        "far": lambda: [float(i) for i in range(n - 1)] + [1e15],
    }[kind]()


@pytest.mark.parametrize("kind", ["tiny", "epoch", "far"])
def test_ranges_follow_the_data(spark, kind):
    values = clustered(kind, 40_000)
    df = spark.createDataFrame([(v, 1) for v in values], "v double, w long").repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so few rows become one range
    try:
        sizes = [r["count"] for r in ordered.in_ranges(df, [], F.col("v")).groupBy("_range").count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) > 1 and max(sizes) <= 2 * sum(sizes) / len(sizes)
    got = {r["v"]: r["before_w"] for r in ordered.running_totals(df, "v", ["w"]).collect()}
    assert [got[v] for v in sorted(values)] == list(range(len(values)))


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals_equal_a_plain_window(spark, descending):
    rng = random.Random(3)
    data = {(g, rng.choice([rng.uniform(-9, 9), rng.randint(-10**12, 10**12), rng.random()])) for g in "ab" for _ in range(300)}
    cells = spark.createDataFrame([(g, float(v), rng.randint(1, 9)) for g, v in data], "g string, v double, w long")
    got = ordered.running_totals(cells, "v", ["w"], ["g"], descending)
    order = F.desc("v") if descending else F.asc("v")
    earlier = Window.partitionBy("g").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    want = cells.withColumn("before_w", F.coalesce(F.sum("w").over(earlier), F.lit(0)))
    assert rows(got.select("g", "v", "w", "before_w")) == rows(want.select("g", "v", "w", "before_w"))


@pytest.mark.parametrize(("n", "k"), [(10, 5), (11, 5), (14, 5), (3, 5), (1, 5), (100, 7)])
def test_tile_number_equals_ntile(spark, n, k):
    df = spark.range(1, n + 1).withColumn("want", F.ntile(k).over(Window.orderBy("id")))
    assert df.where(ordered.tile_number(F.col("id"), F.lit(n), k) != F.col("want")).count() == 0


def test_tiles_with_heavy_ties(spark):
    """Values that a third of all rows and more share, with one row id far away from the others."""
    rng = random.Random(5)
    data = []
    for i in [*rng.sample(range(10**6), 899), 10**15]:
        for f, v in (
            ("tied", 1.0 if rng.random() < 0.6 else float(rng.randint(0, 3))),
            ("one", 2.0),
            ("few", None if rng.random() < 0.99 else rng.random()),
            ("spread", rng.uniform(-50, 50) if rng.random() < 0.8 else None),
        ):
            data.append((f, v, i, rng.choice([0, 0, 1, None])))
    long = spark.createDataFrame(data, "feature string, value double, id long, label int")
    got = ordered.tile_summary(long, "feature", "value", "id", "label", 5)
    w = Window.partitionBy("feature", F.col("value").isNull()).orderBy("value", "id")
    tiles = long.withColumn("tile", F.when(F.col("value").isNull(), 0).otherwise(F.ntile(5).over(w)))
    want = tiles.groupBy("feature", "tile").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("label").alias("labelled"),
        F.count_if(F.col("label") == 1).alias("positives"),
        F.min("value").alias("value_min"),
        F.max("value").alias("value_max"),
    )
    assert rows(got.select(*want.columns)) == rows(want)


def scored(spark, pairs):
    return spark.createDataFrame(pairs, "score double, is_fraud int")


def test_average_precision_counts_ties_once(spark):
    pairs = [(0.9, 1), (0.8, 0), (0.7, 1), (0.4, 0), (0.1, 0)]
    out = ordered.ranking_metrics(scored(spark, pairs)).first()
    assert out["pr_auc"] == pytest.approx((1 + 2 / 3) / 2)
    tied = ordered.ranking_metrics(scored(spark, [(0.5, 1), (0.5, 0), (0.5, 0), (0.5, 0)])).first()
    assert tied["pr_auc"] == 0.25 and tied["roc_auc"] == 0.5


def test_roc_auc_equals_all_pairs(spark):
    rng = random.Random(11)
    pairs = [(rng.randint(0, 20) / 20, int(rng.random() < 0.3)) for _ in range(400)]
    pos = [s for s, y in pairs if y]
    neg = [s for s, y in pairs if not y]
    want = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))
    out = ordered.ranking_metrics(scored(spark, [*pairs, (0.99, None)])).first()
    assert out["roc_auc"] == pytest.approx(want)
    assert (out["row_count"], out["fraud_count"]) == (400, len(pos))


def test_metrics_per_group(spark):
    df = spark.createDataFrame([("a", 0.9, 1), ("a", 0.1, 0), ("b", 0.1, 1), ("b", 0.9, 0)], "m string, score double, is_fraud int")
    got = {r["m"]: r["roc_auc"] for r in ordered.ranking_metrics(df, group=["m"]).collect()}
    assert got == {"a": 1.0, "b": 0.0}
