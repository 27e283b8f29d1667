"""Boosted trees and their contributions, against brute force."""

import pickle
from itertools import combinations
from math import factorial

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from riskloom.operators import boosting as B

NAMES = ("a", "b", "c", "d")
LABEL = "y"


def grown(seed, n=4000, codes=8, depth=4):
    """A tree on four coded features and the codes it was grown on."""
    rng = np.random.default_rng(seed)
    coded = rng.integers(0, codes, (4, n)).astype(np.uint8)
    risk = (coded[0] > 4) * (coded[1] < 3) + (coded[2] == 0) + 0.3 * (coded[3] % 2) * (coded[0] < 3)
    block = B.Block(coded, (rng.random(n) < 0.1 + 0.25 * risk).astype(float), np.ones(n), np.zeros(n))
    return B.grow(block.sums, [False, False, True, True], depth, codes, 0.3), coded


def chance(tree, codes, inside, node=0):
    """The mean value of the tree for a row of which only the features ``inside`` are known."""
    if tree.feature[node] < 0:
        return tree.value[node]
    left, right, f = 2 * node + 1, 2 * node + 2, tree.feature[node]
    if f in inside:
        return chance(tree, codes, inside, left if tree.left[node, codes[f]] else right)
    share = tree.cover[left] / tree.cover[node]
    return share * chance(tree, codes, inside, left) + (1 - share) * chance(tree, codes, inside, right)


@pytest.mark.parametrize("seed", [1, 2])
def test_contributions_are_shapley_values_over_all_subsets(seed):
    tree, coded = grown(seed)
    assert (tree.feature >= 0).sum() > 8
    model = B.TreeModel(B.Codes(NAMES, {}, {}), (tree,), 0.25)
    rows = coded[:, :60]
    margin, parts = B._contribute(model, rows)
    parts = np.array(parts.to_pylist())
    for r in range(rows.shape[1]):
        for f in range(4):
            others = [x for x in range(4) if x != f]
            want = sum(
                factorial(k) * factorial(3 - k) / 24 * (chance(tree, rows[:, r], {*s, f}) - chance(tree, rows[:, r], set(s)))
                for k in range(4)
                for s in combinations(others, k)
            )
            assert parts[r, f] == pytest.approx(want, abs=1e-12)
    assert model.expected() == pytest.approx(0.25 + chance(tree, rows[:, 0], set()))
    assert np.allclose(parts.sum(axis=1) + model.expected(), margin.to_numpy(), atol=1e-12)


def test_best_split_is_the_best_of_all_cuts():
    rng = np.random.default_rng(3)
    for _ in range(40):
        n = rng.integers(0, 60, (3, 6)).astype(float)
        g, h = rng.normal(size=(3, 6)) * n * B.UNIT, n * 0.2 * B.UNIT
        split = B.best_split(np.stack([np.rint(g), np.rint(h), n]), [False, False, True])
        gains = []
        for k in range(3):
            gk, hk, nk = g[k] / B.UNIT, h[k] / B.UNIT, n[k]
            if k == 2:
                order = sorted(range(6), key=lambda c: gk[c] / (hk[c] + B.SMOOTH) if nk[c] else 1e9)
                sides = [order[: i + 1] for i in range(5)]
            else:
                sides = [[*range(1, i + 1), *extra] for i in range(0, 6) for extra in ((), (0,))]
            for side in sides:
                other = [c for c in range(6) if c not in side]
                if min(nk[side].sum(), nk[other].sum()) < B.LEAST_ROWS:
                    continue
                part = lambda s: gk[s].sum() ** 2 / max(hk[s].sum(), 1e-12)  # noqa: B023, E731
                gains.append(part(side) + part(other) - part(list(range(6))))
        best = max(gains, default=0)
        assert (split.gain if split else 0.0) == pytest.approx(max(best, 0), rel=1e-4, abs=1e-4)


def test_codes_of_numbers_text_and_unknowns():
    codes = B.Codes(("x", "t"), {"x": [1.0, 2.0]}, {"t": ["p", "q"]})
    batch = pa.RecordBatch.from_arrays([pa.array([0.5, 1.0, 1.5, 9.0, None, float("nan")]), pa.array(["p", "q", "z", None, "p", "q"])], ["x", "t"])
    assert codes.of(batch).tolist() == [[1, 1, 2, 3, 0, 0], [1, 2, 3, 0, 1, 2]]


@pytest.fixture(scope="module")
def rows(spark):
    """Unknown amounts are risky, as are two of the shops; an id and a date come along."""
    df = spark.range(3000).repartition(3).select(
        "id",
        F.expr("date'2024-01-01' + CAST(id % 5 AS INT)").alias("day"),
        F.when(F.col("id") % 4 != 0, F.pmod(F.xxhash64("id"), F.lit(1000)) / 10).alias("a mount"),
        F.concat(F.lit("shop"), F.col("id") % 7).alias("shop"),
        (F.col("id") % 3 == 0).alias("flag"),
        F.lit(None).cast("double").alias("nothing"),
    )
    risk = 0.1 + 0.5 * F.col("a mount").isNull().cast("int") + 0.3 * F.col("shop").isin("shop2", "shop5").cast("int")
    return df.withColumn(LABEL, (F.pmod(F.xxhash64("id", F.lit(9)), F.lit(1000)) / 1000 < risk).cast("int")).withColumn("w", F.lit(1.0)).cache()


FEATURES = ("a mount", "shop", "flag", "nothing")


@pytest.fixture(scope="module")
def model(rows):
    return B.fit(rows, FEATURES, LABEL, "w", rounds=30, rate=0.2)


def test_blocks_on_executors_grow_the_same_trees(rows, model, monkeypatch):
    monkeypatch.setattr(B, "BLOCK_ROWS", 700)
    monkeypatch.setattr(B, "EACH", 10)
    for few in (100, 1):
        monkeypatch.setattr(B, "FEW_PARTITIONS", few)
        other = B.fit(rows, FEATURES, LABEL, "w", rounds=30 if few > 1 else 4, rate=0.2)
        assert other.codes == model.codes and other.start == model.start
        for x, y in zip(model.trees, other.trees):
            assert (x.feature == y.feature).all() and (x.left == y.left).all() and (x.cover == y.cover).all()
            assert np.allclose(x.value, y.value, atol=1e-9)


def same_trees(model, other):
    assert other.codes == model.codes and other.start == model.start and len(other.trees) == len(model.trees)
    for x, y in zip(model.trees, other.trees):
        assert (x.feature == y.feature).all() and (x.left == y.left).all() and (x.cover == y.cover).all() and (x.value == y.value).all()


def jobs_of(spark, group, run):
    spark.sparkContext.setJobGroup(group, group)
    try:
        return run(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_a_fit_of_a_few_blocks_is_one_job_whatever_its_rounds(spark, rows, model, monkeypatch):
    """From 65,537 rows on, each level was a job of its own."""
    monkeypatch.setattr(B, "BLOCK_ROWS", 1000)  # three blocks
    other, jobs = jobs_of(spark, "few rounds", lambda: B.fit(rows, FEATURES, LABEL, "w", rounds=3, rate=0.2))
    fitted, more = jobs_of(spark, "all rounds", lambda: B.fit(rows, FEATURES, LABEL, "w", rounds=30, rate=0.2))
    assert jobs == more
    same_trees(model, fitted)
    same_trees(B.TreeModel(model.codes, model.trees[:3], model.start), other)


@pytest.mark.parametrize("features, codes", [(1, 64), (9, 5), (70, 1), (40, 64), (12, 256)])
def test_sums_are_those_of_every_feature_by_itself(features, codes):
    rng = np.random.default_rng(features)
    coded = rng.integers(0, codes, (features, 500)).astype(np.uint8)
    margin, weight, label = rng.normal(size=500), rng.random(500), (rng.random(500) < 0.3).astype(float)
    block = B.Block(coded, label, weight, margin)
    tree = B.Tree.empty(2, codes)
    tree.feature[0], tree.left[0, : codes // 2] = 0, True
    p = 1 / (1 + np.exp(-margin))
    g, h = np.rint(weight * (p - label) * B.UNIT), np.rint(weight * p * (1 - p) * B.UNIT)
    left = tree.left[0, coded[0]]
    for sums, side in zip(np.moveaxis(block.sums(tree, np.array([1, 2])), 1, 0), (left, ~left)):
        for k in range(features):
            for j, x in enumerate((g, h, np.ones(500))):
                assert (sums[j, k] == np.bincount(coded[k, side], x[side], codes)).all()


def test_the_driver_receives_splits_and_no_sums(spark, rows, model, monkeypatch):
    """What the driver reads of a fit does not grow with the partitions that sum up gradients."""
    monkeypatch.setattr(B, "BLOCK_ROWS", 100)
    read = []
    collect = type(spark.sparkContext.emptyRDD()).collect

    def collected(self):
        out = collect(self)
        read.append(len(pickle.dumps(out)))
        return out

    monkeypatch.setattr("pyspark.RDD.collect", collected)
    widened = rows.select("*", *[(F.col("a mount") * k).alias(f"more{k}") for k in range(20)])
    more = (*FEATURES, *[f"more{k}" for k in range(20)])
    fitted = B.fit(widened.repartition(8), more, LABEL, "w", rounds=3, rate=0.2)
    one_node = 3 * len(more) * B.CODES * 8  # the sums of one node over all rows
    assert len(fitted.trees) == 3 and read and sum(read) < one_node


def test_learned_scores(rows, model):
    scored = model.transform(rows)
    assert scored.columns == [*rows.columns, "score"] and scored.count() == 3000
    mean = {r["k"]: r["s"] for r in scored.groupBy((F.col("a mount").isNull()).alias("k")).agg(F.avg("score").alias("s")).collect()}
    assert mean[True] > mean[False] + 0.3  # the side of unknown values is learned
    loss = scored.select(F.avg(-F.when(F.col(LABEL) == 1, F.log("score")).otherwise(F.log(1 - F.col("score"))))).first()[0]
    rate = rows.agg(F.avg(LABEL)).first()[0]
    assert loss < 0.85 * -(rate * np.log(rate) + (1 - rate) * np.log(1 - rate))


def test_contributions_of_a_table_add_up(rows, model):
    expected = model.expected()
    parts = model.contributions(rows, ["id", "day"])
    assert parts.columns == ["id", "day", "margin", "contributions"]
    got = parts.collect()
    assert len(got) == 3000
    assert all(abs(sum(r["contributions"]) + expected - r["margin"]) < 1e-9 for r in got)
    mean = {r["feature"]: r["importance"] for r in model.importance(rows).collect()}
    assert set(mean) == set(FEATURES) and mean["nothing"] == 0 and mean["a mount"] > mean["shop"] > mean["flag"]


def test_a_stored_model_is_the_same(spark, rows, model, tmp_path):
    model.save(spark, str(tmp_path))
    again = B.TreeModel.load(spark, str(tmp_path))
    assert again.codes == model.codes and again.start == model.start
    before, after = (sorted(m.transform(rows).select("id", "score").collect()) for m in (model, again))
    assert before == after
    assert again.expected() == pytest.approx(model.expected())


def test_labels_of_one_class_and_no_rows(rows):
    for part in (rows.where(f"{LABEL} = 0"), rows.where("false"), rows.withColumn(LABEL, F.lit(None).cast("int"))):
        model = B.fit(part, FEATURES, LABEL, "w", rounds=3)
        assert not model.trees
        assert {r["score"] for r in model.transform(rows).select("score").distinct().collect()} == {0.5}
        assert model.contributions(rows, []).count() == 3000
