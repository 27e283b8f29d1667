"""Costs of blocking, each against the definition written out over a small list of payments."""

import pytest
from pyspark.sql import functions as F

from riskloom.operators import thresholds as th

# (is_fraud, score, amount)
PAYMENTS = [
    (1, 0.97, 40.0), (0, 0.91, 75.0), (1, 0.83, 310.0), (0, 0.66, 12.0), (0, 0.58, 500.0), (1, 0.35, 25.0), (0, 0.22, 60.0),
    (1, 0.08, 90.0), (0, 0.02, 33.0),
]


def frame(spark, payments=PAYMENTS):
    return spark.createDataFrame(payments, "is_fraud int, score double, transaction_amt double")


def counted(payments, threshold):
    """(caught, missed, false alarms, missed amount) by definition."""
    return (
        sum(y == 1 and s >= threshold for y, s, _ in payments),
        sum(y == 1 and s < threshold for y, s, _ in payments),
        sum(y == 0 and s >= threshold for y, s, _ in payments),
        sum(a for y, s, a in payments if y == 1 and s < threshold),
    )


@pytest.mark.parametrize("threshold", [0.02, 0.35, 0.36, 0.83, 0.98])
@pytest.mark.parametrize("fp_cost", [0.0, 7.5])
def test_cost_at_a_threshold(spark, threshold, fp_cost):
    caught, missed, alarms, amount = counted(PAYMENTS, threshold)
    out = th.cost(frame(spark), threshold, fp_cost).first()
    assert (out["caught"], out["missed"], out["false_alarms"], out["missed_amount"]) == (caught, missed, alarms, amount)
    assert out["total_cost"] == amount + alarms * fp_cost
    assert out["recall"] == caught / 4
    assert out["precision"] == pytest.approx(caught / (caught + alarms) if caught + alarms else 0.0)


def test_sweep_and_curve_hold_the_same_points(spark):
    swept = {r["threshold"]: r for r in th.sweep(frame(spark), 11.0).collect()}
    curve = {r["threshold"]: r for r in th.curve(frame(spark)).collect()}
    assert swept.keys() == curve.keys() == set(th.GRID)
    for t in th.GRID:
        _, _, alarms, amount = counted(PAYMENTS, t)
        assert (curve[t]["missed_amount"], curve[t]["false_alarms"]) == (amount, alarms)
        assert swept[t]["total_cost"] == pytest.approx(amount + 11.0 * alarms)


@pytest.mark.parametrize("fp_cost", [0.0, 3.0, 20.0, 64.0, 400.0])
def test_cheapest_threshold(spark, fp_cost):
    costs = {t: counted(PAYMENTS, t)[3] + counted(PAYMENTS, t)[2] * fp_cost for t in th.GRID}
    want = min(th.GRID, key=lambda t: (costs[t], t))
    got = th.pick(frame(spark), fp_cost).first()
    assert (got["threshold"], got["total_cost"]) == (want, pytest.approx(costs[want]))


def test_dearer_alarms_never_lower_the_threshold(spark):
    picked = th.sensitivity(frame(spark), (0.0, 2.0, 9.0, 50.0, 300.0, 2000.0)).orderBy("fp_cost").collect()
    chosen = [r["threshold"] for r in picked]
    assert chosen == sorted(chosen) and chosen[0] < chosen[-1]


def test_ties_go_to_the_lower_threshold(spark):
    flat = [(0, 0.5, 1.0), (1, 0.75, 8.0)]  # every threshold above 0.5 and up to 0.75 costs nothing
    assert th.pick(frame(spark, flat), 6.0, (0.3, 0.55, 0.6, 0.7)).first()["threshold"] == 0.55


def test_scores_on_grid_points(spark):
    exact = [*th.GRID[::7], 0.0, 1.0, 0.28999999999999998, 0.29000000000000004]
    got = {r["threshold"]: r["caught"] for r in th.points(frame(spark, [(1, s, 2.0) for s in exact])).collect()}
    assert got == {t: sum(s >= t for s in exact) for t in th.GRID}


def test_unknown_scores_and_labels(spark):
    odd = [(1, None, 17.0), (1, float("nan"), 4.0), (0, None, 9.0), (None, 0.99, 1000.0), (1, 0.8, 6.0)]
    out = th.cost(frame(spark, odd), 0.1, 2.0).first()
    assert (out["caught"], out["missed"], out["false_alarms"], out["total_cost"]) == (1, 2, 0, 21.0)


def test_cost_view(spark):
    view = th.cost_view(th.outcomes(frame(spark)), 30.0).first()
    losses = sum(a for y, _, a in PAYMENTS if y)
    best = min(counted(PAYMENTS, t)[3] + 30.0 * counted(PAYMENTS, t)[2] for t in th.GRID)
    assert view["no_block_loss"] == losses and view["total_cost"] == pytest.approx(best)
    assert view["saving"] == pytest.approx(losses - best)
    summary = th.curve_summary(frame(spark)).first()
    assert (summary["row_count"], summary["fraud_count"], summary["fraud_amount"]) == (9, 4, losses)


def test_groups_do_not_mix(spark):
    two = frame(spark).withColumn("model", F.lit("x")).union(frame(spark, PAYMENTS[:3]).withColumn("model", F.lit("y")))
    got = {(r["model"], r["threshold"]): r["caught"] for r in th.points(two, group=["model"]).collect()}
    for name, payments in (("x", PAYMENTS), ("y", PAYMENTS[:3])):
        assert all(got[name, t] == counted(payments, t)[0] for t in th.GRID)
