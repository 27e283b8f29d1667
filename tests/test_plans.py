"""The whole lifecycle on four small CSV files, and the shape of the plans."""

import json
import re
from datetime import date
from functools import partial

import pytest
from pyspark.sql import functions as F

from riskloom.operators import dataset, marts, models
from riskloom.operators.checks import CheckFailure
from riskloom.operators.features import FeatureSet
from riskloom.params import Params
from riskloom.plans import ingest, modelling, profiling, transform
from riskloom.queries import registry
from riskloom.sources import contracts as C
from riskloom.sources import dated

# 240 labelled payments 7,000 seconds apart cover 2017-12-02 to 2017-12-21; unlabelled ones follow from 2018-01-03.
P = Params(valid_start=date(2017, 12, 15), min_bucket_rows=5, domain_min_count=5)
QUICK = [(n, partial(fit, rounds=3) if n == "trees" else fit) for n, fit in models.FITS[FeatureSet.CURATED]]


@pytest.fixture(scope="module")
def lake(spark, csv_directory, tmp_path_factory):
    folder = tmp_path_factory.mktemp("lake")
    raw, mart, model = (str(folder / n) for n in ("raw", "mart", "model"))
    report = {r["dataset"]: r for r in ingest.ingest(spark, csv_directory, raw, P).collect()}
    return {"raw": raw, "mart": mart, "model": model, "report": report}


def test_ingest_reports_and_rejects(spark, lake):
    assert lake["report"]["transactions"]["row_count"] == 320
    assert lake["report"]["identity"]["row_count"] == 76
    rejected = spark.read.parquet(dated.table_path(lake["raw"], ingest.REJECTED))
    assert [r[C.PRIMARY_KEY] for r in rejected.collect()] == [1999]
    table = dated.read_table(spark, lake["raw"], "transactions")
    assert table.where("source_split = 'test' and isFraud is not null").count() == 0
    assert table.where("dt != transaction_date").count() == 0


def test_ingest_twice_changes_nothing(spark, csv_directory, lake):
    again = {r["dataset"]: r for r in ingest.ingest(spark, csv_directory, lake["raw"], P).collect()}
    assert again == lake["report"]


def test_transform_train_score_publish(spark, lake, tmp_path):
    built = transform.transform(spark, lake["raw"], lake["mart"], P)
    assert set(built) == set(transform.MARTS)
    assert built["fct_transactions"].count() == 320
    assert tuple(built["fct_transactions"].columns) == marts.FACT_COLUMNS
    table = modelling.train(spark, lake["raw"], lake["mart"], lake["model"], P, fits=QUICK)
    assert sorted(r["model"] for r in table.collect()) == ["dummy", "logistic", "trees"]

    first, last = date(2018, 1, 1), date(2018, 1, 10)
    report = modelling.score_range(spark, lake["raw"], lake["model"], "trees-curated", first, last, P)
    assert report.where("action = 'load'").agg(F.sum("row_count")).first()[0] == 80

    transform.transform(spark, lake["raw"], lake["mart"], P)
    daily = transform.read_mart(spark, lake["mart"], "agg_predictions_daily")
    assert daily.agg(F.sum("scored_count")).first()[0] == 80
    results = transform.read_mart(spark, lake["mart"], transform.RESULTS)
    assert results.count() == 55 and results.where("not passed").count() == 0

    path = str(tmp_path / "curve")
    modelling.publish_curve(spark, lake["raw"], lake["mart"], lake["model"], "trees-curated", path, P)
    payload = json.loads(spark.read.text(path).first()[0])
    assert len(payload["rows"]) == 99 and payload["summary"]["model"] == "trees-curated"
    assert payload["summary"]["rows"] == modelling.evaluate(
        spark, lake["raw"], lake["mart"], lake["model"], "trees-curated", P
    ).first()["row_count"]


def test_a_stored_model_is_priced_and_explained(spark, lake):
    transform.transform(spark, lake["raw"], lake["mart"], P)
    modelling.train(spark, lake["raw"], lake["mart"], lake["model"], P, fits=[f for f in QUICK if f[0] == "trees"])
    where = (spark, lake["raw"], lake["mart"], lake["model"], "trees-curated", P)
    costs = modelling.cost_table(*where).collect()
    assert sorted(r["fp_cost"] for r in costs) == [1.0, 5.0, 10.0, 25.0, 50.0, 100.0]
    assert all(r["total_cost"] == pytest.approx(r["missed_amount"] + r["false_alarms"] * r["fp_cost"]) for r in costs)
    found = modelling.explain_trees(*where)
    assert found["top"].count() == 9 and set(found) == {"top", "families", "cumulative"}
    assert found["cumulative"].where("top_n = 10").first()["feature_count"] == 9


def test_all_columns_can_be_trained_on(spark, lake):
    transform.transform(spark, lake["raw"], lake["mart"], P)
    everything = models.FeatureSet.ALL
    table = modelling.train(spark, lake["raw"], lake["mart"], lake["model"], P, everything, [f for f in QUICK if f[0] != "logistic"]).collect()
    assert {r["model"]: r["n_features"] for r in table} == {"dummy": 394, "trees": 394}


def test_failed_checks_stop_the_transform(spark, lake, tmp_path):
    """A boundary in the future leaves no validation days, which is fine; a copied day of another split is not."""
    raw = str(tmp_path / "raw")
    tx = dated.read_table(spark, lake["raw"], "transactions").drop(dated.DT)
    twice = tx.union(tx.limit(1))
    dated.write_days(twice, raw, "transactions")
    dated.write_days(dated.read_table(spark, lake["raw"], "identity").drop(dated.DT), raw, "identity")
    with pytest.raises(CheckFailure, match="unique transactions.TransactionID"):
        transform.transform(spark, raw, str(tmp_path / "mart"), P)
    stored = transform.read_mart(spark, str(tmp_path / "mart"), transform.RESULTS)
    assert stored.where("not passed").count() >= 1


def test_profiles_are_stored(spark, csv_directory, tmp_path):
    out = profiling.profile_files(spark, csv_directory, str(tmp_path), P)
    again = spark.read.csv(str(tmp_path / "column_profile_train_transaction"), header=True)
    assert again.count() == 394
    joined = out["join_integrity_test"].first()
    assert (joined["orphans"], joined["identity_rows"]) == (1, 17)
    pairs = out["schemas_identity"].where("side = 'left' and other is not null")
    assert pairs.count() == 38


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# Queries whose unpartitioned windows or one-row joins are over bounded rows: days, candidates, feature names, ranges.
BOUNDED = {
    "deseasonalize", "origin_search", "contribution_top", "contribution_families", "contribution_cumulative",
    "holiday_detail", "tree_importance", "entity_monotonicity", "entity_monotonicity_narrow",
}
# Queries that fit models while they are built.
FITTED = {"model_comparison", "logistic_optimum", "stored_model_day", "tree_contributions", "tree_importance"}


@pytest.mark.parametrize("name", sorted(set(registry()) - {"check_suite"} - FITTED))
def test_plans_hold_no_global_window_and_no_cross_join(spark, name):
    plan = plan_of(registry()[name](spark, "/root/testdata/sf0.001"))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    if name not in BOUNDED:
        specs = re.findall(r"Window \[.*?\], \[(.*?)\]", plan)
        assert "Window" not in plan or all(specs)


def test_scans_read_only_what_they_need(spark):
    plan = plan_of(registry()["agg_predictions_daily"](spark, "/root/testdata/sf0.001"))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,props:string>" in plan


def test_days_prune_partitions_for_training_and_scoring(spark, lake):
    transform.transform(spark, lake["raw"], lake["mart"], P)
    valid = modelling._split(spark, lake["raw"], lake["mart"], "valid", models.FeatureSet.CURATED)
    assert "dynamicpruning" in plan_of(valid)
    assert "dt" not in valid.columns
    tx, identity = modelling._staged(spark, lake["raw"])
    day = dataset.day_rows(tx, identity, date(2018, 1, 4))
    filters = re.findall(r"PartitionFilters: \[(.*?)\]", plan_of(day))
    assert len(filters) == 2 and all("dt" in f for f in filters)
    assert day.count() > 0 and day.where("has_identity").count() > 0
