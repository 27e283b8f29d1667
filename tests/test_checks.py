from datetime import date

import pytest
from conftest import rows

from riskloom.operators import checks as Q


def failures(results):
    return {(r["check"], r["column"]): r["violations"] for r in results.where("not passed").collect()}


def test_the_contract_holds_55_promises():
    assert len(Q.CONTRACT) == 55 and len(set(Q.CONTRACT)) == 55


def test_row_rules_share_one_scan(spark, tmp_path):
    spark.createDataFrame([(1, "a", 5.0), (None, "z", None), (3, None, -1.0)], "id long, kind string, x double").write.parquet(
        str(tmp_path / "t")
    )
    df = spark.read.parquet(str(tmp_path / "t"))
    rules = [
        *Q.not_null("t", "id", "kind"),
        Q.accepted_values("t", "kind", "a", "b"),
        Q.accepted_range("t", "x", 0),
        Q.accepted_range("t", "x", high=4),
        Q.accepted_range("t", "id", 1, 3),
    ]
    out = Q.row_checks(df, rules)
    assert out._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert [r["violations"] for r in out.collect()] == [1, 1, 1, 1, 1, 0]


def test_key_rules(spark):
    parent = spark.createDataFrame([(1,), (2,)], "id long")
    child = spark.createDataFrame([(1,), (1,), (7,), (7,), (None,), (None,)], "id long")
    assert rows(Q.repeated_keys(child, "id")) == [(1, 2), (7, 2)]
    assert rows(Q.orphan_keys(child, "id", parent, "id")) == [(7, 2)]


def test_runner_reports_and_raises(spark):
    day = date(2024, 1, 1)
    dim = spark.createDataFrame([(day, "valid"), (day, "train"), (None, "later")], "transaction_date date, ml_split string")
    own = [c for c in Q.CONTRACT if c.table == "dim_split"]
    results = Q.run_checks({"dim_split": dim}, own)
    assert failures(results) == {
        ("unique", "transaction_date"): 1,
        ("not_null", "transaction_date"): 1,
        ("accepted_values", "ml_split"): 1,
        ("train_before_valid", "transaction_date"): 1,
    }
    with pytest.raises(Q.CheckFailure, match="train_before_valid"):
        Q.enforce(results)
    Q.enforce(results.where("passed"))


def test_totals(spark):
    tables = {
        "agg": spark.createDataFrame([(2,), (3,)], "tx_count long"),
        "fact": spark.range(6).toDF("id"),
        "empty": spark.createDataFrame([], "tx_count long"),
    }
    rule = Q.Check("total_equals_rows", "agg", "tx_count", other="fact")
    assert Q.table_check(rule, tables).first()["violations"] == 1
    assert Q.table_check(Q.Check("equal_rowcount", "agg", other="fact"), tables).first()["violations"] == 4
    assert Q.table_check(Q.Check("total_equals_rows", "empty", "tx_count", other="fact"), tables).first()["violations"] == 6
    with pytest.raises(KeyError):
        Q.table_check(Q.Check("other", "agg"), tables)
