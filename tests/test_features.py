"""Derived features and training inputs. All cases and numbers are this project's own."""

import logging

import pytest
from conftest import rows
from pyspark.sql import functions as F

from riskloom.functions import columns as X
from riskloom.operators import features, models
from riskloom.operators.dataset import DROP_COLUMNS, KEYS, labelled_rows, split_rows
from riskloom.operators.marts import dim_split, train_rows
from riskloom.params import Params
from riskloom.sources.standins import STANDIN_PARAMS

MAIL = "recipient_email_domain"


def mails(spark, *domains):
    """Payments of 12.5 each, one per domain."""
    data = [(i, 12.5, d) for i, d in enumerate(domains)]
    return spark.createDataFrame(data, f"transaction_id long, transaction_amt double, {MAIL} string")


def built(df, keep, params=None):
    done = features.build(df, params or Params(), {MAIL: keep}, ("transaction_id",))
    return [r[MAIL] for r in done.orderBy("transaction_id").collect()]


def test_domains_follow_the_given_list_whatever_the_data_holds(spark):
    seen = ["aol.com", "yahoo.es", None, "live.com.mx", "yahoo.com.br", "nowhere.example"]
    want = ["aol.com", "yahoo.com", X.MISSING, "other", "other", "other"]
    keep = ["aol.com", "yahoo.com"]
    assert built(mails(spark, *seen), keep) == want
    assert built(mails(spark, *seen), spark.createDataFrame([(d,) for d in keep], "domain string")) == want
    assert built(mails(spark, seen[1]), keep) == want[1:2]


def test_aliases_are_whole_values(spark):
    """A pattern for yahoo.* would take yahoo.com.br as well."""
    df = mails(spark, *X.DOMAIN_ALIASES, "yahoo.com.br", "hotmail.fr.example", "GMAIL")
    got = [r[0] for r in df.orderBy("transaction_id").select(X.canonical_domain(MAIL)).collect()]
    assert got == [*X.DOMAIN_ALIASES.values(), "yahoo.com.br", "hotmail.fr.example", "GMAIL"]


def test_fitted_lists_count_services_and_are_stored(spark):
    few = Params(domain_min_count=3)
    df = mails(spark, "gmail", "gmail.com", "gmail.com", "web.de", "web.de", None, None, None, None)
    fitted = features.fit_domains(df, few)
    assert [r["domain"] for r in fitted[MAIL].collect()] == ["gmail.com"]
    assert "Scan parquet" in fitted[MAIL]._jdf.queryExecution().executedPlan().toString()
    assert built(df, fitted[MAIL], few) == ["gmail.com"] * 3 + ["other"] * 2 + [X.MISSING] * 4
    assert features.fit_domains(df.drop(MAIL), few) == {}


def test_amount_bands(spark):
    cases = {
        -0.01: X.MISSING, 0.0: "<25", 24.5: "<25", 25.0: "25-50", 49.999: "25-50", 50.0: "50-100", 99.0: "50-100",
        100.0: "100-250", 250.0: "250-500", 499.99: "250-500", 500.0: "500+", 1e9: "500+", float("inf"): X.MISSING,
        float("nan"): X.MISSING, None: X.MISSING,
    }
    df = spark.createDataFrame([(v, band) for v, band in cases.items()], "v double, want string")
    assert df.where(X.amount_band("v") != F.col("want")).count() == 0


def test_categories_are_filled_and_keys_are_not(spark, caplog):
    df = spark.createDataFrame([(None, None, None, None)], "k string, word string, size int, flag boolean")
    df = df.withColumn("at", F.lit("2020-05-17").cast("date"))
    with caplog.at_level(logging.WARNING):
        out = features.categorical_fill(df, ("k",))
    assert out.first().asDict() == {"k": None, "word": X.MISSING, "size": None, "flag": None, "at": "2020-05-17"}
    assert "'at': 'date'" in caplog.text


def test_building_leaves_its_input_alone(spark):
    df = mails(spark, "web.de", None)
    before = rows(df)
    features.build(df, Params(), {MAIL: []})
    assert rows(df) == before and df.columns == ["transaction_id", "transaction_amt", MAIL]


def test_splits_are_disjoint_and_ordered(spark, standins):
    dim = dim_split(standins.tx, STANDIN_PARAMS)
    parts = {s: split_rows(standins.tx, standins.identity, dim, s) for s in ("train", "valid", "test")}
    spans = [parts[s].agg(F.min("transaction_date"), F.max("transaction_date")).first() for s in parts]
    flat = [d for span in spans for d in span]
    assert flat == sorted(flat) and len(set(flat)) == 6
    for p in parts.values():
        features = set(p.columns) - set(KEYS)
        assert features.isdisjoint(DROP_COLUMNS) and {"transaction_hour", "has_identity"} <= features
    assert sum(p.count() for p in parts.values()) == standins.tx.count()


def test_statistics_come_from_training_days_only(spark, standins):
    dim = dim_split(standins.tx, STANDIN_PARAMS)
    own = train_rows(standins.tx, dim)
    assert own.agg(F.max("transaction_date")).first()[0] < STANDIN_PARAMS.valid_start
    assert own.count() == split_rows(standins.tx, standins.identity, dim, "train").count()
    # A domain that only validation days hold is never kept.
    late = standins.tx.withColumn(
        MAIL, F.when(F.col("transaction_date") >= F.lit(STANDIN_PARAMS.valid_start), "late.example").otherwise(F.col(MAIL))
    )
    fitted = features.fit_domains(train_rows(late, dim), Params(domain_min_count=1))
    assert fitted[MAIL].where("domain = 'late.example'").count() == 0


def test_columns_are_chosen_once(spark, standins):
    dim = dim_split(standins.tx, STANDIN_PARAMS)
    data = split_rows(standins.tx, standins.identity, dim, "valid", ["D2", "product_cd", "D2"])
    assert data.columns == [*KEYS, "D2", "product_cd", "transaction_hour", "has_identity"]


def test_what_is_refused(spark, standins):
    tx, identity, dim = standins.tx, standins.identity, dim_split(standins.tx, STANDIN_PARAMS)
    cases = [
        ("no split is called", lambda: split_rows(tx, identity, dim, "holdout")),
        ("no labels", lambda: labelled_rows(tx, identity, dim, "test")),
        ("no rows", lambda: labelled_rows(tx.limit(0), identity, dim, "valid")),
        ("without a label", lambda: labelled_rows(tx.withColumn("is_fraud", F.lit(None).cast("int")), identity, dim, "valid")),
        ("two splits", lambda: split_rows(tx, identity, dim.union(dim.limit(1)), "valid")),
    ]
    for words, call in cases:
        with pytest.raises(ValueError, match=words):
            call()


def test_fits_of_each_feature_set():
    names = {str(k): [n for n, _ in v] for k, v in models.FITS.items()}
    assert names == {"curated": ["dummy", "logistic", "trees"], "all": ["dummy", "trees"]}
