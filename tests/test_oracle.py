"""Every registered query against its SQL oracle."""

import os
import sys

import pytest
from conftest import MEDIUM, SMALL

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from compare import connect, difference  # noqa: E402

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from riskloom.oracle import oracle  # noqa: E402
from riskloom.queries import registry  # noqa: E402

NAMES = sorted(oracle_sql())


def test_every_query_has_an_oracle():
    assert set(registry()) == set(oracle())
    assert set(registry()) <= set(queries()) and set(oracle()) <= set(oracle_sql())
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0 and "fraud_rate" in df.columns


@pytest.fixture(scope="module")
def connection():
    return connect(SMALL)


@pytest.fixture(scope="module")
def larger():
    return connect(MEDIUM)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_oracle(spark, connection, name):
    assert difference(spark, connection, SMALL, name) is None


@pytest.mark.parametrize("name", ["agg_feature_buckets", "agg_feature_values", "feature_lift", "fit_domains", "normalize_domain", "ranking_metrics"])
def test_query_equals_oracle_where_groups_are_large_enough(spark, larger, name):
    assert difference(spark, larger, MEDIUM, name) is None
