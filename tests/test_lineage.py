"""Stored intermediates: where they go, and that they do not stay."""

import os
import subprocess
import sys
import time

import pytest

from riskloom.functions import lineage

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_discard(spark):
    path = lineage.temporary_path(spark, "gone")
    spark.range(3).write.parquet(path)
    assert spark.read.parquet(path).count() == 3
    lineage.discard(spark, path)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


class Cluster:
    """A session of a cluster, as far as the choice of a folder looks at it."""

    def __init__(self, folder):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = self
        self.master = "spark://host:7077"

    def getCheckpointDir(self):
        return None


def test_clusters_need_a_shared_folder():
    assert lineage.shared_folder(Cluster("hdfs://store/scratch/")) == "hdfs://store/scratch"
    for folder, words in ((None, "set spark.checkpoint.dir"), ("/tmp/x", "one machine"), ("file:///tmp/x", "one machine")):
        with pytest.raises(RuntimeError, match=words):
            lineage.shared_folder(Cluster(folder))


def test_nothing_is_left_when_the_driver_ends(tmp_path):
    code = f"""
import sys; sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession
from riskloom.functions.lineage import materialized
spark = SparkSession.builder.master("local[1]").config("spark.checkpoint.dir", {str(tmp_path)!r}).config("spark.ui.enabled", "false").getOrCreate()
assert materialized(spark.range(5)).count() == 5
import os; assert any(n.startswith("riskloom-") for n in os.listdir({str(tmp_path)!r}))
spark.stop()
"""
    subprocess.run([sys.executable, "-c", code], check=True, capture_output=True, timeout=120)
    # The JVM outlives Python by a moment.
    until = time.time() + 60
    while time.time() < until and any(n.startswith("riskloom-") for n in os.listdir(tmp_path)):
        time.sleep(0.5)
    assert not [n for n in os.listdir(tmp_path) if n.startswith("riskloom-")]


def test_a_scope_discards_what_it_stored(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(lineage, "shared_folder", lambda _: f"file://{tmp_path}")
    with lineage.scope(spark):
        outer = lineage.materialized(spark.range(3))
        with lineage.scope(spark):
            inner = lineage.materialized(outer.selectExpr("id + 1 AS id"))
            result = lineage.kept(inner.selectExpr("id * 2 AS id"))
        assert len(os.listdir(tmp_path)) == 2
        assert sorted(r.id for r in result.collect()) == [2, 4, 6]
        with pytest.raises(Exception, match="(?i)not.?exist|not.?found"):
            inner.collect()
        with pytest.raises(ValueError), lineage.scope(spark):
            lineage.materialized(outer)
            raise ValueError("a broken job leaves nothing either")
        assert len(os.listdir(tmp_path)) == 2
    assert not os.listdir(tmp_path)
    lineage.materialized(spark.range(1))
    assert len(os.listdir(tmp_path)) == 1
