"""Tables whose days change with their commits, and marts that follow changed days."""

from datetime import date

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.operators import marts
from riskloom.plans import refresh
from riskloom.sources.standins import STANDIN_PARAMS as P
from riskloom.sources.versions import VersionedTable

SCHEMA = T.StructType([T.StructField("transaction_date", T.DateType()), T.StructField("n", T.LongType())])
FIRST, SECOND, THIRD = (date(2024, 1, d) for d in (1, 2, 3))


def frame(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


@pytest.fixture()
def table(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path), "numbers", SCHEMA)
    table.write_days(frame(spark, (FIRST, 1), (FIRST, 2), (SECOND, 3)))
    return table


def content(table, **how):
    return sorted((r["transaction_date"], r["n"]) for r in table.read(**how).collect())


def test_readers_see_a_replacement_with_its_commit(spark, table):
    before = table.latest()
    reader = table.read()
    # Files are written, the commit is not.
    written = table._write(frame(spark, (FIRST, 10)))
    assert content(table) == [(FIRST, 1), (FIRST, 2), (SECOND, 3)]
    after = table.commit(written)
    assert content(table) == [(FIRST, 10), (SECOND, 3)]
    # Those that began before go on reading what they began with, in every partition.
    assert sorted(r["n"] for r in reader.collect()) == [1, 2, 3] and content(table, commit=before)[0] == (FIRST, 1)
    assert table.changed_since(before.number) == [FIRST] and table.changed_since(after.number) == []
    assert table.clean() == 0  # the first version still holds the second day
    table.replace_day(frame(spark, (SECOND, 4)), SECOND)
    assert table.clean() == 1 and content(table) == [(FIRST, 10), (SECOND, 4)]


def test_broken_and_refused_writes_change_nothing(spark, table):
    before = table.latest()
    broken = frame(spark, (FIRST, 5)).withColumn("n", F.raise_error(F.lit("broken")).cast("long"))
    for call in (
        lambda: table.write_days(broken),
        lambda: table.replace_day(frame(spark, (FIRST, 5), (SECOND, 6)), FIRST),
        lambda: table.write_days(frame(spark, (None, 5))),
        lambda: table.write_days(frame(spark, (FIRST, 5)).withColumn("m", F.lit(1))),
    ):
        with pytest.raises(Exception):  # noqa: B017
            call()
    assert table.latest() == before and content(table) == [(FIRST, 1), (FIRST, 2), (SECOND, 3)]


def test_two_writers_keep_both_changes(spark, table, monkeypatch):
    other, real = VersionedTable(spark, table.path.rsplit("/", 1)[0], "numbers", SCHEMA), table.latest
    mine, theirs = table._write(frame(spark, (FIRST, 7))), other._write(frame(spark, (THIRD, 8)))
    old = [real()]

    def stale():
        # The first look is from before the other writer's commit.
        if old:
            other.commit(theirs)
            return old.pop()
        return real()

    monkeypatch.setattr(table, "latest", stale)
    table.commit(mine)
    assert content(other) == [(FIRST, 7), (SECOND, 3), (THIRD, 8)]


def test_empty_replacements_and_empty_tables(spark, table, tmp_path):
    table.replace_day(frame(spark), FIRST)
    assert content(table) == [(SECOND, 3)]
    assert content(table, days=[FIRST, THIRD]) == [] and content(table, days=[SECOND]) == [(SECOND, 3)]
    none = VersionedTable(spark, str(tmp_path), "none", SCHEMA)
    assert none.read().count() == 0 and none.latest().number == 0
    none.write_days(frame(spark))
    assert none.read().columns == ["transaction_date", "n", "dt"]


def test_refresh_reads_changed_days_and_equals_a_rebuild(spark, standins, tmp_path):
    tx, identity = standins.tx, standins.identity.join(standins.tx.select("transaction_id", "transaction_date"), "transaction_id")
    tables = {n: VersionedTable(spark, str(tmp_path), n, df.schema) for n, df in (("tx", tx), ("identity", identity))}
    base_schema = T.StructType([f for f in marts.pipeline_base(marts.fct_transactions(tx, identity)).schema])
    base = refresh.base_table(spark, str(tmp_path), base_schema)
    days = [r[0] for r in tx.select("transaction_date").distinct().orderBy("transaction_date").collect()]
    for n, df in (("tx", tx), ("identity", identity)):
        tables[n].write_days(df.where(F.col("transaction_date") < F.lit(days[-1])))

    def now():
        full = marts.fct_transactions(*(tables[n].read().drop("dt") for n in ("tx", "identity")))
        return rows(marts.agg_pipeline_daily(full, P)), rows(refresh.agg_pipeline_daily(base, P))

    assert refresh.refresh_pipeline(tables["tx"], tables["identity"], base) == days[:-1]
    assert refresh.refresh_pipeline(tables["tx"], tables["identity"], base) == []
    tables["tx"].replace_day(tx.where((F.col("transaction_date") == F.lit(days[5])) & (F.col("transaction_id") % 3 == 0)), days[5])
    tables["identity"].replace_day(identity.where("false"), days[7])
    tables["tx"].write_days(tx.where(F.col("transaction_date") == F.lit(days[-1])))
    tables["tx"].replace_day(tx.where("false"), days[9])
    assert refresh.refresh_pipeline(tables["tx"], tables["identity"], base) == [days[5], days[7], days[9], days[-1]]
    rebuilt, refreshed = now()
    assert refreshed == rebuilt and days[9] not in {r[0] for r in refreshed}
    changed = tables["tx"].read([days[5]])
    files = {f.rsplit("dt=", 1)[1][:10] for f in changed.inputFiles()}
    assert files == {str(days[5])}
