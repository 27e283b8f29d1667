from datetime import date, datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.sources import contracts as C
from riskloom.sources import dated, raw, sinks

DAY, NEXT = date(2024, 1, 1), date(2024, 1, 2)
SCHEMA = C.PREDICTION_SCHEMA


def predictions(spark, *ids_and_days):
    now = datetime(2024, 1, 3)
    data = [(i, d, 0.5, "m", now, now) for i, d in ids_and_days]
    return spark.createDataFrame(data, SCHEMA)


def test_contract_sizes():
    assert len(C.transaction_types()) == 394
    assert len(C.transaction_types(with_label=False)) == 393
    assert sum(k == "float32" for c, k in C.transaction_types().items() if c.startswith("V")) == 76
    assert len(C.identity_types()) == 41
    assert len(C.table_schema("transactions")) == 397
    with pytest.raises(KeyError):
        C.table_schema("other")


def test_unknown_source_and_missing_file(spark, tmp_path):
    with pytest.raises(KeyError):
        raw.file_of("x", "valid_transaction")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        raw.read_raw(spark, str(tmp_path), "train_identity")


def test_csv_follows_the_contract(spark, csv_directory):
    df = raw.read_raw(spark, csv_directory, "train_transaction")
    kinds = {f.name: f.dataType for f in df.schema}
    assert kinds["M1"] == T.BooleanType() and kinds["M4"] == T.StringType()
    assert kinds["D1"] == T.LongType() and kinds["D8"] == T.DoubleType()
    assert df.count() == 240
    assert {r[0] for r in df.select("M1").distinct().collect()} == {True, False, None}
    assert raw.read_raw(spark, csv_directory, "train_transaction", nrows=7).count() == 7


def test_hyphens_in_headers_are_normalised(spark, csv_directory):
    df = raw.read_raw(spark, csv_directory, "test_identity")
    assert "id_01" in df.columns and not [c for c in df.columns if "-" in c]


def test_values_off_the_contract_fail(spark, tmp_path):
    types = C.identity_types()
    for name, bad in (("id_01", "abc"), ("id_02", "1.5")):
        folder = tmp_path / name
        folder.mkdir()
        line = ["" if c != C.PRIMARY_KEY else "1" for c in types]
        line[list(types).index(name)] = bad
        (folder / "train_identity.csv").write_text(",".join(types) + "\n" + ",".join(line) + "\n")
        with pytest.raises(Exception):
            raw.read_raw(spark, str(folder), "train_identity").collect()


def test_header_off_the_contract_fails(spark, tmp_path):
    (tmp_path / "train_identity.csv").write_text("TransactionID,surprise\n1,2\n")
    with pytest.raises(C.ContractError, match="surprise"):
        raw.read_raw(spark, str(tmp_path), "train_identity")


def test_prepare_adds_keys_and_a_null_label(spark):
    tx = spark.createDataFrame([(1, 86_399), (2, 86_400)], "TransactionID long, TransactionDT long")
    out = raw.prepare_transactions(tx, "test", date(2017, 12, 1))
    assert [r["transaction_date"] for r in out.orderBy("TransactionID").collect()] == [date(2017, 12, 1), date(2017, 12, 2)]
    assert out.where("isFraud is null and source_split = 'test'").count() == 2


def test_orphans_are_set_apart(spark):
    tx = spark.createDataFrame([(1, DAY)], "TransactionID long, transaction_date date")
    identity = spark.createDataFrame([(1,), (9,)], "TransactionID long")
    kept, rejected = raw.split_orphans(raw.attach_dates(identity, tx))
    assert [r[0] for r in kept.collect()] == [1] and [r[0] for r in rejected.collect()] == [9]
    with pytest.raises(C.ContractError, match="not unique"):
        raw.assert_unique(identity.union(identity), "TransactionID")


def test_gate_reports_missing_then_extra_then_types(spark):
    good = predictions(spark, (1, DAY))
    assert C.gate(good.select(*reversed(good.columns)), SCHEMA).columns == good.columns
    with pytest.raises(C.ContractError, match="missing.*score"):
        C.gate(good.drop("score").withColumn("more", F.lit(1)), SCHEMA)
    with pytest.raises(C.ContractError, match="unexpected.*more"):
        C.gate(good.withColumn("more", F.lit(1)), SCHEMA)
    with pytest.raises(C.ContractError, match="wrong types"):
        C.gate(good.withColumn("score", F.lit("0.5")), SCHEMA)


def test_a_day_is_replaced_alone_and_idempotently(spark, tmp_path):
    root = str(tmp_path)
    dated.write_days(predictions(spark, (1, DAY), (2, NEXT)), root, "p", SCHEMA)
    for _ in range(2):
        dated.replace_day(predictions(spark, (3, DAY), (4, DAY)), root, "p", DAY, SCHEMA)
    table = dated.read_table(spark, root, "p")
    assert sorted(r[0] for r in table.select("transaction_id").collect()) == [2, 3, 4]


def test_an_empty_replacement_clears_the_day(spark, tmp_path):
    root = str(tmp_path)
    dated.write_days(predictions(spark, (1, DAY), (2, NEXT)), root, "p", SCHEMA)
    dated.replace_day(predictions(spark), root, "p", DAY, SCHEMA)
    table = dated.read_table(spark, root, "p")
    assert [r[0] for r in table.select("transaction_id").collect()] == [2]
    assert not dated.has_day(table, DAY) and dated.has_day(table, NEXT)


def test_foreign_days_and_null_days_are_refused(spark, tmp_path):
    with pytest.raises(Exception, match="other days"):
        dated.replace_day(predictions(spark, (1, NEXT)), str(tmp_path), "p", DAY, SCHEMA)
    no_day = predictions(spark, (1, DAY)).withColumn("transaction_date", F.lit(None).cast("date"))
    with pytest.raises(Exception, match="without a partition date"):
        dated.write_days(no_day, str(tmp_path), "p")


def test_day_filter_prunes_partitions(spark, tmp_path):
    dated.write_days(predictions(spark, (1, DAY), (2, NEXT)), str(tmp_path), "p", SCHEMA)
    day = dated.on_day(dated.read_table(spark, str(tmp_path), "p"), DAY)
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and "transaction_date" in day.columns
    assert dated.on_day(dated.read_table(spark, str(tmp_path), "p"), date(2030, 1, 1)).count() == 0


def test_a_table_never_written_is_empty(spark, tmp_path):
    table = dated.read_table(spark, str(tmp_path), "nothing", SCHEMA)
    assert rows(dated.load_totals(table)) == [(0, 0)]
    assert rows(dated.describe(table.withColumn(C.INGESTED_AT, F.current_timestamp())))[0][:2] == (0, 0)


def test_gap_report_marks_absent_days(spark):
    table = predictions(spark, (1, DAY), (2, DAY), (3, date(2024, 1, 3)))
    assert rows(dated.gap_report(table, DAY, date(2024, 1, 3))) == [
        (DAY, 2, "load"),
        (NEXT, 0, "skip"),
        (date(2024, 1, 3), 1, "load"),
    ]


def test_a_heavy_day_is_written_in_several_files(spark, tmp_path):
    data = spark.range(200_000).select(
        F.col("id").alias("TransactionID"),
        F.when(F.col("id") % 10 == 0, F.lit(NEXT)).otherwise(F.lit(DAY)).alias("transaction_date"),
        F.sha2(F.col("id").cast("string"), 256).alias("ProductCD"),
    )
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, str(1 << 20))
    try:
        dated.write_days(data.repartition(8), str(tmp_path), "transactions")
    finally:
        spark.conf.set(key, before)
    heavy = list((tmp_path / "transactions" / "dt=2024-01-01").glob("*.parquet"))
    assert len(heavy) > 1
    assert dated.read_table(spark, str(tmp_path), "transactions").count() == 200_000


def test_curve_document(spark, tmp_path):
    import json

    summary = spark.createDataFrame([("m", 2)], "model string, rows long")
    curve = spark.createDataFrame([(0.02, 1), (0.01, 2)], "threshold double, caught long")
    sinks.write_curve(summary, curve, str(tmp_path / "curve"))
    payload = json.loads(spark.read.text(str(tmp_path / "curve")).first()[0])
    assert payload == {
        "summary": {"model": "m", "rows": 2},
        "rows": [{"threshold": 0.01, "caught": 2}, {"threshold": 0.02, "caught": 1}],
    }
