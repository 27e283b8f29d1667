"""The registered queries: every operator over the whole test tables, with portable output.

Dates and timestamps leave as text, whole numbers with NULLs as doubles, and doubles rounded to six digits, so that two
engines which add up in different orders give equal values. The operators themselves return typed, unrounded columns.
"""

from __future__ import annotations

import functools
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions import columns as X
from riskloom.functions import text
from riskloom.functions.lineage import materialized, temporary_path
from riskloom.operators import checks as Q
from riskloom.operators import (
    dataset,
    explain,
    features,
    marts,
    models,
    origin,
    profile,
    scoring,
    sketches,
    staging,
    store,
    thresholds,
)
from riskloom.operators.entity import entity_monotonicity as steps_of_entities
from riskloom.operators.ordered import ranking_metrics as metrics_of
from riskloom.sources import contracts as C
from riskloom.plans import refresh
from riskloom.sources import dated, raw, sinks, versions
from riskloom.sources.standins import STANDIN_PARAMS as P
from riskloom.sources.standins import Standins

Query = Callable[[SparkSession, str], DataFrame]

READ_DAY = date(2024, 1, 20)
SCORED_DAY = date(2024, 1, 26)
RANGE = (date(2023, 12, 28), date(2024, 2, 3))
ORDERS_ORIGIN = date(1995, 1, 1)
GIVEN_ORIGIN = date(2017, 12, 1)
TRAILING_DAYS = 7
SAMPLE_ROWS = 1000
# Rounds of trees in queries that show what is done with a fitted model, not how good it is.
FEW_ROUNDS = 30
PUBLISHED = datetime(2024, 1, 25)
LIFT_FEATURES = ("product_cd", "card4", "card6", "purchaser_email_domain", "C13", "D2")
CARD_KEYS = ("card1", "card2", "card3", "card5", "addr1")
MOVING_COLUMNS = ("C1", "C13", "D2", "D3")
WEIGHTS = {
    "transaction_amt": 0.01,
    "C13": 0.3,
    "C1": -0.02,
    "D2": -0.2,
    "D3": 0.01,
    "V70": 0.5,
    "V294": 0.15,
    "card1": 0.002,
    "C5": 0.0,
}
# Whole-number columns of the stand-in tables that hold NULLs.
NULLABLE = {"is_fraud", "isFraud", "card2", "addr1", "dist1", "dist2", "C13", "D2", "D3"}
# Added before rounding: a mean that is an exact half in decimal falls to one side whatever its last bit is.
NUDGE = 1e-9

_REGISTRY: dict[str, Query] = {}


def portable(df: DataFrame) -> DataFrame:
    out = []
    for f in df.schema:
        c = text.name(f.name)
        if isinstance(f.dataType, T.DateType):
            e = f"CAST({c} AS STRING)"
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            e = f"date_format({c}, 'yyyy-MM-dd HH:mm:ss.SSSSSS')"
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            e = f"round({c} + {text.literal(NUDGE)}, 6)"
        else:
            e = f"CAST({c} AS DOUBLE)" if f.name in NULLABLE else c
        out.append(f"{e} AS {c}")
    return df.selectExpr(*out)


def query(fn: Callable[[Standins], DataFrame]) -> Callable[[Standins], DataFrame]:
    """Register a query under its function name."""

    @functools.wraps(fn)
    def run(spark: SparkSession, directory: str) -> DataFrame:
        return portable(fn(Standins(spark, directory)))

    _REGISTRY[fn.__name__] = run
    return fn


def registry() -> dict[str, Query]:
    return dict(_REGISTRY)


# Sources and sinks


@query
def bool_parse(s: Standins) -> DataFrame:
    written = F.when(F.col("M4") == "M0", "T").when(F.col("M4") == "M1", "F").otherwise(F.col("M4"))
    files = s.tx.select("transaction_id", written.alias("flag"))
    return files.selectExpr("transaction_id", f"{raw.typed('flag', 'boolean')} AS flag")


@query
def prepare_split(s: Standins) -> DataFrame:
    files = s.raw_transactions.drop(C.PARTITION_KEY, C.INGESTED_AT)
    parts = []
    for split in ("train", "test"):
        part = files.where(F.col(C.SPLIT) == split).drop(C.SPLIT)
        part = part.drop(C.LABEL) if split == "test" else part.withColumn(C.LABEL, F.col(C.LABEL).cast("long"))
        parts.append(raw.prepare_transactions(part, split, P.origin))
    return parts[0].unionByName(parts[1]).drop(C.INGESTED_AT)


@query
def read_day(s: Standins) -> DataFrame:
    return dated.on_day(s.raw_transactions, READ_DAY)


@query
def replaced_day(s: Standins) -> DataFrame:
    """Predictions written by day, one day replaced twice by other scores, read back."""
    root = temporary_path(s.spark, "predictions")
    dated.write_days(s.predictions, root, "predictions")
    corrected = dated.on_day(s.predictions, READ_DAY).withColumn("score", F.col("score") + 1)
    for _ in range(2):
        dated.replace_day(corrected, root, "predictions", READ_DAY)
    return dated.read_table(s.spark, root, "predictions").select(s.predictions.columns)


PREDICTION_ROWS = T.StructType([f for f in C.PREDICTION_SCHEMA if f.name not in ("model_trained_at", "scored_at")])


@query
def versioned_day(s: Standins) -> DataFrame:
    """As ``replaced_day``, in a table whose days change with its commits. A refused write in between changes nothing."""
    table = versions.VersionedTable(s.spark, temporary_path(s.spark, "versions"), "predictions", PREDICTION_ROWS)
    table.write_days(s.predictions)
    corrected = dated.on_day(s.predictions, READ_DAY).withColumn("score", F.col("score") + 1)
    for _ in range(2):
        table.replace_day(corrected, READ_DAY)
    return table.read().select(s.predictions.columns)


@query
def refreshed_pipeline(s: Standins) -> DataFrame:
    """The load mart after one day of the transactions was replaced by half of its rows, refreshed from that day alone."""
    root = temporary_path(s.spark, "refresh")
    tables = {
        name: versions.VersionedTable(s.spark, root, f"staged_{name}", df.schema)
        for name, df in (("tx", s.tx), ("identity", _dated_identity(s)))
    }
    tables["tx"].write_days(s.tx)
    tables["identity"].write_days(_dated_identity(s))
    day = s.tx.where(F.col("transaction_date") == F.lit(READ_DAY))
    schema = T.StructType([f for f in marts.agg_pipeline_daily(fct_transactions(s), P).schema if f.name != "tx_count_vs_baseline"])
    base = refresh.base_table(s.spark, root, schema)
    refresh.refresh_pipeline(tables["tx"], tables["identity"], base)
    tables["tx"].replace_day(day.where("transaction_id % 2 = 0"), READ_DAY)
    read = refresh.refresh_pipeline(tables["tx"], tables["identity"], base)
    if read != [READ_DAY]:
        raise AssertionError(f"the refresh has read {read}")
    return refresh.agg_pipeline_daily(base, P)


def _dated_identity(s: Standins) -> DataFrame:
    return s.identity.join(s.tx.select("transaction_id", "transaction_date"), "transaction_id")


def _as_file(s: Standins, source: str, root: str) -> None:
    """The stand-in rows of a source as a CSV file with every column of its contract; what the events lack is empty."""
    own = s.raw_identity if source.endswith("identity") else s.raw_transactions.where(f"{C.SPLIT} = '{source.split('_')[0]}'")
    have = {f.name: f.dataType for f in own.schema}
    written = []
    for c, kind in raw.SOURCES[source].types.items():
        value = f"CAST({c if c in have else 'NULL'} AS STRING)"
        if c in have and kind == "Int32":
            value = f"CAST(CAST({c} AS BIGINT) AS STRING)"
        if c == "M1":  # a flag, as the files spell them
            value = "CASE M4 WHEN 'M0' THEN 'T' WHEN 'M1' THEN 'F' END"
        written.append(f"{value} AS `{c.replace('id_', 'id-') if source.startswith('test') else c}`")
    own.selectExpr(*written).write.option("header", True).csv(f"{root}/{raw.SOURCES[source].file}")


def _files(s: Standins, *sources: str) -> str:
    root = temporary_path(s.spark, "files")
    for source in sources:
        _as_file(s, source, root)
    return root


FILE_COLUMNS = "TransactionID TransactionDT TransactionAmt ProductCD card1 card2 card4 addr1 dist1 P_emaildomain C1 C13 D2 M1 M4".split()


@query
def csv_transactions(s: Standins) -> DataFrame:
    """The transactions written as files and read back under their contract."""
    root = _files(s, "train_transaction", "test_transaction")
    parts = [raw.read_raw(s.spark, root, f"{split}_transaction").select(FILE_COLUMNS) for split in ("train", "test")]
    return parts[0].unionByName(parts[1])


@query
def csv_identity(s: Standins) -> DataFrame:
    """A file with hyphens in its header, under normalised names."""
    root = _files(s, "test_identity")
    return raw.read_raw(s.spark, root, "test_identity").select("TransactionID", "DeviceType", "DeviceInfo", "id_30", "id_31")


@query
def csv_first_rows(s: Standins) -> DataFrame:
    """How many rows a read of the first ones gives, and that they are rows of the file."""
    root = _files(s, "train_transaction")
    first = raw.read_raw(s.spark, root, "train_transaction", nrows=SAMPLE_ROWS).select("TransactionID")
    rows = s.raw_transactions.select("TransactionID", F.lit(True).alias("_known"))
    return first.join(rows, "TransactionID", "left").agg(
        F.count(F.lit(1)).alias("row_count"), F.count("_known").alias("known_rows")
    )


@query
def profile_files(s: Standins) -> DataFrame:
    """The daily profile written as CSV and read back."""
    path = f"{temporary_path(s.spark, 'profile')}/daily"
    sinks.write_profile(_daily(s), path)
    shape = "day date, tx_count bigint, fraud_count double, fraud_rate double, amt_sum double"
    return s.spark.read.csv(path, header=True, schema=shape)


def _refused(call) -> str | None:
    try:
        call()
    except ValueError as e:
        return type(e).__name__
    return None


@query
def refusals(s: Standins) -> DataFrame:
    """What is refused before a fit or a write, and how: the cases are made of the tables at hand."""
    dim, unlabelled = dim_split(s), s.tx.withColumn("is_fraud", F.when(F.col("transaction_id") % 10 != 0, F.col("is_fraud")))
    rows, schema = s.predictions, PREDICTION_ROWS
    cases = {
        "split without labels": lambda: dataset.labelled_rows(s.tx, s.identity, dim, "test"),
        "rows without a label": lambda: dataset.labelled_rows(unlabelled, s.identity, dim, "valid"),
        "no rows": lambda: dataset.labelled_rows(s.tx.where("transaction_dt < 0"), s.identity, dim, "train"),
        "date in two splits": lambda: dataset.split_rows(s.tx, s.identity, dim.union(dim.limit(1)), "train"),
        "unknown split": lambda: dataset.split_rows(s.tx, s.identity, dim, "holdout"),
        "missing column": lambda: C.gate(rows.drop("score"), schema),
        "further column": lambda: C.gate(rows.withColumn("blocked", F.lit(True)), schema),
        "other type": lambda: C.gate(rows.withColumn("score", F.col("score").cast("string")), schema),
        "nothing": lambda: C.gate(rows, schema),
    }
    found = [(name, _refused(call)) for name, call in cases.items()]
    return s.spark.createDataFrame(found, "case string, refused_by string")


@query
def staged_views(s: Standins) -> DataFrame:
    """Rows of each split by SQL over the registered views."""
    staging.register_views(s.raw_transactions, s.raw_identity)
    return s.spark.sql(
        "SELECT source_split, count(*) AS row_count, count(i.transaction_id) AS with_device FROM stg_transactions t "
        "LEFT JOIN stg_identity i ON t.transaction_id = i.transaction_id GROUP BY source_split"
    )


@query
def compare_schemas(s: Standins) -> DataFrame:
    return profile.compare_schemas(s.table("events"), s.table("orders"))


@query
def list_days(s: Standins) -> DataFrame:
    return dated.present_days(s.raw_transactions)


@query
def load_summary(s: Standins) -> DataFrame:
    return dated.load_totals(s.raw_transactions)


@query
def load_report(s: Standins) -> DataFrame:
    return dated.rows_per_day(s.raw_transactions)


@query
def describe_table(s: Standins) -> DataFrame:
    return dated.describe(s.raw_transactions)


@query
def gap_report(s: Standins) -> DataFrame:
    return dated.gap_report(raw.attach_dates(s.raw_identity, s.raw_transactions), *RANGE)


# Projections


@query
def stg_transactions(s: Standins) -> DataFrame:
    return s.tx


@query
def stg_identity(s: Standins) -> DataFrame:
    return s.identity


@query
def transaction_date(s: Standins) -> DataFrame:
    return s.tx.select("transaction_id", X.transaction_date("transaction_dt", P.origin).alias("transaction_date"))


@query
def amount_band(s: Standins) -> DataFrame:
    return s.tx.select("transaction_id", X.amount_band("transaction_amt").alias("amount_band"))


def _train_domains(s: Standins) -> features.Domains:
    return features.fit_domains(marts.train_rows(s.tx, dim_split(s)), P)


@query
def normalize_domain(s: Standins) -> DataFrame:
    keep = _train_domains(s)
    out = s.tx.select("transaction_id", *features.DOMAIN_COLUMNS)
    for column in features.DOMAIN_COLUMNS:
        out = features.normalize_domain(out, column, keep[column])
    return out


@query
def categorical_fill(s: Standins) -> DataFrame:
    chosen = ("product_cd", "card4", "card6", "M4", "purchaser_email_domain", "addr1", "transaction_date")
    return features.categorical_fill(s.tx.select("transaction_id", *chosen), ("transaction_id",))


@query
def feature_columns(s: Standins) -> DataFrame:
    return dataset.split_rows(s.tx, s.identity, dim_split(s), "test").drop(*dataset.KEYS)


# Joins


@query
def fct_transactions(s: Standins) -> DataFrame:
    return marts.fct_transactions(s.tx, s.identity)


@query
def identity_dates(s: Standins) -> DataFrame:
    for side in (s.raw_identity, s.raw_transactions):
        raw.assert_unique(side, C.PRIMARY_KEY)
    dated_rows, _ = raw.split_orphans(raw.attach_dates(s.raw_identity, s.raw_transactions))
    return dated_rows


@query
def dataset_load(s: Standins) -> DataFrame:
    return dataset.split_rows(s.tx, s.identity, dim_split(s), "valid", features.CURATED_COLUMNS)


@query
def join_integrity(s: Standins) -> DataFrame:
    return profile.join_integrity(s.tx, s.identity, "transaction_id")


@query
def join_integrity_documents(s: Standins) -> DataFrame:
    return profile.join_integrity(s.table("documents"), s.table("labels"), "doc_id")


# Marts


@query
def dim_split(s: Standins) -> DataFrame:
    return marts.dim_split(s.tx, P)


@query
def agg_transactions_daily(s: Standins) -> DataFrame:
    return marts.agg_transactions_daily(fct_transactions(s))


@query
def agg_pipeline_daily(s: Standins) -> DataFrame:
    return marts.agg_pipeline_daily(fct_transactions(s), P)


@query
def agg_predictions_daily(s: Standins) -> DataFrame:
    return marts.agg_predictions_daily(s.predictions, P)


@query
def score_drift_range(s: Standins) -> DataFrame:
    """Score quantiles over the week that ends with each day, from daily sketches; whether their ranks are right."""
    stored = materialized(sketches.score_sketches(s.predictions))
    found = materialized(sketches.trailing_quantiles(stored, TRAILING_DAYS))
    return sketches.rank_bounds(found, s.predictions, TRAILING_DAYS)


@query
def agg_score_amount(s: Standins) -> DataFrame:
    return marts.agg_score_amount(s.predictions, s.tx, P)


@query
def agg_feature_buckets(s: Standins) -> DataFrame:
    return marts.agg_feature_buckets(s.tx, P)


@query
def agg_feature_values(s: Standins) -> DataFrame:
    return marts.agg_feature_values(s.tx, P)


@query
def feature_lift(s: Standins) -> DataFrame:
    return marts.feature_lift(s.tx, P, LIFT_FEATURES)


@query
def split_candidates(s: Standins) -> DataFrame:
    return marts.split_candidates(s.tx, (5, 7, 10, 14))


@query
def entity_monotonicity(s: Standins) -> DataFrame:
    return steps_of_entities(s.tx, ("card1",), MOVING_COLUMNS)


@query
def entity_monotonicity_narrow(s: Standins) -> DataFrame:
    return steps_of_entities(s.tx, CARD_KEYS, MOVING_COLUMNS)


# Profiles


def _daily(s: Standins) -> DataFrame:
    return profile.daily_profile(s.tx, "transaction_date", "transaction_id", "is_fraud", "transaction_amt")


@query
def daily_profile(s: Standins) -> DataFrame:
    # Days without labels have no fraud count.
    return _daily(s).withColumn("fraud_count", F.col("fraud_count").cast("double"))


@query
def daily_profile_summary(s: Standins) -> DataFrame:
    return profile.daily_profile_summary(_daily(s))


@query
def null_profile(s: Standins) -> DataFrame:
    return profile.null_profile(s.tx)


@query
def null_profile_summary(s: Standins) -> DataFrame:
    return profile.null_summary(profile.null_profile(s.tx))


@query
def type_counts(s: Standins) -> DataFrame:
    return profile.type_counts(profile.null_profile(s.tx))


@query
def column_profile(s: Standins) -> DataFrame:
    return profile.column_profile(s.table("events"))


@query
def column_profile_customer(s: Standins) -> DataFrame:
    return profile.column_profile(s.table("customer"))


@query
def column_profile_lineitem(s: Standins) -> DataFrame:
    return profile.column_profile(s.table("lineitem"))


@query
def column_advice(s: Standins) -> DataFrame:
    return profile.column_advice(s.table("lineitem")).withColumn("few", F.col("few").cast("double"))


@query
def compare_tables(s: Standins) -> DataFrame:
    """Columns of the labelled and the unlabelled transactions; counts of values where the sketches are exact."""
    parts = [s.tx.where(f"source_split = '{split}'").drop("ingested_at") for split in ("train", "test")]
    found = sketches.compare_tables(*parts)
    few = (F.col("left_distinct") < sketches.EXACT_SET) & (F.col("right_distinct") < sketches.EXACT_SET)
    counted = {c: F.when(few, F.col(c)).cast("double") for c in ("left_distinct", "right_distinct", "common_distinct", "similarity")}
    return found.withColumns(counted)


@query
def key_difference(s: Standins) -> DataFrame:
    return sketches.key_difference(s.table("documents"), "doc_id", s.table("labels"), "doc_id")


@query
def fit_domains(s: Standins) -> DataFrame:
    return features.frequent_domains(marts.train_rows(s.tx, dim_split(s)), features.DOMAIN_COLUMNS, P.domain_min_count)


@query
def deseasonalize(s: Standins) -> DataFrame:
    return origin.deseasonalize(origin.daily_counts(s.table("orders"), _orders_day()))


@query
def origin_search(s: Standins) -> DataFrame:
    return origin.origin_search(s.table("orders"), _orders_day())


@query
def origin_rank(s: Standins) -> DataFrame:
    return origin.origin_rank(s.table("orders"), _orders_day(), GIVEN_ORIGIN)


@query
def holiday_detail(s: Standins) -> DataFrame:
    """The holidays of one given origin, and whether the orders of these days go the expected way."""
    z = origin.deseasonalize(origin.daily_counts(s.table("orders"), _orders_day()))
    return origin.holiday_detail(z, GIVEN_ORIGIN).drop("name")


def _orders_day():
    return F.date_diff(F.col("o_orderdate").cast("date"), F.lit(ORDERS_ORIGIN))


# Checks


@query
def check_unique(s: Standins) -> DataFrame:
    return Q.repeated_keys(s.table("lineitem"), "l_orderkey", "l_linenumber")


@query
def check_not_null(s: Standins) -> DataFrame:
    return Q.row_checks(s.tx, Q.not_null("tx", *s.tx.columns))


@query
def check_accepted_values(s: Standins) -> DataFrame:
    return Q.row_checks(
        s.tx,
        [
            Q.accepted_values("tx", "source_split", "train", "test"),
            Q.accepted_values("tx", "M4", "M0", "M1"),
            Q.accepted_values("tx", "product_cd", "click", "view"),
        ],
    )


@query
def check_accepted_range(s: Standins) -> DataFrame:
    return Q.row_checks(
        s.tx,
        [
            Q.accepted_range("tx", "transaction_amt", 0),
            Q.accepted_range("tx", "C13", 1, 5),
            Q.accepted_range("tx", "D2", high=7),
        ],
    )


@query
def check_relationships(s: Standins) -> DataFrame:
    tables = {t: s.table(t) for t in ("lineitem", "orders", "documents", "labels")}
    pairs = (("lineitem", "l_orderkey", "orders", "o_orderkey"), ("documents", "doc_id", "labels", "doc_id"))
    rows = [
        Q.table_check(Q.Check("relationships", child, key, other=parent, other_column=parent_key), tables)
        for child, key, parent, parent_key in pairs
    ]
    return rows[0].unionByName(rows[1])


@query
def check_unique_by_day(s: Standins) -> DataFrame:
    """Rows and distinct keys of every day, from one bitmap of keys a day."""
    bitmaps = materialized(sketches.key_bitmaps(s.tx, "transaction_id", ["transaction_date"]))
    return sketches.key_counts(bitmaps, ["transaction_date"])


@query
def bitmap_integrity(s: Standins) -> DataFrame:
    """Keys of two tables and what they have in common, by bitmaps."""
    rows = []
    for child, key, parent, parent_key in (("lineitem", "l_orderkey", "orders", "o_orderkey"), ("labels", "doc_id", "documents", "doc_id")):
        sides = sketches.key_bitmaps(s.table(child), key), sketches.key_bitmaps(s.table(parent), parent_key)
        rows.append(sketches.bitmap_integrity(*sides).select(F.lit(child).alias("child"), "*"))
    return rows[0].unionByName(rows[1])


@query
def check_equal_rowcount(s: Standins) -> DataFrame:
    tables = {"fct_transactions": fct_transactions(s), "stg_transactions": s.tx}
    return Q.table_check(Q.Check("equal_rowcount", "fct_transactions", other="stg_transactions"), tables)


@query
def check_totals(s: Standins) -> DataFrame:
    fact = fct_transactions(s)
    tables = {"agg_transactions_daily": marts.agg_transactions_daily(fact), "fct_transactions": fact}
    rule = Q.Check("total_equals_rows", "agg_transactions_daily", "tx_count", other="fct_transactions")
    return Q.table_check(rule, tables)


@query
def check_split_order(s: Standins) -> DataFrame:
    return Q.split_bounds(dim_split(s))


def _all_tables(s: Standins) -> dict[str, DataFrame]:
    fact = materialized(marts.fct_transactions(s.tx, s.identity))
    return {
        "transactions": s.raw_transactions,
        "identity": s.raw_identity,
        "predictions": s.predictions,
        "stg_transactions": s.tx,
        "fct_transactions": fact,
        "agg_transactions_daily": materialized(marts.agg_transactions_daily(fact)),
        "agg_pipeline_daily": marts.agg_pipeline_daily(fact, P),
        "dim_split": materialized(dim_split(s)),
        "agg_predictions_daily": agg_predictions_daily(s),
        "agg_score_amount": agg_score_amount(s),
        "agg_feature_buckets": agg_feature_buckets(s),
        "agg_feature_values": agg_feature_values(s),
    }


@query
def check_suite(s: Standins) -> DataFrame:
    return Q.run_checks(_all_tables(s))


# Features, models, thresholds


@query
def features_build(s: Standins) -> DataFrame:
    keys = ("transaction_id",)
    chosen = s.tx.select(*keys, *features.CURATED_COLUMNS, "M4", "C13")
    return features.build(chosen, P, _train_domains(s), keys)


@query
def dummy_scores(s: Standins) -> DataFrame:
    parts = {
        split: dataset.labelled_rows(s.tx, s.identity, dim_split(s), split, features.CURATED_COLUMNS)
        for split in ("train", "valid")
    }
    model = models.dummy(parts["train"], list(features.CURATED_COLUMNS), dataset.LABEL)
    return models.scored(model, parts["valid"].select("transaction_id"))


@query
def class_weights(s: Standins) -> DataFrame:
    return models.class_weights(marts.train_rows(s.tx, dim_split(s)))


def fixed_scorer(df: DataFrame) -> DataFrame:
    """A stand-in for a fitted model: a logistic function with written-down weights."""
    z = (
        0.01 * F.col("transaction_amt")
        - 0.02 * F.col("transaction_hour")
        + 0.5 * F.col("has_identity").cast("int")
        + F.when(F.col("amount_band") == "<25", 0.3).otherwise(0.0)
        - F.when(F.col("purchaser_email_domain") == X.OTHER, 0.4).otherwise(0.0)
        - 1.0
    )
    return df.withColumn("score", 1 / (1 + F.exp(-z)))


@query
def score_day(s: Standins) -> DataFrame:
    read = (("transaction_amt", "double"), ("transaction_hour", "bigint"), ("has_identity", "boolean"),
            ("amount_band", "string"), ("purchaser_email_domain", "string"))
    bundle = store.ScoringModel(
        scorer=fixed_scorer,
        inputs=T.StructType.fromDDL(", ".join(f"{c} {t}" for c, t in read)),
        domains=_train_domains(s),
        feature_set=features.FeatureSet.CURATED,
        trained_at=datetime(2024, 1, 25),
        metrics={},
    )
    day = s.tx.where(F.col("transaction_date") == F.lit(SCORED_DAY))
    return scoring.predictions(day, s.identity, bundle, "fixed", P).drop("model_trained_at", "scored_at")


def scored_labels(s: Standins) -> DataFrame:
    truth = s.tx.select("transaction_id", "is_fraud", "transaction_amt")
    return s.predictions.select("transaction_id", "score", "model").join(truth, "transaction_id")


@query
def ranking_metrics(s: Standins) -> DataFrame:
    return metrics_of(scored_labels(s))


@query
def threshold_cost(s: Standins) -> DataFrame:
    return thresholds.cost(scored_labels(s), P.block_threshold, 5.0)


@query
def threshold_sweep(s: Standins) -> DataFrame:
    return thresholds.sweep(scored_labels(s), 5.0)


@query
def threshold_curve(s: Standins) -> DataFrame:
    return thresholds.curve(scored_labels(s))


@query
def threshold_sensitivity(s: Standins) -> DataFrame:
    return thresholds.sensitivity(scored_labels(s))


@query
def cost_view(s: Standins) -> DataFrame:
    return thresholds.cost_view(thresholds.outcomes(scored_labels(s)), 25.0)


@query
def curve_summary(s: Standins) -> DataFrame:
    return thresholds.curve_summary(scored_labels(s))


@query
def published_curve(s: Standins) -> DataFrame:
    """The curve document as a reader gets it: its points, each beside the head of the document."""
    path = f"{temporary_path(s.spark, 'curve')}/curve"
    scored = scored_labels(s)
    sinks.write_curve(sinks.curve_head(thresholds.curve_summary(scored), "base", "all", PUBLISHED, 0.125), thresholds.curve(scored), path)
    return sinks.read_curve(s.spark, path)


def _importance(s: Standins) -> DataFrame:
    return explain.linear_importance(s.tx, WEIGHTS)


@query
def contribution_top(s: Standins) -> DataFrame:
    return explain.contribution_top(_importance(s), 5)


@query
def contribution_families(s: Standins) -> DataFrame:
    return explain.contribution_families(_importance(s))


@query
def contribution_cumulative(s: Standins) -> DataFrame:
    return explain.contribution_cumulative(_importance(s), (1, 2, 5, 10))


def _labelled(s: Standins, split: str) -> DataFrame:
    return dataset.labelled_rows(s.tx, s.identity, dim_split(s), split, features.CURATED_COLUMNS)


@query
def model_comparison(s: Standins) -> DataFrame:
    """All models of the curated features. What can be known beforehand is compared: the rows and features of a fit, the
    dummy's metrics, that metrics lie in their range, and that a fit beats the best constant on its training rows."""
    parts = (_labelled(s, split) for split in ("train", "valid"))
    table = models.comparison_table(s.spark, models.compare(*parts, features.FeatureSet.CURATED, P))
    in_range = F.col("pr_auc").between(0, 1) & F.col("roc_auc").between(0, 1)
    dummy = F.col("model") == "dummy"
    return table.select(
        "model", "feature_set", "n_features", "train_rows", "valid_rows", in_range.alias("metrics_in_range"),
        F.when(dummy, F.col("pr_auc")).alias("base_pr_auc"), F.when(dummy, F.col("roc_auc")).alias("base_roc_auc"),
        (F.col("train_loss") < models.CONSTANT_LOSS - 1e-9).alias("beats_constant"),
    )


@query
def logistic_optimum(s: Standins) -> DataFrame:
    """Whether the fitted logistic model is where its penalised loss is least: the largest slope that is left there."""
    rows = materialized(features.build(_labelled(s, "train"), P, _train_domains(s), dataset.KEYS))
    names = [c for c in rows.columns if c not in dataset.KEYS]
    slope = models.logistic_slope(models.logistic(rows, names, dataset.LABEL), rows, dataset.LABEL)
    return slope.select("row_count", (F.col("largest_slope") < 1e-4).alias("at_optimum"))


def _stored_trees(s: Standins) -> store.ScoringModel:
    """Trees fitted on the training days, stored and loaded again."""
    rows = _labelled(s, "train")
    fits = [("trees", functools.partial(models.trees, rounds=FEW_ROUNDS))]
    fitted = models.compare(rows, _labelled(s, "valid"), features.FeatureSet.CURATED, P, fits)[0]
    kept = store.ScoringModel(
        fitted.model, fitted.inputs, fitted.domains, fitted.feature_set, PUBLISHED, fitted.metrics
    )
    root = temporary_path(s.spark, "models")
    store.save(kept, root, "trees-curated")
    return store.load(s.spark, root, "trees-curated")


@query
def stored_model_day(s: Standins) -> DataFrame:
    """One day scored twice into the predictions table by a stored model, its input with further and shuffled columns."""
    bundle, root = _stored_trees(s), temporary_path(s.spark, "scored")
    shuffled = s.tx.select(F.lit("x").alias("surplus"), *reversed(s.tx.columns))
    for tx in (s.tx, shuffled):
        scoring.score_day(tx, s.identity, bundle, "trees-curated", SCORED_DAY, root, P)
    written = dated.read_table(s.spark, root, scoring.PREDICTIONS, C.PREDICTION_SCHEMA)
    day = scoring.scoring_input(dated.on_day(s.tx, SCORED_DAY), s.identity)
    own = store.score(day, bundle, P, scoring.KEYS).select("transaction_id", F.col("score").alias("own_score"))
    same = F.abs(F.col("score") - F.col("own_score")) < 1e-12
    return written.join(own, "transaction_id").select(
        "transaction_id", "transaction_date", "model", "model_trained_at", same.alias("same_score"),
        F.col("score").between(0, 1).alias("in_range"),
    )


@query
def tree_contributions(s: Standins) -> DataFrame:
    """What each feature adds to the margin of every validation row by the stored trees; the parts add up."""
    bundle = _stored_trees(s)
    ready = store.prepare(_labelled(s, "valid"), bundle, P, dataset.KEYS)
    parts = bundle.scorer.contributions(ready, ["transaction_id"])
    total = F.aggregate("contributions", F.lit(bundle.scorer.expected()), lambda a, x: a + x)
    return parts.select(
        "transaction_id", F.size("contributions").alias("part_count"), (F.abs(total - F.col("margin")) < 1e-9).alias("adds_up")
    )


@query
def tree_importance(s: Standins) -> DataFrame:
    """Shares of the stored trees' features in the scores of the validation rows."""
    bundle = _stored_trees(s)
    ready = store.prepare(_labelled(s, "valid"), bundle, P, dataset.KEYS)
    ranked = explain.ranked(materialized(bundle.scorer.importance(ready)))
    return ranked.select("feature", F.col("share").between(0, 1).alias("share_in_range"))


@query
def seeded_sample(s: Standins) -> DataFrame:
    """The size of a seeded sample, its distinct ids, and how many are ids of the table."""
    sample = materialized(explain.stable_sample(s.tx.select("transaction_id"), "transaction_id", SAMPLE_ROWS))
    ids = s.tx.select("transaction_id", F.lit(True).alias("_known"))
    return sample.join(ids, "transaction_id", "left").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct("transaction_id").alias("id_count"),
        F.count("_known").alias("known_count"),
    )
