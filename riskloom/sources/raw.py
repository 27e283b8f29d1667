"""Raw CSV files: names, contract schema, header normalisation, flags."""

from __future__ import annotations

from datetime import date
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.columns import transaction_date
from riskloom.sources import contracts as C


class Source(NamedTuple):
    """A file of the data set: its name, the table it belongs to, and whether it carries the label."""

    file: str
    dataset: str
    labelled: bool = False

    @property
    def types(self) -> dict[str, str]:
        return {c: kind for c, kind in C.dataset_types(self.dataset).items() if self.labelled or c != C.LABEL}


# Fixed values.
SOURCES = {
    "train_transaction": Source("train_transaction.csv", "transactions", labelled=True),
    "train_identity": Source("train_identity.csv", "identity"),
    "test_transaction": Source("test_transaction.csv", "transactions"),
    "test_identity": Source("test_identity.csv", "identity"),
}


def file_of(directory: str, source: str) -> str:
    if source not in SOURCES:
        raise KeyError(f"no file is known as {source!r}, only {', '.join(SOURCES)}")
    return f"{directory.rstrip('/')}/{SOURCES[source].file}"


def read_header(spark: SparkSession, directory: str, source: str) -> DataFrame:
    """A file as text under its own column names; asking for its columns reads one line."""
    return spark.read.csv(file_of(directory, source), header=True, inferSchema=False)


def read_raw(spark: SparkSession, directory: str, source: str, nrows: int | None = None) -> DataFrame:
    """Read one CSV under its contract; a value that does not fit its type fails the read.

    Spark matches a given schema to CSV columns by position, so the file's own header (one line) orders the schema.
    A missing file fails here, when that line is read.
    """
    path = file_of(directory, source)
    types = SOURCES[source].types
    header = read_header(spark, directory, source).columns
    unknown = [c for c in header if C.underscored(c) not in types]
    absent = [c for c in types if c not in {C.underscored(h) for h in header}]
    if unknown or absent:
        raise C.ContractError(f"{source}: unknown columns {unknown}, absent columns {absent}")
    ordered = {c: types[C.underscored(c)] for c in header}
    # A whole number may be written as "1.0" in the files, so whole columns are read as doubles and narrowed below.
    shape = T.StructType(
        [
            T.StructField(f.name, T.DoubleType() if isinstance(f.dataType, T.LongType) else f.dataType)
            for f in C.struct_of(ordered, flags_as_text=True)
        ]
    )
    frame = C.normalize_header(
        spark.read.csv(path, schema=shape, header=True, mode="FAILFAST", enforceSchema=False)
    )
    frame = frame.limit(nrows) if nrows is not None else frame
    return frame.selectExpr(*[f"{typed(C.underscored(h), ordered[h])} AS {C.underscored(h)}" for h in header])


def typed(name: str, kind: str) -> str:
    """SQL text that turns a column of the file into its contract type."""
    if kind == "boolean":
        return f"CASE {name} WHEN 'T' THEN true WHEN 'F' THEN false END"
    if kind in ("Int32", "Int64"):
        # NaN has no integer; a fraction in a whole-number column breaks the contract.
        return (
            f"CASE WHEN isnan({name}) THEN NULL WHEN {name} % 1 = 0 THEN CAST({name} AS BIGINT)"
            f" WHEN {name} IS NOT NULL THEN CAST(raise_error('{name} is not a whole number') AS BIGINT) END"
        )
    if kind in ("float32", "float64"):
        return f"nanvl({name}, CAST(NULL AS DOUBLE))"
    return name


def prepare_transactions(tx: DataFrame, split: str, origin: date, ingested_at=None) -> DataFrame:
    """Add the partition date, the split tag and the load time; a file without labels gets a NULL label."""
    label = {} if C.LABEL in tx.columns else {C.LABEL: F.lit(None).cast("long")}
    return tx.withColumns(
        {
            C.PARTITION_KEY: transaction_date(C.OFFSET, origin),
            C.SPLIT: F.lit(split),
            C.INGESTED_AT: F.current_timestamp() if ingested_at is None else ingested_at,
        }
        | label
    )


def attach_dates(identity: DataFrame, tx: DataFrame, split: str | None = None, ingested_at=None) -> DataFrame:
    """Give identity rows the date of their transaction; rows without one keep a NULL date.

    Both keys must be unique (see ``assert_unique``), which makes the join 1:1.
    """
    dates = tx.select(C.PRIMARY_KEY, C.PARTITION_KEY)
    out = identity.join(dates, C.PRIMARY_KEY, "left")
    if split is None:
        return out
    return out.withColumns(
        {C.SPLIT: F.lit(split), C.INGESTED_AT: F.current_timestamp() if ingested_at is None else ingested_at}
    )


def split_orphans(identity: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with a date, rejected rows without one), so that no row reaches the table under a NULL partition."""
    return identity.where(F.col(C.PARTITION_KEY).isNotNull()), identity.where(F.col(C.PARTITION_KEY).isNull())


def assert_unique(df: DataFrame, key: str) -> None:
    """Fail when a key occurs twice. One aggregation, pre-combined per task; at most five examples are fetched."""
    repeated = df.groupBy(key).count().where((F.col("count") > 1) & F.col(key).isNotNull()).limit(5).collect()
    if repeated:
        raise C.ContractError(f"{key} is not unique, for example {[r[0] for r in repeated]}")
