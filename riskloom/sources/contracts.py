"""Schema contracts of the raw data sets, header normalisation and the gate before a write."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Role columns.
PRIMARY_KEY = "TransactionID"
LABEL = "isFraud"
OFFSET = "TransactionDT"
PARTITION_KEY = "transaction_date"
SPLIT = "source_split"
INGESTED_AT = "ingested_at"

# Number ranges of the anonymous columns, and the members that are not whole numbers.
V_RANGE = (1, 339)
V_FRACTIONAL = ((126, 137), (159, 166), (202, 216), (263, 278), (306, 321), (331, 339))
C_RANGE = (1, 14)
D_RANGE = (1, 15)
D_FRACTIONAL = (8, 9)
M_RANGE = (1, 9)
M_CATEGORY = (4,)
ID_RANGE = (1, 38)
ID_CATEGORY = (12, 15, 16, 23, 27, 28, 29, 34)
ID_FLAG = (35, 36, 37, 38)
ID_TEXT = (30, 31, 33)
ID_FRACTIONAL = (11,)
WHOLE_NAMED = ("card1", "card2", "card3", "card5", "addr1", "addr2", "dist1", "dist2")

# Contract type -> Spark type. Flags are text in the source and boolean only after parsing.
SPARK_TYPES: dict[str, T.DataType] = {
    "Int32": T.LongType(),
    "Int64": T.LongType(),
    "float32": T.DoubleType(),
    "float64": T.DoubleType(),
    "boolean": T.BooleanType(),
    "category": T.StringType(),
    "str": T.StringType(),
}

# Order of the keys matters: the first one prunes most.
CLUSTERING = {
    "transactions": ("source_split", "ProductCD", "card1"),
    "identity": ("source_split", "DeviceType"),
}


def _family(prefix: str, bounds: tuple[int, int], usual: str, width: int = 1, **other: tuple) -> dict[str, str]:
    """Types of a numbered family: the usual one, and the members (numbers or ranges of them) of every other type."""
    out = {f"{prefix}{i:0{width}d}": usual for i in range(bounds[0], bounds[1] + 1)}
    for kind, members in other.items():
        for m in members:
            first, last = m if isinstance(m, tuple) else (m, m)
            out |= {f"{prefix}{i:0{width}d}": kind for i in range(first, last + 1)}
    return out


_NAMED = {
    "transactions": {
        PRIMARY_KEY: "Int32", OFFSET: "Int32", "TransactionAmt": "float32", "ProductCD": "category", "P_emaildomain": "str",
        "R_emaildomain": "str", LABEL: "Int32", **{c: "Int32" for c in WHOLE_NAMED}, "card4": "category",
        "card6": "category",
    },
    "identity": {PRIMARY_KEY: "Int32", "DeviceType": "category", "DeviceInfo": "str"},
}
_FAMILIES = {
    "transactions": (
        _family("C", C_RANGE, "Int32"),
        _family("D", D_RANGE, "Int32", float32=D_FRACTIONAL),
        _family("M", M_RANGE, "boolean", category=M_CATEGORY),
        _family("V", V_RANGE, "Int32", float32=V_FRACTIONAL),
    ),
    "identity": (
        _family("id_", ID_RANGE, "Int32", 2, category=ID_CATEGORY, boolean=ID_FLAG, str=ID_TEXT, float32=ID_FRACTIONAL),
    ),
}


def dataset_types(dataset: str) -> dict[str, str]:
    """Contract type of every column of a data set: the named columns and the numbered families."""
    if dataset not in _NAMED:
        raise KeyError(f"unknown data set {dataset!r}")
    return {c: kind for part in (_NAMED[dataset], *_FAMILIES[dataset]) for c, kind in part.items()}


def transaction_types(with_label: bool = True) -> dict[str, str]:
    """Of the transactions; files of the unlabelled split have no label column."""
    return {c: kind for c, kind in dataset_types("transactions").items() if with_label or c != LABEL}


def identity_types() -> dict[str, str]:
    return dataset_types("identity")


def struct_of(types: dict[str, str], flags_as_text: bool = False) -> T.StructType:
    """Spark schema of contract types; ``flags_as_text`` gives the shape of the files, before flags are parsed."""
    return T.StructType(
        [
            T.StructField(name, T.StringType() if flags_as_text and kind == "boolean" else SPARK_TYPES[kind])
            for name, kind in types.items()
        ]
    )


def table_schema(dataset: str) -> T.StructType:
    """Schema of a raw table: the source columns and the three the pipeline adds."""
    return (
        struct_of(dataset_types(dataset))
        .add(PARTITION_KEY, T.DateType())
        .add(SPLIT, T.StringType())
        .add(INGESTED_AT, T.TimestampType())
    )


PREDICTION_SCHEMA = T.StructType(
    [
        T.StructField("transaction_id", T.LongType(), False),
        T.StructField("transaction_date", T.DateType(), False),
        T.StructField("score", T.DoubleType(), False),
        T.StructField("model", T.StringType(), False),
        T.StructField("model_trained_at", T.TimestampType(), False),
        T.StructField("scored_at", T.TimestampType(), False),
    ]
)


class ContractError(ValueError):
    """A frame does not have the columns or types its table promises."""


def underscored(name: str) -> str:
    return name.replace("-", "_")


def normalize_header(df: DataFrame) -> DataFrame:
    """Hyphens in column names become underscores (``id-01`` -> ``id_01``)."""
    return df.withColumnsRenamed({c: underscored(c) for c in df.columns if "-" in c})


def gate(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Refuse a frame whose column set or types differ from the contract; else return it in contract order.

    Only metadata is compared, so no job runs. Missing columns are reported before extra ones.
    """
    have = {f.name: f.dataType for f in df.schema}
    want = {f.name: f.dataType for f in schema}
    missing = sorted(want.keys() - have.keys())
    if missing:
        raise ContractError(f"missing columns: {missing}")
    extra = sorted(have.keys() - want.keys())
    if extra:
        raise ContractError(f"unexpected columns: {extra}")
    wrong = {c: f"{have[c].simpleString()} instead of {t.simpleString()}" for c, t in want.items() if have[c] != t}
    if wrong:
        raise ContractError(f"wrong types: {wrong}")
    return df.select(*want)
