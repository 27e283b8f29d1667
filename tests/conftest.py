import csv
import os
import random
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from riskloom.sources import contracts as C  # noqa: E402
from riskloom.sources.standins import Standins  # noqa: E402

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def standins(spark):
    return Standins(spark, SMALL)


def rows(df):
    """Rows as sorted tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


def value_of(kind, name, i, rng):
    if name == C.PRIMARY_KEY:
        return str(1000 + i)
    if name == C.OFFSET:
        return str(86_400 + i * 7_000)
    if name == C.LABEL:
        return str(int(i % 5 == 0))
    if name == "TransactionAmt":
        return f"{rng.uniform(1, 400):.2f}"
    if name in ("P_emaildomain", "R_emaildomain"):
        return rng.choice(["gmail.com", "yahoo.fr", "rare.net", ""])
    if rng.random() < 0.1:
        return ""
    return {
        "Int32": lambda: f"{rng.randint(0, 9)}.0" if name.startswith("D") else str(rng.randint(0, 9)),
        "float32": lambda: f"{rng.uniform(0, 9):.3f}",
        "boolean": lambda: rng.choice("TF"),
        "category": lambda: rng.choice(["a", "b", "c"]),
        "str": lambda: f"text{rng.randint(0, 99)}",
    }[kind]()


def write_csv(path, types, ids, hyphens=False, drop=(), seed=0):
    rng = random.Random(seed)
    names = [c for c in types if c not in drop]
    with open(path, "w", newline="") as f:
        out = csv.writer(f)
        out.writerow([c.replace("id_", "id-") if hyphens else c for c in names])
        for i in ids:
            out.writerow([value_of(types[c], c, i, rng) for c in names])


@pytest.fixture(scope="session")
def csv_directory(tmp_path_factory):
    """Four small files under the full contract; days of the two splits do not overlap and leave a gap between them."""
    folder = tmp_path_factory.mktemp("csv")
    write_csv(folder / "train_transaction.csv", C.transaction_types(), range(0, 240))
    write_csv(folder / "train_identity.csv", C.identity_types(), range(0, 240, 4), seed=1)
    write_csv(folder / "test_transaction.csv", C.transaction_types(with_label=False), range(400, 480), seed=2)
    # One identity row of the test split has no transaction.
    write_csv(folder / "test_identity.csv", C.identity_types(), [*range(400, 480, 5), 999], hyphens=True, seed=3)
    return str(folder)
