"""Fixtures for the operators on language-model data: one table of documents with all the cases that have to be defined."""

import random
import string

import pytest

WORDS = ["".join(random.Random(i).choices(string.ascii_lowercase, k=2 + i % 8)) for i in range(400)]


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) for _ in range(n))


def edge_rows():
    """(doc_id, text): NULLs, empty and very long texts, ties, copies, near copies, repeated rows."""
    base = prose(1, 120)
    words = base.split()
    near = [" ".join(words[:i] + [f"new{i}"] + words[i + 1 :]) for i in (3, 60, 110)]
    rows = [
        (1, base), (2, base.upper()), (3, base), (3, base), (4, near[0]), (5, near[1]), (6, near[2]),
        (7, None), (8, ""), (9, "   \n\t "), (None, base), (None, None), (None, "only without an id here, once"),
        (10, prose(2, 30_000)), (11, prose(3, 4)), (12, prose(3, 4)), (13, "one"), (14, "Été à la plage, ÉTÉ. naïve"),
        (15, "\U0001f600 日本語 テキスト ١٢٣"), (16, "a\x00b\x1cc\x85d e"), (17, "x" * 70_000),
    ]
    return rows + [(100 + i, prose(10 + i, 5 + 7 * i)) for i in range(40)]


CLASHES = ("id", "digest", "node", "a", "b", "keep_id", "score", "block", "_row", "turns", "label", "count")


def frame(spark, rows, clashes=True):
    """Documents with further columns whose names the operators use themselves."""
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    if clashes:
        df = df.selectExpr("*", *[f"'clash' AS `{c}`" for c in CLASHES])
    return df


@pytest.fixture(scope="session")
def edge(spark):
    return frame(spark, edge_rows()).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return frame(spark, [])


@pytest.fixture(scope="session")
def sf(tmp_path_factory):
    return "/root/testdata/sf0.001"
