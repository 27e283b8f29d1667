"""Small helpers that all operators of this package share."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import gc
import string
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.lineage import materialized as stored  # noqa: F401
from riskloom.functions.shipping import ship_package  # noqa: F401

UPPER, LOWER = string.ascii_uppercase, string.ascii_lowercase


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(text: str | Column = "text") -> Column:
    """The text, empty where it is NULL."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def nameless(doc_id: str = "doc_id", text: str = "text") -> Column:
    """What tells rows without an id apart: the SHA-256 of their text; NULL for rows with an id."""
    return F.when(F.col(doc_id).isNull(), F.sha2(whole_text(text), 256))


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not in ``gone`` (doc_id, nameless), by id, or by text where they have no id."""
    gone = gone.select(F.col("doc_id").cast("long").alias("_gone_id"), F.col("nameless").alias("_gone_text")).distinct()
    gone = stored(gone)  # its size decides whether the texts have to move
    same = docs["doc_id"].cast("long").eqNullSafe(F.col("_gone_id"))
    text = F.when(docs["doc_id"].isNull(), F.sha2(whole_text(docs["text"]), 256))
    return docs.join(gone, same & text.eqNullSafe(F.col("_gone_text")), "left_anti").select(docs.columns)


def one_row_each(rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """One row of every value of ``key``, the one with the smallest text, with ``columns``."""
    row = F.struct(*[F.col(f"`{c}`") for c in columns])
    return rows.groupBy(key).agg(F.min_by(row, F.col("text")).alias("_row")).select("_row.*")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else. ``lower`` does the same on pure ASCII, and much faster."""
    ascii_only = F.length(text) == F.octet_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def fold(doc_id: str, n: int) -> Column:
    """crc32(id as text) mod n; NULL for a NULL id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % n


def held_out(doc_id: str, n: int, remainder: int) -> Column:
    """True for rows of the remainder; a row without an id is never learned from either."""
    return F.coalesce(fold(doc_id, n) == remainder, F.lit(True))


#: Bytes of an Arrow batch on its way to a Python worker. Both sides hold some batches at a time.
ARROW_BATCH = 4 << 20
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def in_arrow(df: DataFrame, fn, schema: str, *args) -> DataFrame:
    """``fn(batches, *args)`` over the partitions of ``df``, in batches of bounded size where the user set no other."""
    spark = df.sparkSession
    ship_package(spark)
    if spark.conf.get(_BATCH_BYTES, None) in (None, "67108864b", "64m", "64MB"):  # the default
        spark.conf.set(_BATCH_BYTES, str(ARROW_BATCH))
    return df.mapInArrow(functools.partial(_call, fn, args), schema)


#: What operators hold in a worker between tasks, by module: how to let it go.
_held: dict[str, Callable[[], None]] = {}


def hold(module: str, release: Callable[[], None]) -> None:
    """Keep a store of a module until the worker turns to tasks of another one."""
    _held[module] = release


#: The module whose tasks the worker has run last.
_last: list[str] = []


def _turn_to(module: str) -> None:
    """Let go of what other modules hold, and give the memory that they have freed back to the machine."""
    for other in [m for m in _held if m != module]:
        _held.pop(other)()
    if _last == [module]:
        return
    if _last:
        gc.collect()
        with contextlib.suppress(OSError, AttributeError):  # glibc only
            ctypes.CDLL(None).malloc_trim(0)
    _last[:] = [module]


def _call(fn, args, batches):
    _turn_to(fn.__module__)
    for batch in fn(batches, *args):
        yield batch
        pa.default_memory_pool().release_unused()
