"""Cutting lineage where one intermediate result feeds several branches."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Folders that every machine has for itself, whatever its settings are.
_OWN_FOLDERS = ("/tmp", "/var/tmp")
#: Paths that were written inside of each open scope, the innermost last.
_scopes: ContextVar[tuple[tuple[SparkSession, list[str]], ...]] = ContextVar("scopes", default=())


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names. Only a local session without it gets a folder of its own."""
    context = spark.sparkContext
    local = context.master.startswith("local")
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not local:
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="riskloom-checkpoint-"))
        folder = context.getCheckpointDir()
    own = {tempfile.gettempdir(), *_OWN_FOLDERS}
    if not local and any(re.sub("^file:/*", "/", folder).startswith(f"{x}/") for x in own):
        raise RuntimeError(f"{folder} is a temporary folder of one machine; executors do not share it")
    return folder.rstrip("/")


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def discard(spark: SparkSession, path: str) -> None:
    """Delete a stored intermediate that nothing reads any more."""
    fs, where = _file_system(spark, path)
    fs.delete(where, True)


def temporary_path(spark: SparkSession, prefix: str = "riskloom") -> str:
    """A new path in the shared folder. What is written there goes when the driver's JVM ends, if not before."""
    folder = f"{shared_folder(spark)}/{prefix}-{uuid.uuid4().hex}"
    fs, where = _file_system(spark, folder)
    fs.mkdirs(where)  # only what exists can be marked
    fs.deleteOnExit(where)
    return f"{folder}/data"


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Discard at its end what was materialized inside of it, but for what was ``kept``.

    Results that leave the scope must not read what was stored there, unless they are stored themselves.
    """
    own: list[str] = []
    token = _scopes.set((*_scopes.get(), (spark, own)))
    try:
        yield
    finally:
        _scopes.reset(token)
        for path in own:
            discard(spark, path.removesuffix("/data"))


def _write(df: DataFrame, scopes: tuple) -> DataFrame:
    path = temporary_path(df.sparkSession)
    if scopes:
        scopes[-1][1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialized(df: DataFrame) -> DataFrame:
    """Write a result once as a Parquet table in the shared folder and go on from there.

    Readers prune columns and know its size, and a lost executor costs a re-read instead of a recomputation. Inside of a
    ``scope`` the table goes when the scope ends.
    """
    return _write(df, _scopes.get())


def kept(df: DataFrame) -> DataFrame:
    """Like ``materialized``, for a result that outlives the innermost scope."""
    return _write(df, _scopes.get()[:-1])
