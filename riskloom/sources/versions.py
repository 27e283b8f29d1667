"""Dated tables whose days are replaced without a moment at which a reader sees half of it.

``<root>/<data set>/version=<id>/dt=YYYY-MM-DD/*.parquet`` holds the files, ``<root>/<data set>/_commits/<number>.json`` one
file a commit. A commit names the version of every day. Writing it is the moment at which a change happens: files are
complete before, and readers go by the latest commit only. A write that breaks leaves files that no commit names.

Two writers at a time: the number of a commit is taken by renaming a finished file to it, and a store that refuses to rename
onto an existing file (HDFS does) lets only one of them have it; the other one applies its days to the newer commit.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.lineage import _file_system, discard
from riskloom.sources import contracts as C
from riskloom.sources.dated import DT, laid_out, table_path

VERSION = "version"
ATTEMPTS = 20


@dataclass(frozen=True)
class Commit:
    """The version of every day, and what the writer noted beside it."""

    number: int = 0
    days: dict[str, str] = field(default_factory=dict)
    notes: dict[str, int] = field(default_factory=dict)


class VersionedTable:
    def __init__(self, spark: SparkSession, root: str, dataset: str, schema: T.StructType) -> None:
        """``schema`` is that of the files: what it says about columns holds for a table without a day as well."""
        self.spark, self.dataset, self.schema = spark, dataset, schema
        self.path = table_path(root, dataset)

    # Commits

    def _numbers(self) -> list[int]:
        fs, where = _file_system(self.spark, f"{self.path}/_commits")
        if not fs.exists(where):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(where)]
        return sorted(int(m[1]) for n in names if (m := re.fullmatch(r"(\d+)\.json", n)))

    def commit_of(self, number: int) -> Commit:
        if not number:
            return Commit()
        text = self.spark.read.option("wholetext", True).text(f"{self.path}/_commits/{number:012d}.json").first()[0]
        found = json.loads(text)
        return Commit(number, found["days"], found["notes"])

    def latest(self) -> Commit:
        return self.commit_of(max(self._numbers(), default=0))

    def commit(self, changes: dict[str, str | None], notes: dict[str, int] | None = None) -> Commit:
        """Make days be of the given versions, or be gone, all at once."""
        fs, _ = _file_system(self.spark, self.path)
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        for _ in range(ATTEMPTS):
            last = self.latest()
            days = {d: v for d, v in (last.days | changes).items() if v is not None}
            new = Commit(last.number + 1, days, last.notes | (notes or {}))
            waiting = path(f"{self.path}/_commits/_{uuid.uuid4().hex}")
            out = fs.create(waiting, False)
            out.write(bytearray(json.dumps({"days": new.days, "notes": new.notes}), "utf-8"))
            out.close()
            final = path(f"{self.path}/_commits/{new.number:012d}.json")
            if not fs.exists(final) and fs.rename(waiting, final):
                return new
            fs.delete(waiting, False)
        raise RuntimeError(f"{self.dataset}: {ATTEMPTS} other writers came first")

    def changed_since(self, number: int) -> list[date]:
        """Days whose version differs between a commit and now."""
        before, now = self.commit_of(number).days, self.latest().days
        return sorted(date.fromisoformat(d) for d in before.keys() | now.keys() if before.get(d) != now.get(d))

    # Files

    def _write(self, df: DataFrame) -> dict[str, str]:
        """Files of a new version; the days that it holds."""
        version = uuid.uuid4().hex
        where = f"{self.path}/{VERSION}={version}"
        rows = C.gate(df, self.schema)
        key = F.coalesce(C.PARTITION_KEY, F.raise_error(F.lit("row without a partition date")).cast("date"))
        arranged = laid_out(rows.withColumn(C.PARTITION_KEY, key), C.CLUSTERING.get(self.dataset, ()))
        arranged.write.partitionBy(DT).option("compression", "snappy").parquet(where)
        fs, path = _file_system(self.spark, where)
        names = [s.getPath().getName() for s in fs.listStatus(path)]
        return {n.removeprefix(f"{DT}="): version for n in names if n.startswith(f"{DT}=")}

    def write_days(self, df: DataFrame, notes: dict[str, int] | None = None, gone: Iterable[date] = ()) -> Commit:
        """Replace all days that ``df`` has rows of, in one step; days in ``gone`` without rows are cleared."""
        empty = {f"{d:%Y-%m-%d}": None for d in gone}
        return self.commit(empty | self._write(df), notes)

    def replace_day(self, df: DataFrame, day: date) -> Commit:
        """Replace exactly one day; no rows clear it, rows of other days are refused."""
        key = F.col(C.PARTITION_KEY)
        refusal = F.raise_error(F.lit(f"rows of other days in the replacement of {day}")).cast("date")
        guarded = df.withColumn(C.PARTITION_KEY, F.when(key == F.lit(day), key).otherwise(refusal))
        return self.write_days(guarded, gone=[day])

    def read(self, days: Iterable[date] | None = None, commit: Commit | None = None) -> DataFrame:
        """The table as of a commit, by default the latest, with ``dt``; only the given days if there are any."""
        now = self.latest() if commit is None else commit
        wanted = now.days if days is None else {d: now.days[d] for d in (f"{x:%Y-%m-%d}" for x in days) if d in now.days}
        shape = T.StructType(list(self.schema.fields)).add(DT, T.DateType())
        if not wanted:
            return self.spark.createDataFrame([], shape)
        paths = [f"{self.path}/{VERSION}={v}/{DT}={d}" for d, v in sorted(wanted.items())]
        full = T.StructType(list(shape.fields)).add(VERSION, T.StringType())
        return self.spark.read.schema(full).option("basePath", self.path).parquet(*paths).drop(VERSION)

    def clean(self) -> int:
        """Delete versions that the latest commit does not name; returns how many. No reader of an older one may be left."""
        fs, path = _file_system(self.spark, self.path)
        named = set(self.latest().days.values())
        old = [s.getPath().getName() for s in fs.listStatus(path)]
        old = [n for n in old if n.startswith(f"{VERSION}=") and n.removeprefix(f"{VERSION}=") not in named]
        for n in old:
            discard(self.spark, f"{self.path}/{n}")
        return len(old)
