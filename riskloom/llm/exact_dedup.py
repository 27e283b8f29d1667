"""Exact deduplication against a persistent index of text digests.

The index is a table bucketed and sorted by digest. New rows are reduced to one row per digest, sort-merge anti-joined
with the index and appended; what the index holds already wins. Only DataFrame functions are used.

Defined cases: a NULL text equals the empty text; texts are equal when they are identical after lower-casing A-Z only;
rows without an id count as copies, and one of them stays only where no copy has an id; rows that repeat id and text are one document
and share its result; an empty table leaves an empty index; further columns are ignored.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.lineage import discard, temporary_path
from riskloom.llm.common import lower_ascii, one_row_each, stored, table, whole_text

ROWS_PER_BUCKET = 1_000_000
#: A digest with more than one in HOT_SHARE of all rows is hot; by arithmetic there are fewer than HOT_SHARE of them.
HOT_SHARE = 1_000


def text_digest(text: str | Column = "text") -> Column:
    """SHA-256 of the normalised text as 32 bytes."""
    return F.unhex(F.sha2(lower_ascii(whole_text(text)), 256))


class DigestIndex:
    """A bucketed table (digest, keep_id): one row per distinct text, held in ``folder`` for later batches."""

    def __init__(self, spark: SparkSession, name: str, folder: str, buckets: int) -> None:
        self.spark, self.name, self.folder, self.buckets = spark, name, folder, buckets

    def frame(self) -> DataFrame:
        return self.spark.table(self.name)

    def append(self, rows: DataFrame) -> None:
        """Add the digests of ``rows`` (doc_id, digest) that the index lacks; the largest id of a batch is its owner."""
        owners = rows.groupBy("digest").agg(F.max("doc_id").alias("keep_id"))
        if self.spark.catalog.tableExists(self.name):
            owners = owners.join(self.frame().select("digest").hint("merge"), "digest", "left_anti")
        (
            owners.repartition(self.buckets, "digest")
            .write.bucketBy(self.buckets, "digest")
            .sortBy("digest")
            .option("path", self.folder)
            .mode("append")
            .format("parquet")
            .saveAsTable(self.name)
        )

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        discard(self.spark, self.folder)

    def new_rows(self, rows: DataFrame) -> DataFrame:
        """The rows whose digest the index lacks."""
        return rows.join(self.frame().select("digest").hint("merge"), "digest", "left_anti")


def temporary_index(spark: SparkSession, rows: int) -> DigestIndex:
    """An index of one job, in the folder that all executors share."""
    name = f"digest_index_{uuid.uuid4().hex}"
    buckets = max(1, math.ceil(rows / ROWS_PER_BUCKET))
    return DigestIndex(spark, name, temporary_path(spark, name), buckets)


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, digest, keep_id, group_size, kept: one row per input row.

    The larger ids are loaded first and the smaller ones against them, so that the owner of a digest has its largest id.
    Digests are stored once, 40 bytes a row; texts are never shuffled. The join back splits off hot digests: they are
    fewer than ``HOT_SHARE`` rows and are broadcast, everything else meets in a sort-merge join.
    """
    spark = docs.sparkSession
    rows = stored(docs.select(F.col(doc_id).alias("doc_id"), text_digest(text).alias("digest")))
    n, middle = rows.agg(F.count(F.lit(1)), F.avg("doc_id")).first()
    index = temporary_index(spark, n)
    upper = F.coalesce(F.col("doc_id") >= F.lit(middle), F.lit(False))
    index.append(rows.where(upper))
    index.append(rows.where(~upper))

    sizes = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"))
    groups = stored(sizes.join(index.frame().hint("merge"), "digest"))
    index.drop()
    hot = groups.where(F.col("group_size") > max(n / HOT_SHARE, 1)).collect()
    small = F.broadcast(spark.createDataFrame(hot, groups.schema))
    parts = rows.join(small, "digest").unionByName(
        rows.join(small.select("digest"), "digest", "left_anti").join(groups, "digest")
    )
    return parts.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))


def kept_documents(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns.

    What goes is found by id and digest, so that texts which share an id by mistake are told apart. Of copies that all
    have no id, one stays.
    """
    gone = deduplicate(docs).where(~F.col("kept"))
    gone = gone.select(F.col("doc_id").alias("_gone_id"), F.col("digest").alias("_gone_digest")).distinct()
    same = docs["doc_id"].eqNullSafe(F.col("_gone_id")) & (text_digest(docs["text"]) == F.col("_gone_digest"))
    stay = docs.join(gone.hint("merge"), same, "left_anti")
    unnamed = stay.where("doc_id IS NULL").withColumn("_digest", text_digest())
    return stay.where("doc_id IS NOT NULL").unionByName(one_row_each(unnamed, "_digest", docs.columns))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = deduplicate(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


OP5_SQL = """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))
    AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
  count(*) OVER (PARTITION BY text_sha256) AS group_size,
  doc_id IS NOT DISTINCT FROM max(doc_id) OVER (PARTITION BY text_sha256) AS kept, text_sha256
FROM d
"""
