"""The corpus pipeline: documents in, encoded training rows out, one operator of ``riskloom.llm`` a stage.

Every stage but the last returns the columns of its input, for the rows that it keeps. ``run`` stores each result in the
shared folder before the next stage reads it, so a lost executor never costs more than one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.lineage import kept, scope
from riskloom.llm import bpe, decontaminate, exact_dedup, jaccard_join, toxicity
from riskloom.llm.common import table


#: Words that a worker holds when it encodes: executors are as large by then as the stages before have made them.
WORDS_HELD = 50_000


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are predicted to be toxic go; the model is learned from the labels of the documents at hand."""
    return toxicity.clean_documents(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for the case of A-Z, the document with the largest doc_id stays."""
    return exact_dedup.kept_documents(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a shingle similarity of 0.8 or more, the one with the smallest doc_id stays."""
    return jaccard_join.one_of_each(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids (decimal, joined by blanks), n_tokens, ids_sha256, decoded_sha256 of every document that is left."""
    encoded = bpe.encode_documents(docs, words_held=WORDS_HELD)
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return encoded.select(
        "doc_id",
        ids.alias("ids"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("BPE encoding and decoding", encode),
]

#: Trained scores, MinHash and BPE have no SQL form; tests/llm holds every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, stored; what all stages have stored before is gone by then."""
    docs = table(spark, sf_dir, "documents")
    with scope(spark):
        for _, stage in STAGES[:-1]:
            with scope(spark):
                docs = kept(stage(spark, docs, sf_dir))
        return kept(STAGES[-1][1](spark, docs, sf_dir))
