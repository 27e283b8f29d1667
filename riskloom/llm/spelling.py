"""Spelling variants: words one edit apart, found by asymmetric chunks.

One word of a pair, the chunk word, contributes two disjoint chunks, its halves; one edit falls into one half, so the other
half stays as it is and is a positional gram of the second word. The gram word contributes its grams at the places where
a half can stand after one edit: as long as the chunk word, or one longer, so the shift is 0 or 1 (of two words of different
length the shorter is the chunk word). Both sides meet on the preserved chunk, its place and the length of the chunk word;
``levenshtein`` verifies.

A chunk that many words share would pair all of them. Such a chunk is not paired: its words go on with what is left, the
half with the edit is cut into halves itself, and one of those is preserved as well. At the last step only one place is
open, and a key has no more words than an alphabet has letters and pairs of letters. So candidates stay in proportion to
words whatever the words are, and none is dropped. Steps end after the binary logarithm of the longest word.

A word's form is its most frequent near word, if that is frequent enough. Forms grow in frequency, so chains are short;
their ends are found by pointer doubling.

Runs of words are counted by document inside tasks, then summed by word. Everything after that is DataFrame code.

Defined cases: a NULL text has no words; a row without an id has no misprints, its runs stay as they are; repeated rows count
again; a text may be one run of any length; ties for a form go to the smaller word in code-point order; empty tables give
no rows; further columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import LOWER, UPPER, in_arrow, stored, table

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LEAST_LENGTH, LEAST_COUNT, FACTOR = 5, 3, 2
#: One run of so many loses a code point.
MISPRINTS = 97
#: Pairs of one key that are compared; keys with more are cut further.
PAIRS = 512
#: Words that a task counts before it passes them on.
FLUSH = 100_000

_LOWERED = str.maketrans(UPPER, LOWER)


def _count(batches, misprints: int) -> Iterator[pa.RecordBatch]:
    held: Counter[str] = Counter()

    def flush() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"]
        )
        held.clear()
        return out

    crc32 = zlib.crc32
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
            runs = Counter(RUN.findall((text.as_py() or "").translate(_LOWERED)))
            if doc_id is None or not misprints:
                held.update(runs)
            else:
                start = crc32(b"%d:" % doc_id)
                for run, n in runs.items():
                    h = crc32(run.encode(), start)
                    if h % misprints == 0:
                        at = h % len(run)
                        run = run[:at] + run[at + 1 :]
                    held[run] += n
            if len(held) >= FLUSH:
                yield flush()
    if held:
        yield flush()


def words(docs: DataFrame, misprints: int = MISPRINTS) -> DataFrame:
    """(word, n): the words that are long and frequent enough, with misprints as ``misprints`` says (0: none)."""
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    counted = in_arrow(rows, _count, "word string, n long", misprints)
    counted = counted.where(F.length("word") >= LEAST_LENGTH).groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= LEAST_COUNT)


def _key(word: Column, length: Column, begin: Column, end: Column, shift: Column) -> Column:
    """What a word with an open place [begin, end) of a chunk word of ``length`` has outside of it."""
    before = F.substring(word, F.lit(1), begin)
    behind = F.substring(word, end + shift + 1, length - end)
    return F.xxhash64(length, begin, end, F.length(before), before, behind)


def _halves(rows: DataFrame) -> DataFrame:
    """The two ways to open one half of a row's open place, as further rows (word, length, begin, end, shift)."""
    middle = F.col("begin") + F.ceil((F.col("end") - F.col("begin")) / 2).cast("int")
    halves = F.array(
        F.struct(F.col("begin").alias("begin"), middle.alias("end")), F.struct(middle.alias("begin"), F.col("end").alias("end"))
    )
    cut = rows.select("word", "length", "shift", F.explode(halves).alias("_half"))
    return cut.select("word", "length", "_half.begin", "_half.end", "shift")


def near_pairs(words: DataFrame, pairs: int = PAIRS) -> DataFrame:
    """Distinct (a, b): words of a table (word, ...) that differ by one edit; ``a`` is not longer than ``b``.

    ``shift`` 0 rows stand for both a chunk word and a gram word of its length, ``shift`` 1 rows for one that is longer.
    """
    size = F.length("word")
    roles = F.array(*[F.struct((size - s).alias("length"), F.lit(s).alias("shift")) for s in (0, 1)])
    start = words.select("word", F.explode(roles).alias("_role")).select(
        "word", "_role.length", F.lit(0).alias("begin"), F.col("_role.length").alias("end"), "_role.shift"
    )
    rows = _halves(start.where(F.col("length") > 0))
    found = []
    while True:
        keyed = stored(rows.withColumn("key", _key(F.col("word"), *map(F.col, ("length", "begin", "end", "shift")))))
        sizes = keyed.groupBy("key").agg(
            F.count_if(F.col("shift") == 0).alias("short"),
            F.count_if(F.col("shift") == 1).alias("long"),
            F.max(F.col("end") - F.col("begin")).alias("open"),
        )
        # A key without a chunk word has no pair.
        sizes = sizes.where((F.col("short") > 0) & (F.col("short") + F.col("long") > 1))
        small = (F.col("short") * (F.col("short") + F.col("long")) <= pairs) | (F.col("open") <= 1)
        sizes = stored(sizes.select("key", small.alias("small")))
        paired = keyed.join(sizes.where("small").select("key"), "key").select("key", "length", "word", "shift")
        a = paired.where("shift = 0").select("key", F.col("word").alias("a"))
        b = paired.select("key", F.col("word").alias("b"), "shift")
        both = a.join(b, "key").where((F.col("shift") == 1) | (F.col("a") < F.col("b")))
        found.append(both.where(F.levenshtein("a", "b", 1) == 1).select("a", "b"))
        hot = sizes.where(~F.col("small")).select("key")
        if hot.isEmpty():
            break
        rows = _halves(keyed.join(hot, "key"))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.distinct()


def forms(counted: DataFrame, factor: int = FACTOR) -> DataFrame:
    """word, form, n, n_near, form_n of every word of a table (word, n)."""
    pairs = stored(near_pairs(counted))
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("near"))
    )
    named = both.join(counted.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = named.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near"))).alias("_best")
    )
    rows = counted.select("word", "n").join(best, "word", "left")
    better = -F.col("_best.minus") >= factor * F.col("n")
    return rows.select(
        "word",
        F.when(better, F.col("_best.near")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(better, -F.col("_best.minus")).alias("form_n"),
    )


def roots(formed: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form: each step doubles the distance that is followed."""
    links = stored(formed.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root")))
    while True:
        further = links.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        moved = stored(links.join(further, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), "_next"))
        if moved.where(F.col("_next").isNotNull()).isEmpty():
            return moved.select("word", "root")
        links = moved.select("word", "root")


def variants(docs: DataFrame, misprints: int = MISPRINTS) -> DataFrame:
    """word, form, root, n, n_near, form_n."""
    formed = stored(forms(stored(words(docs, misprints))))
    out = formed.join(roots(formed), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(table(spark, sf_dir, "documents"))
