"""Benchmark decontamination by size-partitioned MinHash containment search.

An item is contained in a document when at least ``threshold`` of its distinct five-word shingles occur there. Items are
partitioned by their number of shingles; the sketch of an item is its k smallest shingle hashes, where k follows from the
size of its partition: with k = floor((1 - threshold) * size) + 1 values, a document that contains the item holds at
least one of them, so the candidate search misses nothing. Documents are far longer than items, which is why only items
are sketched and whole documents are probed. Every candidate is verified on the shingles themselves, as text.

Words are runs of ASCII letters, digits and characters beyond ASCII, after lower-casing A-Z.

Items go to the workers in blocks of at most ``ITEMS_PER_BLOCK`` items and ``BLOCK_CHARACTERS`` characters, each a bounded
broadcast and a scan of its own; one block is the usual case.

Defined cases: NULL texts are empty; an item of one to four words is one shingle of all its words and is found where they
stand in a row; an item without a word is never found; every row of the items is an item of its own, whether it
has an id or shares one; repeated documents are each reported; empty tables give no rows; further columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import LOWER, UPPER, in_arrow, nameless, table, without
from riskloom.llm.vectors import SHINGLE, shingles, slices, texts, word_hashes, words

THRESHOLD = 0.8
ITEMS_PER_BLOCK, BLOCK_CHARACTERS = 50_000, 32 << 20
_WORD = re.compile("[0-9a-z\x80-\U0010ffff]+")
_LOWER = str.maketrans(UPPER, LOWER)


def found_words(text: str) -> list[str]:
    return _WORD.findall(text.translate(_LOWER))


def word_shingles(text: str, size: int = SHINGLE) -> list[str]:
    """Runs of ``size`` words of a text in order, words joined by one blank."""
    found = found_words(text)
    return [" ".join(found[i : i + size]) for i in range(len(found) - size + 1)]


def _hashes(text: str, size: int = SHINGLE) -> np.ndarray:
    """Hashes of ``word_shingles``, in the same order."""
    part = next(slices(pa.array([text])))
    found = words(part)
    if len(found.starts) < size:
        return np.zeros(0, np.uint64)
    return shingles(word_hashes(part.data, found.starts, found.ends), found.bounds, size)[0]


class Sketches:
    """The sketch values of a block of items (id, text) with shingles of one size, and their shingles for the verification."""

    def __init__(self, items: list[tuple[int | None, str]], threshold: float, width: int = SHINGLE) -> None:
        self.threshold, self.width = threshold, width
        self.ids: list[int | None] = []
        self.shingles: list[frozenset[str]] = []
        values, owners = [], []
        for item_id, text in items:
            own = dict(zip(word_shingles(text, width), _hashes(text, width).tolist()))
            if not own:
                continue
            values.append(np.sort(np.array(list(own.values()), np.uint64))[: self.size(len(own))])
            owners.append(np.full(len(values[-1]), len(self.ids)))
            self.ids.append(item_id)
            self.shingles.append(frozenset(own))
        every = np.concatenate(values) if values else np.zeros(0, np.uint64)
        owner = np.concatenate(owners) if owners else np.zeros(0, np.int64)
        order = np.argsort(every, kind="stable")
        self.values, self.owners = every[order], owner[order]

    @staticmethod
    def by_width(items: list[tuple[int | None, str]], threshold: float) -> list[Sketches]:
        """Items of five words and more together, shorter ones by their number of words."""
        widths: dict[int, list[tuple[int | None, str]]] = {}
        for item in items:
            widths.setdefault(min(len(found_words(item[1])), SHINGLE), []).append(item)
        return [Sketches(own, threshold, width) for width, own in sorted(widths.items()) if width]

    def size(self, shingles_: int) -> int:
        """Sketch values of an item, from the upper end of its size partition (powers of two)."""
        upper = 1 << max(shingles_ - 1, 0).bit_length()
        return min(shingles_, math.floor((1 - self.threshold) * upper + 1e-9) + 1)

    def candidates(self, hashes: np.ndarray, bounds: np.ndarray) -> dict[int, set[int]]:
        """For rows of shingle hashes, the items of which a sketch value occurs in the row."""
        if not len(self.values) or not len(hashes):
            return {}
        at = np.minimum(np.searchsorted(self.values, hashes), len(self.values) - 1)
        hits = np.flatnonzero(self.values[at] == hashes)
        rows = np.searchsorted(bounds, hits, "right") - 1
        found: dict[int, set[int]] = {}
        for row, first in zip(rows.tolist(), at[hits].tolist()):
            value = self.values[first]
            while first < len(self.values) and self.values[first] == value:
                found.setdefault(row, set()).add(int(self.owners[first]))
                first += 1
        return found


def _search(batches, sketches: list[Sketches]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("doc_id").to_pylist()
        out: list[tuple] = []
        column = batch.column("text")
        for part in slices(column):
            found = words(part)
            hashed = word_hashes(part.data, found.starts, found.ends)
            for own in sketches:
                hashes, bounds = shingles(hashed, found.bounds, own.width)
                for row, items in own.candidates(hashes, bounds).items():
                    runs = set(word_shingles(texts(column.slice(part.first + row, 1))[0], own.width))
                    for i in sorted(items):
                        size = len(own.shingles[i])
                        shared = len(own.shingles[i] & runs)
                        if shared >= own.threshold * size - 1e-9:
                            out.append((ids[part.first + row], own.ids[i], shared, size, shared / size))
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in out], t) for k, t in enumerate(_TYPES)], [n for n, _ in _COLUMNS]
        )


_COLUMNS = (
    ("doc_id", "long"), ("item_id", "long"), ("shared", "long"), ("item_shingles", "long"), ("containment", "double")
)
_TYPES = [pa.float64() if t == "double" else pa.int64() for _, t in _COLUMNS]


def _blocks(items: DataFrame, size: int) -> Iterator[list[tuple[int | None, str]]]:
    """Items (id, text), as many at a time as a block may hold; the driver holds one block."""
    block: list[tuple[int | None, str]] = []
    held = 0
    rows = items.select(F.col("item_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    for r in rows.orderBy("item_id", "text").toLocalIterator():
        if block and (len(block) == size or held + len(r["text"]) > BLOCK_CHARACTERS):
            yield block
            block, held = [], 0
        block.append((r["item_id"], r["text"]))
        held += len(r["text"])
    yield block


def search(
    docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, items_per_block: int = ITEMS_PER_BLOCK
) -> DataFrame:
    """doc_id, item_id, shared, item_shingles, containment: every document that contains an item, with no shuffle."""
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    schema = ", ".join(f"{n} {t}" for n, t in _COLUMNS)
    found = None
    for block in _blocks(items, items_per_block):
        part = in_arrow(rows, _search, schema, Sketches.by_width(block, threshold))
        found = part if found is None else found.unionByName(part)
    return found


def short_items(items: DataFrame) -> DataFrame:
    """Items of fewer words than a shingle has; they are searched as one shingle, and common phrases among them hit a lot."""
    count = F.size(F.array_remove(F.split(F.coalesce("text", F.lit("")), "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"), ""))
    return items.where(count < SHINGLE)


def clean_documents(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that contain no item, with all their columns."""
    # Rows without an id are searched apart, under a number of their text.
    own = docs.select(F.col("doc_id").cast("long"), "text", nameless().alias("nameless"))
    named = search(own.where("doc_id IS NOT NULL"), items, threshold).select("doc_id", F.lit(None).cast("string").alias("nameless"))
    rows = own.where("doc_id IS NULL").select(F.xxhash64("nameless").alias("doc_id"), "text")
    hit = search(rows, items, threshold).select("doc_id").distinct()
    texts_ = own.where("doc_id IS NULL").select(F.xxhash64("nameless").alias("_key"), "nameless")
    others = texts_.join(hit.withColumnRenamed("doc_id", "_key"), "_key").select(F.lit(None).cast("long").alias("doc_id"), "nameless")
    return without(docs, named.unionByName(others))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
