"""Language identification by rank-order profiles.

A language's profile is its most frequent character n-grams in order of frequency. A document's own most frequent
n-grams are compared with each profile by the out-of-place distance: the sum of rank differences, the profile length for
an n-gram that the profile lacks. The nearest profile wins.

N-grams of one to three characters are packed exactly into 64 bits (21 bits a code point), so counting is sorting of
integers. Runs of non-letters are one blank, and the blank is a character of an n-gram.

Defined cases: a NULL text, or one without a letter, is ``und`` with score 0, as is every text where nothing was learned;
ties in frequency go to the smaller packed n-gram, ties in distance to the language that sorts first; rows without text,
language or id are not learned from; repeated rows count repeatedly; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.llm.common import held_out, in_arrow, table
from riskloom.llm.vectors import texts

ORDERS = (1, 2, 3)
PROFILE = 400
UNKNOWN = "und"
#: Language tags are a closed vocabulary (ISO 639 has fewer than 8,000); more than this is a wrong column.
MAX_LANGUAGES = 10_000
_FLUSH = 500_000
_PIECE = 1 << 19

_LETTER = None


def letters() -> np.ndarray:
    """For every code point whether it is a letter; made once per process."""
    global _LETTER
    if _LETTER is None:
        _LETTER = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _LETTER


def grams(text: str) -> list[np.ndarray]:
    """Packed n-grams of a whole text, in pieces of bounded size that overlap so that none is lost or counted twice."""
    out, table_ = [], letters()
    reach = max(ORDERS) - 1
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    inside = table_[codes]
    if not inside.any():
        return out
    codes = np.where(inside, codes, 32).astype(np.uint64)
    keep = inside | np.concatenate([[True], inside[:-1]])
    blank = np.uint64(32)
    codes = np.concatenate([[blank], codes[keep], [blank]])
    if codes[1] == blank:
        codes = codes[1:]
    if codes[-2] == blank:
        codes = codes[:-1]
    for at in range(0, len(codes), _PIECE):
        piece = codes[at : at + _PIECE + reach]
        for n in ORDERS:
            starts = min(_PIECE, len(piece) - n + 1)
            if starts <= 0:
                continue
            packed = piece[:starts].copy()
            for j in range(1, n):
                packed = (packed << np.uint64(21)) | piece[j : j + starts]
            if n == 1:
                packed = packed[packed != blank]
            out.append(packed)
    return out


def counted(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams and their counts."""
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if sum(map(len, parts)) <= 4 * _PIECE:
        return np.unique(np.concatenate(parts), return_counts=True)
    keys, sums = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for part in parts:  # a very long text is merged piece by piece
        k, c = np.unique(part, return_counts=True)
        keys, sums = merged(np.concatenate([keys, k]), np.concatenate([sums, c]))
    return keys, sums


def merged(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    distinct, at = np.unique(keys, return_inverse=True)
    sums = np.zeros(len(distinct), np.int64)
    np.add.at(sums, at, counts)
    return distinct, sums


def ranked(keys: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The most frequent n-grams, first rank first."""
    if len(keys) > 4 * size:  # only those at or above the last place need sorting
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        kept = counts >= least
        keys, counts = keys[kept], counts[kept]
    return keys[np.lexsort((keys, -counts))[:size]]


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n) summed over as many rows as fit; memory is bounded by the flush size."""
    held: dict[str, list] = {}
    size = 0

    def flush():
        for lang, parts in held.items():
            keys, counts = merged(np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(keys)), pa.array(keys.view(np.int64)), pa.array(counts)], ["lang", "gram", "n"]
            )
        held.clear()

    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), texts(batch.column("text"))):
            keys, counts = counted(grams(text))
            held.setdefault(lang, []).append((keys, counts))
            size += len(keys)
            if size > _FLUSH:
                for name, parts in held.items():
                    held[name] = [merged(np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts]))]
                size = sum(len(p[0][0]) for p in held.values())
                if size > _FLUSH // 2:
                    yield from flush()
                    size = 0
    yield from flush()


def learn_profiles(rows: DataFrame, size: int = PROFILE) -> dict[str, np.ndarray]:
    """Profiles from rows (lang, text). The driver receives ``size`` n-grams a language."""
    known = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    totals = in_arrow(known, _count_grams, "lang string, gram long, n long").groupBy("lang", "gram").agg(
        F.sum("n").alias("n")
    )
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = totals.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)
    found: dict[str, list] = {}
    for r in top.orderBy("lang", "rank").toLocalIterator():
        found.setdefault(r["lang"], []).append(r["gram"])
        if len(found) > MAX_LANGUAGES:
            raise ValueError(f"more than {MAX_LANGUAGES} language tags")
    return {lang: np.array(g, np.int64).view(np.uint64) for lang, g in found.items()}


class Profiles:
    """All profiles as one sorted table of n-grams with a row of ranks for each."""

    def __init__(self, profiles: dict[str, np.ndarray], size: int) -> None:
        self.languages, self.size = sorted(profiles), size
        every = [profiles[x] for x in self.languages]
        self.keys = np.unique(np.concatenate(every)) if every else np.zeros(0, np.uint64)
        self.ranks = np.full((len(self.keys) + 1, len(every)), -1, np.int64)
        for j, p in enumerate(every):
            self.ranks[np.searchsorted(self.keys, p), j] = np.arange(len(p))

    def nearest(self, text: str) -> tuple[str, float]:
        keys, counts = counted(grams(text))
        if not len(keys) or not self.languages:
            return UNKNOWN, 0.0
        own = ranked(keys, counts, self.size)
        at = np.minimum(np.searchsorted(self.keys, own), len(self.keys) - 1)
        at = np.where(self.keys[at] == own, at, len(self.keys))
        ranks = self.ranks[at]
        away = np.where(ranks < 0, self.size, np.abs(ranks - np.arange(len(own))[:, None])).sum(axis=0)
        best = int(np.argmin(away))
        return self.languages[best], float(1.0 - away[best] / (self.size * len(own)))


def _predict(batches, profiles: Profiles) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [profiles.nearest(t) for t in texts(batch.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("held_out"),
                pa.array([x[0] for x in found], pa.string()),
                pa.array([x[1] for x in found], pa.float64()),
            ],
            ["doc_id", "held_out", "lang_pred", "score"],
        )


def predict(docs: DataFrame, profiles: dict[str, np.ndarray], size: int = PROFILE) -> DataFrame:
    """doc_id, held_out, lang_pred, score for rows (doc_id, held_out, text)."""
    return in_arrow(
        docs.select(F.col("doc_id").cast("long"), "held_out", "text"),
        _predict,
        "doc_id long, held_out boolean, lang_pred string, score double",
        Profiles(profiles, size),
    )


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", held_out("doc_id", 3, 1))
    profiles = learn_profiles(docs.where(~F.col("held_out")))
    return predict(docs, profiles)
