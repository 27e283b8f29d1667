"""Toxic passages by maximum-scoring segments.

Every token has a score: the log odds of its rate in toxic against clean documents, with a Dirichlet prior that pulls
rare tokens to the overall rate, less a drift that makes an average clean token negative. A word and its first four, five
and six bytes are counted each; the significant one with the highest odds speaks for the word, so that new forms of a
known stem are met. All maximal scoring segments
of a document are found in one linear scan (Ruzzo and Tompa); a segment is significant by its extreme-value statistic:
the number of segments of that score expected by chance in a text of that length (Karlin and Altschul). The document's
evidence is the negative logarithm of the smallest such number, plus what further significant segments add; a logistic
curve fitted on all labelled rows turns it into a probability.

Tokens are hashed into a table of fixed size, so the model that goes to the workers is bounded whatever the vocabulary.

Defined cases: a NULL or empty text has no segment and gets the curve's value at no evidence; without labels of both
classes every score is 0; rows without a label or an id are not learned from; a document with several labels counts once
for each; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import held_out, in_arrow, nameless, stored, table, without
from riskloom.llm.vectors import Slice, Words, mix, slices, word_hashes, words

BUCKETS_LOG2 = 20
#: Bytes of a word's stems.
STEMS = (4, 5, 6)
#: The lowest score of a token.
LEAST = -2.0
#: The prior of a bucket in each class: a share of this many tokens, and an equal part for every bucket.
PRIOR, EACH = 20.0, 0.5
#: The least drift: odds below it do not make a token positive.
LEAST_DRIFT = 3.0
#: Standard errors by which a bucket's log odds must differ from 0 to count; others score as a common token.
SIGNIFICANT = 3.0
#: A segment is reported when fewer than this many are expected by chance.
E_VALUE = 0.01
#: The evidence is calibrated in steps of 1 / STEPS up to LAST, and beyond it on a logarithmic scale.
STEPS, LAST, SHIFT = 10, 60, 3.0


class Model(NamedTuple):
    odds: np.ndarray  # float32 by bucket, 0 where not significant
    drift: float
    rate: float  # lambda of the extreme-value distribution
    scale: float  # K of it
    slope: float
    offset: float
    fitted: bool


    def scores(self, at: np.ndarray) -> np.ndarray:
        """Scores of words from their buckets: the form with the highest significant odds speaks for the word."""
        return np.maximum(self.odds[at].max(axis=0) - self.drift, LEAST)


def buckets(part: Slice) -> tuple[np.ndarray, Words]:
    """One row of buckets for the words of a slice of text, one for each length of stem; and the words' spans."""
    found = words(part)
    shift = np.uint64(64 - BUCKETS_LOG2)
    whole = mix(word_hashes(part.data, found.starts, found.ends) ^ np.uint64(1))
    stems = [word_hashes(part.data, found.starts, np.minimum(found.ends, found.starts + k)) for k in STEMS]
    return np.stack([(h >> shift).astype(np.int64) for h in (whole, *stems)]), found


def _count_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Token counts of a partition by bucket and class."""
    counts = np.zeros((2, 1 << BUCKETS_LOG2), np.int64)
    for batch in batches:
        label = batch.column("toxic").to_numpy(zero_copy_only=False).astype(np.int64)
        for part in slices(batch.column("text")):
            at, found = buckets(part)
            owner = label[part.first + found.rows()]
            for k in (0, 1):
                own = at[:, owner == k].ravel()
                if len(own):
                    at_, n = np.unique(own, return_counts=True)
                    counts[k, at_] += n
    seen = np.flatnonzero(counts.any(axis=0))
    for i in range(0, len(seen), 100_000):
        s = seen[i : i + 100_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array(s), pa.array(counts[0, s]), pa.array(counts[1, s])], ["bucket", "clean", "toxic"]
        )


def token_model(clean: np.ndarray, toxic: np.ndarray) -> Model:
    """Log odds by bucket, their drift, and lambda and K of segments in clean text; not calibrated yet."""
    forms = 1 + len(STEMS)
    both = clean + toxic
    total_clean, total_toxic = clean.sum() / forms, toxic.sum() / forms
    prior = EACH + PRIOR * both / max(total_clean + total_toxic, 1)
    a, b = toxic + prior, clean + prior
    seen = both > 0
    odds, weight = np.zeros(len(both)), np.zeros(len(both))
    rest_a, rest_b = np.maximum(total_toxic + PRIOR - a, 1), np.maximum(total_clean + PRIOR - b, 1)
    odds[seen] = np.log(a[seen] / rest_a[seen]) - np.log(b[seen] / rest_b[seen])
    weight[seen] = np.abs(odds[seen]) / np.sqrt(1 / a[seen] + 1 / b[seen])
    odds[weight < SIGNIFICANT] = 0.0
    share = clean / max(clean.sum(), 1)
    # An average clean token has to score below 0, by as much again as the positive part gains.
    drift = max(LEAST_DRIFT, 2 * float((share * np.maximum(odds, 0)).sum()))
    rate, scale = gumbel(np.maximum(odds - drift, LEAST), share)
    return Model(odds.astype(np.float32), drift, rate, scale, 0.0, 0.0, False)


def gumbel(scores: np.ndarray, share: np.ndarray) -> tuple[float, float]:
    """lambda solves sum(share * exp(lambda * score)) = 1; K is taken as the chance that a token starts a segment."""
    known = share > 0
    s, p = scores[known], share[known]
    if not (s > 0).any():
        return 1.0, 1e-3
    low, high = 1e-4, 20.0
    for _ in range(80):
        mid = (low + high) / 2
        with np.errstate(over="ignore"):
            low, high = (mid, high) if (p * np.exp(mid * s)).sum() < 1 else (low, mid)
    return low, float(p[s > 0].sum())


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score), disjoint and in order, in time linear in the text.

    Runs of equal sign are summed first, so the scan itself steps over positive runs only.
    """
    positive = np.flatnonzero(scores > 0)
    if not len(positive):
        return []
    sums = np.concatenate([[0.0], np.cumsum(scores, dtype=np.float64)])
    breaks = np.flatnonzero(np.diff(positive) > 1)
    starts = positive[np.concatenate([[0], breaks + 1])]
    ends = positive[np.concatenate([breaks, [len(positive) - 1]])] + 1
    # Stack of (start, end, sum before, sum after, index of the nearest earlier one with a smaller sum before).
    stack: list[tuple[int, int, float, float, int]] = []
    for start, end in zip(starts.tolist(), ends.tolist()):
        left, right = float(sums[start]), float(sums[end])
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= left:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= right:
                stack.append((start, end, left, right, j))
                break
            start, left = stack[j][0], stack[j][2]
            del stack[j:]
    return [(s, e, r - l) for s, e, l, r, _ in stack]


def significant(scores: np.ndarray, rate: float, scale: float) -> list[tuple[int, int, float, float]]:
    """(start, end, score, -log10 of the number expected by chance) of every maximal segment, best first."""
    n = max(len(scores), 1)
    shift = np.log10(max(scale, 1e-12) * n)
    found = [(s, e, x, rate * x / np.log(10) - shift) for s, e, x in segments(scores)]
    return sorted(found, key=lambda f: (-f[3], f[0]))


def evidence(scores: np.ndarray, rate: float, scale: float) -> float:
    """-log10 of the number of segments as good as the best one that clean text of this length would have by chance,
    and as much for every further significant segment; shifted so that weak evidence stays above 0."""
    found = significant(scores, rate, scale)
    if not found:
        return 0.0
    more = sum(f[3] for f in found[1:] if f[3] > -np.log10(E_VALUE))
    return float(max(found[0][3] + more + SHIFT, 0.0))


def _score(batches, model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = np.zeros(batch.num_rows)
        best = [None] * batch.num_rows
        for part in slices(batch.column("text")):
            at, found = buckets(part)
            scores = model.scores(at)
            hits = np.unique(np.searchsorted(found.bounds, np.flatnonzero(scores > 0), "right") - 1)
            for r in hits.tolist():
                a, b = found.bounds[r], found.bounds[r + 1]
                own = scores[a:b]
                out[part.first + r] = evidence(own, model.rate, model.scale)
                best[part.first + r] = [
                    {"first_word": int(s), "last_word": int(e - 1), "score": float(x), "log_e": float(v)}
                    for s, e, x, v in significant(own, model.rate, model.scale)
                    if v > -np.log10(E_VALUE)
                ]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in batch.schema.names if c != "text"), pa.array(out), pa.array(best, PASSAGES)],
            [*(c for c in batch.schema.names if c != "text"), "evidence", "passages"],
        )


PASSAGES = pa.list_(
    pa.struct([("first_word", pa.int64()), ("last_word", pa.int64()), ("score", pa.float64()), ("log_e", pa.float64())])
)
_PASSAGES_SQL = "passages array<struct<first_word: long, last_word: long, score: double, log_e: double>>"


def with_evidence(rows: DataFrame, model: Model) -> DataFrame:
    """Columns of ``rows`` (long, boolean and text ones beside the text), evidence and significant passages."""
    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")
    return in_arrow(rows, _score, f"{kept}, evidence double, {_PASSAGES_SQL}", model)


def _logistic(x: np.ndarray, positive: np.ndarray, negative: np.ndarray) -> tuple[float, float]:
    """Newton steps for P(label) = 1 / (1 + exp(-(slope * x + offset))) over counted cells, with a small ridge."""
    w = np.zeros(2)
    design = np.stack([x, np.ones_like(x)], axis=1)
    n = positive + negative
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        gradient = design.T @ (positive - n * p) - 1e-3 * w
        hessian = (design * (n * p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        w = w + step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def learn_tokens(rows: DataFrame) -> Model:
    """The model from labelled rows (text, toxic), not calibrated. The driver receives one row a bucket."""
    size = 1 << BUCKETS_LOG2
    totals = (
        in_arrow(rows.select(F.col("toxic").cast("long"), "text"), _count_tokens, "bucket long, clean long, toxic long")
        .groupBy("bucket")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .toArrow()
    )
    clean, toxic = np.zeros(size), np.zeros(size)
    at = totals.column("bucket").to_numpy()
    clean[at], toxic[at] = totals.column("clean").to_numpy(), totals.column("toxic").to_numpy()
    return token_model(clean, toxic)


def _scaled(evidence: str = "evidence") -> Column:
    """The evidence as the curve sees it: strong evidence keeps its order, and the number of steps stays small."""
    e = F.col(evidence)
    return F.when(e <= LAST, e).otherwise(LAST + F.log1p(e - LAST))


def calibrate(model: Model, labelled: DataFrame) -> Model:
    """Fit the logistic curve to all rows (evidence, toxic). The driver receives one row a step of evidence."""
    cells = (
        labelled.groupBy(F.round(_scaled() * STEPS).cast("int").alias("step"))
        .agg(F.count_if(F.col("toxic") == 1).alias("positive"), F.count_if(F.col("toxic") == 0).alias("negative"))
        .collect()
    )
    positive = np.array([c["positive"] for c in cells], float)
    negative = np.array([c["negative"] for c in cells], float)
    if not positive.sum() or not negative.sum():
        return model
    slope, offset = _logistic(np.array([c["step"] / STEPS for c in cells]), positive, negative)
    return model._replace(slope=slope, offset=offset, fitted=True)


def assess(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, nameless, evidence, passages, score, predicted for all documents.

    Labels are learned from where crc32(doc_id) mod 5 is not 0. Texts are shuffled once, to meet their labels for the
    token counts; the join is the same at every size. Evidence is stored once, for the calibration and the result.
    """
    known = labels.where(F.col("toxic").isin(0, 1) & ~held_out("doc_id", 5, 0)).select("doc_id", "toxic")
    rows = docs.select(
        F.col("doc_id").cast("long"), held_out("doc_id", 5, 0).alias("held_out"), nameless().alias("nameless"), "text"
    )
    own = rows.where(~F.col("held_out")).select("doc_id", "text")
    model = learn_tokens(own.join(known.hint("merge"), "doc_id"))
    found = stored(with_evidence(rows, model))
    model = calibrate(model, found.select("doc_id", "evidence").join(known.hint("merge"), "doc_id"))
    z = _scaled() * model.slope + model.offset
    scored = found.withColumn("score", 1 / (1 + F.exp(-z)) if model.fitted else F.lit(0.0))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def clean_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not predicted to be toxic, with all their columns."""
    return without(docs, assess(docs, labels).where("predicted = 1"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = assess(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted")
