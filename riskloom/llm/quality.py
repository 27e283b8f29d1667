"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of whole texts are computed by numpy over Arrow batches. Trees are grown on binned features: each level sums
gradients and hessians by (node, feature, bin) and takes the best split of every node. The trees are kept as flat arrays
of one complete binary tree each, so scoring is a few vectorised steps a level with no branch per row.

The fit uses at most ``FIT_ROWS`` labelled rows, those with the smallest hash of their id; everything else covers all
rows.

Defined cases: a NULL text is empty, and an empty text has all statistics 0 and the score the trees give to that; without
labels of both classes the score is their mean (0.5 without labels); rows without a label or an id are not learned from;
a document with several labels counts once for each; ties in a split go to the first feature and the lowest bin; further
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.sampling import first_by_hash
from riskloom.llm.common import held_out, in_arrow, table
from riskloom.llm.vectors import VISIBLE, Slice, slices, word_hashes, words

#: The bound on labelled rows that the trees are fitted on.
FIT_ROWS = 20_000
TREES, DEPTH, BINS = 60, 4, 64
RATE, RIDGE, LEAST_HESSIAN = 0.15, 1.0, 2.0

_bytes = np.arange(256)
_CLASSES = {
    "upper": (_bytes >= 65) & (_bytes <= 90),
    "lower": (_bytes >= 97) & (_bytes <= 122),
    "digit": (_bytes >= 48) & (_bytes <= 57),
    "beyond_ascii": _bytes >= 128,
    "space": _bytes == 32,
    "line": _bytes == 10,
    "sentence": np.isin(_bytes, [ord(c) for c in ".?"]),
    "shout": _bytes == ord("!"),
    "comma": np.isin(_bytes, [ord(c) for c in ",;:"]),
    "pipe": np.isin(_bytes, [ord(c) for c in "|/\\_"]),
    "markup": np.isin(_bytes, [ord(c) for c in "<>{}[]()="]),
    "odd": np.isin(_bytes, [ord(c) for c in "#$%&*+@^~`"]),
    "control": (_bytes < 32) & (_bytes != 10),
}
FEATURES = (
    *(f"share_{c}" for c in _CLASSES),
    "log_bytes", "log_words", "mean_word", "long_words", "short_words", "distinct_words", "distinct_pairs",
    "top_word", "repeat_neighbour", "words_a_line", "distinct_lines", "longest_run",
)


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of the values of each row."""
    total = np.concatenate([[0], np.cumsum(values)])
    return (total[offsets[1:]] - total[offsets[:-1]]).astype(float)


def _distinct(hashes: np.ndarray, owner: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each row, and the count of its most frequent one."""
    order = np.lexsort((hashes, owner))
    h, o = hashes[order], owner[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
    at = np.flatnonzero(fresh)
    top = np.zeros(rows)
    if len(at):
        np.maximum.at(top, o[at], np.diff(np.append(at, len(h))))
    return np.bincount(o[fresh], minlength=rows).astype(float), top


def statistics(part: Slice) -> np.ndarray:
    """One row of FEATURES for each row of a slice of text."""
    rows, n = part.rows, np.diff(part.offsets).astype(float)
    size = np.maximum(n, 1)
    columns = [_sums(c[part.data], part.offsets) / size for c in _CLASSES.values()]
    found = words(part, VISIBLE)
    length = (found.ends - found.starts).astype(float)
    owner, count = found.rows(), np.diff(found.bounds).astype(float)
    many = np.maximum(count, 1)
    hashes = word_hashes(part.data, found.starts, found.ends)
    same = owner[1:] == owner[:-1]
    with np.errstate(over="ignore"):
        pairs = hashes[1:][same] * np.uint64(0x9E3779B97F4A7C15) + hashes[:-1][same]
    distinct, top = _distinct(hashes, owner, rows)
    distinct_pairs, _ = _distinct(pairs, owner[1:][same], rows)
    repeated = np.bincount(owner[1:][same], hashes[1:][same] == hashes[:-1][same], minlength=rows)
    lines = words(part, _bytes != 10)
    line_owner, line_count = lines.rows(), np.maximum(np.diff(lines.bounds), 1)
    distinct_lines, _ = _distinct(word_hashes(part.data, lines.starts, lines.ends), line_owner, rows)
    # The longest run of one byte, as a share of the text.
    change = np.ones(len(part.data), bool)
    change[1:] = part.data[1:] != part.data[:-1]
    change[part.offsets[:-1][n > 0]] = True
    begin = np.flatnonzero(change)
    longest = np.zeros(rows)
    if len(begin):
        run_owner = np.searchsorted(part.offsets, begin, "right") - 1
        np.maximum.at(longest, run_owner, np.diff(np.append(begin, len(part.data))))
    columns += [
        np.log1p(n), np.log1p(count),
        np.bincount(owner, length, minlength=rows) / many,
        np.bincount(owner, length > 14, minlength=rows) / many,
        np.bincount(owner, length < 3, minlength=rows) / many,
        distinct / many, distinct_pairs / np.maximum(count - 1, 1), top / many, repeated / many,
        count / line_count, distinct_lines / line_count, longest / size,
    ]
    return np.stack(columns, axis=1)


class Trees(NamedTuple):
    """``TREES`` complete binary trees of one depth; node i has the children 2 i + 1 and 2 i + 2."""

    base: float
    feature: np.ndarray  # tree x inner node
    threshold: np.ndarray  # tree x inner node; a row goes right when its value is above
    leaf: np.ndarray  # tree x leaf

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        row = np.arange(len(x))
        inner = self.feature.shape[1] if len(self.feature) else 0
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(x), np.int64)
            for _ in range(int(np.log2(inner + 1))):
                node = 2 * node + 1 + (x[row, feature[node]] > threshold[node])
            out += leaf[node - inner]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -40, 40)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS) -> Trees:
    """Boosted trees for labels 0 and 1."""
    inner, leaves = (1 << depth) - 1, 1 << depth
    rate = (y.sum() + 0.5) / (len(y) + 1)
    base = float(np.log(rate / (1 - rate)))
    out = Trees(base, np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, leaves)))
    if not 0 < y.sum() < len(y):
        return out._replace(feature=out.feature[:0], threshold=out.threshold[:0], leaf=out.leaf[:0])
    features = x.shape[1]
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T)], axis=1)
    cell = binned + np.arange(features) * bins
    margin = np.full(len(y), base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            width = 1 << level
            flat = ((node - (width - 1))[:, None] * (features * bins) + cell).ravel()
            shape = (width, features, bins)
            size = width * features * bins
            gs = np.bincount(flat, np.repeat(g, features), minlength=size).reshape(shape).cumsum(axis=2)
            hs = np.bincount(flat, np.repeat(h, features), minlength=size).reshape(shape).cumsum(axis=2)
            g_all, h_all = gs[:, :1, -1:], hs[:, :1, -1:]
            gain = gs**2 / (hs + RIDGE) + (g_all - gs) ** 2 / (h_all - hs + RIDGE) - g_all**2 / (h_all + RIDGE)
            gain[(hs < LEAST_HESSIAN) | (h_all - hs < LEAST_HESSIAN)] = 0
            best = gain.reshape(width, -1).argmax(axis=1)
            for k, b in enumerate(best):
                f, cut = divmod(int(b), bins)
                if gain[k, f, cut] > 1e-9 and cut < len(edges[f]):
                    out.feature[t, width - 1 + k], out.threshold[t, width - 1 + k] = f, edges[f][cut]
            split, limit = out.feature[t, node], out.threshold[t, node]
            node = 2 * node + 1 + (x[np.arange(len(y)), split] > limit)
        leaf = node - inner
        value = -np.bincount(leaf, g, minlength=leaves) / (np.bincount(leaf, h, minlength=leaves) + RIDGE)
        out.leaf[t] = RATE * value
        margin += out.leaf[t, leaf]
    return out


def _features(batches) -> Iterator[pa.RecordBatch]:
    """Labels and statistics of the rows of the fit."""
    for batch in batches:
        x = [statistics(p) for p in slices(batch.column("text"))]
        if x:
            flat = pa.array(np.concatenate(x).ravel())
            offsets = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * len(FEATURES))
            yield pa.RecordBatch.from_arrays(
                [batch.column("quality"), pa.ListArray.from_arrays(offsets, flat)], ["quality", "x"]
            )


def _score(batches, trees: Trees) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts = [trees.probability(statistics(p)) for p in slices(batch.column("text"))]
        score = np.concatenate(parts) if parts else np.zeros(0)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("held_out"), pa.array(score)], ["doc_id", "held_out", "score"]
        )


def learn(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Trees:
    """Trees from at most ``rows`` labelled documents. Ids are chosen before any text is read, and they are few."""
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    chosen = first_by_hash(known.select("doc_id", F.col("quality").cast("long")), ["doc_id"], rows, ["doc_id", "quality"], None)
    small = F.broadcast(docs.sparkSession.createDataFrame(chosen.toArrow()))
    fitted = in_arrow(
        docs.select("doc_id", "text").join(small, "doc_id").select("quality", "text"),
        _features,
        "quality long, x array<double>",
    ).toArrow()
    if not fitted.num_rows:
        return Trees(0.0, np.zeros((0, 0), np.int64), np.zeros((0, 0)), np.zeros((0, 0)))
    x = np.array(fitted.column("x").combine_chunks().flatten().to_numpy()).reshape(-1, len(FEATURES))
    y = fitted.column("quality").to_numpy().astype(float)
    order = np.lexsort((*x.T, y))  # whatever order the tasks ended in, the sums are the same
    return fit(x[order], y[order])


def score(docs: DataFrame, trees: Trees) -> DataFrame:
    """doc_id, held_out, score, predicted for rows (doc_id, text)."""
    rows = docs.select(F.col("doc_id").cast("long"), held_out("doc_id", 3, 1).alias("held_out"), "text")
    found = in_arrow(rows, _score, "doc_id long, held_out boolean, score double", trees)
    return found.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return score(docs, learn(docs, labels.where(~held_out("doc_id", 3, 1))))
