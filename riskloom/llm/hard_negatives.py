"""Hard negatives for contrastive training: inner-product search within score windows, by cover trees.

Vectors are whole numbers, floor(scale * x). A coordinate sqrt(M^2 - |x|^2), M the largest norm, gives all of them one
norm, so that the inner product with an anchor falls as the Euclidean distance grows, and every ball of a tree bounds the
inner products inside of it from both sides.

The top level is a table: cells around rows that a hash picks, each with its covering radius; every row goes to its
nearest centre, and a cell of many rows (one vector may hold a third of them) is cut by a hash of the ids. Each piece gets
a cover tree of its own: a node's centres are chosen farthest first, so they are as far apart as their balls are wide, and
every child keeps the exact radius of what it covers. Equal vectors stay side by side in the leaves.

An anchor asks twice, for the best rows of its own label (its positives), and then, in the windows that these positives
open, for rows of other labels. Each time it goes first to the cell of the best bound, then to those cells whose bounds
reach the scores found there; a cell whose bounds miss all windows is skipped. Inside a piece the descent is best first
as well: leaves are visited in the order of their bounds, one, then two, then four at a time, each visit multiplies whole
numbers exactly, and what the window or the scores found so far exclude is skipped. So bounds only save work; the
result is that of comparing everything.

Anchors are dealt into blocks, a piece meets one block at a time, and only the best rows of each window leave a task.

Defined cases: rows with a NULL id, label, vector, or a NULL or non-finite component take no part, nor do those whose
vector has another length than most vectors (ties: the longer). Rows that share an id are rows of their own, but never
positives or negatives of an anchor of that id; an anchor that is there twice is one. Scores that do not fit 64 bits are
cut at their bounds. Ties go to the smaller id. Empty tables, and anchors without positives, give no rows. Further columns are
ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.llm.common import in_arrow, ship_package, stored, table

SCALE, EVERY, POSITIVES, NEGATIVES = 256, 100, 5, 5
#: Percent of the positive's score that a negative has at least.
LEAST_PERCENT = 80
#: Rows of a piece, cells at most (cells of more rows are cut), anchors of a block, rows of a leaf, children of a node.
PIECE, CELLS, BLOCK, LEAF, FAN = 2048, 4096, 32_768, 64, 8
#: Below this square of the largest norm, inner products and their order are exact in 64-bit floats and integers.
EXACT = 1 << 50
_FAR = np.iinfo(np.int64).max


class Space(NamedTuple):
    """What all tasks know: length of the vectors, square of the largest norm, centres (augmented) of the cells."""

    size: int
    most: float
    centres: np.ndarray


def _vectors(column: pa.Array, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i8").reshape(-1, size) if len(column) else np.zeros((0, size), "<i8")


def _augmented(vectors: np.ndarray, most: float, query: bool = False) -> np.ndarray:
    """Vectors with the coordinate that gives all the same norm; 0 for anchors."""
    v = vectors.astype(np.float64)
    rest = np.zeros(len(v)) if query else np.sqrt(np.maximum(most - (v * v).sum(axis=1), 0.0))
    return np.column_stack([v, rest])


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    squares = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2.0 * (a @ b.T)
    return np.sqrt(np.maximum(squares, 0.0))


def _bounds(queries: np.ndarray, centres: np.ndarray, radii: np.ndarray, most: float) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of each anchor with anything in each ball, with room for rounding."""
    own = (queries * queries).sum(axis=1)[:, None] + most
    d = _distances(queries, centres)
    # A distance is exact to about the square root of the unit in the last place.
    room = 1e-6 * np.sqrt(own) + 1e-6
    near, far = np.maximum(d - radii - room, 0.0), d + radii + room
    return (own - far * far) / 2 - 1e-9 * own - 1e-6, (own - near * near) / 2 + 1e-9 * own + 1e-6


class Tree(NamedTuple):
    """Nodes in the order of their levels; a leaf covers rows [begin, end) of the piece."""

    centres: np.ndarray
    radii: np.ndarray
    parents: np.ndarray
    begins: np.ndarray
    ends: np.ndarray
    leaves: np.ndarray


def cover_tree(points: np.ndarray) -> tuple[Tree, np.ndarray]:
    """The tree of a piece, and the order of its rows."""
    order = np.arange(len(points))
    nodes: list[tuple[np.ndarray, float, int, int, int, bool]] = []
    waiting = [(0, len(points), -1, 0)] if len(points) else []
    while waiting:
        level: list[tuple[int, int, int, int]] = []
        for begin, end, parent, centre in waiting:
            rows = order[begin:end]
            own = points[rows]
            at = own[centre]
            d = _distances(own, at[None, :])[:, 0]
            leaf = end - begin <= LEAF or d.max() <= 1e-6 * (1 + np.abs(at).max())
            nodes.append((at, float(d.max()), parent, begin, end, leaf))
            if leaf:
                continue
            # Farthest first: the node's own centre stays one of them.
            chosen, nearest, side = [centre], d, np.zeros(len(rows), np.int64)
            while len(chosen) < FAN and nearest.max() > 0:
                chosen.append(int(nearest.argmax()))
                d = _distances(own, own[chosen[-1]][None, :])[:, 0]
                side[d < nearest] = len(chosen) - 1
                nearest = np.minimum(d, nearest)
            side[chosen] = np.arange(len(chosen))
            place = np.argsort(side, kind="stable")
            order[begin:end] = rows[place]
            cuts = np.searchsorted(side[place], np.arange(len(chosen) + 1))
            for k, (s, e) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
                level.append((begin + s, begin + e, len(nodes) - 1, int(np.flatnonzero(place[s:e] == chosen[k])[0])))
        waiting = level
    if not nodes:
        nodes = [(np.zeros(points.shape[1]), 0.0, -1, 0, 0, True)]
    columns = [np.array(c) for c in zip(*nodes)]
    return Tree(*columns[:5], columns[5].astype(bool)), order


class Piece(NamedTuple):
    tree: Tree
    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    #: Place of each row in the order of ids.
    ranks: np.ndarray


class Asked(NamedTuple):
    """A block of anchors with their windows: rows (ids, labels, vectors), matrices of least and greatest scores."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    least: np.ndarray
    greatest: np.ndarray


def _scores(a: np.ndarray, b: np.ndarray, most: float) -> np.ndarray:
    if most < EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    exact = a.astype(object) @ b.astype(object).T
    return np.clip(exact, -_FAR, _FAR).astype(object)


def search(piece: Piece, asked: Asked, same: bool, count: int, most: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(score, row of the piece, whether there is one) of the ``count`` best rows in every window of every anchor."""
    tree, n, windows = piece.tree, len(asked.ids), asked.least.shape[1]
    wide = len(piece.ids).bit_length()
    kind = np.int64 if most < EXACT else object
    # A key is the score and then the id: larger keys come first. Scores below ``none`` do not exist.
    none = -(int(2 * most) + 2) << wide
    best = np.full((n, windows, count), none, kind)
    if not n or not len(piece.ids):
        return np.zeros_like(best), np.zeros(best.shape, np.int64), np.zeros(best.shape, bool)
    low, high = _bounds(_augmented(asked.vectors, most, query=True), tree.centres, tree.radii, most)
    least, greatest = asked.least.astype(np.float64), asked.greatest.astype(np.float64)

    def reaches(rows: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        """Whether a ball may hold something better for any window of an anchor."""
        worst = np.right_shift(best[rows, :, 0], wide) if kind is np.int64 else best[rows, :, 0] >> wide
        floor = np.maximum(least[rows], worst.astype(np.float64))
        return ((high[rows, nodes][:, None] >= floor) & (low[rows, nodes][:, None] <= greatest[rows])).any(axis=1)

    alive = np.zeros((n, len(tree.radii)), bool)
    for node, parent in enumerate(tree.parents.tolist()):
        rows = np.arange(n) if parent < 0 else np.flatnonzero(alive[:, parent])
        alive[rows, node] = reaches(rows, np.full(len(rows), node))
    leaves = np.flatnonzero(tree.leaves)
    order = leaves[np.argsort(-high[:, leaves], axis=1, kind="stable")]
    first, step = 0, 1
    while first < len(leaves):
        rows = np.repeat(np.arange(n), min(step, len(leaves) - first))
        nodes = order[:, first : first + step].reshape(-1)
        keep = alive[rows, nodes]
        rows, nodes = rows[keep], nodes[keep]
        keep = reaches(rows, nodes)
        rows, nodes = rows[keep], nodes[keep]
        for node in np.unique(nodes).tolist():
            who = rows[nodes == node]
            begin, end = int(tree.begins[node]), int(tree.ends[node])
            for at in range(begin, end, 512):  # a leaf of equal vectors may be long
                here = slice(at, min(at + 512, end))
                score = _scores(asked.vectors[who], piece.vectors[here], most)
                allowed = (piece.labels[here][None, :] == asked.labels[who][:, None]) == same
                allowed &= piece.ids[here][None, :] != asked.ids[who][:, None]
                key = (score << wide) + ((1 << wide) - 1 - piece.ranks[here])
                for w in range(windows):
                    fits = allowed & (score >= asked.least[who, w][:, None]) & (score <= asked.greatest[who, w][:, None])
                    some = np.flatnonzero((np.where(fits, key, none) > best[who, w, :1]).any(axis=1))
                    if len(some):
                        both = np.concatenate([best[who[some], w], np.where(fits[some], key[some], none)], axis=1)
                        best[who[some], w] = np.sort(both, axis=1)[:, -count:]
        first, step = first + step, step * 2
    found = best > none
    rank = ((1 << wide) - 1 - (best & ((1 << wide) - 1))).astype(np.int64)
    by_rank = np.argsort(piece.ranks)
    row = by_rank[np.where(found, rank, 0)]
    return np.where(found, best >> wide, 0), row, found


# Spark jobs


def whole_numbers(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", scale: int = SCALE) -> DataFrame:
    """(vec_id, label, q): the rows that take part, with vectors of floor(scale * x)."""
    whole = F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * scale).cast("long"))
    finite = F.forall(F.col(vector), lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")) & ~F.isnan(x.cast("double")))
    rows = rows.where(F.col(vec_id).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull()).where(finite)
    rows = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), whole.alias("q"))
    usual = rows.groupBy(F.size("q").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    return rows.where(F.size("q") == (usual["size"] if usual else 0))


def _assign(batches, space: Space) -> Iterator[pa.RecordBatch]:
    """(vec_id, label, q as bytes, cell, distance to its centre)."""
    for batch in batches:
        if batch.num_rows:
            q = batch.column("q").flatten().to_numpy(zero_copy_only=False).astype("<i8").reshape(batch.num_rows, -1)
            d = _distances(_augmented(q, space.most), space.centres)
            cell = d.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"), batch.column("label"), pa.array([x.tobytes() for x in q], pa.binary()),
                    pa.array(cell.astype(np.int32)), pa.array(d[np.arange(len(d)), cell]),
                ],
                ["vec_id", "label", "q", "cell", "distance"],
            )


_PIECE = "cell int, part int, ids binary, labels binary, vectors binary, tree binary, nodes int"


def _build(space: Space):
    def build(key: tuple[pa.Scalar, ...], part: pa.Table) -> pa.Table:
        """One row: a piece with its cover tree."""
        vectors = _vectors(part.column("q"), space.size)
        tree, order = cover_tree(_augmented(vectors, space.most))
        packed = np.column_stack([tree.centres, tree.radii, tree.parents, tree.begins, tree.ends, tree.leaves]).astype("<f8")
        ids, labels = part.column("vec_id").to_numpy()[order], part.column("label").to_numpy()[order]
        return pa.table(
            {
                "cell": pa.array([key[0].as_py()], pa.int32()), "part": pa.array([key[1].as_py()], pa.int32()),
                "ids": pa.array([ids.astype("<i8").tobytes()], pa.binary()),
                "labels": pa.array([labels.astype("<i8").tobytes()], pa.binary()),
                "vectors": pa.array([vectors[order].tobytes()], pa.binary()),
                "tree": pa.array([packed.tobytes()], pa.binary()), "nodes": pa.array([len(packed)], pa.int32()),
            }
        )

    return build


def _unpacked(row: dict, size: int) -> Piece:
    ids, labels = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["labels"], "<i8")
    t = np.frombuffer(row["tree"], "<f8").reshape(row["nodes"], -1)
    tree = Tree(t[:, : size + 1], t[:, size + 1], *t[:, size + 2 : size + 5].T.astype(np.int64), t[:, size + 5] > 0)
    ranks = np.empty(len(ids), np.int64)
    ranks[np.argsort(ids, kind="stable")] = np.arange(len(ids))
    return Piece(tree, ids, labels, np.frombuffer(row["vectors"], "<i8").reshape(-1, size), ranks)


class Index(NamedTuple):
    """The stored pieces, the cells' radii, and how often each cell is cut."""

    space: Space
    pieces: DataFrame
    radii: np.ndarray
    parts: np.ndarray


def index(rows: DataFrame) -> Index:
    """The cover trees of all rows of a table (vec_id, label, q)."""
    ship_package(rows.sparkSession)
    norm = F.aggregate("q", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    n, most, size = rows.agg(F.count(F.lit(1)), F.max(norm), F.max(F.size("q"))).first()
    size = size or 0
    cells = min(CELLS, max(1, math.ceil(n / PIECE)))
    picked = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "label", "q").limit(cells).select("q").collect()
    most = float(most or 0)
    centres = _augmented(np.array([r["q"] for r in picked], np.int64).reshape(len(picked), size), most)
    space = Space(size, most, np.unique(centres, axis=0))
    assigned = stored(in_arrow(rows, _assign, "vec_id long, label long, q binary, cell int, distance double", space))
    known = assigned.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("distance").alias("radius")).collect()
    radii, parts = np.full(len(space.centres), -1.0), np.ones(len(space.centres), np.int64)
    for r in known:
        radii[r["cell"]], parts[r["cell"]] = r["radius"], math.ceil(r["n"] / PIECE)
    cut = F.element_at(F.lit(parts.tolist()).cast("array<int>"), F.col("cell") + 1) if len(parts) else F.lit(1)
    part = F.pmod(F.xxhash64("vec_id", "label"), cut).cast("int")
    keyed = assigned.select("vec_id", "label", "q", "cell", part.alias("part"))
    return Index(space, stored(keyed.groupBy("cell", "part").applyInArrow(_build(space), _PIECE)), radii, parts)


_QUERY = "anchor long, label long, q binary, least array<long>, greatest array<long>"


def _route(batches, space: Space, radii: np.ndarray, best_only: bool, after: bool) -> Iterator[pa.RecordBatch]:
    """The anchors with every cell that they have to see: that of the best bound, or all others that reach a window."""
    for batch in batches:
        if not batch.num_rows:
            continue
        q = _augmented(_vectors(batch.column("q"), space.size), space.most, query=True)
        low, high = _bounds(q, space.centres, np.maximum(radii, 0.0), space.most)
        least = batch.column("least").flatten().to_numpy(zero_copy_only=False).reshape(len(q), -1).astype(np.float64)
        greatest = batch.column("greatest").flatten().to_numpy(zero_copy_only=False).reshape(len(q), -1).astype(np.float64)
        take = (high >= least.min(axis=1)[:, None]) & (low <= greatest.max(axis=1)[:, None]) & (radii >= 0)
        first = np.where(radii >= 0, high, -np.inf).argmax(axis=1)
        if best_only:
            take &= np.arange(len(radii)) == first[:, None]
        elif after:
            take &= np.arange(len(radii)) != first[:, None]
        row, cell = np.nonzero(take)
        out = batch.take(pa.array(row))
        yield pa.RecordBatch.from_arrays([*out.columns, pa.array(cell.astype(np.int32))], [*batch.schema.names, "cell"])


_FOUND = "anchor long, q binary, label long, place int, other long, score long"


def _searching(space: Space, same: bool, count: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        """The best rows of one piece for one block of anchors."""
        columns: list[list] = [[], [], [], [], [], []]
        if left.num_rows and right.num_rows:
            piece = _unpacked({c: left.column(c)[0].as_py() for c in ("ids", "labels", "vectors", "tree", "nodes")}, space.size)
            matrix = [np.array(right.column(c).to_pylist(), np.int64) for c in ("least", "greatest")]
            ids, labels = right.column("anchor").to_numpy(), right.column("label").to_numpy()
            asked = Asked(ids, labels, _vectors(right.column("q"), space.size), *matrix)
            score, row, found = search(piece, asked, same, count, space.most)
            who, place, _ = np.nonzero(found)
            q = right.column("q").take(pa.array(who))
            return pa.table(
                {
                    "anchor": pa.array(ids[who]), "q": q, "label": pa.array(labels[who]), "place": pa.array(place.astype(np.int32)),
                    "other": pa.array(piece.ids[row[found]]), "score": pa.array(score[found].astype(np.int64)),
                }
            )
        names = ("anchor", "q", "label", "place", "other", "score")
        kinds = (pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
        return pa.table({k: pa.array(c, t) for k, c, t in zip(names, columns, kinds)})

    return run


def _best(found: DataFrame, count: int) -> DataFrame:
    """The best rows of every window, with their rank from 1."""
    order = Window.partitionBy("anchor", "label", "q", "place").orderBy(F.desc("score"), "other")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)


def _ask(idx: Index, anchors: DataFrame, blocks: int, same: bool, count: int, best_only: bool = False, after: bool = False) -> DataFrame:
    schema = f"{_QUERY}, cell int"
    routed = in_arrow(anchors.select("anchor", "label", "q", "least", "greatest"), _route, schema, idx.space, idx.radii, best_only, after)
    block = F.pmod(F.xxhash64("anchor", "label", "q"), F.lit(blocks)).cast("int")
    parts = F.element_at(F.lit(idx.parts.tolist()).cast("array<int>"), F.col("cell") + 1)
    asked = routed.withColumn("block", block).withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))
    pieces = idx.pieces.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    keys = ["cell", "part", "block"]
    found = pieces.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(_searching(idx.space, same, count), _FOUND)
    return _best(found, count)


def _window(least: Column, greatest: Column) -> list[Column]:
    return [F.array(least.cast("long")).alias("least"), F.array(greatest.cast("long")).alias("greatest")]


def mine(
    rows: DataFrame, anchors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, percent: int = LEAST_PERCENT
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score, for tables (vec_id, label, q).

    A negative has another label, and a score of at most the positive's and at least ``percent`` of it.
    """
    rows = stored(rows)
    idx = index(rows)
    if not len(idx.space.centres):
        empty = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
        return rows.sparkSession.createDataFrame([], empty)
    packed = in_arrow(anchors, _assign, "vec_id long, label long, q binary, cell int, distance double", idx.space)
    own = stored(packed.select(F.col("vec_id").alias("anchor"), "label", "q").distinct())
    blocks = max(1, math.ceil(own.count() / BLOCK))
    keys = ["anchor", "label", "q"]
    everything = _window(F.lit(-_FAR), F.lit(_FAR))
    nearest = stored(_ask(idx, own.select(*keys, *everything), blocks, True, positives, best_only=True))
    # What was found first is the least that rows of other cells have to reach.
    reached = nearest.where(F.col("rank") == positives).select(*keys, F.col("score").alias("_reached"))
    further = own.join(reached, keys, "left").select(*keys, *_window(F.coalesce("_reached", F.lit(-_FAR)), F.lit(_FAR)))
    columns = [*keys, "place", "other", "score"]
    both = nearest.select(columns).unionByName(_ask(idx, further, blocks, True, positives, after=True).select(columns))
    chosen = stored(_best(both, positives).select(*keys, F.col("rank").alias("k"), F.col("other").alias("positive_id"), "score"))
    # percent * p <= 100 * n <= 100 * p
    least = F.ceil(F.col("score").cast("decimal(20,0)") * percent / 100).cast("long")
    windows = chosen.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("k", least.alias("least"), F.col("score").alias("greatest")))).alias("w"))
    # Windows of anchors with fewer positives are filled up with empty ones, so that all have the same number.
    filled = F.lit(positives) - F.size("w")
    asked = windows.select(
        *keys,
        F.concat(F.col("w.least"), F.array_repeat(F.lit(1).cast("long"), filled)).alias("least"),
        F.concat(F.col("w.greatest"), F.array_repeat(F.lit(0).cast("long"), filled)).alias("greatest"),
    )
    found = _ask(idx, stored(asked), blocks, False, negatives)
    named = found.withColumn("k", F.col("place") + 1).withColumnRenamed("score", "negative_score").join(chosen, [*keys, "k"])
    return named.select(
        F.col("anchor").alias("anchor_id"), "positive_id", "rank", F.col("other").alias("negative_id"),
        F.col("score").alias("positive_score"), "negative_score",
    )


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whole_numbers(table(spark, sf_dir, "embeddings"))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows.withColumn("label", moved)
    return mine(rows, rows.where(F.col("vec_id") % EVERY == 0))


OP12_SQL = """
WITH used AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * x::DOUBLE) FOR x IN embedding] AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x::DOUBLE)]) = 0
),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         list_dot_product(a.q, b.q)::BIGINT AS score
  FROM (SELECT * FROM used WHERE vec_id % 100 = 0) a JOIN used b ON a.vec_id <> b.vec_id
),
positive AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score
  FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id)::INTEGER AS rank,
       s.other_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positive p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score
QUALIFY rank <= 5
"""
