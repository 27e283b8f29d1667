"""Boosted trees on binned tables, and what each feature adds to their scores.

Features become small whole numbers once: numbers fall between quantiles, text by its frequent values, and code 0 is the
unknown. The coded table is stored, cut into blocks, and held by the executors next to the margin of every row. A level of
a tree is one pass: each partition counts gradients by (node, feature, code), the sums of a node meet in one task, which
picks the best split of it, and the driver receives the splits alone. What a partition sends is bounded by the shape of the
model, what the driver receives by that of the tree. Up to a few blocks, one task makes all passes by itself.
Gradients are whole multiples of a small unit, so that sums do not depend on their order and a fit can be repeated.

A split is a set of codes that go left. For numbers it is a prefix with the unknown on the side that gains more; for text,
codes are first put in the order of their gradients.

Contributions are Shapley values along the paths of the trees: what a row's margin owes to each feature, where a feature
that is left out follows the training rows. A path with m features has 2**m cases, whose shares are worked out once per
leaf; a row then looks up its case. They add up to the margin exactly.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property
from math import factorial, log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import RDD
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.lineage import materialized, scope, shared_folder
from riskloom.functions.shipping import ship_package
from riskloom.functions.text import name

# Fixed values.
ROUNDS = 300
RATE = 0.05
#: Levels of a tree, rows and weight that a side of a split has at least, codes of a feature, smoothing of text values.
DEPTH, LEAST_ROWS, LEAST_WEIGHT, CODES, SMOOTH = 5, 20, 1e-3, 64, 10.0
#: Gradients are multiples of 1 / UNIT; rows of a block; the most tasks that pick the splits of a level; rounds between two
#: checkpoints of the margins.
UNIT, BLOCK_ROWS, FEW_PARTITIONS, EACH = 1 << 20, 1 << 20, 32, 25
#: Codes that one task goes through at most; cases and number of features that are counted together.
BLOCK_CODES, MOST_CASES, MOST_JOINED = 1 << 25, 1 << 10, 8
#: Blocks that one task goes through by itself: a level as a job costs more than counting them.
ALONE = 4
ACCURACY = 10_000


# Codes


@dataclass(frozen=True)
class Codes:
    """How the values of each feature become codes: above how many cuts a number lies, or which listed text it is."""

    features: tuple[str, ...]
    cuts: dict[str, list[float]]
    values: dict[str, list[str]]

    def of(self, batch: pa.RecordBatch) -> np.ndarray:
        """(features, rows) codes; 0 is unknown, and a text that is not listed has the last code."""
        out = np.zeros((len(self.features), batch.num_rows), np.uint8)
        for k, feature in enumerate(self.features):
            column = batch.column(feature)
            if feature in self.values:
                listed = self.values[feature]
                place = pc.index_in(column, pa.array(listed, pa.string())) if listed else pa.nulls(len(column), pa.int32())
                place = pc.fill_null(place, len(listed)).to_numpy(zero_copy_only=False) + 1
                out[k] = np.where(pc.is_null(column).to_numpy(zero_copy_only=False), 0, place)
            else:
                number = pc.fill_null(column.cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False)
                place = np.searchsorted(np.array(self.cuts[feature]), number, "left") + 1
                out[k] = np.where(np.isnan(number), 0, place)
        return out


def _numbers(df: DataFrame, features: Sequence[str]) -> list[str]:
    """The features as doubles or text, in their order."""
    types = {f.name: f.dataType for f in df.schema}
    kind = {c: "STRING" if isinstance(types[c], T.StringType) else "DOUBLE" for c in features}
    return [f"CAST({name(c)} AS {kind[c]}) AS {name(c)}" for c in features]


def fit_codes(df: DataFrame, features: Sequence[str], codes: int = CODES) -> Codes:
    """Cuts of all numbers in one pass, frequent values of all text columns in another."""
    typed = df.selectExpr(*_numbers(df, features))
    text = [f.name for f in typed.schema if isinstance(f.dataType, T.StringType)]
    number = [c for c in features if c not in text]
    cuts: dict[str, list[float]] = {}
    if number:
        steps = [k / (codes - 1) for k in range(1, codes - 1)]
        known = [F.nanvl(F.col(name(c)), F.lit(None)) for c in number]
        found = typed.agg(*[F.percentile_approx(x, steps, ACCURACY).alias(c) for x, c in zip(known, number)]).first()
        cuts = {c: sorted(set(found[c] or [])) for c in number}
    values: dict[str, list[str]] = {c: [] for c in text}
    if text:
        rows = typed.unpivot([], [F.col(name(c)) for c in text], "column", "value").where(F.col("value").isNotNull())
        order = Window.partitionBy("column").orderBy(F.desc("n"), "value")
        counted = rows.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
        frequent = counted.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= codes - 2)
        for r in sorted(frequent.collect(), key=lambda r: r["_rank"]):  # at most codes - 2 rows a column
            values[r["column"]].append(r["value"])
    return Codes(tuple(features), cuts, values)


# Trees


@dataclass(frozen=True)
class Tree:
    """Nodes as in a heap: the children of i are 2 i + 1 and 2 i + 2. ``feature`` is -1 in a leaf."""

    feature: np.ndarray
    left: np.ndarray
    value: np.ndarray
    cover: np.ndarray

    @staticmethod
    def empty(depth: int, codes: int) -> Tree:
        n = 2 ** (depth + 1) - 1
        return Tree(np.full(n, -1), np.zeros((n, codes), bool), np.zeros(n), np.zeros(n))

    def leaf_of(self, codes: np.ndarray) -> np.ndarray:
        """The leaf, or the node not split yet, of each column of codes."""
        at = np.zeros(codes.shape[1], np.int64)
        row = np.arange(codes.shape[1])
        while True:
            inner = self.feature[at] >= 0
            if not inner.any():
                return at
            who, node = (row, at) if inner.all() else (row[inner], at[inner])
            goes_left = self.left[node, codes[self.feature[node], who]]
            at[who] = 2 * node + 2 - goes_left


def joined(codes: np.ndarray) -> list[tuple[list[int], tuple[int, ...], np.ndarray]]:
    """Features put together as long as their codes have few cases: (features, codes of each, the case of every row).

    One count over the cases of several features, summed up by each of them, costs less than a count for each.
    """
    sizes = [int(k.max()) + 1 if k.size else 1 for k in codes]
    groups: list[list[int]] = []
    cases: list[int] = []
    for k in sorted(range(len(sizes)), key=lambda k: -sizes[k]):
        place = next((i for i, c in enumerate(cases) if c * sizes[k] <= MOST_CASES and len(groups[i]) < MOST_JOINED), None)
        if place is None:
            groups.append([])
            cases.append(1)
            place = len(groups) - 1
        groups[place].append(k)
        cases[place] *= sizes[k]
    out = []
    for group in groups:
        case = np.zeros(codes.shape[1], np.uint16)
        for k in group:
            case = case * np.uint16(sizes[k]) + codes[k]
        out.append((group, tuple(sizes[k] for k in group), case))
    return out


def dealt(codes: np.ndarray, tree: Tree, held: dict[int, np.ndarray | None]) -> dict[int, np.ndarray | None]:
    """The rows of each leaf or node not split yet, from those of nodes above; None stands for all rows."""
    out, todo = {}, dict(held)
    while todo:
        node, rows = todo.popitem()
        if tree.feature[node] < 0:
            out[node] = rows
            continue
        code = codes[tree.feature[node]]
        goes_left = tree.left[node].take(code if rows is None else code.take(rows))
        for child, side in ((2 * node + 1, goes_left), (2 * node + 2, ~goes_left)):
            todo[child] = np.flatnonzero(side) if rows is None else rows.compress(side)
    return out


@dataclass
class Block:
    """Rows next to each other: codes by feature, label, weight, margin."""

    codes: np.ndarray
    label: np.ndarray
    weight: np.ndarray
    margin: np.ndarray
    groups: list | None = None

    def __post_init__(self) -> None:
        if self.groups is None:
            self.groups = joined(self.codes)

    def advanced(self, tree: Tree, held: dict[int, np.ndarray | None] | None = None) -> Block:
        """With the margins after a further tree; ``held`` has the rows of some of its nodes, if they are known."""
        margin = self.margin.copy()
        for node, rows in dealt(self.codes, tree, {0: None} if held is None else held).items():
            margin[slice(None) if rows is None else rows] += tree.value[node]
        return Block(self.codes, self.label, self.weight, margin, self.groups)

    def gradients(self, rows: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Gradient and curvature of rows, in whole units."""
        margin, w, label = (x if rows is None else x.take(rows) for x in (self.margin, self.weight, self.label))
        p = 1 / (1 + np.exp(-margin))
        return np.rint(w * (p - label) * UNIT), np.rint(w * p * (1 - p) * UNIT)

    def counted(self, rows: np.ndarray | None, g: np.ndarray, h: np.ndarray, width: int) -> np.ndarray:
        """(gradient, curvature, rows; feature, code) sums of rows, whose gradients and curvatures are given."""
        out = np.zeros((3, len(self.codes), width))
        for group, sizes, case in self.groups:
            key = (case if rows is None else case.take(rows)).astype(np.intp)
            for j, x in enumerate((g, h, None)):
                sums = np.bincount(key, x, int(np.prod(sizes))).reshape(sizes)
                for axis, k in enumerate(group):
                    out[j, k, : sizes[axis]] = sums.sum(axis=tuple(a for a in range(len(sizes)) if a != axis))
        return out

    def sums(self, tree: Tree, nodes: np.ndarray) -> np.ndarray:
        """(gradient, curvature, rows; node, feature, code) of the given nodes, gradients in whole units."""
        held = dealt(self.codes, tree, {0: None})
        width = tree.left.shape[1]
        none = np.zeros(0, np.intp)
        parts = [held.get(node, none) for node in nodes.tolist()]
        return np.stack([self.counted(rows, *self.gradients(rows), width) for rows in parts], axis=1)


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / np.maximum(h, 1e-12)


@dataclass(frozen=True)
class Split:
    feature: int
    left: np.ndarray
    gain: float


def best_split(sums: np.ndarray, text: Sequence[bool]) -> Split | None:
    """The split of one node that gains most, from its (3, features, codes) sums; None where none gains.

    Codes are put in an order and cut: numbers in their own with the unknown behind or before all others, text by the mean
    gradient of each value.
    """
    is_text = np.array(text)
    g, h, n = sums / np.array([UNIT, UNIT, 1.0])[:, None, None]
    all_g, all_h, all_n = (x.sum(axis=1, keepdims=True) for x in (g, h, n))
    own = np.arange(n.shape[1])
    mean = np.where(n > 0, g / (h + SMOOTH), np.inf)
    unknown_behind = np.where(is_text[:, None], np.argsort(mean, axis=1, kind="stable"), np.roll(own, -1))
    best: Split | None = None
    for unknown_first, order in enumerate((unknown_behind, np.broadcast_to(own, n.shape))):
        gl, hl, nl = (np.cumsum(np.take_along_axis(x, order, axis=1), axis=1) for x in (g, h, n))
        gain = _gain(gl, hl) + _gain(all_g - gl, all_h - hl) - _gain(all_g, all_h)
        fits = (nl >= LEAST_ROWS) & (all_n - nl >= LEAST_ROWS) & (hl >= LEAST_WEIGHT) & (all_h - hl >= LEAST_WEIGHT)
        if unknown_first:
            fits &= (~is_text & (n[:, 0] > 0))[:, None]
        gain = np.where(fits, gain, 0.0)
        k, at = divmod(int(gain.argmax()), n.shape[1])
        if gain[k, at] > 1e-9 and (best is None or gain[k, at] > best.gain):
            left = np.zeros(n.shape[1], bool)
            left[order[k, : at + 1]] = True
            # What was not seen here goes with most rows: the unknown, and texts.
            unseen = (n[k] == 0) & (is_text[k] | (own == 0))
            left[unseen] = 2 * nl[k, at] > all_n[k, 0]
            best = Split(k, left, float(gain[k, at]))
    return best


@dataclass(frozen=True)
class Node:
    """What a tree takes from the sums of a node: (gradient, curvature, rows) of it and of both sides of its split, if any."""

    own: np.ndarray
    split: Split | None
    sides: np.ndarray | None

    @staticmethod
    def of(sums: np.ndarray, text: Sequence[bool]) -> Node:
        split = best_split(sums, text)
        sides = None
        if split is not None:
            of_feature = sums[:, split.feature]
            sides = np.stack([of_feature[:, side].sum(axis=1) for side in (split.left, ~split.left)])
        return Node(sums[:, 0].sum(axis=1), split, sides)


def grow(sums_of, text: Sequence[bool], depth: int, codes: int, rate: float) -> Tree:
    """A tree, level by level; ``sums_of(tree, nodes)`` gives the sums of the nodes of a level over all rows."""

    def nodes_of(tree: Tree, nodes: np.ndarray) -> list[Node]:
        sums = sums_of(tree, nodes)
        return [Node.of(sums[:, slot], text) for slot in range(len(nodes))]

    return grown(nodes_of, depth, codes, rate)


def grown(nodes_of, depth: int, codes: int, rate: float) -> Tree:
    """The same where ``nodes_of(tree, nodes)`` gives each node of a level, wherever its split was picked."""
    tree = Tree.empty(depth, codes)
    nodes = np.array([0])
    for level in range(depth):
        further = []
        for node, found in zip(nodes.tolist(), nodes_of(tree, nodes)):
            if level == 0:
                g, h, n = found.own
                tree.value[node], tree.cover[node] = -rate * g / max(h, 1.0), n
            if found.split is None:
                continue
            tree.feature[node], tree.left[node] = found.split.feature, found.split.left
            for child, (g, h, n) in zip((2 * node + 1, 2 * node + 2), found.sides):
                tree.value[child], tree.cover[child] = -rate * g / max(h, 1.0), n
                further.append(child)
        nodes = np.array(further)
        if not len(nodes):
            break
    return tree


# Contributions


@dataclass(frozen=True)
class Path:
    """One leaf: its features, for each the nodes on the path and their sides, and the shares of all 2**m cases."""

    features: np.ndarray
    nodes: list[list[tuple[int, bool]]]
    shares: np.ndarray
    expected: float


def path_shares(zero: Sequence[float], value: float) -> np.ndarray:
    """(case, feature) Shapley values of a leaf whose path has m features.

    Bit j of a case tells whether the row follows the path at feature j; a feature that is left out follows it with
    probability ``zero[j]``. With the other features in or out at random, the chance to follow is a polynomial in the
    number of those that are in; Shapley weighs its coefficients.
    """
    m = len(zero)
    cases = np.arange(2**m)
    one = [((cases >> j) & 1).astype(float) for j in range(m)]
    weights = np.array([factorial(k) * factorial(m - 1 - k) / factorial(m) for k in range(m)])
    out = np.zeros((2**m, m))
    for i in range(m):
        chance = np.zeros((2**m, m))
        chance[:, 0] = 1
        for j in range(m):
            if j != i:
                inside = chance * one[j][:, None]
                chance *= zero[j]
                chance[:, 1:] += inside[:, :-1]
        out[:, i] = value * (chance @ weights) * (one[i] - zero[i])
    return out


def paths(tree: Tree) -> list[Path]:
    out = []
    stack: list[tuple[int, list[tuple[int, bool]]]] = [(0, [])]
    while stack:
        node, steps = stack.pop()
        if tree.feature[node] >= 0:
            stack += [(2 * node + 1, [*steps, (node, True)]), (2 * node + 2, [*steps, (node, False)])]
            continue
        features = list(dict.fromkeys(int(tree.feature[n]) for n, _ in steps))
        by = [[(n, side) for n, side in steps if tree.feature[n] == f] for f in features]
        zero = [float(np.prod([tree.cover[2 * n + 2 - side] / tree.cover[n] for n, side in own])) for own in by]
        out.append(Path(np.array(features, int), by, path_shares(zero, tree.value[node]), tree.value[node] * float(np.prod(zero))))
    return out


# The model

_NODES = "tree int, node int, feature int, left binary, value double, cover double"
_CODES = "place int, feature string, cuts array<double>, `values` array<string>"


@dataclass(frozen=True)
class TreeModel:
    """Trees with the codes they read. ``transform`` adds ``score``, the probability of the label."""

    codes: Codes
    trees: tuple[Tree, ...]
    start: float

    def margins(self, codes: np.ndarray) -> np.ndarray:
        out = np.full(codes.shape[1], self.start)
        for tree in self.trees:
            out += tree.value[tree.leaf_of(codes)]
        return out

    def expected(self) -> float:
        """The mean margin of the training rows, as the covers tell it."""
        return self.start + sum(p.expected for own in self.paths for p in own)

    @cached_property
    def paths(self) -> list[list[Path]]:
        return [paths(t) for t in self.trees]

    def transform(self, df: DataFrame) -> DataFrame:
        return _mapped(self, df, df.columns, "score double", _score)

    def contributions(self, df: DataFrame, keys: Sequence[str]) -> DataFrame:
        """keys, margin, and contributions, an array in the order of the model's features. One pass for all features."""
        return _mapped(self, df, list(keys), "margin double, contributions array<double>", _contribute)

    def importance(self, df: DataFrame) -> DataFrame:
        """(feature, importance): mean absolute contributions."""
        rows = self.contributions(df, []).select(F.posexplode("contributions").alias("place", "part"))
        mean = rows.groupBy("place").agg(F.avg(F.abs("part")).alias("importance"))
        named = F.element_at(F.lit(list(self.codes.features)), F.col("place") + 1)
        return mean.select(named.alias("feature"), "importance")

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [
            (i, n, int(t.feature[n]), np.packbits(t.left[n]).tobytes(), float(t.value[n]), float(t.cover[n]))
            for i, t in enumerate(self.trees)
            for n in range(len(t.feature))
            if t.cover[n] > 0
        ]
        # Sizes are those of the model.
        spark.createDataFrame(rows, _NODES).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        c = self.codes
        coded = [(k, f, c.cuts.get(f), c.values.get(f)) for k, f in enumerate(c.features)]
        spark.createDataFrame(coded, _CODES).coalesce(1).write.mode("overwrite").parquet(f"{path}/codes")
        shape = json.dumps({"start": self.start, "trees": len(self.trees), "shape": self.trees[0].left.shape if self.trees else [1, CODES]})
        spark.createDataFrame([(shape,)], "shape string").coalesce(1).write.mode("overwrite").parquet(f"{path}/shape")

    @staticmethod
    def load(spark: SparkSession, path: str) -> TreeModel:
        shape = json.loads(spark.read.parquet(f"{path}/shape").first()["shape"])
        n, width = shape["shape"]
        trees = [Tree(np.full(n, -1), np.zeros((n, width), bool), np.zeros(n), np.zeros(n)) for _ in range(shape["trees"])]
        for r in spark.read.parquet(f"{path}/nodes").collect():  # the model's nodes
            t, k = trees[r["tree"]], r["node"]
            t.feature[k], t.value[k], t.cover[k] = r["feature"], r["value"], r["cover"]
            t.left[k] = np.unpackbits(np.frombuffer(bytes(r["left"]), np.uint8))[:width]
        coded = sorted(spark.read.parquet(f"{path}/codes").collect(), key=lambda r: r["place"])
        cuts = {r["feature"]: list(r["cuts"]) for r in coded if r["cuts"] is not None}
        values = {r["feature"]: list(r["values"]) for r in coded if r["values"] is not None}
        return TreeModel(Codes(tuple(r["feature"] for r in coded), cuts, values), tuple(trees), shape["start"])


def _mapped(model: TreeModel, df: DataFrame, keep: Sequence[str], added: str, fn) -> DataFrame:
    """``keep`` columns as they are and what ``fn`` adds. Inputs travel besides them under names of their own."""
    ship_package(df.sparkSession)
    inputs = [f"_in{k}" for k in range(len(model.codes.features))]
    typed = _numbers(df, model.codes.features)
    ready = df.selectExpr(*[name(c) for c in keep], *[f"{e.rsplit(' AS ', 1)[0]} AS {i}" for e, i in zip(typed, inputs)])
    schema = T.StructType([*df.select(*[name(c) for c in keep]).schema.fields, *T.StructType.fromDDL(added).fields])
    kept = len(keep)

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = pa.RecordBatch.from_arrays(batch.columns[kept:], list(model.codes.features))
            columns = fn(model, model.codes.of(own))
            yield pa.RecordBatch.from_arrays([*batch.columns[:kept], *columns], schema.names)

    return ready.mapInArrow(run, schema)


def _score(model: TreeModel, codes: np.ndarray) -> list[pa.Array]:
    return [pa.array(1 / (1 + np.exp(-model.margins(codes))))]


def _contribute(model: TreeModel, codes: np.ndarray) -> list[pa.Array]:
    n = codes.shape[1]
    out = np.zeros((len(model.codes.features), n))
    for tree, own_paths in zip(model.trees, model.paths):
        inner = np.flatnonzero(tree.feature >= 0).tolist()
        goes_left = {k: tree.left[k, codes[tree.feature[k]]] for k in inner}
        # Rows that go the same way at every node share their contributions.
        rows = np.arange(n)
        if len(inner) < 63:
            ways = np.zeros(n, np.int64)
            for j, k in enumerate(inner):
                ways |= goes_left[k].astype(np.int64) << j
            _, first, rows = np.unique(ways, return_index=True, return_inverse=True)
            goes_left = {k: side[first] for k, side in goes_left.items()}
        kinds = int(rows.max()) + 1 if n else 0
        parts = np.zeros((len(out), kinds))
        for path in own_paths:
            case = np.zeros(kinds, np.int64)
            for j, own in enumerate(path.nodes):
                follows = np.ones(kinds, bool)
                for node, side in own:
                    follows &= goes_left[node] == side
                case |= follows.astype(np.int64) << j
            for j, feature in enumerate(path.features.tolist()):
                parts[feature] += path.shares[case, j]
        for feature in {int(tree.feature[k]) for k in inner}:
            out[feature] += parts[feature, rows]
    offsets = np.arange(n + 1, dtype=np.int32) * len(out)
    listed = pa.ListArray.from_arrays(pa.array(offsets), pa.array(out.T.reshape(-1)))
    return [pa.array(model.margins(codes)), listed]


# Fitting


def _blocks(codes: Codes, batches) -> Iterator[pa.RecordBatch]:
    """One row a block: its number of rows, codes, labels and weights as bytes."""
    for batch in batches:
        for first in range(0, batch.num_rows, BLOCK_ROWS):
            part = batch.slice(first, BLOCK_ROWS)
            numbers = [part.column(c).to_numpy(zero_copy_only=False) for c in ("_label", "_weight")]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part.num_rows], pa.int32()),
                    pa.array([codes.of(part).tobytes()], pa.binary()),
                    *[pa.array([x.astype("<f8").tobytes()], pa.binary()) for x in numbers],
                ],
                ["n", "codes", "label", "weight"],
            )


def _merged(start: float, most: int):
    """The stored rows of a partition as blocks of up to ``most`` rows."""

    def blocks(rows) -> Iterator[Block]:
        held: list = []
        size = 0
        for r in rows:
            if held and size + r["n"] > most:
                yield one(held)
                held, size = [], 0
            held.append(r)
            size += r["n"]
        if held:
            yield one(held)

    def one(held: list) -> Block:
        codes = np.concatenate([np.frombuffer(r["codes"], np.uint8).reshape(-1, r["n"]) for r in held], axis=1)
        label, weight = (np.concatenate([np.frombuffer(r[c], "<f8") for r in held]) for c in ("label", "weight"))
        return Block(codes, label, weight, np.full(len(label), start))

    return blocks


def fit(
    df: DataFrame, features: Sequence[str], label: str, weight: str, rounds: int = ROUNDS, rate: float = RATE,
    depth: int = DEPTH, codes: int = CODES,
) -> TreeModel:
    """Boosted trees for a 0/1 label. Rows without a label take no part."""
    spark = df.sparkSession
    ship_package(spark)
    coded = fit_codes(df, features, codes)
    text = [f in coded.values for f in features]
    own = [f"CAST({name(label)} AS DOUBLE) AS _label", f"CAST({name(weight)} AS DOUBLE) AS _weight"]
    rows = df.where(F.col(name(label)).isNotNull()).selectExpr(*_numbers(df, features), *own)
    with scope(spark):
        stored = materialized(rows.mapInArrow(lambda b: _blocks(coded, b), "n int, codes binary, label binary, weight binary"))
        weights = [F.sum(F.col("_label") * F.col("_weight")), F.sum((1 - F.col("_label")) * F.col("_weight"))]
        ones, zeros, n = rows.agg(*weights, F.count(F.lit(1))).first()
        start = log(ones / zeros) if ones and zeros else 0.0
        # A pass over few rows is all scheduling, so a task gets a whole block, and one task makes all passes over a few of
        # them. Beyond that, there are as many tasks as keep all cores busy to the end of a pass.
        most = max(1, min(BLOCK_ROWS, BLOCK_CODES // max(1, ALONE * len(features))))
        alone, cores = n <= ALONE * most, spark.sparkContext.defaultParallelism
        tasks = 1 if alone else -(-n // (most * cores)) * cores
        blocks = stored.rdd.coalesce(tasks).mapPartitions(_merged(start, max(1, n) if alone else most))
        if not (ones and zeros):
            trees = []
        elif alone:
            trees = blocks.flatMap(lambda block: boosted(OneBlock(block), text, rounds, rate, depth, codes)).collect()
        else:
            if not spark.sparkContext.getCheckpointDir():
                spark.sparkContext.setCheckpointDir(shared_folder(spark))
            held = ManyBlocks(blocks)
            trees = boosted(held, text, rounds, rate, depth, codes)
            held.blocks.unpersist()
    return TreeModel(coded, tuple(trees), start)


class OneBlock:
    """All rows of a small fit: nothing has to meet, so what a level has found serves the next one."""

    def __init__(self, block: Block) -> None:
        self.block = block
        self._begin()

    def _begin(self) -> None:
        self.held: dict[int, np.ndarray | None] = {0: None}
        self.found: dict[int, np.ndarray] = {}
        self.g, self.h = self.block.gradients()

    def _counted(self, node: int, width: int) -> np.ndarray:
        rows = self.held[node]
        g, h = (x if rows is None else x.take(rows) for x in (self.g, self.h))
        return self.block.counted(rows, g, h, width)

    def sums(self, tree: Tree, nodes: np.ndarray) -> np.ndarray:
        """As those of the block. The larger side of a split is what the smaller one leaves of its node, as sums are whole."""
        self.held = dealt(self.block.codes, tree, self.held)
        width, above, self.found = tree.left.shape[1], self.found, {}
        for node in sorted(nodes.tolist(), key=lambda node: tree.cover[node]):
            sibling, parent = node + 1 if node % 2 else node - 1, (node - 1) // 2
            if sibling in self.found and parent in above:
                self.found[node] = above[parent] - self.found[sibling]
            else:
                self.found[node] = self._counted(node, width)
        return np.stack([self.found[node] for node in nodes.tolist()], axis=1)

    def tree(self, text: Sequence[bool], depth: int, codes: int, rate: float) -> Tree:
        return grow(self.sums, text, depth, codes, rate)

    def advance(self, tree: Tree) -> None:
        self.block = self.block.advanced(tree, self.held)
        self._begin()


class ManyBlocks:
    """Blocks that the executors hold; the sums of a node meet in one task, which sends its split to the driver."""

    def __init__(self, blocks: RDD) -> None:
        self.blocks, self.old, self.rounds = blocks.persist(), None, 0

    def nodes(self, tree: Tree, nodes: np.ndarray, text: Sequence[bool]) -> list[Node]:
        def sums(blocks) -> Iterator[tuple[int, np.ndarray]]:
            total = None
            for block in blocks:
                own = block.sums(tree, nodes)
                total = own if total is None else np.add(total, own, out=total)
            if total is not None:
                yield from ((slot, total[:, slot]) for slot in range(len(nodes)))

        # A partition has each node once, so there is nothing to combine before the shuffle.
        tasks = min(len(nodes), FEW_PARTITIONS)
        met = self.blocks.mapPartitions(sums).partitionBy(tasks, int)
        out = dict(met.mapPartitions(lambda parts: _picked(parts, text)).collect())
        if self.old is not None:  # this pass has read the new margins
            self.old.unpersist()
            self.old = None
        return [out[slot] for slot in range(len(nodes))]

    def tree(self, text: Sequence[bool], depth: int, codes: int, rate: float) -> Tree:
        return grown(lambda tree, nodes: self.nodes(tree, nodes, text), depth, codes, rate)

    def advance(self, tree: Tree) -> None:
        self.old, self.blocks = self.blocks, self.blocks.map(lambda block: block.advanced(tree)).persist()
        self.rounds += 1
        if self.rounds % EACH == 0:
            self.blocks.checkpoint()


def _picked(parts, text: Sequence[bool]) -> Iterator[tuple[int, Node]]:
    """Each node that meets here, from the sums of all partitions."""
    total: dict[int, np.ndarray] = {}
    for slot, sums in parts:
        total[slot] = total[slot] + sums if slot in total else sums
    for slot, sums in total.items():
        yield slot, Node.of(sums, text)


def boosted(rows: OneBlock | ManyBlocks, text: Sequence[bool], rounds: int, rate: float, depth: int, codes: int) -> list[Tree]:
    trees: list[Tree] = []
    for _ in range(rounds):
        trees.append(rows.tree(text, depth, codes, rate))
        if trees[-1].feature[0] < 0:
            break
        rows.advance(trees[-1])
    return trees
