"""N-gram Jaccard self-join by chosen paths (Christiani, Pagh and Sivertsen's CPSJoin), as rounds of Spark jobs.

A document is its set of distinct five-word shingles. Documents with one and the same set are one class from the start;
the join works on one set of each class.

Every set is embedded as ``COORDINATES`` MinHash values (one permutation, densified) of four bytes. A run starts with all
sets in one node. A node picks coordinates by its own seed, 1 / threshold of them on average, and sends each set to one
child for every picked coordinate, chosen by the set's value there: similar sets share paths. Paths are rows (node, id)
and nothing else; those that are alone in their node end there, and only the others meet their MinHash values again.
Nodes of at most ``LEAF`` sets are brute-forced on these. Larger nodes are split again; before that, every set is compared
with a block of its node, ``TILE`` sets on average, and one that resembles a smaller one as much as linked sets have to is
linked to the best of them and leaves the recursion, which is what keeps a group of thousands of near copies linear. What a
run proposes is verified on the full sets, and a set that is linked to a smaller one takes no part in the next run: the
smallest of its group stand for it.

Values of four bytes keep sets apart that have nothing in common: of two bytes, a first level of 65,536 nodes a coordinate
would bring all sets of a large table together, the more the larger it is.

Runs are repeated until the target recall: what a run still joins tells how much is left. A run finds a pair at the
threshold with a known probability at least, and what the last three join shows how much better they do with the sets at
hand. ``runs_for`` bounds their number.

The paths leave each set with links to its group, not with certainty. An exact search then looks for links between
different groups only: linked sets share one of their rarest shingles (prefix filter), and what sizes and places of it
allow is verified and joined to the groups. So no link is lost, whatever the depth of the recursion.

Nodes are rows, never objects: no node is collected into one row unless it has at most ``LEAF`` sets, larger ones are blocks
of rows. Sets are stored once,
in a table bucketed by id; joins bring ids to them and do not move them. All intermediates go when the join is over.

Results: one row per document with class_id (smallest doc_id of its group) and n_links, the number of links of its set to
other sets plus its equal copies. Links are counted when the groups are known, exactly, by comparing each group with
itself block by block on the full sets; ``one_of_each`` needs no numbers and leaves that out.

Defined cases: a text of one to four words is one shingle; a NULL, empty or wordless text has no set, no link and its own
class; rows without an id are joined as all others, and class_id is NULL where none of a group has one; repeated rows share class and
links; similarity is 0.8 or more, ties included; empty tables give no rows; further columns are ignored.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.lineage import discard, kept, scope, temporary_path
from riskloom.llm.common import in_arrow, nameless, one_row_each, ship_package, stored, table, without
from riskloom.llm.vectors import mix, shingles, slices, word_hashes, words

THRESHOLD, RECALL = 0.8, 0.99
COORDINATES_LOG2 = 7
COORDINATES = 1 << COORDINATES_LOG2
LEAF = 64
#: What a text with a word has.
A_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
#: Bytes of a bucket of stored sets, and buckets at most; digests by which a task knows that it has sent a set before.
BUCKET_BYTES, BUCKETS, SENT = 16 << 20, 20_000, 1_000_000
#: Sketches that agree on this share are proposed, those of a leaf's set with so many smaller ones.
PROPOSED, BEST = 0.62, 3
#: Sets that are compared at a time (a block of a node or of a group), shingles at a time, and bytes of the sets that a task counts links of.
TILE, COLUMNS, BLOCK_BYTES = 256, 4096, 8 << 20
#: Shingles in a block of prefixes, entries that a task holds back, and entries of a shingle compared at a time.
PREFIX_BLOCK, PREFIX_FLUSH, RUN_TILE = 1_000_000, 500_000, 1024
#: Steps of a path that are taken at a time where nodes stay large: one after the first level, two after the second, ...
STEPS = 6
#: Depth for which the bound on runs is chosen: most nodes are leaves by then.
USUAL_DEPTH = 4

_U = np.uint64
_BINS = np.arange(COORDINATES, dtype=np.uint64) << _U(64 - COORDINATES_LOG2)
_PROBES = (mix(np.arange(64 * COORDINATES, dtype=np.uint64) + _U(1)) % _U(COORDINATES)).astype(np.int64).reshape(64, -1)


def chance(threshold: float, depth: int) -> float:
    """Probability that a pair at the threshold shares a node of this depth in one run."""
    extra = 1 / threshold - 1
    level = 1 - (1 - threshold) * (1 - extra * threshold)
    return level**depth


def runs_for(recall: float, threshold: float) -> int:
    """Runs until a pair at the threshold shares a leaf with the wanted probability, were they ``USUAL_DEPTH`` levels deep."""
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - chance(threshold, USUAL_DEPTH))))


def recall_reached(joined: list[int], depth: int, threshold: float) -> float:
    """Estimated share of what runs can join, after runs that have joined so many sets each.

    A run leaves (1 - p) / p sets for each that it joins, where p is its chance. The bound on p is that of a pair at the
    threshold in the deepest node. Three runs show how they fare with the sets at hand, by the worse of the last two: the
    first finds what is easy to find.
    """
    p = chance(threshold, depth)
    if len(joined) > 2 and min(joined[-3:-1]) > 0:
        p = max(p, 1 - max(joined[-1] / joined[-2], joined[-2] / joined[-3]))
    left = joined[-1] * (1 - p) / p
    return sum(joined) / (sum(joined) + left) if sum(joined) else 1.0


def min_hashes(values: np.ndarray) -> np.ndarray:
    """MinHash values of a sorted set: the smallest of each bin; an empty bin borrows that of a fixed other bin."""
    at = np.searchsorted(values, _BINS)
    filled = np.append(at[1:], len(values)) > at
    out = np.zeros(COORDINATES, np.uint32)
    out[filled] = (values[at[filled]] >> _U(16)).astype(np.uint32)
    empty = np.flatnonzero(~filled)
    for probe in _PROBES:
        if not len(empty):
            return out
        source = probe[empty]
        good = filled[source]
        out[empty[good]] = out[source[good]]
        empty = empty[~good]
    have = np.flatnonzero(filled)
    out[empty] = out[have[np.searchsorted(have, empty) % len(have)]]
    return out


def _sketch(batches) -> Iterator[pa.RecordBatch]:
    """doc_id, nameless, d1, d2 (digest of the set), size, mins, shingles of texts; NULL digests where there is no word.

    mins and shingles are NULL where the task has sent the same set before.
    """
    sent: set[int] = set()
    for batch in batches:
        for part in slices(batch.column("text")):
            found = words(part)
            hashes, bounds = shingles(word_hashes(part.data, found.starts, found.ends), found.bounds)
            d1, d2, size, mins, sets = [], [], [], [], []
            for r in range(part.rows):
                own = np.unique(hashes[bounds[r] : bounds[r + 1]])
                size.append(len(own))
                if len(own):
                    with np.errstate(over="ignore"):
                        d1.append(int(mix(own).sum(dtype=np.uint64).astype(np.int64)))
                        d2.append(int(mix(own ^ _U(0x5555555555555555)).sum(dtype=np.uint64).astype(np.int64)))
                    new = d1[-1] not in sent
                    if len(sent) >= SENT:
                        sent.clear()
                    sent.add(d1[-1])
                    mins.append(min_hashes(own).astype("<u4").tobytes() if new else None)
                    sets.append(np.unique((own >> _U(32)).astype("<u4")).tobytes() if new else None)
                else:
                    for column in (d1, d2, mins, sets):
                        column.append(None)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c).slice(part.first, part.rows) for c in ("doc_id", "nameless")),
                    pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), pa.array(size, pa.int32()),
                    pa.array(mins, pa.binary()), pa.array(sets, pa.binary()),
                ],
                ["doc_id", "nameless", "d1", "d2", "size", "mins", "shingles"],
            )


_SKETCH = "doc_id long, nameless string, d1 long, d2 long, size int, mins binary, shingles binary"


# A set goes by 63 bits of its digest, so that those without an id, or that share one by mistake, are joined as well.
_KEY = "d1 & 9223372036854775807 AS id"


def _matrix(column: pa.Array, kind: str) -> np.ndarray:
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, kind).reshape(len(column), -1) if len(column) else np.zeros((0, COORDINATES), kind)


def _children(nodes: np.ndarray, mins: np.ndarray, threshold: float, steps: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """(child node, row) of every set after so many steps of the path.

    A step takes one coordinate always, and a second one so often that 1 / threshold is the mean.
    """
    row = np.arange(len(nodes))
    for _ in range(steps):
        out_node, out_row = [], []
        first = (mix(nodes + _U(1)) % _U(COORDINATES)).astype(np.int64)
        second = (mix(nodes + _U(3)) % _U(COORDINATES)).astype(np.int64)
        again = (mix(nodes + _U(17)) < _U(int((1 / threshold - 1) * 2**64))) & (second != first)
        for pick, take in ((first, np.arange(len(nodes))), (second, np.flatnonzero(again))):
            with np.errstate(over="ignore"):
                seed = mix(nodes[take] + pick[take].astype(np.uint64) * _U(0x9E3779B97F4A7C15))
                out_node.append(mix(seed ^ mins[row[take], pick[take]]))
            out_row.append(row[take])
        nodes, row = np.concatenate(out_node), np.concatenate(out_row)
    return nodes, row


def _node_rows(nodes: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(nodes.view(np.int64)), pa.array(ids)], ["node", "id"])


def _first_level(batches, run: int, threshold: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, mins = batch.column("id").to_numpy(), _matrix(batch.column("mins"), "<u4")
        nodes = np.full(len(ids), mix(np.array([run], np.uint64))[0])
        child, row = _children(nodes, mins, threshold)
        yield _node_rows(child, ids[row])


PATH, LINK = 0, 1


def _shares(ids: np.ndarray, sketches: np.ndarray) -> np.ndarray:
    """The share on which every set agrees with every one of a smaller id; -1 for all others."""
    share = (sketches[:, None, :] == sketches[None, :, :]).mean(axis=2)
    share[ids[:, None] <= ids[None, :]] = -1.0
    return share


def _best_smaller(ids: np.ndarray, sketches: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of every set, the share on which it agrees best with one of a smaller id, and that one; -1 if there is none."""
    share = _shares(ids, sketches)
    best = share.argmax(axis=1)
    return share[np.arange(len(ids)), best], ids[best]


def _next_level(batches, threshold: float, steps: int) -> Iterator[pa.RecordBatch]:
    """Rows (kind, node, id, a): a path to a child, or a proposed link id - a, for the blocks of a node's sets."""
    for batch in batches:
        if not batch.num_rows:
            continue
        members = batch.column("members")
        bounds, flat = members.offsets.to_numpy(), members.values
        ids, mins = flat.field("id").to_numpy(), _matrix(flat.field("mins"), "<u4")
        nodes = np.repeat(batch.column("node").to_numpy().view(np.uint64), np.diff(bounds))
        top, star = np.empty(len(ids)), np.empty(len(ids), np.int64)
        for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            top[s:e], star[s:e] = _best_smaller(ids[s:e], mins[s:e])
        linked = top >= PROPOSED
        # Sets as similar to another one as links have to be would share paths for ever; the smallest stand for them.
        goes_on = top < threshold
        child, at = _children(nodes[goes_on], mins[goes_on], threshold, steps)
        child_id = ids[goes_on][at]
        parts = (
            (PATH, child, child_id, np.zeros(len(child), np.int64)),
            (LINK, np.zeros(int(linked.sum()), np.uint64), ids[linked], star[linked]),
        )
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([np.full(len(x), kind, np.int32) for kind, x, _, _ in parts])),
                pa.array(np.concatenate([x for _, x, _, _ in parts]).view(np.int64)),
                pa.array(np.concatenate([x for _, _, x, _ in parts])),
                pa.array(np.concatenate([x for _, _, _, x in parts])),
            ],
            ["kind", "node", "id", "a"],
        )


def _leaf_links(ids: np.ndarray, sketches: np.ndarray) -> list[tuple[int, int]]:
    """Pairs proposed in a leaf: every set with the ``BEST`` smaller ones that it agrees with most.

    They hold a group together; all its pairs would be as many as the square of its size, and ``degrees`` counts these.
    """
    share = _shares(ids, sketches)
    best = np.argsort(-share, axis=1, kind="stable")[:, :BEST]
    i, j = np.repeat(np.arange(len(ids)), best.shape[1]), best.ravel()
    good = share[i, j] >= PROPOSED
    return list(zip(ids[j[good]].tolist(), ids[i[good]].tolist()))


def _brute_force(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        members = batch.column("members")
        bounds = members.offsets.to_numpy()
        flat = members.values
        ids, sketches = flat.field("id").to_numpy(), _matrix(flat.field("mins"), "<u4")
        pairs: set[tuple[int, int]] = set()
        for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            order = np.argsort(ids[s:e]) + s
            pairs.update(_leaf_links(ids[order], sketches[order]))
        listed = np.array(sorted(pairs), np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([pa.array(listed[:, 0]), pa.array(listed[:, 1])], ["a", "b"])


def _verify(batches, threshold: float) -> Iterator[pa.RecordBatch]:
    """Pairs whose full sets have the wanted similarity."""
    for batch in batches:
        good, found = [], []
        for x, y in zip(batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist()):
            p, q = np.frombuffer(x, "<u4"), np.frombuffer(y, "<u4")
            shared = len(np.intersect1d(p, q, assume_unique=True))
            similarity = shared / (len(p) + len(q) - shared)
            good.append(similarity >= threshold - 1e-12)
            found.append(similarity)
        keep = pa.array(good, pa.bool_())
        yield pa.RecordBatch.from_arrays(
            [c.filter(keep) for c in (batch.column("a"), batch.column("b"), pa.array(found, pa.float64()))],
            ["a", "b", "similarity"],
        )


def proposals(sets: DataFrame, run: int, threshold: float = THRESHOLD, gone: DataFrame | None = None) -> tuple[DataFrame, int]:
    """Distinct pairs (a, b), a < b, that one run proposes for rows (id, mins), and how deep it went.

    ``gone`` (id) names the rows that take no part.
    """
    part = sets if gone is None else sets.join(gone, "id", "left_anti")
    paths = stored(in_arrow(part.select("id", "mins"), _first_level, "node long, id long", run, threshold))
    found: list[DataFrame] = []
    leaves: list[DataFrame] = []
    depth = 1
    while True:
        sizes = paths.groupBy("node").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
        rows = stored(paths.join(sizes, "node"))
        leaves.append(rows.where(F.col("n") <= LEAF).select("node", "id"))
        if (rows.agg(F.max("n")).first()[0] or 0) <= LEAF:
            break
        # Blocks differ from run to run, and a node that was not split is dealt anew as its number is another one.
        large = rows.where(F.col("n") > LEAF)
        block = F.pmod(F.xxhash64("id", "node", F.lit(run)), F.ceil(F.col("n") / TILE)).alias("block")
        dealt = large.select("node", "id", block).join(sets.select("id", "mins"), "id")
        blocks = dealt.groupBy("node", "block").agg(F.collect_list(F.struct("id", "mins")).alias("members"))
        steps = min(len(leaves), STEPS)
        depth += steps
        level = stored(in_arrow(blocks.select("node", "members"), _next_level, "kind int, node long, id long, a long", threshold, steps))
        link = level.where(F.col("kind") == LINK)
        found.append(link.select(F.least("a", "id").alias("a"), F.greatest("a", "id").alias("b")))
        paths = level.where(F.col("kind") == PATH).select("node", "id")
    # The leaves of all levels at once; nodes of different levels have different numbers.
    members = reduce(DataFrame.unionByName, leaves).join(sets, "id")
    members = members.groupBy("node").agg(F.collect_list(F.struct("id", "mins")).alias("members"))
    found.append(in_arrow(members.select("members"), _brute_force, "a long, b long"))
    return reduce(DataFrame.unionByName, found).distinct(), depth


def candidates(sets: DataFrame, run: int = 1, threshold: float = THRESHOLD, gone: DataFrame | None = None) -> DataFrame:
    """Distinct pairs (a, b), a < b, that one run proposes for rows (id, mins)."""
    return proposals(sets, run, threshold, gone)[0]


def joined_by_paths(sets: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """(id, group) of the sets that runs have joined, for rows (id, mins, shingles).

    A set that is linked to a smaller one leaves the search: the smallest ones stand for it in further runs.
    """
    spark = sets.sparkSession
    sketches, full = sets.select("id", "mins"), sets.select("id", "shingles")
    links = stored(spark.createDataFrame([], "a long, b long"))
    joined: list[int] = []
    for run in range(1, runs_for(recall, threshold) + 1):
        with scope(spark):
            gone = links.select(F.col("b").alias("id")).distinct() if sum(joined) else None
            pairs, depth = proposals(sketches, run, threshold, gone)
            links = links.unionByName(verified(pairs, full, threshold, kept).select("a", "b"))
        joined.append(links.select("b").distinct().count() - sum(joined))
        if recall_reached(joined, depth, threshold) >= recall:
            break
    return stored(components(links))


# Exact search for what the paths have missed


def _frequencies(batches, log2: int) -> Iterator[pa.RecordBatch]:
    """How often the shingles of each hash range occur, in slices of the table."""
    counts = np.zeros(1 << log2, np.int64)
    for batch in batches:
        data = b"".join(batch.column("shingles").to_pylist())
        at = np.frombuffer(data, "<u4") >> np.uint32(32 - log2)
        counts += np.bincount(at, minlength=len(counts))
    if counts.any():
        parts = np.array_split(np.minimum(counts, 0xFFFFFFFF).astype("<u4"), 1 << min(log2, 6))
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(parts)), pa.int32()), pa.array([x.tobytes() for x in parts], pa.binary())],
            ["slice", "counts"],
        )


def _sum_slices(part: pa.Table) -> pa.Table:
    """One byte a range: the binary logarithm of its count, in quarters."""
    total = sum(np.frombuffer(x, "<u4").astype(np.int64) for x in part.column("counts").to_pylist())
    ranks = np.minimum(4 * np.log2(total + 1.0), 255).astype("u1")
    return pa.table({"slice": part.column("slice").slice(0, 1), "ranks": pa.array([ranks.tobytes()], pa.binary())})


def shingle_ranks(sets: DataFrame, log2: int) -> np.ndarray:
    """How common the shingles of each hash range are. Any table gives the same pairs; a good one gives little work."""
    ship_package(sets.sparkSession)
    parts = in_arrow(sets.select("shingles"), _frequencies, "slice int, counts binary", log2)
    rows = parts.groupBy("slice").applyInArrow(_sum_slices, "slice int, ranks binary").collect()
    data = b"".join(bytes(r["ranks"]) for r in sorted(rows, key=lambda r: r["slice"]))
    return np.frombuffer(data, "u1") if data else np.zeros(1 << log2, "u1")


_TOKENS = np.dtype([("token", "<u4"), ("pos", "<u4"), ("size", "<u4"), ("id", "<i8"), ("group", "<i8")])


def _prefixes(batches, shared, blocks: int, threshold: float) -> Iterator[pa.RecordBatch]:
    """The rarest shingles of every set, so many that linked sets share one, packed by block of their hash range."""
    ranks = shared.value
    shift = np.uint32(32 - (len(ranks).bit_length() - 1))
    held: list[np.ndarray] = []
    size = 0

    def flush():
        rows = np.concatenate(held)
        block = (rows["token"].astype(np.uint64) * _U(blocks) >> _U(32)).astype(np.int32)
        order = np.argsort(block, kind="stable")
        rows, block = rows[order], block[order]
        at = np.searchsorted(block, np.arange(blocks + 1))
        some = np.flatnonzero(np.diff(at))
        return pa.RecordBatch.from_arrays(
            [pa.array(some.astype(np.int32)), pa.array([rows[at[b] : at[b + 1]].tobytes() for b in some], pa.binary())],
            ["block", "rows"],
        )

    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("id", "group", "shingles"))
        for own_id, group, data in zip(*columns):
            own = np.frombuffer(data, "<u4")
            first = len(own) - math.ceil(threshold * len(own) - 1e-9) + 1
            order = np.lexsort((mix(own.astype(np.uint64)), ranks[own >> shift]))[:first]
            rows = np.empty(len(order), _TOKENS)
            rows["token"], rows["pos"], rows["size"] = own[order], np.arange(len(order)), len(own)
            rows["id"], rows["group"] = own_id, group
            held.append(rows)
            size += len(rows)
            if size >= PREFIX_FLUSH:
                yield flush()
                held.clear()
                size = 0
    if held:
        yield flush()


def _mixed(part: pa.Table) -> pa.Table:
    """Of one block, the shingles that sets of different groups share; long runs of a shingle as one row a tile.

    A row's first ``own`` entries have to be compared with all entries after them.
    """
    rows = np.frombuffer(b"".join(part.column("rows").to_pylist()), _TOKENS)
    rows = rows[np.lexsort((rows["group"], rows["token"]))]
    starts = np.flatnonzero(np.concatenate([[True], rows["token"][1:] != rows["token"][:-1]]))
    ends = np.append(starts[1:], len(rows))
    good = rows["group"][starts] != rows["group"][ends - 1]
    keep = np.repeat(good, ends - starts)
    rows, lengths = rows[keep], (ends - starts)[good]
    ends = np.cumsum(lengths)
    packed: list[bytes] = []
    own: list[int] = []
    begin = 0
    for start, end in zip((ends - lengths).tolist(), ends.tolist()):
        if end - start > RUN_TILE:
            if start > begin:
                packed.append(rows[begin:start].tobytes())
                own.append(start - begin)
            for first in range(start, end, RUN_TILE):
                packed.append(rows[first:end].tobytes())
                own.append(min(RUN_TILE, end - first))
            begin = end
        elif end - begin >= 8 * RUN_TILE:
            packed.append(rows[begin:end].tobytes())
            own.append(end - begin)
            begin = end
    if len(rows) > begin:
        packed.append(rows[begin:].tobytes())
        own.append(len(rows) - begin)
    return pa.table({"own": pa.array(own, pa.int32()), "rows": pa.array(packed, pa.binary())})


def _possible(batches, threshold: float) -> Iterator[pa.RecordBatch]:
    """Pairs of different groups that share a rare shingle, and whose sizes and places of it allow a link."""
    for batch in batches:
        for own, data in zip(batch.column("own").to_pylist(), batch.column("rows").to_pylist()):
            rows = np.frombuffer(data, _TOKENS)
            size, left = rows["size"].astype(np.int64), (rows["size"] - rows["pos"]).astype(np.int64)
            at, step = np.arange(own), 0
            found: list[np.ndarray] = []
            held = 0
            while len(at):
                step += 1
                at = at[at + step < len(rows)]
                at = at[rows["token"][at] == rows["token"][at + step]]
                to = at + step
                need = threshold / (1 + threshold) * (size[at] + size[to]) - 1e-6
                hit = (rows["group"][at] != rows["group"][to]) & (np.minimum(left[at], left[to]) >= need)
                hit &= np.minimum(size[at], size[to]) >= threshold * np.maximum(size[at], size[to]) - 1e-6
                a, b = rows["id"][at[hit]], rows["id"][to[hit]]
                found.append(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1))
                held += len(a)
                if held >= PREFIX_FLUSH:
                    yield _pair_rows(found)
                    found, held = [], 0
            if held:
                yield _pair_rows(found)


def _pair_rows(found: list[np.ndarray]) -> pa.RecordBatch:
    pairs = np.unique(np.concatenate(found), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])


def missed(sets: DataFrame, groups: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Pairs (a, b), a < b, that hold every link between sets of different groups, for (id, shingles) and (id, group).

    Two linked sets share one of their rarest shingles (prefix filter; any order common to all sets will do). Groups have
    been found before, so a shingle that only one group has costs nothing, however large the group is.
    """
    total = sets.agg(F.sum(F.octet_length("shingles"))).first()[0] or 0
    ranks = shingle_ranks(sets, min(max((total // 4 >> 5).bit_length(), 16), 24))
    blocks = max(1, math.ceil((1 - threshold) * total / 4 / PREFIX_BLOCK))
    shared = sets.sparkSession.sparkContext.broadcast(ranks)
    rows = sets.join(groups, "id", "left").select("id", F.coalesce("group", "id").alias("group"), "shingles")
    packed = in_arrow(rows, _prefixes, "block int, rows binary", shared, blocks, threshold)
    runs = stored(packed.groupBy("block").applyInArrow(_mixed, "own int, rows binary"))
    return in_arrow(runs.repartition("rows"), _possible, "a long, b long", threshold).distinct()


def verified(pairs: DataFrame, sets: DataFrame, threshold: float = THRESHOLD, store=stored) -> DataFrame:
    """(a, b, similarity) of the pairs that hold, for rows (id, shingles).

    The smaller ids bring their sets along, each set of a larger id goes once to where the pairs are; the second join is
    on shuffled sides, so that a set with many partners can be split off.
    """
    pairs = stored(pairs)
    left = pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("set_a")), "a")
    ends = pairs.select(F.col("b").alias("id")).distinct()
    right = sets.join(ends, "id").select(F.col("id").alias("b"), F.col("shingles").alias("set_b"))
    both = left.join(right, "b").select("a", "b", "set_a", "set_b")
    return store(in_arrow(both, _verify, "a long, b long, similarity double", threshold))


def components(links: DataFrame) -> DataFrame:
    """(id, group): the smallest id reachable over links (a, b), by alternating large and small stars."""
    edges = stored(links.select("a", "b"))
    seen = None
    while True:
        both = edges.union(edges.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("m").alias("a"), F.col("v").alias("b"))
        ).distinct()
        down = large.select(F.col("b").alias("u"), F.col("a").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        joined = down.join(least, "u")
        small = joined.select(F.col("m").alias("a"), F.col("v").alias("b")).union(joined.select("m", "u"))
        edges = stored(small.where(F.col("a") != F.col("b")).distinct())
        state = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == seen:
            return edges.select(F.col("b").alias("id"), F.col("a").alias("group"))
        seen = state


# Exact numbers of links


def _tile_links(a: list[int], b: list[int], codes: list[np.ndarray], sizes: np.ndarray, distinct: int, threshold: float):
    """Which sets of ``a`` are linked to which of ``b``, by the sizes of all intersections."""
    both = np.zeros((2, distinct), bool)
    for side, rows in enumerate((a, b)):
        for r in rows:
            both[side, codes[r]] = True
    shared = both.all(axis=0)
    place = np.cumsum(shared) - 1
    ends = []
    for rows in (a, b):
        column = np.concatenate([codes[r] for r in rows])
        row = np.repeat(np.arange(len(rows)), [len(codes[r]) for r in rows])
        keep = shared[column]
        column, row = place[column[keep]], row[keep]
        order = np.argsort(column, kind="stable")
        ends.append((column[order], row[order]))
    common = np.zeros((len(a), len(b)), np.float32)
    for first in range(0, int(shared.sum()), COLUMNS):
        dense = []
        for (column, row), rows in zip(ends, (a, b)):
            s, e = np.searchsorted(column, [first, first + COLUMNS])
            dense.append(np.zeros((len(rows), COLUMNS), np.float32))
            dense[-1][row[s:e], column[s:e] - first] = 1
        common += dense[0] @ dense[1].T
    common = common.astype(np.float64)
    union = sizes[a][:, None] + sizes[b][None, :] - common
    return common / union >= threshold - 1e-12


def count_links(sets: list[np.ndarray], side: np.ndarray, threshold: float) -> np.ndarray:
    """For every set the number of linked ones among the others; where there are two sides, only of the other side."""
    sizes = np.array([len(x) for x in sets])
    _, codes = np.unique(np.concatenate(sets), return_inverse=True)
    often = np.bincount(codes) > 1
    place = np.cumsum(often) - 1
    parts = np.split(codes, np.cumsum(sizes)[:-1])
    parts = [place[c[often[c]]] for c in parts]
    out = np.zeros(len(sets), np.int64)
    distinct = int(often.sum())
    left, right = np.flatnonzero(side == side.min()), np.flatnonzero(side == side.max())
    alone = side.min() == side.max()
    for i in range(0, len(left), TILE):
        for j in range(i if alone else 0, len(right), TILE):
            a, b = left[i : i + TILE].tolist(), right[j : j + TILE].tolist()
            links = _tile_links(a, b, parts, sizes, distinct, threshold)
            if alone and i == j:
                np.fill_diagonal(links, False)
                out[a] += links.sum(axis=1)
            else:
                out[a] += links.sum(axis=1)
                out[b] += links.sum(axis=0)
    return out


def _counting(threshold: float):
    def count(part: pa.Table) -> pa.Table:
        """(id, linked) of the groups in a bucket, or of one pair of blocks of a large group."""
        group, block = part.column("group").to_numpy(), part.column("block").to_numpy()
        order = np.argsort(group, kind="stable")
        cuts = np.flatnonzero(np.diff(group[order])) + 1
        sets = [np.frombuffer(x, "<u4") for x in part.column("shingles").to_pylist()]
        x, y = part.column("x")[0].as_py(), part.column("y")[0].as_py()
        linked = np.zeros(len(sets), np.int64)
        for own in np.split(order, cuts):
            # Two blocks of which one is empty have no pair.
            if len(own) > 1 and (x == y or len(np.unique(block[own])) == 2):
                linked[own] = count_links([sets[r] for r in own.tolist()], block[own], threshold)
        return pa.table({"id": part.column("id"), "linked": pa.array(linked)})

    return count


def degrees(sets: DataFrame, groups: DataFrame, threshold: float = THRESHOLD, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(id, linked): the exact number of links of every set in a group, for rows (id, shingles) and (id, group).

    Links never leave a group, so a group is compared with itself: small groups many a task, large ones as pairs of
    blocks. Only counts leave a task.
    """
    ids = groups.select("group", "id").union(groups.select("group", F.col("group").alias("id"))).distinct()
    members = stored(sets.join(ids, "id"))
    volume = members.groupBy("group").agg(F.sum(F.octet_length("shingles")).alias("bytes"))
    volume = stored(volume.withColumn("blocks", F.ceil(F.col("bytes") / block_bytes).cast("int")))
    small = volume.where("blocks = 1").agg(F.sum("bytes")).first()[0] or 0
    buckets = max(1, math.ceil(small / block_bytes))
    rows = members.join(volume.select("group", "blocks"), "group")
    block = F.pmod(F.xxhash64("id", F.lit("block")), F.col("blocks")).cast("int")
    rows = rows.withColumn("block", block)
    one = rows.where("blocks = 1").select(
        F.pmod(F.xxhash64("group"), F.lit(buckets)).alias("key"), F.lit(0).alias("x"), F.lit(0).alias("y"),
        F.lit(True).alias("bucket"), "group", "block", "id", "shingles",
    )
    other = rows.where("blocks > 1").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    many = other.select(
        F.col("group").alias("key"), F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"),
        F.lit(False).alias("bucket"), "group", "block", "id", "shingles",
    )
    counted = one.unionByName(many).groupBy("bucket", "key", "x", "y")
    ship_package(sets.sparkSession)
    counts = counted.applyInArrow(_counting(threshold), "id long, linked long")
    return counts.groupBy("id").agg(F.sum("linked").alias("linked"))


def _stored_sets(docs: DataFrame) -> tuple[DataFrame, str, str]:
    """doc_id, nameless, d1, d2, size of every document; name and path of the table of its sets (id, mins, shingles).

    The table is bucketed by id: joins on id move what they join to it, and not the sets.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), nameless().alias("nameless"), "text")
    with scope(spark):
        sketched = stored(in_arrow(rows, _sketch, _SKETCH))
        ids = kept(sketched.select("doc_id", "nameless", "d1", "d2", "size"))
        sets = sketched.where(F.col("shingles").isNotNull()).select(F.expr(_KEY), "mins", "shingles")
        volume = sets.agg(F.sum(F.octet_length("shingles") + F.octet_length("mins"))).first()[0] or 0
        # With fewer buckets than shuffles have partitions, Spark would rather move the sets.
        least = int(spark.conf.get("spark.sql.shuffle.partitions"))
        buckets = max(least, min(BUCKETS, math.ceil(volume / BUCKET_BYTES)))
        name = f"jaccard_sets_{uuid.uuid4().hex}"
        dealt = sets.repartition(buckets, "id").dropDuplicates(["id"])
        path = temporary_path(spark, name)
        dealt.write.bucketBy(buckets, "id").sortBy("id").option("path", path).format("parquet").saveAsTable(name)
    return ids, name, path


def _joined(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, counted: bool = True) -> DataFrame:
    """doc_id, nameless, class_id, n_links of every document, and text: which one stays of a group where none has an id.

    n_links is NULL where links are not ``counted``.
    """
    spark = docs.sparkSession
    with scope(spark):
        ids, name, path = _stored_sets(docs)
        try:
            groups, degree = _groups(spark.table(name), threshold, recall, counted)
        finally:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
            discard(spark, path.removesuffix("/data"))
        with_set = ids.where(F.col("d1").isNotNull())
        classes = with_set.groupBy("d1", "d2", "size").agg(
            F.min("doc_id").alias("doc_id"), F.min("nameless").alias("text"), F.count(F.lit(1)).alias("copies")
        ).selectExpr("*", _KEY)
        known = stored(
            classes.join(groups, "id", "left")
            .join(degree, "id", "left")
            .select(
                "d1", "d2", "size", "doc_id", "text", F.coalesce("group", "id").alias("group"),
                (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            )
        )
        heads = known.groupBy("group").agg(F.min("doc_id").alias("class_id"), F.min("text").alias("text"))
        known = known.drop("doc_id", "text").join(heads, "group").drop("group")
        columns = ["doc_id", "nameless", "class_id", "n_links", "text"]
        alone = ids.where(F.col("d1").isNull()).select(
            "doc_id", "nameless", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"),
            F.col("nameless").alias("text"),
        )
        found = with_set.join(known, ["d1", "d2", "size"]).select(columns).unionByName(alone)
        return kept(found if counted else found.withColumn("n_links", F.lit(None).cast("long")))


def _groups(sets: DataFrame, threshold: float, recall: float, counted: bool) -> tuple[DataFrame, DataFrame]:
    """(id, group) of linked sets and (id, linked), for rows (id, mins, shingles)."""
    full = sets.select("id", "shingles")
    groups = joined_by_paths(sets, threshold, recall)
    late = verified(missed(full, groups, threshold), full, threshold).select("a", "b")
    # A group is as well held by its links to its smallest member.
    held = groups.select(F.col("group").alias("a"), F.col("id").alias("b"))
    groups = stored(components(held.unionByName(late)))
    if not counted:
        return groups, groups.select("id", F.lit(0).cast("long").alias("linked")).where("false")
    return groups, stored(degrees(full, groups, threshold))


def join(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """doc_id, class_id, n_links of every document."""
    return _joined(docs, threshold, recall).select("doc_id", "class_id", "n_links")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The document with the smallest id of every group, with all its columns; one of a group where none has an id."""
    other = F.when(F.col("doc_id").isNotNull(), F.col("doc_id") != F.col("class_id")).otherwise(
        F.col("class_id").isNotNull() | (F.col("nameless") != F.col("text"))
    )
    stay = without(docs, _joined(docs, counted=False).where(other))
    # Equal texts without an id are copies, unless they have no word.
    copies = F.col("doc_id").isNull() & F.coalesce(F.col("text").rlike(A_WORD), F.lit(False))
    unnamed = stay.where(copies).withColumn("_nameless", nameless())
    return stay.where(~copies).unionByName(one_row_each(unnamed, "_nameless", docs.columns))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "documents"))
